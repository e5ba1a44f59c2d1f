"""Write PLANS.md: the physical plan shape of every registered query.

For each query: shuffles (hash / range / single-partition exchanges),
broadcasts, windows (partitioned or not), generators, aggregates and the
scanned columns.  Run: python tests/plan_report.py [sf_dir]
"""

from __future__ import annotations

import re
import sys
import time

sys.path.insert(0, ".")


def shape(plan: str) -> dict:
    lines = plan.split("\n")
    out = {
        "hash_exchanges": sum(1 for l in lines if "Exchange hashpartitioning" in l),
        "range_exchanges": sum(1 for l in lines if "Exchange rangepartitioning" in l),
        "single_partition": sum(1 for l in lines if "Exchange SinglePartition" in l),
        "broadcasts": sum(1 for l in lines if "BroadcastExchange" in l),
        "windows": sum(1 for l in lines if re.search(r"\bWindow \[", l)),
        "generate": sum(1 for l in lines if "Generate " in l),
        "take_ordered": sum(1 for l in lines if "TakeOrderedAndProject" in l),
        "joins": sorted({m.group(0) for l in lines for m in re.finditer(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", l)}),
        "schemas": sorted({m.group(1) for l in lines for m in re.finditer(r"ReadSchema: (struct<[^>]*>)", l)}),
    }
    return out


def main() -> None:
    import __spark_entry__ as E
    from entiscore.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    rows = []
    for name, fn in E.queries().items():
        t0 = time.time()
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        rows.append((name, s, round(time.time() - t0, 1)))
    with open("PLANS.md", "w") as fh:
        fh.write("# Plan shapes of the registered queries\n\n")
        fh.write(f"Generated by `tests/plan_report.py` on `{sf_dir}` (AQE final plans of the returned "
                 "DataFrame; eager steps inside a query — checkpoints, ≤K collects, model fits — are "
                 "separate jobs not shown).  Single-partition exchanges only ever feed aggregates "
                 "of ≤ K / ≤ 101 / ≤ buckets rows or final one-row aggregates.\n\n")
        fh.write("| query | hash shuffles | single-partition | broadcasts | windows | joins | generate | top-k | scanned columns |\n")
        fh.write("| --- | --- | --- | --- | --- | --- | --- | --- | --- |\n")
        for name, s, _ in rows:
            cols = "; ".join(x.replace("struct<", "").replace(">", "") for x in s["schemas"])
            fh.write(f"| {name} | {s['hash_exchanges'] + s['range_exchanges']} | {s['single_partition']} | "
                     f"{s['broadcasts']} | {s['windows']} | {', '.join(s['joins']) or '-'} | {s['generate']} | "
                     f"{s['take_ordered']} | {cols} |\n")
    spark.stop()


if __name__ == "__main__":
    main()
