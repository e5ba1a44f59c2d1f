"""Compare registered queries with their DuckDB oracle (like the driver does).

Usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, ".")

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return int(v) if v.is_integer() else round(v, 6)      # a column with nulls comes as floats on one side
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(repr(_norm(x)) for x in rec))
    return cols, sorted(out)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main():
    import __spark_entry__ as E
    from entiscore.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SPARK ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:32s} rows-only {len(sdf)} rows  {ts:.1f}s")
            continue
        try:
            ddf = con.sql(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"{name:32s} SQL ERROR {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = rows_of(sdf)
        dc, dr = rows_of(ddf)
        ok = sc == dc and sr == dr
        if not ok:
            bad += 1
            print(f"{name:32s} MISMATCH spark {len(sr)} rows {sc} | duck {len(dr)} rows {dc}")
            diff_s = [r for r in sr if r not in set(dr)][:3]
            diff_d = [r for r in dr if r not in set(sr)][:3]
            print("   spark-only:", diff_s)
            print("   duck-only: ", diff_d)
        else:
            print(f"{name:32s} ok {len(sr)} rows  {ts:.1f}s")
    print("bad:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
