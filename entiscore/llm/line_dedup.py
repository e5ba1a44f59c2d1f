"""Line deduplication by overlapping three-line windows (DataFrame functions only).

A text is cut at ``\\n``.  Every run of three consecutive lines is a window, named
by 128 bits of hash.  A window found more than once in the corpus is kept where it
starts first, in the order (doc_id, line); at each later start its lines are
covered, and the covered positions of a document, merged, are removed.  Windows
whose lines all lack a word do not count.

Spark sees one row per window: counts and smallest doc_id combine before the
shuffle, and only windows found twice are joined back, in a join that adaptive
execution splits where one window is very frequent.  A document's covered
positions are at most its own lines.

Edge cases: null text stays null, with 0 lines; texts of fewer lines than a
window are kept whole; a text whose lines all go becomes empty; rows with equal
``doc_id`` do not remove each other's lines (a repeat inside one text still
goes) and repeated rows are treated alike; a null ``doc_id`` counts as larger
than every number; an empty table gives no rows; columns of the caller that are
named like an added column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entiscore.llm.common import ROW, WORD_SPACE, field, once, packed, unpacked, written

#: A null doc_id in the order of documents.
LAST = 2**63 - 1


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _windows(lines: Column, size: int) -> Column:
    """Starts and hashes of the windows that hold a word; ``lines`` must be a stored column."""
    def window(i: Column) -> Column:
        own = [lines[i + k] for k in range(size)]
        return F.struct(i.alias("pos"), F.xxhash64(*own).alias("h1"), F.xxhash64(F.lit("window"), *own).alias("h2"),
                        (F.btrim(F.concat(*own), F.lit(WORD_SPACE)) != "").alias("said"))

    n = F.size(lines)
    return F.when(n >= size, F.filter(F.transform(F.sequence(F.lit(0), n - size), window), lambda w: w["said"]))


def dedup_lines(docs: DataFrame, window: int = 3) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, and ``n_lines, n_removed`` (long)."""
    rows = packed(docs).select(ROW, F.coalesce(field("doc_id").cast("long"), F.lit(LAST)).alias("_id"),
                               F.xxhash64(field("text")).alias("_key"), _lines(field("text")).alias("_lines"))

    found = rows.select("_id", "_key", F.explode(_windows(F.col("_lines"), window)).alias("w")).select(
        "_id", "_key", "w.h1", "w.h2", "w.pos")
    # written before it is joined back: the join then shuffles both sides itself, and adaptive
    # execution can split a window that very many documents hold
    repeated = written(found.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
                       .where("_n > 1").select("h1", "h2", "_first"))
    starts = found.join(repeated, ["h1", "h2"]).groupBy("_id", "_key").agg(
        F.collect_set(F.struct("h1", "h2", "pos", (F.col("_id") > F.col("_first")).alias("later"))).alias("_found"))
    # inside one text: later starts follow the first one in the order (hash, position)
    later = once(F.array_sort("_found"), lambda s: F.filter(s, lambda x, i: x["later"] | (
        (i > 0) & (F.get(s, i - 1)["h1"] == x["h1"]) & (F.get(s, i - 1)["h2"] == x["h2"]))))
    covered = starts.select(F.col("_id").alias("_cid"), F.col("_key").alias("_ckey"),
                            F.array_sort(F.transform(later, lambda x: x["pos"])).alias("_starts"))
    covered = covered.where(F.size("_starts") > 0)

    joined = rows.select(ROW, "_id", "_key").join(
        covered, (F.col("_id") == F.col("_cid")) & (F.col("_key") == F.col("_ckey")), "left")
    # kept stretches: from the end of one covered window to the start of the next
    zero = F.array(F.lit(0))
    joined = joined.select(ROW, "_starts", _lines(field("text")).alias("_lines")).withColumn(
        "_n", F.coalesce(F.size("_lines"), F.lit(0)))
    ends = F.concat(zero, F.transform("_starts", lambda s: s + window))
    begins = F.concat(F.col("_starts"), F.array(F.col("_n")))
    stretches = F.filter(F.arrays_zip(ends.alias("e"), begins.alias("b")), lambda x: x["b"] > x["e"])
    kept = F.flatten(F.transform(stretches, lambda x: F.slice(F.col("_lines"), x["e"] + 1, x["b"] - x["e"])))
    out = joined.withColumn("_kept", F.when(F.col("_starts").isNotNull(), kept))
    text = F.when(F.col("_starts").isNull(), field("text")).otherwise(F.array_join("_kept", "\n"))
    n = F.when(field("text").isNull(), F.lit(0)).otherwise(F.col("_n")).cast("long")
    removed = F.when(F.col("_starts").isNull(), F.lit(0)).otherwise(F.col("_n") - F.size("_kept")).cast("long")
    return unpacked(out, {"n_lines": n, "n_removed": removed}, {"text": text})
