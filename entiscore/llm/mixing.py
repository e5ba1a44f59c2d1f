"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Every document of a source expects ``target / source size`` copies.  The running
sum of these within the source, shifted by one random offset, crosses whole
numbers; a document is emitted once per crossing.  Documents are walked through
by size, so each stretch of similar sizes gets its share and the words taken stay
close to the target.

The running sum is a count times a constant, so it needs no sort of a whole
source: documents are counted by (source, size, cell), where the cell is one of
256 values of a hash of ``doc_id``; starts are summed over sizes and then over
cells, and only the documents of one cell are numbered together.

Edge cases: null text has size 0; a null source is a source of its own, placed
last; a source without words has target 0 and takes nothing; rows that share a
``doc_id`` are separate documents; null ``doc_id`` rows sort first in their cell;
an empty table gives no rows; columns of the caller that are named like an added
column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entiscore.llm.common import ROW, unpacked, word_count, written


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share_pct: int = 150,
                   most: int = 2) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows (one row per source).

    Sources, in code point order with null last, take the weights in turn and share
    ``share_pct`` percent of all sizes.  A target stops at ``most`` times its
    source's size and the excess goes to the others by weight: every open source
    ends at one common level times its weight.  In order of size over weight the
    stopped sources come first, so the level follows from running sums.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (nth % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    w = (by_source.withColumn("_nth", nth).withColumn("_w", weight.cast("long"))
         .withColumn("_cap", F.lit(most) * F.col("source_size"))
         .withColumn("_all", F.sum("source_size").over(everything) * F.lit(share_pct) / F.lit(100)))
    order = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("_nth").asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    w = (w.withColumn("_stopped", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
         .withColumn("_open", F.sum("_w").over(onward))
         .withColumn("_level", (F.col("_all") - F.col("_stopped")) / F.col("_open")))
    # the level rises up to the first open source (in this order) and falls after it
    is_open = F.col("_cap") > F.col("_level") * F.col("_w")
    first = F.max(F.when(is_open, F.col("_level"))).over(everything)
    w = w.withColumn("_at", first)
    target = F.when(F.col("_at").isNull(), F.col("_cap").cast("double")).otherwise(
        F.least(F.col("_cap").cast("double"), F.col("_at") * F.col("_w")))
    return w.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share_pct: int = 150, most: int = 2,
                seed: str = "mix", carry: list[str] | None = None) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies, taken``; 0 copies: not in the mix.

    ``carry`` names the columns of ``docs`` to return (all); without ``text`` among
    them the texts are read once and never shuffled.
    """
    carry = docs.columns if carry is None else carry
    text = F.coalesce("text", F.lit("")).cast("binary")
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW), F.col("source").alias("source"),
                        F.col("doc_id").alias("_id"), word_count(F.col("text")).alias("size"), F.crc32(text).alias("_tie"))
    cell = F.conv(F.substring(F.md5(F.coalesce(F.col("_id").cast("string"), F.lit(""))), 1, 2), 16, 10).cast("int")
    sized = sized.withColumn("_cell", cell)
    if "text" not in carry:
        sized = written(sized)

    cells = written(sized.groupBy("source", "size", "_cell").agg(F.count(F.lit(1)).alias("_n")))
    by_size = cells.groupBy("source", "size").agg(F.sum("_n").alias("_m"))
    targets = source_targets(cells.select("source", (F.col("size") * F.col("_n")).alias("size")), weights, share_pct, most)
    in_source = Window.partitionBy("source").orderBy("size")
    by_size = by_size.withColumn("_from", F.sum("_m").over(in_source) - F.col("_m"))
    by_size = by_size.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        "s.source", "s.size", "s._from", "t.source_size", "t.target")
    in_size = Window.partitionBy("source", "size").orderBy("_cell")
    starts = cells.withColumn("_start", F.sum("_n").over(in_size) - F.col("_n"))
    starts = starts.alias("c").join(
        by_size.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")) & (F.col("c.size") == F.col("s.size"))
    ).select(F.col("c.source").alias("_source"), F.col("c.size").alias("_size"), F.col("c._cell").alias("_c"),
             (F.col("_from") + F.col("_start")).alias("_start"), "source_size", "target")

    same = (F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size"))
            & (F.col("_cell") == F.col("_c")))
    in_cell = Window.partitionBy("source", "size", "_cell").orderBy(F.col("_id").asc_nulls_first(), "_tie")
    ranked = sized.join(starts, same).withColumn("_rank", F.col("_start") + F.row_number().over(in_cell))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # one offset per source: 16 bits of a hash, so that whole multiples stay exact in a double
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("source"), F.lit("")))), 1, 4),
                    16, 10).cast("double") / F.lit(65536.0)
    crossed = (F.floor(F.col("_each") * F.col("_rank") + F.col("_u"))
               - F.floor(F.col("_each") * (F.col("_rank") - 1) + F.col("_u")))
    out = ranked.withColumn("_each", each).withColumn("_u", offset).withColumn("_copies", crossed.cast("long"))
    return unpacked(out, {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"),
                          "copies": F.col("_copies"), "taken": F.col("_copies") * F.col("size")})


def emit_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: ``columns`` of each document once per copy."""
    return mixed.where("copies > 0").select(
        *[F.col(f"`{c}`") for c in columns],
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_mix_copy_no")).drop("_mix_copy_no")
