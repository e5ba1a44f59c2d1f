"""Connected components of an edge list by min labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.llm.common import let_go, stored, written


def connected_components(edges: DataFrame) -> DataFrame:
    """``v, label`` for every node of ``a, b`` rows (long): the smallest node it is joined to.

    Each round takes the least label among the neighbours (combined before the
    shuffle, so a node with very many neighbours costs one row a task) and then the
    label of that label; it ends when no label changes.  Every round is written to
    the shared folder and the one before it let go.
    """
    spark = edges.sparkSession
    both, both_at = stored(edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels, at = stored(both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m")).select(
        "v", F.col("v").alias("old"), F.least("v", "m").alias("label")), "labels")
    while labels.where("label <> old").limit(1).count():
        near = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(
            F.col("a").alias("v")).agg(F.min("label").alias("m"))
        step = labels.select("v", F.col("label").alias("old")).join(near, "v").select(
            "v", "old", F.least("old", "m").alias("label"))
        jump = step.select(F.col("v").alias("label"), F.col("label").alias("next"))
        moved, then = stored(step.join(jump, "label").select("v", "old", F.col("next").alias("label")), "labels")
        let_go(spark, at)
        labels, at = moved, then
    result = written(labels.select("v", "label"))
    let_go(spark, at)
    let_go(spark, both_at)
    return result
