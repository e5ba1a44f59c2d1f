"""Bounded samples of labelled documents for the two-class operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.llm.common import class_sample, fold, written

#: Documents whose crc32(doc_id as text) mod 4 is 2 are never learned from.
PARTS, HELD_OUT = 4, 2


def held_out(doc_id):
    return fold(doc_id, PARTS) == HELD_OUT


def known_labels(labels: DataFrame, label: str) -> DataFrame:
    """``_id, _y`` of the labelled documents outside the held-out part; documents with both values go."""
    own = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("_y"))
    own = own.where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("_id")))
    return (own.groupBy("_id").agg(F.min("_y").alias("_y"), F.max("_y").alias("_top"))
            .where("_y = _top").select("_id", "_y"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int,
                    seed: str) -> tuple[DataFrame, float]:
    """``_id, _y, text`` of about ``per_class`` documents a class (twice that at most in all),
    and the share of label 1 among all labelled documents outside the held-out part."""
    known = known_labels(labels, label)
    picked = written(class_sample(known, "_y", "_id", per_class, seed, few=True))     # 0 and 1
    share = known.agg(F.avg("_y")).first()[0]
    # at most 2 * per_class rows: bounded, whatever the input
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(picked), "_id").dropDuplicates(["_id"])
    return rows.select("_id", "_y", "text"), 0.5 if share is None else float(share)
