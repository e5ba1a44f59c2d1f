"""The training-data pipeline over ``documents``: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's ``docs``; all but the last return the
columns of ``documents`` (other columns of the input go along).

1. ``language_id``: the string-kernel classifier, fitted on the documents with a
   known language.  It rejects texts without a letter, and texts whose best language is
   hardly likelier than chance (below ``LEAST_ODDS`` over the number of languages: none of the
   languages it knows).  Where no document has a language there is nothing to be told apart,
   and every text with a letter stays.
2. ``line_dedup``: lines of three-line windows that start earlier in the corpus go;
   ``n_chars`` follows the text.  Documents stay, if need be without text.
3. ``jaccard_join``: of documents linked by 5-word shingles at a similarity of 0.8 or
   more, that of the smallest ``doc_id`` stays.
4. ``mixing``: each document as often as the systematic sample takes it.
5. ``best_fit_packing``: the pieces of all documents with their sequences.

Edge cases are those of the operators; an empty table passes through as an empty
result.  SQL cannot express the first stage (a fitted classifier), so there is no
``ORACLE_SQL``; tests compare every stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiscore.llm import jaccard, langid, line_dedup, mixing, packing
from entiscore.llm.common import ROW, field, modest_batches, packed, unpacked
from entiscore.llm.queries import read, vocabulary
from entiscore.session import scratch_path


#: A text stays if its best language is this many times as likely as chance (one known language: no such test).
LEAST_ODDS = 1.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs)
    rows = packed(docs)
    if model.languages:
        modest_batches(spark)
        told = rows.select(ROW, langid.verdict(field("text"), model).alias("_p"))
        rows = told.where((F.col("_p.lang_pred") != langid.UNKNOWN)
                          & (F.col("_p.score") >= min(LEAST_ODDS / len(model.languages), 1.0)))
    else:
        rows = rows.where(field("text").rlike("\\p{L}"))
    return unpacked(rows.select(ROW), {})


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit_copies(mixing.mix_sources(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(docs, vocabulary())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("jaccard_join", one_of_each),
    ("mixing", mix),
    ("best_fit_packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
