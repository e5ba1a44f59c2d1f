"""Registered queries of the training-data operators: ``name -> (spark, sf_dir) -> DataFrame``.

Each applies its operator, with production parameters, to the whole table and
derives the columns of its result from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entiscore.llm import (
    ann, ball_search, divergence, jaccard, labelled, langid, line_dedup, mixing, packing, quality, quality_rules, spelling,
    substring_dedup, toxicity)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def q_nearest(spark, sf_dir):
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def q_line_dedup(spark, sf_dir):
    """Per document: lines, lines removed, and the hash of the text that is left."""
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed",
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def q_substring_dedup(spark, sf_dir):
    out = substring_dedup.dedup_substrings(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def q_quality_rules(spark, sf_dir):
    entries = quality_rules.apply_policy(quality_rules.ledger(read(spark, sf_dir, "documents")))
    base_failed = ~quality_rules.passes(quality_rules.BASE)
    return entries.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          base_failed.alias("base_failed"), (F.col("kept") & ~base_failed).alias("kept"),
                          "failed", "n_upper", "n_letters")


def q_best_fit_packing(spark, sf_dir):
    return packing.best_fit_pack(read(spark, sf_dir, "documents"), vocabulary())


def q_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    score = F.col("score")
    return toxicity.score_documents(docs, model).select(
        "doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), score,
        (score >= 0.3).cast("int").alias("predicted"))


def q_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held_out = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def q_mixing(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return mixing.mix_sources(docs, carry=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken", "copies")


def q_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    score = F.col("score")
    return quality.score_documents(docs, model).select(
        "doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), score,
        (score >= 0.7).cast("int").alias("predicted"))


def q_jaccard_join(spark, sf_dir):
    return jaccard.jaccard_classes(read(spark, sf_dir, "documents"))


def q_jaccard_links(spark, sf_dir):
    """Per document the number of documents it is linked with, every link verified."""
    return jaccard.link_counts(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "n_links")


def q_spelling_variants(spark, sf_dir):
    return spelling.variant_groups(spelling.word_counts(read(spark, sf_dir, "documents")))


def q_exact_top_k(spark, sf_dir):
    return ball_search.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def q_source_divergence(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_nearest": q_nearest,
        "op2_line_dedup": q_line_dedup,
        "op3_substring_dedup": q_substring_dedup,
        "op4_quality_rules": q_quality_rules,
        "op5_best_fit_packing": q_best_fit_packing,
        "op6_toxicity": q_toxicity,
        "op7_language_id": q_language_id,
        "op8_mixing": q_mixing,
        "op9_quality": q_quality,
        "op10_jaccard_join": q_jaccard_join,
        "jaccard_links": q_jaccard_links,
        "op11_spelling_variants": q_spelling_variants,
        "op12_exact_top_k": q_exact_top_k,
        "op13_source_divergence": q_source_divergence,
    }
