"""Label operators: join known labels to features, split train/predict, publish.

Labels are ``entity_id, label`` with label 1/0.  Conflicting labels for one
entity are dropped and equal duplicates collapsed (one partial aggregate, so a
hot entity costs one row per map task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entiscore.functions.text import jvm_trim


def clean_labels(labels: DataFrame, entity_col: str = "entity_id", label_col: str = "label") -> DataFrame:
    """One ``(entity_id, label double)`` row per entity whose labels agree; rows whose
    label is empty or no number are dropped."""
    norm = labels.select(jvm_trim(F.col(entity_col).cast("string")).alias("entity_id"),
                         jvm_trim(F.col(label_col).cast("string")).try_cast("double").alias("label"))
    agg = norm.where(F.col("label").isNotNull()).groupBy("entity_id").agg(
        F.min("label").alias("_lo"), F.max("label").alias("_hi"))
    return agg.where(F.col("_lo") == F.col("_hi")).select("entity_id", F.col("_lo").alias("label"))


def labeled_features(labels: DataFrame, features: DataFrame, label_col: str = "label",
                     features_col: str = "features") -> DataFrame:
    """Known labels with their non-empty feature text, plus the text line.

    Written as the left join with a not-null filter; Catalyst turns it into an
    inner join.  ``line`` is ``"<label> <features>"`` with an integer label,
    the sparse text sink's format.
    """
    j = labels.join(features, "entity_id", "left")
    kept = j.where(F.col(features_col).isNotNull() & (F.length(F.col(features_col)) > 0))
    label_text = F.col(label_col).cast("double").cast("int").cast("string")
    return kept.select("entity_id", F.col(label_col).cast("int").alias("label"),
                       F.col(features_col).alias("features"),
                       F.concat_ws(" ", label_text, F.col(features_col)).alias("line"))


def split_train_predict(labels: DataFrame, features: DataFrame) -> DataFrame:
    """Tag every entity with features: ``train`` (known label) or ``predict``.

    Entities with a label but no features carry no information and are left
    out, so one left join on the feature side does the work of the full outer
    join.  Returns ``entity_id, label, features, role`` (plus any other
    feature columns, e.g. index arrays).
    """
    clean = clean_labels(labels)
    feats = features.where(F.col("features").isNotNull() & (F.length("features") > 0))
    j = feats.join(clean, "entity_id", "left")
    role = F.when(F.col("label").isNull(), F.lit("predict")).otherwise(F.lit("train"))
    extra = [c for c in features.columns if c not in ("entity_id", "features")]
    return j.select("entity_id", "label", "features", *extra, role.alias("role"))


def train_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("role") == "train").drop("role")


def predict_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("role") == "predict").drop("role")


def class_counts(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Row count per class in one aggregate: ``n, n1, n0``."""
    lab = F.col(label_col).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.count_if(lab == 1.0).alias("n1"),
                  F.count_if(lab == 0.0).alias("n0"))


def label_profile(df: DataFrame, label_col: str = "label", measures: list[str] | None = None) -> DataFrame:
    """``GROUP BY label`` with the average of each measure (``avg_<m>``)."""
    measures = measures or [c for c in df.columns if c != label_col]
    return df.groupBy(label_col).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col(m)).alias(f"avg_{m}") for m in measures])


def assign_classes(labeled: DataFrame, scored: DataFrame, threshold: float,
                   names: tuple[str, str] = ("1", "0"), score_col: str = "score") -> DataFrame:
    """Final classes: known labels as they are, the rest by ``score > threshold``.

    Returns ``entity_id, class, source`` (``known`` / ``model``).
    """
    pos, neg = names
    known = labeled.select("entity_id",
                           F.when(F.col("label").cast("double") == 1.0, F.lit(pos)).otherwise(F.lit(neg)).alias("class"),
                           F.lit("known").alias("source"))
    model = scored.select("entity_id",
                          F.when(F.col(score_col) > F.lit(float(threshold)), F.lit(pos)).otherwise(F.lit(neg)).alias("class"),
                          F.lit("model").alias("source"))
    return known.unionByName(model)
