"""Binary-classification metrics as DataFrame queries.

``scored`` frames have a ``label`` (1 positive / 0 negative, or any value
above 0.5 for the curves) and a ``score`` column.

* :func:`threshold_sweep` — confusion counts at fixed thresholds (``score > t``
  is positive), precision and recall ("coverage") of both classes and their
  geometric mean; one aggregate over the data instead of four counts per
  threshold.
* :func:`metrics_by_threshold`, :func:`roc_curve`, :func:`pr_curve`,
  :func:`area_under_roc`, :func:`area_under_pr` — one point per distinct
  score, ``score >= t`` is positive, no binning; areas by trapezoids.
* :func:`accuracy`, :func:`class_recall`, :func:`match_counts`,
  :func:`evaluate_binary` — hard-prediction summaries.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entiscore.functions.literals import double_array
from entiscore.functions.numeric import safe_div
from entiscore.operators.cumulative import descending_cumsum
from entiscore.session import checkpointed

# The sweep grid: 0.01, 0.02, …, 0.99.
DEFAULT_THRESHOLDS = [i / 100 for i in range(1, 100)]


# ------------------------------------------------------------------ threshold sweep

def threshold_sweep(scored: DataFrame, thresholds: list[float] | None = None,
                    score_col: str = "score", label_col: str = "label") -> DataFrame:
    """Confusion counts and rates at each threshold.

    Returns ``threshold, n11, n10, n00, n01, pre1, pre0, cov1, cov0, gmean``
    where ``n11`` = label 1 and score > t, ``n10`` = label 1 and score ≤ t (and
    likewise for label 0), ``pre`` = precision and ``cov`` = recall of the class,
    ``gmean = sqrt(cov1 * cov0)``.  Ratios with a zero denominator are 0.

    Plan: each row gets m = number of thresholds strictly below its score
    (binary search, exact comparison), one grouped count by (m, label) runs
    over the data, and the per-threshold counts are suffix sums over at most
    ``len(thresholds) + 2`` rows.
    """
    spark = scored.sparkSession
    ts = sorted({float(t) for t in (thresholds or DEFAULT_THRESHOLDS)})
    score = F.col(score_col).cast("double")
    staged = scored.select(score.alias("_s"), F.col(label_col).cast("double").alias("_l"))
    bucketed = Bucketizer(splits=[-math.inf] + ts + [math.inf], inputCol="_s", outputCol="_b",
                          handleInvalid="keep").transform(staged)
    # Bucketizer gives #thresholds <= score; drop one when the score equals a threshold.
    # Null / NaN scores compare false both ways: they only count in the class totals.
    b = F.col("_b").cast("int")
    grid_arr = double_array(ts)
    at = F.element_at(grid_arr, F.greatest(b, F.lit(1)))
    m = (F.when(F.col("_s").isNull() | F.isnan(F.col("_s")), F.lit(-1))
         .when((b >= 1) & (at == F.col("_s")), b - 1)
         .otherwise(b))
    counts = (bucketed.select(m.alias("m"), "_l")
              .groupBy("m")
              .agg(F.count_if(F.col("_l") == 1.0).alias("c1"), F.count_if(F.col("_l") == 0.0).alias("c0")))
    # Attach the grid by union + group (no join): m = i is threshold i's slot.
    grid = spark.createDataFrame([(i + 1, t, 0, 0) for i, t in enumerate(ts)],
                                 "m int, threshold double, c1 long, c0 long")
    j = (counts.select("m", F.lit(None).cast("double").alias("threshold"), "c1", "c0")
         .unionByName(grid)
         .groupBy("m").agg(F.max("threshold").alias("threshold"), F.sum("c1").alias("c1"),
                           F.sum("c0").alias("c0")))
    suffix = Window.orderBy(F.desc("m")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.orderBy(F.desc("m")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = j.select(
        "m", "threshold",
        F.sum("c1").over(suffix).alias("n11"),
        F.sum("c0").over(suffix).alias("n01"),
        F.sum(F.when(F.col("m") >= 0, F.col("c1")).otherwise(0)).over(every).alias("valid1"),
        F.sum(F.when(F.col("m") >= 0, F.col("c0")).otherwise(0)).over(every).alias("valid0"),
        F.sum("c1").over(every).alias("num1"),
        F.sum("c0").over(every).alias("num0"),
    ).where(F.col("threshold").isNotNull())
    n11, n01 = F.col("n11").cast("long"), F.col("n01").cast("long")
    n10 = (F.col("valid1") - F.col("n11")).cast("long")
    n00 = (F.col("valid0") - F.col("n01")).cast("long")
    out = s.select("threshold", n11.alias("n11"), n10.alias("n10"), n00.alias("n00"), n01.alias("n01"),
                   F.col("num1"), F.col("num0"))
    out = out.select(
        "threshold", "n11", "n10", "n00", "n01",
        safe_div(F.col("n11"), F.col("n11") + F.col("n01")).alias("pre1"),
        safe_div(F.col("n00"), F.col("n00") + F.col("n10")).alias("pre0"),
        safe_div("n11", "num1").alias("cov1"),
        safe_div("n00", "num0").alias("cov0"),
    )
    return out.withColumn("gmean", F.sqrt(F.col("cov1") * F.col("cov0")))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The threshold with the highest ``gmean`` (> 0), the lowest one on ties."""
    return sweep.where(F.col("gmean") > 0).orderBy(F.desc("gmean"), F.asc("threshold")).limit(1)


def prune_positives(scored: DataFrame, threshold: float, score_col: str = "score",
                    label_col: str = "label") -> DataFrame:
    """Keep every negative and the positives scored at or above ``threshold``."""
    lab = F.col(label_col).cast("double")
    return scored.where((lab == 1.0) & (F.col(score_col) >= F.lit(float(threshold))) | (lab == 0.0))


# ------------------------------------------------------------------- curve metrics

def _curve_base(scored: DataFrame, score_col: str, label_col: str,
                num_buckets: int | None = None, materialize: bool = True) -> DataFrame:
    """One row per distinct score: ``score, pos, neg, tp, fp, P, N`` (tp/fp inclusive).

    The per-score counts are read three times (quantile sketch, range totals,
    running sums); ``materialize`` writes them once with ``checkpoint()`` so the
    scored rows (often a model's output) are computed and scanned only once.
    """
    positive = F.col(label_col).cast("double") > 0.5
    counts = (scored.select(F.col(score_col).cast("double").alias("score"), positive.alias("_p"))
              .where(F.col("score").isNotNull())         # a missing score is no point of any curve
              .groupBy("score")
              .agg(F.count_if(F.col("_p")).alias("pos"), F.count_if(~F.col("_p")).alias("neg")))
    if materialize:
        counts = checkpointed(counts)
    c = descending_cumsum(counts, "score", ["pos", "neg"], num_buckets)
    return c.select("score", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                    F.col("total_pos").alias("P"), F.col("total_neg").alias("N"))


def _precision(tp: str = "tp", fp: str = "fp"):
    return F.when((F.col(tp) + F.col(fp)) == 0, F.lit(1.0)).otherwise(
        F.col(tp).cast("double") / (F.col(tp) + F.col(fp)))


def _f_measure(p, r, beta: float):
    b2 = float(beta) * float(beta)
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(F.lit(1.0 + b2) * (p * r / (F.lit(b2) * p + r)))


def metrics_by_threshold(scored: DataFrame, beta: float = 1.0, score_col: str = "score",
                         label_col: str = "label", num_buckets: int | None = None) -> DataFrame:
    """Per distinct score t: ``threshold, tp, fp, precision, recall, fpr, f_measure``."""
    base = _curve_base(scored, score_col, label_col, num_buckets)
    p = _precision()
    r = safe_div("tp", "P")
    out = base.select(F.col("score").alias("threshold"), F.col("tp").cast("long").alias("tp"),
                      F.col("fp").cast("long").alias("fp"), p.alias("precision"), r.alias("recall"),
                      safe_div("fp", "N").alias("fpr"))
    return out.withColumn("f_measure", _f_measure(F.col("precision"), F.col("recall"), beta))


def roc_curve(scored: DataFrame, score_col: str = "score", label_col: str = "label",
              num_buckets: int | None = None) -> DataFrame:
    """``threshold, fpr, tpr``: (0,0), one point per distinct score, (1,1)."""
    base = _curve_base(scored, score_col, label_col, num_buckets)
    pts = base.select(F.col("score").alias("threshold"), safe_div("fp", "N").alias("fpr"),
                      safe_div("tp", "P").alias("tpr"))
    spark = scored.sparkSession
    ends = spark.createDataFrame([(None, 0.0, 0.0), (None, 1.0, 1.0)], "threshold double, fpr double, tpr double")
    return ends.unionByName(pts)


def pr_curve(scored: DataFrame, score_col: str = "score", label_col: str = "label",
             num_buckets: int | None = None) -> DataFrame:
    """``threshold, recall, precision``: (0, first precision), then one point per score."""
    base = _curve_base(scored, score_col, label_col, num_buckets)
    pts = base.select(F.col("score").alias("threshold"), safe_div("tp", "P").alias("recall"),
                      _precision().alias("precision"), ((F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))).alias("_first"))
    # the highest score also gives the start point: one pass over the curve
    own = F.struct("threshold", "recall", "precision")
    start = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"), F.col("precision"))
    points = F.when(F.col("_first"), F.array(start, own)).otherwise(F.array(own))
    return pts.select(F.explode(points).alias("p")).select("p.threshold", "p.recall", "p.precision")


def area_under_roc(scored: DataFrame, score_col: str = "score", label_col: str = "label",
                   num_buckets: int | None = None) -> DataFrame:
    """Trapezoid area under (0,0) → points → (1,1); one row ``area_under_roc``.

    Each distinct score adds ``(neg/N) * (tpr + previous tpr) / 2`` where the
    previous tpr is ``(tp - pos)/P``, so no lag (and no global order) is needed.
    """
    base = _curve_base(scored, score_col, label_col, num_buckets)
    dx = safe_div("neg", "N")
    y = safe_div("tp", "P")
    y_prev = safe_div(F.col("tp") - F.col("pos"), F.col("P"))
    seg = base.select((dx * (y + y_prev) / 2.0).alias("a"),
                      safe_div("fp", "N").alias("x"), y.alias("y"),
                      ((F.col("tp") == F.col("P")) & (F.col("fp") == F.col("N"))).alias("_last"))
    agg = seg.agg(F.sum("a").alias("a"),
                  F.max(F.when(F.col("_last"), F.col("x"))).alias("xl"),
                  F.max(F.when(F.col("_last"), F.col("y"))).alias("yl"))
    tail = (F.lit(1.0) - F.col("xl")) * (F.col("yl") + F.lit(1.0)) / 2.0
    return agg.select((F.col("a") + tail).alias("area_under_roc"))


def area_under_pr(scored: DataFrame, score_col: str = "score", label_col: str = "label",
                  num_buckets: int | None = None) -> DataFrame:
    """Trapezoid area under (0, first precision) → points; one row ``area_under_pr``."""
    base = _curve_base(scored, score_col, label_col, num_buckets)
    dr = safe_div("pos", "P")
    p = _precision()
    prev_tp = F.col("tp") - F.col("pos")
    prev_fp = F.col("fp") - F.col("neg")
    p_prev = F.when((prev_tp + prev_fp) == 0, p).otherwise(prev_tp.cast("double") / (prev_tp + prev_fp))
    return base.select((dr * (p + p_prev) / 2.0).alias("a")).agg(F.sum("a").alias("area_under_pr"))


# ------------------------------------------------------------- hard predictions

def accuracy(predictions: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """``n, correct, accuracy, error`` in one aggregate."""
    hit = F.col(label_col).cast("double") == F.col(prediction_col).cast("double")
    agg = predictions.agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("correct"))
    acc = safe_div("correct", "n")
    return agg.select("n", "correct", acc.alias("accuracy"), (F.lit(1.0) - acc).alias("error"))


def class_recall(predictions: DataFrame, positive: float = 1.0, label_col: str = "label",
                 prediction_col: str = "prediction") -> DataFrame:
    """Share of rows of class ``positive`` predicted as that class."""
    lab = F.col(label_col).cast("double")
    of_class = predictions.where(lab == float(positive))
    agg = of_class.agg(F.count(F.lit(1)).alias("n"),
                       F.count_if(F.col(prediction_col).cast("double") == lab).alias("correct"))
    return agg.select("n", "correct", safe_div("correct", "n").alias("recall"))


def match_counts(predictions: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """Rows whose label minus prediction is zero, and the others."""
    diff = F.col(label_col).cast("double") - F.col(prediction_col).cast("double")
    return predictions.agg(F.count_if(diff == 0).alias("matched"), F.count_if(diff != 0).alias("unmatched"))


def evaluate_binary(predictions: DataFrame, label_col: str = "label", score_col: str = "prediction",
                    prediction_col: str = "prediction", num_buckets: int | None = None) -> DataFrame:
    """Area under ROC of ``score_col`` and accuracy.

    With hard predictions as the score (the default) both follow from the counts by
    label and prediction: one aggregate, one pass.  Rows are ranked by the score, so
    the area is P(score of a positive > of a negative) + half of the ties.
    """
    if score_col != prediction_col:
        auc = area_under_roc(predictions, score_col, label_col, num_buckets)
        acc = accuracy(predictions, label_col, prediction_col).select("accuracy")
        return auc.select("area_under_roc", acc.scalar().alias("accuracy"))
    label, score = F.col(label_col).cast("double"), F.col(score_col).cast("double")
    hard = predictions.select((label > 0.5).alias("p"), (label == score).alias("hit"), (score > 0.5).alias("up"),
                              score.isNotNull().alias("has"), (score.isNotNull() & (score != 0) & (score != 1)).alias("soft"))
    c = hard.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("hit").alias("hits"), F.count_if(F.col("soft")).alias("soft"),
        F.count_if(F.col("has") & F.col("p") & F.col("up")).alias("tp"),
        F.count_if(F.col("has") & F.col("p") & ~F.col("up")).alias("fn"),
        F.count_if(F.col("has") & ~F.col("p") & F.col("up")).alias("fp"),
        F.count_if(F.col("has") & ~F.col("p") & ~F.col("up")).alias("tn"))
    tpr = safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    fpr = safe_div(F.col("fp"), F.col("fp") + F.col("tn"))
    area = (fpr * tpr + (F.lit(1.0) - fpr) * (tpr + F.lit(1.0))) / 2.0
    checked = F.when(F.col("soft") > 0, F.raise_error(F.lit("hard predictions must be 0 or 1")).cast("double")).otherwise(area)
    return c.select(checked.alias("area_under_roc"), safe_div("hits", "n").alias("accuracy"))
