"""Threshold sweep and curve metrics: brute force and Spark's own metrics."""

import math
import random

import pytest
from pyspark.sql import functions as F

from entiscore.operators import metrics as M
from entiscore.operators.cumulative import descending_cumsum


def _scored(spark, n=400, seed=7, ties=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        label = 1 if rnd.random() < 0.4 else 0
        s = rnd.random() * 0.6 + 0.4 * label
        if ties:
            s = round(s, 2)           # many exact threshold hits and tied scores
        rows.append((i, label, s))
    return spark.createDataFrame(rows, "id long, label int, score double"), rows


def test_sweep_equals_brute_force(spark):
    df, rows = _scored(spark)
    got = {r.threshold: r for r in M.threshold_sweep(df).collect()}
    assert len(got) == 99
    num1 = sum(1 for _, l, _ in rows if l == 1)
    num0 = len(rows) - num1
    for i in range(1, 100):
        t = i / 100
        n11 = sum(1 for _, l, s in rows if l == 1 and s > t)
        n10 = sum(1 for _, l, s in rows if l == 1 and s <= t)
        n00 = sum(1 for _, l, s in rows if l == 0 and s <= t)
        n01 = sum(1 for _, l, s in rows if l == 0 and s > t)
        r = got[t]
        assert (r.n11, r.n10, r.n00, r.n01) == (n11, n10, n00, n01)
        cov1, cov0 = n11 / num1, n00 / num0
        assert r.gmean == pytest.approx(math.sqrt(cov1 * cov0))
        assert r.pre1 == pytest.approx(0.0 if n11 + n01 == 0 else n11 / (n11 + n01))


def test_best_threshold_lowest_on_ties(spark):
    df = spark.createDataFrame([(0, 0.2), (1, 0.9)], "label int, score double")
    best = M.best_threshold(M.threshold_sweep(df)).first()
    # every threshold in [0.2, 0.9) separates perfectly; the lowest wins
    assert best.threshold == 0.2 and best.gmean == 1.0


def test_all_one_class_has_no_usable_threshold(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.8)], "label int, score double")
    assert M.best_threshold(M.threshold_sweep(df)).count() == 0


def test_cumulative_sum_bucketed_equals_naive(spark):
    rows = [(float(i % 97) + i / 1000.0, i % 3, 1) for i in range(500)]
    df = spark.createDataFrame(rows, "k double, a int, b int")
    got = {r.k: (r.cum_a, r.total_a) for r in descending_cumsum(df, "k", ["a", "b"], num_buckets=7).collect()}
    for k, _, _ in rows:
        assert got[k] == (sum(a for kk, a, _ in rows if kk >= k), sum(a for _, a, _ in rows))


@pytest.mark.parametrize("ties", [True, False])
def test_areas_match_spark_binary_metrics(spark, ties):
    from pyspark.mllib.evaluation import BinaryClassificationMetrics

    df, rows = _scored(spark, ties=ties)
    ref = BinaryClassificationMetrics(spark.sparkContext.parallelize([(s, float(l)) for _, l, s in rows], 4))
    roc = M.area_under_roc(df, num_buckets=5).first().area_under_roc
    pr = M.area_under_pr(df, num_buckets=5).first().area_under_pr
    assert roc == pytest.approx(ref.areaUnderROC, abs=1e-12)
    assert pr == pytest.approx(ref.areaUnderPR, abs=1e-12)


def test_curve_points_trapezoid_equals_area(spark):
    df, _ = _scored(spark)
    pts = sorted((r.fpr, r.tpr) for r in M.roc_curve(df).collect())
    area = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(pts, pts[1:]))
    assert area == pytest.approx(M.area_under_roc(df).first().area_under_roc)
    mb = M.metrics_by_threshold(df, beta=0.5).collect()
    for r in mb:
        p, rc = r.precision, r.recall
        f = 0.0 if p + rc == 0 else 1.25 * p * rc / (0.25 * p + rc)
        assert r.f_measure == pytest.approx(f)


def test_hard_prediction_summaries(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (0.0, 0.0)], "label double, prediction double")
    a = M.accuracy(df).first()
    assert (a.n, a.correct, a.accuracy) == (4, 3, 0.75)
    assert M.class_recall(df, 1.0).first().recall == 0.5
    m = M.match_counts(df).first()
    assert (m.matched, m.unmatched) == (3, 1)
    ev = M.evaluate_binary(df).first()
    assert ev.accuracy == 0.75 and 0.0 <= ev.area_under_roc <= 1.0


def test_prune_keeps_negatives_and_confident_positives(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.4), (0, 0.1), (0, 0.9)], "label int, score double")
    kept = sorted((r.label, r.score) for r in M.prune_positives(df, 0.5).collect())
    assert kept == [(0, 0.1), (0, 0.9), (1, 0.5)]    # score == threshold kept (>=)
