"""End-to-end jobs on the supplied sf0.01 tables."""

import os

from pyspark.sql import functions as F

from entiscore.operators import labels as L
from entiscore.plans import fixtures as X
from entiscore.plans.jobs import behavior_model_job, credit_forest_job
from entiscore.sources.readers import read_partition
from tests.conftest import MEDIUM


def test_behavior_model_job_end_to_end_and_idempotent(spark, tmp_dir):
    items, beh, labels = X.items(spark, MEDIUM), X.behavior_text(spark, MEDIUM), X.known_labels(spark, MEDIUM)
    root = os.path.join(tmp_dir, "job")
    res = behavior_model_job(spark, items, beh, labels, "20240101", root, k=1000, prefix="12", rounds=3)
    assert 0.0 < res.threshold < 1.0 and res.gmean > 0 and res.dimension == 1000
    for t in ("items", "features", "predictions", "threshold_report"):
        assert read_partition(spark, f"{root}/{t}", "20240101").count() > 0
    preds = {r.entity_id: r["class"] for r in res.predictions.collect()}
    feats = read_partition(spark, f"{root}/features", "20240101")
    assert set(preds) == {r.entity_id for r in feats.select("entity_id").collect()}
    clean = {r.entity_id: r.label for r in L.clean_labels(labels).collect()}
    for e, c in preds.items():
        if e in clean:
            assert c == ("1" if clean[e] == 1.0 else "0")
    # Re-running the day replaces it: same number of rows, no duplicates.
    behavior_model_job(spark, items, beh, labels, "20240101", root, k=1000, prefix="12", rounds=3)
    again = read_partition(spark, f"{root}/predictions", "20240101")
    assert again.count() == len(preds) == again.select("entity_id").distinct().count()


def test_credit_forest_job(spark):
    credit = X.credit_table(spark, MEDIUM)
    profile, pred, acc, forest = credit_forest_job(credit, ["nation", "n_orders", "total_price", "mean_price"])
    assert profile.count() == 2
    a = acc.first()
    assert a.n == pred.count() and 0.0 <= a.accuracy <= 1.0
    assert set(pred.columns) >= {"prediction", "predicted_label"}
