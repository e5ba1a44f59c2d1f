"""Label joins, train/predict split and class assignment."""

from entiscore.operators import labels as L


def test_split_roles_and_conflicts(spark):
    labels = spark.createDataFrame(
        [("a", 1), ("b", 0), ("c", 1), ("d", 1), ("d", 0), ("e", 1), ("e", 1)], "entity_id string, label int")
    feats = spark.createDataFrame(
        [("a", "0:1"), ("x", "1:1"), ("d", "2:1"), ("e", "0:1"), ("z", "")], "entity_id string, features string")
    got = {(r.entity_id, r.role, r.label) for r in L.split_train_predict(labels, feats).collect()}
    # b, c: label only (dropped); x: features only (predict); d: conflicting labels (predict);
    # e: duplicate labels collapse; z: empty features dropped
    assert got == {("a", "train", 1.0), ("x", "predict", None), ("d", "predict", None), ("e", "train", 1.0)}


def test_labeled_features_is_inner_join(spark):
    labels = spark.createDataFrame([("a", 1), ("b", 0)], "entity_id string, label int")
    feats = spark.createDataFrame([("a", "0:1 3:1"), ("b", None)], "entity_id string, features string")
    out = L.labeled_features(labels, feats)
    assert [tuple(r) for r in out.collect()] == [("a", 1, "0:1 3:1", "1 0:1 3:1")]
    assert "Inner" in out._jdf.queryExecution().optimizedPlan().toString()


def test_class_counts_and_profile(spark):
    df = spark.createDataFrame([(1, 2.0), (0, 4.0), (0, 6.0)], "label int, x double")
    c = L.class_counts(df).first()
    assert (c.n, c.n1, c.n0) == (3, 1, 2)
    prof = {r.label: r.avg_x for r in L.label_profile(df, "label", ["x"]).collect()}
    assert prof == {1: 2.0, 0: 5.0}


def test_assign_classes(spark):
    known = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "entity_id string, label double")
    scored = spark.createDataFrame([("c", 0.7), ("d", 0.5)], "entity_id string, score double")
    got = {(r.entity_id, r["class"], r.source) for r in L.assign_classes(known, scored, 0.5, ("m", "f")).collect()}
    assert got == {("a", "m", "known"), ("b", "f", "known"), ("c", "m", "model"), ("d", "f", "model")}


def test_labels_that_are_no_numbers_are_dropped(spark):
    df = spark.createDataFrame([("a", "1"), ("b", ""), ("c", " "), ("d", "x"), ("e", None), ("f", " 0 ")],
                               "entity_id string, label string")
    assert {r.entity_id: r.label for r in L.clean_labels(df).collect()} == {"a": 1.0, "f": 0.0}
