"""Golden fixtures (FIXTURES.md §1), feature operators, models and loops."""

import os

import pytest
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from entiscore.functions.vectors import to_sparse_vector, vector_elements
from entiscore.operators import features as FE
from entiscore.operators import models as MO
from entiscore.operators.training import NoUsableThreshold, retrain_dropping_errors, train_with_pruning
from entiscore.sources import readers as R

# The 8 points of the reference's k-means data file (fixed values).
POINTS = ["0 0 0", "0 1 0", "1 1 10", "1 1 9", "10 1 0", "8 1 0", "10 8 9", "9 9 8"]


def test_one_hot_golden(spark):
    rows = ["oak", "elm", "ash", "oak", "ash", "oak", "fir", "elm"]        # a tie (elm, ash), unequal counts
    df = spark.createDataFrame(list(enumerate(rows)), "id int, category string")
    idx, _ = FE.index_labels(df, "category", "category_index")
    enc, _ = FE.one_hot(idx, "category_index", "category_vec")
    got = {r.id: (r.category_index, r.category_vec) for r in enc.collect()}
    assert got[0] == (0.0, SparseVector(3, [0], [1.0]))
    assert got[2] == (1.0, SparseVector(3, [1], [1.0]))
    assert got[1] == (2.0, SparseVector(3, [2], [1.0]))
    assert got[6] == (3.0, SparseVector(3, [], []))


def test_assemble_golden_and_label_guard(spark):
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType
    schema = StructType([StructField("orders", IntegerType()), StructField("balance", DoubleType()),
                         StructField("shares", VectorUDT()), StructField("late", DoubleType())])
    df = spark.createDataFrame([(7, -2.5, Vectors.dense([0.25, 0.75]), 0.0), (0, 3.0, Vectors.dense([1.0, 0.0]), 1.0)], schema)
    out, _ = FE.assemble(df, ["orders", "balance", "shares"], "features", label_col="late")
    assert [list(r.features) for r in out.collect()] == [[7.0, -2.5, 0.25, 0.75], [0.0, 3.0, 1.0, 0.0]]
    with pytest.raises(ValueError):
        FE.assemble(df, ["orders", "late"], "features", label_col="late")


def test_kmeans_golden(spark, tmp_dir):
    p = os.path.join(tmp_dir, "km")
    os.makedirs(p)
    with open(os.path.join(p, "data.txt"), "w") as fh:
        fh.write("\n".join(POINTS) + "\n")
    vecs = R.read_dense_text(spark, p)
    centers = MO.kmeans_centers(vecs, k=4, max_iter=10).collect()
    assert len(centers) == 4 and all(len(c.center) == 3 for c in centers)
    assert all(len(c.center_text.split(":")) == 3 for c in centers)
    costs = {r.k: r.cost for r in MO.kmeans_cost_sweep(vecs).collect()}
    assert set(costs) == {2, 3, 4, 5, 6} and costs[6] < costs[2]
    ordered = [r.cost for r in MO.kmeans_cost_sweep(vecs).collect()]
    assert ordered == sorted(ordered, reverse=True)


def test_kmeans_assign_nearest(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [9.0, 9.0]), (2, [5.0, 5.0])], "id int, embedding array<double>")
    got = {r.id: r.cluster for r in MO.kmeans_assign(df, [[0.0, 0.0], [10.0, 10.0]]).collect()}
    assert got == {0: 0, 1: 1, 2: 0}      # 2 is at equal distance: lowest centre id wins


def test_standardize_divides_by_sample_std(spark):
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StructField, StructType
    df = spark.createDataFrame([(Vectors.dense([1.0, 5.0]),), (Vectors.dense([3.0, 5.0]),)],
                               StructType([StructField("features", VectorUDT())]))
    out, _ = FE.standardize(df)
    vals = [list(r.scaled_features) for r in out.collect()]
    s = (2.0 ** 0.5)
    assert vals == [[pytest.approx(1 / s), 0.0], [pytest.approx(3 / s), 0.0]]


def test_split_by_key_is_a_partition(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, b = FE.split_by_key(df, "k", [0.8, 0.2])
    assert a.count() == 800 and b.count() == 200
    assert a.join(b, "k").count() == 0


def test_split_by_key_loses_no_row(spark):
    df = spark.createDataFrame([(1,), (99,), (None,)], "k long")
    a, b = FE.split_by_key(df, "k", [0.8, 0.2])
    assert a.count() == 2 and b.count() == 1                 # the null key is in the first part
    many = spark.range(10_000).withColumnRenamed("id", "k")
    parts = FE.split_by_key(many, "k", [0.996, 0.004], modulus=1000)
    assert [p.count() for p in parts] == [9960, 40]
    thirds = FE.split_by_key(many, "k", [1, 1, 1])
    assert sum(p.count() for p in thirds) == 10_000
    assert FE.undersample_by_key(many.withColumn("y", F.lit(0)), "y", {0: 0.005}, "k", 1000).count() == 50


def test_to_sparse_vector_forms(spark):
    df = spark.createDataFrame([([0, 3], [2.0, 5.0])], "indices array<int>, values array<double>")
    v1 = to_sparse_vector(df, 5, "indices").first().features
    v2 = to_sparse_vector(df, 5, "indices", "values").first().features
    assert v1 == SparseVector(5, [0, 3], [1.0, 1.0]) and v2 == SparseVector(5, [0, 3], [2.0, 5.0])
    plan = to_sparse_vector(df, 5, "indices", "values")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_logistic_score_is_narrow_and_keeps_empty_entities(spark):
    df = spark.createDataFrame([("a", [0, 2]), ("b", []), ("c", None), ("d", [9])], "entity_id string, indices array<int>")
    w = spark.createDataFrame([(0, 0.5), (1, 9.0), (2, -1.5)], "column_index long, weight double")
    out = MO.logistic_score(df, w, intercept=0.25)
    got = {r.entity_id: r.margin for r in out.collect()}
    assert got == {"a": -0.75, "b": 0.25, "c": 0.25, "d": 0.25}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    vals = df.limit(1).withColumn("x", F.array(F.lit(2.0), F.lit(4.0)))
    assert MO.logistic_score(vals, w, values_col="x").first().margin == -5.0


def _toy_training(spark, n=300):
    rows = []
    for i in range(n):
        label = float(i % 2)
        idx = [0, 2] if label else [1, 2]
        if i % 7 == 0:
            idx = [0, 1]
        rows.append((f"e{i}", label, SparseVector(3, idx, [1.0] * len(idx))))
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    schema = StructType([StructField("entity_id", StringType()), StructField("label", DoubleType()),
                         StructField("features", VectorUDT())])
    return spark.createDataFrame(rows, schema)


def test_train_with_pruning_runs_and_reports(spark):
    res = train_with_pruning(_toy_training(spark), rounds=3)
    assert 0.0 < res.threshold < 1.0 and res.gmean > 0
    rep = res.report.collect()
    assert res.rounds_run == 3 and len(rep) == 99 * 3
    assert {r.iteration for r in rep} == {0, 1, 2}


def test_train_with_pruning_runs_every_round_and_leaves_no_old_model(spark, tmp_dir):
    easy = _toy_training(spark).where("int(substring(entity_id, 2)) % 7 <> 0")      # nothing to prune
    folder = os.path.join(tmp_dir, "models")
    assert train_with_pruning(easy, rounds=4, model_dir=folder).rounds_run == 4
    assert sorted(os.listdir(folder)) == ["model_0", "model_1", "model_2", "model_3"]
    res = train_with_pruning(easy, rounds=2, model_dir=folder)
    assert sorted(os.listdir(folder)) == ["model_0", "model_1"] and len(res.train_sizes) == 2


def test_train_with_pruning_one_class_fails(spark):
    df = _toy_training(spark).withColumn("label", F.lit(1.0))
    with pytest.raises(NoUsableThreshold):
        train_with_pruning(df, rounds=2)


def test_retrain_dropping_errors_shrinks_or_keeps(spark):
    from pyspark.ml.classification import LogisticRegression
    df = _toy_training(spark).withColumn("label_text", F.col("label").cast("int").cast("string"))
    idx, _ = FE.index_labels(df, "label_text", "indexed_label")
    from pyspark.ml.feature import SQLTransformer
    fits = []

    def refit():
        fits.append(1)
        return LogisticRegression(labelCol="indexed_label", maxIter=10)

    always_wrong = SQLTransformer(statement="SELECT *, 1.0D - indexed_label AS prediction FROM __THIS__")
    data, model, sizes = retrain_dropping_errors(idx, always_wrong, refit, rounds=2,
                                                 keep_cols=["entity_id", "features", "indexed_label"])
    counts = [n for _, n in sizes]
    # the errors of the given model go first: every row of the majority class
    assert counts[:2] == [300, idx.where("indexed_label = 1").count()] and len(fits) == 2
    assert counts == sorted(counts, reverse=True)


def test_tree_refit_job_meets_items_no_training_row_has(spark):
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType

    from entiscore.plans.jobs import tree_refit_job
    schema = StructType([StructField("entity_id", LongType()), StructField("label", DoubleType()),
                         StructField("features", VectorUDT())])
    rows = [(i, float(i % 3 == 0), SparseVector(3, [0] if i % 3 == 0 else [1], [1.0])) for i in range(200)]
    rows += [(100 * k + 99, 0.0, SparseVector(3, [1, 2], [1.0, 1.0])) for k in range(3)]     # held out: slot 2 is new
    res = tree_refit_job(spark.createDataFrame(rows, schema))
    assert res.accuracy == 1.0 and res.final_recall.first()["recall"] == 1.0
    deep = tree_refit_job(spark.createDataFrame(rows, schema), refit_tree_depth=10)
    assert len(deep.sizes) == 3 and deep.final_recall.first()["recall"] == 1.0


def test_cross_validated_model_is_loaded_and_scores_a_stream(spark, tmp_dir):
    from pyspark.ml.tuning import CrossValidatorModel

    from entiscore.streaming import stream_score, stream_source, run_to_end
    df = _toy_training(spark)
    est = MO.logistic(fit_intercept=True, max_iter=10)
    path = os.path.join(tmp_dir, "cv")
    MO.save_model(MO.train_cv(df, est, {est.regParam: [0.0, 0.1]}, folds=2), path)
    model = MO.load_model(path, CrossValidatorModel)
    src, sink = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "sink")
    df.write.parquet(src)
    run_to_end(stream_score(stream_source(spark, src, df.schema), model, sink, os.path.join(tmp_dir, "ck"),
                            keep=["entity_id"], available_now=True))
    got = {r.entity_id: r.score for r in spark.read.parquet(sink).collect()}
    assert got == {r.entity_id: r.score for r in MO.score(model, df, ["entity_id"]).collect()} and len(got) == 300


def test_model_save_load_same_predictions(spark, tmp_dir):
    df = _toy_training(spark)
    model = MO.train_logistic(df, fit_intercept=True, max_iter=20)
    path = os.path.join(tmp_dir, "m")
    MO.save_model(model, path)
    MO.save_model(model, path)          # overwrite works
    from pyspark.ml.classification import LogisticRegressionModel
    loaded = MO.load_model(path, LogisticRegressionModel)
    a = [r.score for r in MO.score(model, df, ["entity_id"]).orderBy("entity_id").collect()]
    b = [r.score for r in MO.score(loaded, df, ["entity_id"]).orderBy("entity_id").collect()]
    assert a == b


def test_tree_forest_cv(spark):
    df = _toy_training(spark)
    assert "If (" in MO.describe_model(MO.train_tree(df, max_depth=3, max_bins=8))
    forest = MO.train_forest(df, num_trees=3, max_depth=3)
    assert forest.getNumTrees == 3
    imp = MO.feature_importances(forest, spark).collect()
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9
    est = MO.logistic(fit_intercept=True, max_iter=10)
    cv = MO.train_cv(df, est, {est.regParam: [0.0, 0.1]}, folds=2)
    assert len(cv.avgMetrics) == 2
