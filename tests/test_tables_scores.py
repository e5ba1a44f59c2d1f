"""Day tables in the catalog, scoring by join, gradients, trees as relations, exact shares, dense positions, restarts."""

import math
import os
import random
import re
import uuid

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from entiscore.operators import behavior as B
from entiscore.operators import cumulative as C
from entiscore.operators import features as FE
from entiscore.operators import models as MO
from entiscore.sources import readers as R
from entiscore.sources import sinks as K
from entiscore.streaming import stream as S


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- day tables

@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_day_table_lists_and_prunes_its_partitions(spark, tmp_dir, mode):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        df = spark.createDataFrame([("a", 1), ("b", None), (None, 3)], "entity string, `odd name` int")
        name = f"days_{uuid.uuid4().hex[:8]}"
        K.create_day_table(spark, name, df.schema, path=os.path.join(tmp_dir, name))
        K.create_day_table(spark, name, df.schema)                                  # there already
        for day in ("20240101", "20240102", "20240103"):
            K.overwrite_table_day(df.select("odd name", "entity"), name, day)       # columns go by name
        K.overwrite_table_day(df.where("entity = 'a'"), name, "20240101")            # a re-run
        K.overwrite_table_day(df.limit(0), name, "20240103")                          # a re-run without rows
        K.overwrite_table_day(df.limit(0), name, "20240104")                          # a day without rows
        assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()] == [f"stat_date=2024010{i}" for i in (1, 2, 3, 4)]
        rows = {d: R.read_table_days(spark, name, [d]).count() for d in ("20240101", "20240102", "20240103", "20240104")}
        assert rows == {"20240101": 1, "20240102": 3, "20240103": 0, "20240104": 0}
        one = R.read_table_days(spark, name, ["20240102"])
        assert re.search(r"PartitionFilters: \[[^\]]*stat_date", plan_of(one))
        assert {r["odd name"] for r in one.collect()} == {1, None, 3}
        with pytest.raises(ValueError):
            K.overwrite_table_day(df, name, "x') --")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


# --- scores of any number of weights

def scored_rows(spark):
    r = random.Random(3)
    rows = [(f"e{i % 90}", sorted(r.sample(range(60), r.randrange(0, 12)))) for i in range(120)] + [("none", None), (None, [1, 2])]
    rows = [(e, ix, None if ix is None else [r.choice([1.0, -2.0, 0.5]) for _ in ix]) for e, ix in rows]
    return spark.createDataFrame(rows, "entity_id string, indices array<int>, values array<double>").repartition(4)


@pytest.mark.parametrize("values", [None, "values"])
def test_join_scores_equal_literal_scores(spark, values):
    rows = scored_rows(spark)
    weights = spark.createDataFrame([(i, float(i % 7 - 3)) for i in range(0, 50)] + [(3, 2.0), (8, None)], "column_index long, weight double")
    literal = MO.logistic_score(rows, weights, values_col=values, intercept=0.25)
    joined = MO.logistic_score(rows, weights, values_col=values, intercept=0.25, most_slots=10)
    key = lambda df: sorted(map(repr, map(tuple, df.collect())))
    assert key(literal) == key(joined) and joined.count() == 122
    assert MO.logistic_score(rows, weights.limit(0), most_slots=0).where("margin <> 0").count() == 0


def test_large_weight_tables_are_joined_and_not_broadcast(spark):
    rows = spark.createDataFrame([(i, [i, 10**12 + i]) for i in range(50)], "entity_id long, indices array<long>")
    weights = spark.range(200_000).select((F.col("id") + F.lit(10**12)).alias("column_index"), F.lit(0.5).alias("weight"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        out = MO.logistic_score(rows, weights)
        assert out.where("margin <> 0.5").count() == 0 and out.count() == 50
        assert "BroadcastHashJoin" not in plan_of(MO.logistic_score_join(rows, weights)).split("SortMergeJoin")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_gradient_is_the_slope_of_the_loss(spark):
    r = np.random.default_rng(4)
    x = (r.random((80, 6)) < 0.4) * r.normal(size=(80, 6)).round(2)
    y, w = (r.random(80) < 0.5).astype(float), r.normal(size=6)

    def loss(v):
        z = x @ v
        return np.mean(np.logaddexp(0, z) - y * z) + 0.05 * (v @ v)

    p = 1 / (1 + np.exp(-x @ w))
    rows = [(float(y[i]), float(p[i]), [int(j) for j in np.flatnonzero(x[i])], [float(v) for v in x[i][x[i] != 0]]) for i in range(80)]
    df = spark.createDataFrame(rows, "label double, score double, indices array<int>, values array<double>")
    weights = spark.createDataFrame([(j, float(v)) for j, v in enumerate(w)], "column_index long, weight double")
    got = {g.column_index: g.gradient for g in MO.logistic_gradient(df, values_col="values", reg_param=0.1, weights=weights).collect()}
    for j in range(6):
        step = np.eye(6)[j] * 1e-6
        assert math.isclose(got[j], (loss(w + step) - loss(w - step)) / 2e-6, abs_tol=1e-6)


# --- trees as relations

def test_tree_relation_says_what_the_tree_does(spark):
    from pyspark.ml.feature import VectorIndexer
    r = random.Random(5)
    rows = [(i, [float(r.randrange(40)), float(r.randrange(4)), r.random()]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, x array<double>").select(
        "id", array_to_vector("x").alias("raw"),
        F.when(F.col("x")[1].isin(1.0, 3.0), F.col("x")[0] > 20).otherwise(F.col("x")[2] > 0.5).cast("double").alias("label"))
    data = VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5).fit(df).transform(df)
    for model in (MO.train_tree(data, max_depth=6), MO.train_forest(data, num_trees=3, max_depth=4)):
        nodes, trees = MO.tree_nodes(model, spark), getattr(model, "getNumTrees", 1)
        got = nodes.join(MO.tree_rules(nodes), ["tree", "node"]).collect()
        assert len(got) == nodes.count() == (model.totalNumNodes if trees > 1 else model.numNodes)
        assert len([g for g in got if g.parent is None]) == trees and any(g.left_categories for g in got)
        x = {q.id: q.features.toArray() for q in data.collect()}

        def holds(rule, v):
            for step in filter(None, rule.split(" AND ")):
                f, op, value = re.fullmatch(r"feature (\d+) (<=|>|in|not in) (.*)", step).groups()
                inside = v[int(f)] <= float(value) if op in ("<=", ">") else v[int(f)] in {float(c) for c in value.strip("{}").split(", ")}
                if inside != (op in ("<=", "in")):
                    return False
            return True

        leaves = [g for g in got if g.feature is None]
        assert all(g.gain is None and g.threshold is None for g in leaves)
        for v in x.values():
            assert sorted(g.tree for g in leaves if holds(g.rule, v)) == list(range(trees))      # one leaf of each tree
        if trees == 1:
            said = {q.id: q.prediction for q in model.transform(data).collect()}
            for i, v in x.items():
                assert next(g.prediction for g in leaves if holds(g.rule, v)) == said[i]
            assert sum(g.rows for g in leaves) == 400


def test_centre_costs_of_many_sets_in_one_pass(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(60, 5))
    df = spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").select(array_to_vector("x").alias("features"))
    sets = {f"k{k}": r.normal(size=(k, 5)).tolist() for k in (1, 2, 5)}
    got = MO.centre_costs(df, sets)
    assert plan_of(got).count("HashAggregate") <= 2 and "Join" not in plan_of(got)
    for name, centres in sets.items():
        want = sum(min(((v - np.array(c))**2).sum() for c in centres) for v in x)
        assert math.isclose(got.first()[name], want, rel_tol=1e-12)
    assert MO.centre_costs(df.limit(0), sets).first()["k2"] == 0.0


# --- exact shares

@pytest.mark.parametrize("few", [1_000_000, 3])
def test_exact_fraction_is_exact_and_repeatable(spark, few):
    rows = [(i, i % 7) for i in range(997)] + [(5, 0)] * 400                     # one key holds a third of all rows
    df = spark.createDataFrame(rows, "k long, v long").repartition(5)
    for fraction in (0.0, 0.3, 0.5, 1.0):
        got = FE.exact_fraction(df, "k", fraction, few)
        assert got.count() == math.floor(len(rows) * fraction + 1e-9)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, FE.exact_fraction(df.repartition(3), "k", fraction, few).collect()))
    assert FE.exact_fraction(df.limit(0), "k", 0.3).count() == 0


def test_undersample_correct_keeps_class_one_and_right_majority_rows(spark):
    rows = [(i, float(i % 3 == 0), float(i % 3 == 0) if i % 5 else 1.0 - float(i % 3 == 0)) for i in range(300)] + [(900, None, 0.0)]
    df = spark.createDataFrame(rows, "id long, indexed_label double, prediction double")
    got = FE.undersample_correct(df, "id", 0.3).collect()
    assert sum(r.indexed_label == 1.0 for r in got) == 100
    major = [r for r in got if r.indexed_label == 0.0]
    assert all(r.prediction == 0.0 for r in major) and len(major) == 160 * 3 // 10


# --- positions without a single task

def test_dense_positions_equal_the_window_form(spark, monkeypatch):
    r = random.Random(2)
    top = spark.createDataFrame([(f"12{i}", f"n{i}", r.randrange(40)) for i in range(500)], "item_code string, item_name string, installs long").repartition(7)
    pairs = spark.createDataFrame([("e", f"12{i % 650}", 1.0) for i in range(0, 900, 2)], "entity_id string, item_code string, value double")
    small = B.used_items(top, pairs)
    monkeypatch.setattr(B, "ONE_TASK", 100)
    large = B.used_items(top, pairs, k=500)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    assert "SinglePartition" in plan_of(small) and "SinglePartition" not in plan_of(large)
    for mode in ("binary", "sum"):
        a, b = (B.build_item_features(pairs, top, value_mode=mode, k=k) for k in (None, 500))
        for x, y in zip(a, b):
            assert sorted(map(repr, map(tuple, x.collect()))) == sorted(map(repr, map(tuple, y.collect())))
    assert C.dense_index(top.limit(0), [F.asc("item_code")], "at").count() == 0


def test_running_sums_by_ranges_equal_those_of_one_window(spark, monkeypatch):
    r = random.Random(6)
    df = spark.createDataFrame([(r.randrange(200) / 7, r.randrange(5), 1) for _ in range(800)], "s double, a long, b long").repartition(5)
    one = C.descending_cumsum(df, "s", ["a", "b"])
    assert "rangepartitioning" not in plan_of(one)
    monkeypatch.setattr(C, "ONE_TASK", 90)
    many = C.descending_cumsum(df, "s", ["a", "b"])
    assert "rangepartitioning" in plan_of(many)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


# --- stop and restart

class Stopped(Exception):
    pass


def test_scoring_stopped_between_batches_finds_each_row_once(spark, tmp_dir):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    model = PipelineModel(stages=[SQLTransformer(statement="SELECT *, id * 0.5D AS score, CAST(id % 2 AS DOUBLE) AS prediction FROM __THIS__")])
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    spark.range(0, 60, 1, 6).write.parquet(src)

    def run(stop_after=None):
        def after(batch_id):
            seen.append(batch_id)
            if batch_id == stop_after:
                raise Stopped("the rows are written, the end of the batch is not recorded")
        stream = S.stream_source(spark, src, "id long", max_files_per_trigger=2)
        q = S.score_batches(stream, model, sink, ckpt, keep=["id"], available_now=True, after_batch=after)
        S.run_to_end(q)

    seen = []
    with pytest.raises(Exception, match="the end of the batch is not recorded"):
        run(stop_after=1)
    assert seen == [0, 1] and spark.read.parquet(sink).count() == 40
    first = {r.id: r.batch_time for r in spark.read.parquet(sink).where("batch_id = 0").collect()}
    seen = []
    run()
    assert seen == [1, 2]                                              # batch 1 again, batch 0 not
    rows = spark.read.parquet(sink).collect()
    assert sorted(r.id for r in rows) == list(range(60)) and all(r.score == r.id * 0.5 for r in rows)
    assert {r.id: r.batch_time for r in rows if r.batch_id == 0} == first
    spark.range(60, 70).write.mode("append").parquet(src)
    run()
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == list(range(70))


def test_scores_of_the_file_sink_go_on_after_a_restart(spark, tmp_dir):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer
    model = PipelineModel(stages=[SQLTransformer(statement="SELECT *, 1.0D AS prediction FROM __THIS__")])
    src, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    for start in (0, 10):
        spark.range(start, start + 10, 1, 2).write.mode("append").parquet(src)
        S.run_to_end(S.stream_score(S.stream_source(spark, src, "id long", max_files_per_trigger=1), model, sink, ckpt,
                                    keep=["id"], available_now=True))
    assert sorted(r.id for r in spark.read.parquet(sink).collect()) == list(range(20))


def test_kafka_source_asks_for_the_connector(spark):
    """The connector's jar is not here: the options reach Spark, which names what is missing."""
    with pytest.raises(Exception, match="(?i)kafka"):
        S.kafka_source(spark, "host:9092", "events", startingOffsets="earliest")
