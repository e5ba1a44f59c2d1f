"""Readers and sinks: sparse/dense text, CSV, day partitions."""

import os

import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from entiscore.sources import readers as R
from entiscore.sources import sinks as K


def _write_lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.txt"), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_sparse_text_reader(spark, tmp_dir):
    p = os.path.join(tmp_dir, "svm")
    _write_lines(p, ["# comment", "", "1 0:1.5 3:2", "\t 0 2:1 \x01", "1", " \t# indented comment"])
    rows = R.read_sparse_text(spark, p).collect()
    got = [(r.label, r.features) for r in rows]
    assert got == [(1.0, SparseVector(4, [0, 3], [1.5, 2.0])), (0.0, SparseVector(4, [2], [1.0])),
                   (1.0, SparseVector(4, [], []))]
    fixed = R.read_sparse_text(spark, p, num_features=10).first()
    assert fixed.features.size == 10


def test_sparse_text_out_of_order_fails(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bad")
    _write_lines(p, ["1 3:1 2:1"])
    with pytest.raises(Exception):
        R.read_sparse_text(spark, p).collect()


def test_sparse_text_roundtrip_identity(spark, tmp_dir):
    df = spark.createDataFrame([(1, "0:1 5:1"), (0, "2:1"), (1, "")], "label int, features string")
    p = os.path.join(tmp_dir, "rt")
    K.write_sparse_text(df, p, mode="overwrite")
    back = {(r.label, tuple(r.indices)) for r in R.read_sparse_text(spark, p, keep_arrays=True).collect()}
    assert back == {(1.0, (0, 5)), (0.0, (2,))}


def test_dense_text(spark, tmp_dir):
    p = os.path.join(tmp_dir, "dense")
    _write_lines(p, ["0 0 0", "1 1 10", "10 8 9"])
    got = [list(r.features) for r in R.read_dense_text(spark, p).collect()]
    assert got == [[0.0, 0.0, 0.0], [1.0, 1.0, 10.0], [10.0, 8.0, 9.0]]


def test_labeled_csv_keeps_last_record(spark, tmp_dir):
    p = os.path.join(tmp_dir, "csv")
    _write_lines(p, ["label,a,b", "1.9, 2,3", "0,4,5", "1,6,7"])
    rows = R.read_labeled_csv(spark, p).collect()
    assert [(r.label, list(r.features)) for r in rows] == [(1.0, [2.0, 3.0]), (0.0, [4.0, 5.0]), (1.0, [6.0, 7.0])]


def test_typed_and_raw_csv(spark, tmp_dir):
    p = os.path.join(tmp_dir, "typed")
    _write_lines(p, ["x,y", "1,2", ",3"])
    typed = R.read_csv_typed(spark, p, R.int_schema(["x", "y"])).collect()
    assert [(r.x, r.y) for r in typed] == [(1, 2), (None, 3)]
    raw = R.read_csv_raw(spark, p)
    assert dict(raw.dtypes) == {"x": "string", "y": "string"}


def test_overwrite_partition_is_idempotent(spark, tmp_dir):
    p = os.path.join(tmp_dir, "days")
    a = spark.createDataFrame([("e1", "m"), ("e2", "f")], "entity_id string, class string")
    K.overwrite_partition(a, p, "20240101")
    K.overwrite_partition(a, p, "20240102")
    b = spark.createDataFrame([("e9", "f")], "entity_id string, class string")
    K.overwrite_partition(b, p, "20240101")
    K.overwrite_partition(b, p, "20240101")       # re-run of the same day
    d1 = {tuple(r) for r in R.read_partition(spark, p, "20240101").select("entity_id", "class").collect()}
    d2 = {tuple(r) for r in R.read_partition(spark, p, "20240102").select("entity_id", "class").collect()}
    assert d1 == {("e9", "f")}
    K.overwrite_partition(b.where("class = 'none'"), p, "20240101")            # a result without rows
    empty = R.read_partition(spark, p, "20240101")
    assert empty.count() == 0 and empty.columns == ["entity_id", "class", "stat_date"]
    assert d2 == {("e1", "m"), ("e2", "f")}


def test_partition_filter_prunes(spark, tmp_dir):
    p = os.path.join(tmp_dir, "prune")
    K.overwrite_partition(spark.createDataFrame([("e", 1)], "entity_id string, v int"), p, "20240105")
    plan = R.read_partition(spark, p, "20240105")._jdf.queryExecution().executedPlan().toString()
    assert "stat_date=20240105" in plan          # the one day's folder, nothing else is listed
