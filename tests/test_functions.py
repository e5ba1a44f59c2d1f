"""Column helpers, run day, table sink."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from entiscore.functions.dates import day_column, run_day
from entiscore.functions.text import jvm_trim, normalize_columns, rtrim_chars, strip_prefix
from entiscore.sources.sinks import save_table


def test_run_day():
    assert run_day(dt.date(2024, 3, 1)) == "20240229"
    assert run_day(dt.date(2024, 3, 1), days_back=0) == "20240301"


def test_day_column(spark):
    df = spark.createDataFrame([("2024-03-01",)], "d string")
    assert df.select(day_column("d").alias("x")).first().x == "20240229"


def test_trims(spark):
    df = spark.createDataFrame([("\t a:: \x01",)], "t string")
    r = df.select(jvm_trim("t").alias("a"), rtrim_chars(jvm_trim("t"), ":").alias("b")).first()
    assert (r.a, r.b) == ("a::", "a")


def test_strip_prefix(spark):
    df = spark.createDataFrame([("12345",), ("12",), ("1",)], "c string")
    assert [r.x for r in df.select(strip_prefix("c", 2).alias("x")).collect()] == ["345", "12", "1"]


def test_normalize_columns(spark):
    df = spark.createDataFrame([(" a\nb ", 5, None)], "s string, n int, z string")
    r = normalize_columns(df, ["s", "z"], null_text="null").first()
    assert (r.s, r.n, r.z) == ("ab", 5, "null")


def test_save_table_modes(spark, tmp_dir):
    df = spark.createDataFrame([("e", 1)], "entity_id string, label int")
    save_table(df, "t_entiscore_modes", path=os.path.join(tmp_dir, "t"))
    with pytest.raises(Exception):
        save_table(df, "t_entiscore_modes", path=os.path.join(tmp_dir, "t"))
    save_table(df.union(df), "t_entiscore_modes", mode="overwrite", path=os.path.join(tmp_dir, "t"))
    assert spark.table("t_entiscore_modes").count() == 2
    spark.sql("DROP TABLE t_entiscore_modes")


def test_feature_text_arrays_follow_jvm_split(spark):
    from entiscore.functions.vectors import feature_text_arrays
    df = spark.createDataFrame([("3:1 5: 7:2: 9:1:4  11:0.5",), (None,), ("",)], "t string")
    idx, val = feature_text_arrays("t")
    rows = df.select(idx.alias("i"), val.alias("v")).collect()
    assert (rows[0].i, rows[0].v) == ([3, 7, 11], [1.0, 2.0, 0.5])
    assert rows[1].i == [] and rows[2].i == []
