"""Driver contract: entry, registered queries and their DuckDB oracle."""

import math

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E
from tests.conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):     # a column with nulls comes as
        return None                                                          # floats on one side
    if isinstance(v, float):
        return int(v) if v.is_integer() else round(v, 6)
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if hasattr(v, "tolist"):
        v = v.tolist()
    return tuple(_norm(x) for x in v) if isinstance(v, (list, tuple)) else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(repr(_norm(x)) for x in rec) for rec in pdf[cols].itertuples(index=False))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["entity_id", "features"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SMALL).toPandas()
    want = duck.sql(E.oracle_sql()[name]).df()
    assert _rows(got) == _rows(want)
