"""Numeric column helpers."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_div(num: Column | str, den: Column | str, default: float = 0.0) -> Column:
    """``num / den`` as double, ``default`` where the denominator is 0."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(d == 0, F.lit(default)).otherwise(n / d)


def sigmoid(margin: Column | str) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(margin)))


def probability_of_one(probability_col: Column | str = "probability") -> Column:
    """Class-1 probability out of a Spark ML probability vector (JVM-side)."""
    return vector_to_array(_c(probability_col)).getItem(1)
