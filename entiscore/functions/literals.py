"""Array literals built in one JVM call.

Building a K-element array from K ``lit`` columns costs K round trips from
Python; one SQL expression string is parsed (and constant-folded) in the JVM
at once.  Doubles go through their exact text form, so they round-trip.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def long_array(values: list[int]) -> Column:
    if not values:
        return F.expr("CAST(array() AS array<bigint>)")
    return F.expr("CAST(array(" + ",".join(str(int(v)) for v in values) + ") AS array<bigint>)")


def double_array(values: list[float]) -> Column:
    if not values:
        return F.expr("CAST(array() AS array<double>)")
    return F.expr("array(" + ",".join(f"CAST('{float(v)!r}' AS DOUBLE)" for v in values) + ")")


def double_matrix(rows: list[list[float]]) -> Column:
    inner = ["array(" + ",".join(f"CAST('{float(v)!r}' AS DOUBLE)" for v in r) + ")" for r in rows]
    return F.expr("array(" + ",".join(inner) + ")")
