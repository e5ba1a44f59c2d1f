"""Exact running sums and positions without a single-partition window.

A window ordered over a whole table runs in one task.  Here the order column
is cut into about ``num_buckets`` value ranges at approximate quantiles (a
distributed sketch, one small row back to the driver), each range is summed
in its own window partition, and the totals of all higher ranges (at most
``num_buckets`` rows, broadcast) are added as an offset.  The result is exact;
only the balance of the ranges is approximate.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiscore.functions.literals import long_array
from entiscore.session import checkpointed

#: Rows one task sorts without help; beyond it an order is cut into ranges.
ONE_TASK = 100_000

_AT = "_entiscore_at"
_BUCKET = "_entiscore_bucket"
_VALUE = "_entiscore_value"


def quantile_splits(df: DataFrame, col: str, num_buckets: int, accuracy: int = 10000) -> list[float]:
    """Distinct finite split points at the i/num_buckets quantiles (≤ num_buckets-1 values)."""
    if num_buckets <= 1:
        return []
    probs = [i / num_buckets for i in range(1, num_buckets)]
    row = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, accuracy).alias("q")).first()
    values = row["q"] if row is not None and row["q"] is not None else []
    return sorted({float(v) for v in values if v is not None and math.isfinite(v)})


def range_bucket(df: DataFrame, col: str, splits: list[float], output_col: str = _BUCKET) -> DataFrame:
    """Add the index of the value range each row falls in (binary search in the JVM)."""
    if not splits:
        return df.withColumn(output_col, F.lit(0.0))
    full = [-math.inf] + splits + [math.inf]
    staged = df.withColumn(_VALUE, F.col(col).cast("double"))
    out = Bucketizer(splits=full, inputCol=_VALUE, outputCol=output_col, handleInvalid="keep").transform(staged)
    return out.drop(_VALUE)


def descending_cumsum(df: DataFrame, order_col: str, sum_cols: list[str],
                      num_buckets: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` (sum over rows with ``order_col`` ≥ this row's) and ``total_<c>``.

    The number of ranges follows the number of rows (``ONE_TASK`` each) unless it is
    given; up to that many rows are one range, summed by a plain window.  ``df`` is read
    more than once: hand in a checkpointed frame.
    """
    if num_buckets is None:
        num_buckets = -(-df.count() // ONE_TASK)
    if num_buckets <= 1:
        down = Window.orderBy(F.desc(order_col)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.orderBy(F.desc(order_col)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return df.select(*df.columns, *[F.sum(c).over(down).alias(f"cum_{c}") for c in sum_cols],
                         *[F.sum(c).over(whole).alias(f"total_{c}") for c in sum_cols])
    splits = quantile_splits(df, order_col, num_buckets)
    bucketed = range_bucket(df, order_col, splits)
    totals = bucketed.groupBy(_BUCKET).agg(*[F.sum(c).alias(c) for c in sum_cols])
    higher = Window.orderBy(F.desc(_BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.desc(_BUCKET)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        _BUCKET,
        *[F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *[F.sum(c).over(every).alias(f"total_{c}") for c in sum_cols],
    )
    within = (Window.partitionBy(_BUCKET).orderBy(F.desc(order_col))
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    # each range in a partition of its own: hashed ranges would share some tasks and leave others idle
    joined = bucketed.join(F.broadcast(offsets), _BUCKET).repartitionByRange(len(splits) + 1, _BUCKET)
    return joined.select(
        *df.columns,
        *[(F.sum(c).over(within) + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in sum_cols],
        *[F.col(f"total_{c}") for c in sum_cols],
    )


def dense_index(df: DataFrame, order: list[Column], output_col: str) -> DataFrame:
    """Add the 0-based position of each row in ``order``, whatever the number of rows.

    Rows are dealt into ranges of the order and sorted within them, in parallel, and written
    with their place in the range; the ranges' sizes (one number a partition) are the only
    thing the driver sees.  Rows equal in ``order`` come in any sequence.
    """
    placed = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order)
                          .withColumn(_AT, F.monotonically_increasing_id()))      # partition << 33 | place
    part = F.shiftright(_AT, 33).cast("int")
    sizes = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, at = [], 0
    for p in range(max(sizes, default=-1) + 1):
        offsets.append(at)
        at += sizes.get(p, 0)
    place = F.col(_AT).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(output_col, F.element_at(long_array(offsets), part + 1) + place).drop(_AT)
