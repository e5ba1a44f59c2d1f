"""Run-day helpers: partitions are keyed by a ``yyyyMMdd`` day string."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_day(as_of: _dt.date | None = None, days_back: int = 1) -> str:
    """The day ``days_back`` before ``as_of`` as ``yyyyMMdd`` (a job parameter)."""
    as_of = as_of or _dt.date.today()
    return (as_of - _dt.timedelta(days=days_back)).strftime("%Y%m%d")


def day_column(col: Column | str, days_back: int = 1) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(F.date_sub(c.cast("date"), days_back), "yyyyMMdd")
