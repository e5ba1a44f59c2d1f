"""Sinks: sparse text, idempotent day partitions (folders and catalog tables), managed tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_sparse_text(df: DataFrame, path: str, mode: str = "errorifexists",
                      label_col: str = "label", features_col: str = "features") -> None:
    """One ``label idx:val …`` line per row with non-empty features (integer label)."""
    feats = F.col(features_col)
    lines = df.where(feats.isNotNull() & (F.length(feats) > 0)).select(
        F.concat_ws(" ", F.col(label_col).cast("double").cast("int").cast("string"), feats).alias("value"))
    lines.write.mode(mode).text(path)


def overwrite_partition(df: DataFrame, path: str, day: str, partition_col: str = "stat_date",
                        fmt: str = "parquet") -> None:
    """Replace exactly the ``day`` partition; other days stay as they are.

    The day's folder itself is overwritten, so a result without rows empties the day
    and re-running a day is idempotent.  Creates the table on first use.
    """
    df.drop(partition_col).write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/{partition_col}={day}")


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _day(day: str) -> str:
    if not re.fullmatch(r"[\w.:-]+", day):
        raise ValueError(f"not a day: {day!r}")
    return day


def create_day_table(spark: SparkSession, name: str, schema: StructType, partition_col: str = "stat_date",
                     path: str | None = None, fmt: str = "parquet") -> None:
    """Catalog table partitioned by day, if it is not there yet; its partitions are tracked in the catalog."""
    cols = ", ".join(f"{_quoted(f.name.replace('.', '_'))} {f.dataType.simpleString()}"
                     for f in schema.fields if f.name != partition_col)
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({cols}, {_quoted(partition_col)} STRING) USING {fmt} "
              f"PARTITIONED BY ({_quoted(partition_col)}){where}")


def overwrite_table_day(df: DataFrame, name: str, day: str, partition_col: str = "stat_date") -> None:
    """``INSERT OVERWRITE`` of exactly one day of a :func:`create_day_table` table.

    The other days stay whatever the session's overwrite mode; columns are matched by
    name; a result without rows leaves the day as an empty partition.
    """
    spark = df.sparkSession
    table, part = _quoted(name), f"PARTITION ({_quoted(partition_col)} = '{_day(day)}')"
    cols = ", ".join(_quoted(c) for c in spark.table(name).columns if c != partition_col)
    spark.sql(f"INSERT OVERWRITE TABLE {table} {part} SELECT {cols} FROM {{rows}}", rows=df.drop(partition_col))
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {part}")


def save_table(df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None,
               fmt: str = "parquet") -> None:
    """Catalog table; fails when it exists unless another ``mode`` is given.

    With ``path`` the data lives there (a shared location) instead of the
    session's warehouse folder.
    """
    writer = df.write.mode(mode).format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
