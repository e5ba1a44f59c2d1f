"""Scans: CSV (typed, raw, labelled), dense and sparse vector text, day partitions.

All readers are distributed Spark scans; none reads a file on the driver.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from entiscore.functions.text import jvm_trim
from entiscore.functions.vectors import to_sparse_vector


def int_schema(names: list[str]) -> StructType:
    """A schema of nullable integer columns (the typed CSV's declared schema)."""
    return StructType([StructField(n, IntegerType(), True) for n in names])


def read_csv_typed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line and a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line; every column read as text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_labeled_csv(spark: SparkSession, path: str, header: bool = True,
                     features_col: str = "features") -> DataFrame:
    """Numeric CSV: first column the label (truncated to an integer), the rest a dense vector.

    Cells are trimmed; every record is kept (the header is the only line
    skipped).  Returns ``label double, features vector``.
    """
    raw = spark.read.option("header", header).option("inferSchema", False).csv(path)
    cols = raw.columns
    vals = [F.trim(F.col(c)).cast("double") for c in cols]
    label = vals[0].cast("int").cast("double")
    return raw.select(label.alias("label"), array_to_vector(F.array(*vals[1:])).alias(features_col))


def read_dense_text(spark: SparkSession, path: str, sep: str = " ", features_col: str = "features") -> DataFrame:
    """Lines of separated numbers → one dense vector per line."""
    lines = spark.read.text(path)
    nums = F.transform(F.split(F.trim(F.col("value")), sep), lambda s: F.trim(s).cast("double"))
    return lines.where(F.length(F.trim(F.col("value"))) > 0).select(array_to_vector(nums).alias(features_col))


def parse_sparse_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """``label idx:val …`` lines → ``label, indices, values`` (0-based indexes).

    Lines are trimmed; blank lines and ``#`` comments are skipped; empty items
    are ignored.  Indexes must strictly increase, else the job fails.
    """
    line = jvm_trim(F.col(value_col))                    # JVM trim: control characters too
    kept = lines.where(~((line == "") | line.startswith("#"))).select(line.alias("_line"))
    items = F.split(F.col("_line"), " ")
    pairs = F.transform(F.filter(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(1))),
                                 lambda s: F.length(s) > 0),
                        lambda s: F.split(s, ":"))
    staged = kept.select(
        items.getItem(0).cast("double").alias("label"),
        F.transform(pairs, lambda p: p.getItem(0).cast("int")).alias("indices"),
        F.transform(pairs, lambda p: p.getItem(1).cast("double")).alias("values"),
    ).withColumn("indices", F.coalesce(F.col("indices"), F.array().cast("array<int>")))
    ordered = F.forall(F.sequence(F.lit(1), F.greatest(F.size("indices") - 1, F.lit(1))),
                       lambda i: (F.size("indices") < 2) | (F.element_at("indices", i + 1) > F.element_at("indices", i)))
    return staged.withColumn(
        "indices", F.when(ordered, F.col("indices")).otherwise(
            F.raise_error(F.lit("indexes must be strictly increasing")).cast("array<int>")))


def sparse_dimension(parsed: DataFrame) -> int:
    """``max(last index) + 1`` over all lines (one scalar to the driver)."""
    last = F.coalesce(F.try_element_at("indices", F.lit(-1)), F.lit(0))   # empty line → 0
    row = parsed.agg(F.max(last).alias("m")).first()
    return 0 if row is None or row["m"] is None else int(row["m"]) + 1


def read_sparse_text(spark: SparkSession, path: str, num_features: int | None = None,
                     keep_arrays: bool = False) -> DataFrame:
    """0-based sparse vector text → ``label, features`` (``VectorUDT``).

    The dimension is ``num_features`` when given (> 0), else inferred.
    """
    parsed = parse_sparse_lines(spark.read.text(path))
    dim = num_features if num_features and num_features > 0 else sparse_dimension(parsed)
    out = to_sparse_vector(parsed, dim, "indices", "values", "features")
    return out if keep_arrays else out.select("label", "features")


def read_table_days(spark: SparkSession, name: str, days: list[str], partition_col: str = "stat_date") -> DataFrame:
    """Some days of a day-partitioned catalog table; the filter prunes partitions through the catalog."""
    return spark.table(name).where(F.col(partition_col).isin(list(days)))


def read_partition(spark: SparkSession, path: str, day: str, partition_col: str = "stat_date",
                   fmt: str = "parquet") -> DataFrame:
    """One day of a day-partitioned table; only that day's folder is listed."""
    root = path.rstrip("/")
    return spark.read.format(fmt).option("basePath", root).load(f"{root}/{partition_col}={day}")
