"""Sparse-feature text and vector helpers.

Feature text is ``idx:val idx:val`` with 0-based, increasing indexes.  Long
form (index and value arrays) is kept as long as possible; a ``VectorUDT`` is
only built at the model boundary.  Binary features become vectors inside the
JVM (``CountVectorizerModel`` over a fixed ``"0".."d-1"`` vocabulary);
arbitrary values are written in the vector type's own layout and read back.
"""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from entiscore.session import scratch_path


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def feature_text_arrays(text: Column | str) -> tuple[Column, Column]:
    """Parse ``idx:val …`` text into (indices array<int>, values array<double>).

    Pairs without exactly two parts are skipped; empty text gives empty arrays.
    """
    from entiscore.functions.text import jvm_trim, rtrim_chars

    # Trailing ':' dropped first: the JVM split drops trailing empty parts.
    cores = F.transform(F.split(jvm_trim(F.coalesce(_c(text), F.lit(""))), " "),
                        lambda t: rtrim_chars(jvm_trim(t), ":"))
    pairs = F.filter(cores, lambda t: F.size(F.split(t, ":")) == 2)
    parts = F.transform(pairs, lambda t: F.split(t, ":"))
    idx = F.transform(parts, lambda p: jvm_trim(p.getItem(0)).cast("int"))
    val = F.transform(parts, lambda p: jvm_trim(p.getItem(1)).cast("double"))
    return idx, val


def indices_text(indices: Column | str, value_text: str = "1") -> Column:
    """``i:1 j:1 …`` text from an already sorted index array."""
    return F.array_join(
        F.transform(_c(indices), lambda i: F.concat(i.cast("string"), F.lit(":" + value_text))), " ")


def to_sparse_vector(df: DataFrame, num_features: int, indices_col: str = "indices",
                     values_col: str | None = None, output_col: str = "features") -> DataFrame:
    """Add a ``VectorUDT`` column of dimension ``num_features``.

    Without ``values_col`` every listed index gets 1.0.  With values the rows are
    written once to the shared folder, the vectors in the layout of their type, and
    read again as vectors; either way they are built in the JVM.  Indexes must be
    distinct (duplicates are collapsed in the binary form).
    """
    if values_col is None:
        tok = "_entiscore_tokens"
        vocab = [str(i) for i in range(int(num_features))]
        model = CountVectorizerModel.from_vocabulary(
            vocab, inputCol=tok, outputCol=output_col, binary=True)
        staged = df.withColumn(tok, F.transform(F.col(indices_col), lambda i: i.cast("string")))
        return model.transform(staged).drop(tok)
    spark = df.sparkSession
    layout = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(int(num_features)).cast("int").alias("size"),
                      F.coalesce(F.col(indices_col).cast("array<int>"), F.array().cast("array<int>")).alias("indices"),
                      F.coalesce(F.col(values_col).cast("array<double>"), F.array().cast("array<double>")).alias("values"))
    path = scratch_path(spark, "vectors")
    df.withColumn(output_col, layout).write.parquet(path)
    kept = [f for f in df.schema.fields if f.name != output_col]
    order = [c for c in df.columns if c != output_col] + [output_col]
    return spark.read.schema(StructType([*kept, StructField(output_col, VectorUDT())])).parquet(path).select(*order)


def vector_elements(vec: Column | str) -> Column:
    """Vector as ``array<double>`` (JVM-side)."""
    return vector_to_array(_c(vec))
