"""Helpers shared by the training-data operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entiscore.session import checkpointed, scratch_path

#: The characters that separate words (space, tab … carriage return).
WORD_SPACE = " \t\n\x0b\x0c\r"
WORD_SPLIT = "[\\x20\\x09-\\x0D]+"

ROW = "_row"


def packed(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` as one struct column, so that no column an operator
    adds can clash with a column the caller brought along."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))


def unpacked(df: DataFrame, added: dict[str, Column], replaced: dict[str, Column] | None = None) -> DataFrame:
    """The original columns again, ``replaced`` ones exchanged in place and ``added``
    ones appended.  An added name that the caller already used replaces that column."""
    replaced = replaced or {}
    names = df.schema[ROW].dataType.names
    clash = {c.lower() for c in added}
    cols = [replaced[c].alias(c) if c in replaced else F.col(f"{ROW}.`{c}`").alias(c)
            for c in names if c.lower() not in clash]
    return df.select(*cols, *[v.alias(k) for k, v in added.items()])


def field(name: str) -> Column:
    return F.col(f"{ROW}.`{name}`")


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, unchanged; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_SPLIT, -1))


def word_count(text: Column) -> Column:
    """Number of words of a text as a long; 0 for null."""
    return F.size(words(text)).cast("long")


def once(value: Column, use) -> Column:
    """``use(x)`` with ``value`` evaluated once and bound to ``x`` however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def fold(doc_id: Column, parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``; a null ``doc_id`` counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def uniform(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on ``key`` alone, for samples that reruns repeat."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 40)).cast("double") / F.lit(float(1 << 40))


#: Parts of a class when its rows meet the class's rate.
_SALTS = 64


def class_sample(rows: DataFrame, label: str, key: str, per_class: int, seed: str, few: bool = False) -> DataFrame:
    """About ``per_class`` rows of each class by a hash of ``key``, and no more than that.

    For fitting only.  The class counts are one aggregate joined back (a row a class, however many
    there are; ``few``: a handful by definition, so they are broadcast); a class is dealt over
    ``_SALTS`` parts for that.  The rows that are picked are a filter on the hash, so no class is sorted
    or gathered as a whole.
    """
    rates = rows.groupBy(label).agg((F.lit(float(per_class)) / F.count(F.lit(1))).alias("_rate"))
    u = uniform(F.col(key), seed)
    least = Window.partitionBy(label).orderBy(u, key)        # of the picked rows: about per_class of a class
    if few:
        rated = rows.join(F.broadcast(rates), label)
    else:       # any part will do: each holds the rate
        parts = rates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
        own = rows.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int"))
        rated = own.join(parts, [label, "_salt"]).drop("_salt")
    return (rated.where(u < F.col("_rate")).withColumn("_at", F.row_number().over(least))
            .where(F.col("_at") <= per_class).drop("_at", "_rate"))


def modest_batches(spark) -> None:
    """Arrow batches of 512 rows unless the session says otherwise: texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, "512")


@contextmanager
def batches_of(spark, rows: int):
    """Arrow batches of at most ``rows`` rows for what runs inside; the session's own size afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """An eager checkpoint in the shared folder, after which its shuffle files are let go.

    They are only needed to make the rows again, and those are on shared storage now;
    else every step's shuffles stay on the executors' disks until the driver happens
    to collect its garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        return checkpointed(df.select("*"))      # a frame planned under the setting
    finally:
        conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet in the shared folder and read again, and where.

    For loops: unlike a checkpoint the rows come with their real size, so the size
    the optimiser expects does not multiply from round to round.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def let_go(spark, path: str) -> None:
    """Deletes what :func:`stored` wrote, once nothing reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
