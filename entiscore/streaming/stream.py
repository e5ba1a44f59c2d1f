"""Structured Streaming: file source, tokens, per-batch counts, model scoring.

The micro-batch interval is a processing-time trigger (2 s by default);
tests and registered queries use ``availableNow`` so the query drains what is
there and stops.  Every sink has a checkpoint in the shared folder, so a
restarted query resumes where it stopped and the file sink stays
exactly-once.  Nothing is collected per batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from entiscore.functions.numeric import probability_of_one

DEFAULT_INTERVAL = "2 seconds"


def stream_source(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Streaming DataFrame over files arriving in ``path`` (schema given, no inference)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def kafka_source(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Kafka topic as a stream (needs the Kafka connector on the classpath)."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def stream_tokens(stream: DataFrame, body_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Decode each body to text and emit one ``word`` row per space-separated token.

    Empty tokens (from repeated spaces) are dropped.
    """
    body = F.col(body_col).cast("string")
    words = stream.select(*(keep or []), F.explode(F.split(body, " ")).alias("word"))
    return words.where(F.col("word") != "")


def _trigger(writer, interval: str | None, available_now: bool):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval or DEFAULT_INTERVAL)


def stream_batch_counts(stream: DataFrame, sink_path: str, checkpoint: str,
                        interval: str | None = DEFAULT_INTERVAL, available_now: bool = False) -> StreamingQuery:
    """Write ``n_rows`` and ``batch_time`` of every micro-batch with rows to ``sink_path/batch_id=<id>``.

    The count is a distributed aggregate of the batch.  ``foreachBatch`` may
    replay a batch after a failure; each batch overwrites only its own
    directory, so a replay rewrites the same row (idempotent, exactly-once
    effect).  Read back, ``batch_id`` is the partition column.
    """
    root = sink_path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        (batch.agg(F.count(F.lit(1)).alias("n_rows"), F.current_timestamp().alias("batch_time"))
              .write.mode("overwrite").parquet(f"{root}/batch_id={int(batch_id)}"))

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval, available_now).start()


def score_stream(stream: DataFrame, model: Transformer, keep: list[str] | None = None) -> DataFrame:
    """``model.transform`` on a stream; ``score`` is the class-1 probability (or the
    model's own ``score`` column)."""
    out = model.transform(stream)
    cols = list(keep or []) + ["prediction"]
    if "probability" in out.columns:
        out = out.withColumn("score", probability_of_one("probability"))
    if "score" in out.columns:
        cols.append("score")
    return out.select(*cols)


def stream_score(stream: DataFrame, model: Transformer, sink_path: str, checkpoint: str,
                 keep: list[str] | None = None, interval: str | None = DEFAULT_INTERVAL,
                 available_now: bool = False) -> StreamingQuery:
    """Score every record with a loaded model and append to parquet (exactly-once file sink)."""
    scored = score_stream(stream, model, keep)
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", sink_path).option("checkpointLocation", checkpoint))
    return _trigger(writer, interval, available_now).start()


def score_batches(stream: DataFrame, model: Transformer, sink_path: str, checkpoint: str, keep: list[str] | None = None,
                  interval: str | None = DEFAULT_INTERVAL, available_now: bool = False,
                  after_batch: Callable[[int], None] | None = None) -> StreamingQuery:
    """Score batch by batch through a batch hook: ``sink_path/batch_id=<id>`` holds the scored rows and ``batch_time``.

    A batch that is replayed after a stop (its rows written, its end not yet recorded in
    ``checkpoint``) overwrites its own folder, so after any number of restarts every row is
    there once.  ``after_batch`` is called with the id when a batch's rows are written.
    """
    root = sink_path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            (score_stream(batch, model, keep).withColumn("batch_time", F.current_timestamp())
             .write.mode("overwrite").parquet(f"{root}/batch_id={int(batch_id)}"))
        if after_batch:
            after_batch(int(batch_id))

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, interval, available_now).start()


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` query, as long as it takes unless a limit is given."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"streaming query did not finish within {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
