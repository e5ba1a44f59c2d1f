"""Streams give the same rows as the batch form of the same work."""

import os

from pyspark.sql import functions as F

from entiscore.streaming import stream as S


def _files(spark, df, path, n=3):
    df.repartitionByRange(n, df.columns[0]).write.mode("overwrite").parquet(path)
    return path


def test_tokens_stream_equals_batch(spark, tmp_dir):
    df = spark.createDataFrame([(i, f"w{i % 3}  x{i}") for i in range(30)], "id long, value string")
    src = _files(spark, df, os.path.join(tmp_dir, "src"))
    stream = S.stream_source(spark, src, df.schema, max_files_per_trigger=1)
    sink, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    q = (S.stream_tokens(stream, "value", keep=["id"]).writeStream.format("parquet")
         .option("path", sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    S.run_to_end(q, 300)
    got = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    want = sorted(tuple(r) for r in S.stream_tokens(df, "value", keep=["id"]).collect())
    assert got == want and len(got) == 60


def test_batch_counts(spark, tmp_dir):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    src = _files(spark, df, os.path.join(tmp_dir, "src"), 4)
    stream = S.stream_source(spark, src, df.schema, max_files_per_trigger=1)
    sink, ckpt = os.path.join(tmp_dir, "counts"), os.path.join(tmp_dir, "ckpt")
    S.run_to_end(S.stream_batch_counts(stream, sink, ckpt, available_now=True), 300)
    rows = spark.read.parquet(sink).collect()
    assert len(rows) == 4 and sum(r.n_rows for r in rows) == 100


def test_stream_score_equals_batch(spark, tmp_dir):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    df = spark.range(200).select(F.col("id"), (F.col("id") % 17).cast("double").alias("x"),
                                 ((F.col("id") % 17) > 8).cast("double").alias("label"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             LogisticRegression(maxIter=10)]).fit(df)
    mpath = os.path.join(tmp_dir, "model")
    model.write().overwrite().save(mpath)
    loaded = PipelineModel.load(mpath)
    src = _files(spark, df, os.path.join(tmp_dir, "src"))
    stream = S.stream_source(spark, src, df.schema, max_files_per_trigger=1)
    sink, ckpt = os.path.join(tmp_dir, "scored"), os.path.join(tmp_dir, "ckpt")
    S.run_to_end(S.stream_score(stream, loaded, sink, ckpt, keep=["id"], available_now=True), 300)
    got = {r.id: (r.prediction, r.score) for r in spark.read.parquet(sink).collect()}
    want = {r.id: (r.prediction, r.score) for r in S.score_stream(df, model, keep=["id"]).collect()}
    assert got == want


def test_byte_bodies_and_repeated_spaces(spark, tmp_dir):
    src = os.path.join(tmp_dir, "bytes")
    spark.createDataFrame([(1, bytearray("a  é b".encode()))], "id int, value binary").write.parquet(src)
    stream = S.stream_source(spark, src, "id int, value binary")
    sink = os.path.join(tmp_dir, "words")
    q = (S.stream_tokens(stream, keep=["id"]).writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", os.path.join(tmp_dir, "ck")).trigger(availableNow=True).start())
    S.run_to_end(q)
    assert sorted(r.word for r in spark.read.parquet(sink).collect()) == ["a", "b", "é"]


def test_two_second_batches_skip_empty_ones(spark, tmp_dir):
    import time
    src, sink = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    spark.range(5).write.parquet(src)
    q = S.stream_batch_counts(S.stream_source(spark, src, "id long"), sink, os.path.join(tmp_dir, "ck"))
    try:
        deadline = time.time() + 60
        while not os.path.isdir(sink) or not any(n.startswith("batch_id=") for n in os.listdir(sink)):
            assert time.time() < deadline and q.isActive
            time.sleep(0.3)
        q.processAllAvailable()
        spark.range(7).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.read.parquet(sink).collect()
    assert sorted(r.n_rows for r in rows) == [5, 7] and all(r.batch_time is not None for r in rows)
    empty = os.path.join(tmp_dir, "none")
    spark.range(0).write.parquet(empty)
    S.run_to_end(S.stream_batch_counts(S.stream_source(spark, empty, "id long"), os.path.join(tmp_dir, "o2"),
                                       os.path.join(tmp_dir, "ck2"), available_now=True))
    assert not os.path.isdir(os.path.join(tmp_dir, "o2"))
