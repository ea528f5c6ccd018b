"""Streams give what the whole tables give."""

import uuid

from pyspark.sql import functions as F

from chronopix.streaming import live

FOLDER = "/root/testdata/sf0.001"


def run(spark, frame, mode):
    name = f"got_{uuid.uuid4().hex}"
    frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


def test_latest_frame(spark, tmp_path):
    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("label", "vec_id", "embedding")
    vectors.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = live.frames_stream(spark, str(tmp_path / "in"), "label int, vec_id long, embedding array<float>", 2)
    got = {r.label: (r.vec_id, r.embedding) for r in run(spark, live.latest_frame(stream, "label", "vec_id", "embedding"), "complete").collect()}
    want = {}
    for r in vectors.collect():
        want[r.label] = max(want.get(r.label, (-1, None)), (r.vec_id, r.embedding))
    assert got == want


def test_binned_counts(spark, tmp_path):
    events = spark.read.parquet(f"{FOLDER}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = live.frames_stream(spark, str(tmp_path / "in"), "ts timestamp, event_type string")
    got = run(spark, live.binned_counts(stream, "ts", "1 day", "1 hour", "event_type"), "complete")
    want = events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select("w.start", "event_type", "count").collect()))
