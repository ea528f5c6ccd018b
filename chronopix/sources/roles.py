"""The roles that plain tables play: recordings on a frame clock, image stacks, stimuli.

Every role makes order explicit: a trial id and a frame number beside each row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """trial_id, frame, t and the raw columns of ``events``; k from its properties."""
    clock = Window.partitionBy("user_id").orderBy("ts", "event_id")
    seconds = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)") / 1e6
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("trial_id"), (F.row_number().over(clock) - 1).cast("long").alias("frame"), seconds.alias("t"), "value", "event_type", "event_id", F.get_json_object("props", "$.k").cast("int").alias("k")
    )


FRAMES = """frames AS (SELECT user_id AS trial_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame,
 epoch(ts) AS t, value, event_type, event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)"""


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four sensor channels on the frame clock."""
    k = F.col("k").cast("double")
    return frames(spark, sf_dir).select(
        "trial_id", "frame", "t", "event_type", "k", F.col("value").alias("s0x"), ((k - 50) / 50).alias("s0y"), (F.col("event_id") % 11 - 5).cast("double").alias("s1x"), (F.col("value") / 100 - k / 100).alias("s1y")
    )


SENSORS = FRAMES + """, sensors AS (SELECT trial_id, frame, t, event_type, k, value AS s0x, (CAST(k AS DOUBLE) - 50) / 50 AS s0y,
 CAST(event_id % 11 - 5 AS DOUBLE) AS s1x, value / 100 - CAST(k AS DOUBLE) / 100 AS s1y FROM frames)"""


def pixels(spark: SparkSession, sf_dir: str, width: int = 8) -> DataFrame:
    """An image stack in long form: trial_id, frame, y, x, value."""
    clock = Window.partitionBy("label").orderBy("vec_id")
    stack = table(spark, sf_dir, "embeddings").select(F.col("label").alias("trial_id"), (F.row_number().over(clock) - 1).cast("long").alias("frame"), "embedding")
    long = stack.select("trial_id", "frame", F.posexplode("embedding").alias("pos", "v"))
    return long.select("trial_id", "frame", F.expr(f"cast(pos div {width} as int)").alias("y"), (F.col("pos") % width).alias("x"), F.col("v").cast("double").alias("value"))


PIXELS = """stack AS (SELECT label AS trial_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame, embedding FROM embeddings),
 flat AS (SELECT trial_id, frame, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM stack),
 pixels AS (SELECT trial_id, frame, CAST(pos // 8 AS INTEGER) AS y, CAST(pos % 8 AS INTEGER) AS x, CAST(v AS DOUBLE) AS value FROM flat)"""


def keypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of a wide table on the frame clock of each supplier."""
    clock = Window.partitionBy("l_suppkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("trial_id"), (F.row_number().over(clock) - 1).cast("long").alias("frame"), F.col("l_quantity").alias("ax"), F.col("l_discount").alias("ay"), (F.col("l_extendedprice") / 1e5).alias("bx"),
        F.col("l_tax").alias("by"), (F.col("l_quantity") / 50).alias("cx"), (F.col("l_extendedprice") / 1e4).alias("cy"), "l_orderkey", "l_linenumber", "l_partkey"
    )


KEYPOINTS = """keypoints AS (SELECT l_suppkey AS trial_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) - 1 AS frame,
 l_quantity AS ax, l_discount AS ay, l_extendedprice / 1e5 AS bx, l_tax AS "by", l_quantity / 50 AS cx, l_extendedprice / 1e4 AS cy, l_orderkey, l_linenumber, l_partkey FROM lineitem)"""


def stimuli(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-open stimulus intervals: runs of k >= 50; the condition is the event type
    just before the run (empty at a trial's start)."""
    from chronopix.operators.windows import intervals

    line = frames(spark, sf_dir).withColumn("on", F.col("k") >= 50).withColumn("before", F.coalesce(F.lag("event_type").over(Window.partitionBy("trial_id").orderBy("frame")), F.lit("")))
    return intervals(line, "on", F.min_by("before", "frame").alias("condition"), F.min_by("k", "frame").alias("power"))


STIMULI = FRAMES + """, marked AS (SELECT *, k >= 50 AS "on", coalesce(lag(event_type) OVER (PARTITION BY trial_id ORDER BY frame), '') AS before,
 frame - row_number() OVER (PARTITION BY trial_id, k >= 50 ORDER BY frame) AS island FROM frames),
 stims AS (SELECT trial_id, min(frame) AS start_frame, max(frame) + 1 AS stop_frame, arg_min(before, frame) AS condition, arg_min(k, frame) AS power
 FROM marked WHERE "on" GROUP BY trial_id, island)"""
