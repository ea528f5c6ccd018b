"""Recordings that are still being written, as streams of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def frames_stream(spark: SparkSession, path: str, schema: str, files_at_once: int = 16) -> DataFrame:
    """New Parquet files of a folder, a bounded number in each step."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def latest_frame(stream: DataFrame, trial: str, order: str, value: str) -> DataFrame:
    """The last frame of each trial so far; its state is one row for each trial."""
    return stream.groupBy(trial).agg(F.max(order).alias(order), F.max_by(value, order).alias(value))


def binned_counts(stream: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Counts in windows of time; rows later than ``late`` are let go with their windows."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("window"), *keys).agg(F.count("*").alias("n")).select("window.start", *keys, "n")
