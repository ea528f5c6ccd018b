"""Queries that go through files: what a sink has written, a reader must give back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.registry import query
from chronopix.sources import files
from chronopix.sources.roles import FRAMES, SENSORS, frames, sensors, table


@query(f"WITH {SENSORS} SELECT s0x AS sens0X, s0y AS sens0Y, s1x AS sens1X, s1y AS sens1Y, t AS OpflowTime FROM sensors")
def sensor_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.shared_scratch(spark)
    sensors(spark, sf_dir).select("s0x", "s0y", "s1x", "s1y", "t").write.csv(path)
    return files.sensor_csv(spark, path)


def tracker_rows(df: DataFrame) -> DataFrame:
    return df.select(F.col("frame").alias("Frame_counter"), *[(F.col("value") * i + F.col("k")).alias(c) for i, c in enumerate(files.TRACKER_COLUMNS) if i])


@query(f"WITH {FRAMES} SELECT CAST(frame AS DOUBLE) AS Frame_counter, {', '.join(f'value * {i} + k AS {c}' for i, c in enumerate(files.TRACKER_COLUMNS) if i)} FROM frames WHERE event_type <> 'error'")
def tracker_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, f = files.shared_scratch(spark), frames(spark, sf_dir)
    tracker_rows(f).write.csv(f"{path}/camera1")
    tracker_rows(f.where("event_type <> 'error'")).write.csv(f"{path}/camera2")
    return files.tracker_csv(spark, path)


@query(f"WITH {FRAMES} SELECT CAST(trial_id AS VARCHAR) AS trial, 'cam' || (k % 3) AS camera, 100.0::DOUBLE AS fps, CAST(480 + trial_id % 2 AS INTEGER) AS height, 960 AS width, frame, event_id AS grabbed FROM frames")
def camera_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, f = files.shared_scratch(spark), frames(spark, sf_dir)
    camera = F.concat(F.lit("cam"), (F.col("k") % 3).cast("string"))
    # one document for each recording: frames of a trial are bounded by its length
    of_camera = f.groupBy("trial_id", camera.alias("camera")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col("frame").cast("string").alias("f"), F.col("event_id").alias("g"))))).alias("counts"))
    height, width = (480 + F.col("trial_id") % 2).cast("int"), F.lit(960)
    one = lambda v: F.map_from_entries(F.collect_list(F.struct("camera", v)))
    docs = of_camera.groupBy("trial_id").agg(F.map_from_entries(F.collect_list(F.struct("camera", "counts"))).alias("Frame Counts"), F.struct(one(height).alias("Height"), one(width).alias("Width")).alias("ROI"))
    docs.select(F.col("trial_id").cast("string").alias("trial"), F.lit(100.0).alias("FPS"), "Frame Counts", "ROI").write.json(path)
    return files.camera_metadata(spark, path)


@query("SELECT o_orderpriority AS line, count(*) AS n FROM orders WHERE o_custkey % 5 <> 0 GROUP BY ALL")
def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, o = files.shared_scratch(spark), table(spark, sf_dir, "orders")
    o.select(F.when(F.col("o_custkey") % 5 == 0, "  ").otherwise(F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))).alias("value")).write.text(path)
    return files.manifest(spark, path).groupBy("line").agg(F.count("*").alias("n"))


CENTRE_ROWS_SQL = "SELECT CAST(c_custkey % 1000 AS INTEGER) AS idx, CAST(c_custkey * 7 % 90 AS INTEGER) AS y, CAST(c_nationkey * 40 AS INTEGER) AS x FROM customer"


@query(f"SELECT min(idx) AS idx, y, x FROM ({CENTRE_ROWS_SQL}) GROUP BY y, x")
def centres_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, c = files.shared_scratch(spark), table(spark, sf_dir, "customer")
    files.write_centres(c.select((F.col("c_custkey") % 1000).alias("idx"), (F.col("c_custkey") * 7 % 90).alias("y"), (F.col("c_nationkey") * 40).alias("x")), path)
    return files.read_centres(spark, path)


@query(f"WITH {FRAMES} SELECT CAST(trial_id AS INTEGER) AS trial_id, frame, event_type AS label FROM frames")
def label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.shared_scratch(spark)
    files.write_labels(frames(spark, sf_dir).select("trial_id", "frame", F.col("event_type").alias("label")), path)
    return files.read_labels(spark, path, "frame long, label string", kind="int")


@query(f"""WITH {FRAMES}, s AS (SELECT trial_id, frame, frame - lag(frame) OVER (PARTITION BY trial_id ORDER BY frame) AS step FROM frames WHERE k < 95)
 SELECT trial_id, count(*) AS n, min(frame) AS first, max(frame) AS last, count(*) FILTER (step <> 1) AS gaps FROM s GROUP BY ALL""")
def camera_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = frames(spark, sf_dir).where("k < 95").select("trial_id", F.format_string("camera_5_img_%d.jpg", "frame").alias("name"))
    return files.frame_gaps(names, F.col("name"), ["trial_id"])


@query("""SELECT c_nationkey AS fly, c_name AS trial, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) - 1 AS position FROM customer
 WHERE starts_with(c_name, 'Customer') AND ends_with(c_name, '1') AND contains(c_name, '0') AND NOT contains(c_name, '9')""")
def trial_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("fly"), F.col("c_name").alias("trial"))
    return files.discovered(names, "trial", "fly", startswith="Customer", endswith="1", contains="0", exclude="9").withColumn("position", F.col("position").cast("long"))


@query("SELECT s_nationkey, min(s_name) AS match, CASE WHEN count(*) = 1 THEN 'found' ELSE 'ambiguous' END AS state FROM supplier WHERE ends_with(s_name, '3') GROUP BY ALL")
def unique_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.unique_match(table(spark, sf_dir, "supplier").where(F.col("s_name").endswith("3")), F.col("s_name"), ["s_nationkey"])
