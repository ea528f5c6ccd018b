"""Queries that bring behaviour to another clock, score it by classes, and find its files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.functions.scalar import cohort_condition, joined_each, tidy
from chronopix.operators import align, scoring, windows
from chronopix.plans.recordings import VELOCITIES, on_slow_clock, with_velocities
from chronopix.registry import query
from chronopix.sources import stores
from chronopix.sources.files import shared_scratch, unique_match
from chronopix.sources.roles import FRAMES, frames, table

#: A column of the fast clock, its name on the slow clock, and how it is reduced; ``odour`` isn't recorded here.
COLUMN_MAP = {"value": ("v", "mean"), "k": ("k_most", "max"), "on": ("stimulus", "any"), "event_type": ("condition", "first_last"), "odour": ("odour", "max")}


@query(f"""WITH {FRAMES}, slow AS (SELECT trial_id, t, row_number() OVER (PARTITION BY trial_id ORDER BY t) - 1 AS slow_index FROM frames WHERE event_type = 'purchase'),
 fast AS (SELECT f.*, s.slow_index FROM (SELECT * FROM frames WHERE event_type <> 'purchase') f ASOF JOIN slow s ON f.trial_id = s.trial_id AND f.t >= s.t),
 r AS (SELECT trial_id, slow_index, avg(value) AS v, max(k) AS k_most, bool_or(k >= 50) AS stimulus, arg_min(event_type, frame) AS a, arg_max(event_type, frame) AS b FROM fast GROUP BY ALL)
 SELECT trial_id, slow_index, round(coalesce(v, 0), 6) + 0.0 AS v, coalesce(k_most, 0) AS k_most, coalesce(stimulus, false) AS stimulus, coalesce(CASE WHEN a = b THEN a ELSE a || b END, '') AS condition FROM slow LEFT JOIN r USING (trial_id, slow_index)""")
def mapped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the fast clock on every row of the slow clock, by a map of names and reducers."""
    f = frames(spark, sf_dir)
    slow = align.asof_index(f.where("event_type = 'purchase'"), f.where("event_type = 'purchase'")).select("trial_id", "slow_index")
    fast = on_slow_clock(spark, sf_dir).withColumn("on", F.col("k") >= 50)
    return align.mapped_groups(slow, fast, COLUMN_MAP).withColumn("v", tidy(F.col("v")))


@query(f"""WITH {FRAMES}, a AS (SELECT trial_id, t, row_number() OVER (PARTITION BY trial_id ORDER BY t) - 1 AS i FROM frames WHERE event_type = 'purchase'), b AS (SELECT trial_id, t, row_number() OVER (PARTITION BY trial_id ORDER BY t) - 1 AS i FROM frames WHERE event_type = 'click'),
 rest AS (SELECT * FROM frames WHERE event_type NOT IN ('purchase', 'click')), x AS (SELECT r.trial_id, r.frame, a.i AS image_index FROM rest r ASOF LEFT JOIN a ON r.trial_id = a.trial_id AND r.t >= a.t), y AS (SELECT r.trial_id, r.frame, b.i AS flow_index FROM rest r ASOF LEFT JOIN b ON r.trial_id = b.trial_id AND r.t >= b.t)
 SELECT trial_id, frame, image_index, flow_index FROM x JOIN y USING (trial_id, frame)""")
def two_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each frame of a camera the last image and the last reading of the ball's sensors."""
    f = frames(spark, sf_dir)
    rest = f.where("event_type not in ('purchase', 'click')")
    image = align.asof_index(rest, f.where("event_type = 'purchase'")).withColumnRenamed("slow_index", "image_index")
    both = align.asof_index(image, f.where("event_type = 'click'")).withColumnRenamed("slow_index", "flow_index")
    return both.select("trial_id", "frame", "image_index", "flow_index")


@query(f"""WITH {VELOCITIES}, slow AS (SELECT trial_id, t, row_number() OVER (PARTITION BY trial_id ORDER BY t) - 1 AS slow_index FROM frames WHERE event_type = 'purchase'),
 fast AS (SELECT f.*, s.slow_index FROM (SELECT * FROM vel WHERE event_type <> 'purchase') f ASOF JOIN slow s ON f.trial_id = s.trial_id AND f.t >= s.t),
 all_m AS (SELECT trial_id, slow_index AS frame, round(avg(vel_forw), 9) AS f, round(avg(vel_side), 9) AS s, round(avg(vel_turn), 9) AS t FROM fast GROUP BY ALL), m AS (SELECT * FROM all_m QUALIFY frame < max(frame) OVER (PARTITION BY trial_id)),
 raw AS (SELECT *, f >= 0.1 AS w, abs(f) <= 3 AND abs(s) <= 3 AND abs(t) <= 3 AS r FROM m)
 SELECT trial_id, frame, w AND sum(CAST(w AS INTEGER)) OVER (PARTITION BY trial_id ORDER BY frame ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) / 4.0 >= 0.75 AS walk,
 r AND sum(CAST(r AS INTEGER)) OVER (PARTITION BY trial_id ORDER BY frame ROWS BETWEEN 8 PRECEDING AND 7 FOLLOWING) / 16.0 >= 0.75 AS rest FROM raw""")
def slow_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walking and resting on the slow clock from mean velocities, without a trial's last row."""
    v = with_velocities(spark, sf_dir)
    fast = align.asof_index(v.where("event_type <> 'purchase'"), v.where("event_type = 'purchase'"))
    names = ["vel_forw", "vel_side", "vel_turn"]
    slow = align.reduce_groups(fast, dict.fromkeys(names, "mean")).withColumnRenamed("slow_index", "frame")
    kept = windows.without_last(slow).select("trial_id", "frame", *[F.round(c, 9).alias(c) for c in names])
    return kept.select("trial_id", "frame", windows.walking(F.col("vel_forw"), 0.1, 4).alias("walk"), windows.resting(*map(F.col, names), threshold=3.0, size=16).alias("rest"))


CONDITION_SQL = "CASE o_orderkey % 6 WHEN 0 THEN 'after high caffeine, sucrose' WHEN 1 THEN 'low caff. starved' WHEN 2 THEN 'sucrose starvation' WHEN 3 THEN 'starved' WHEN 4 THEN 'high low caff' ELSE 'fed' END"


@query(f"""SELECT o_orderkey, CASE WHEN contains(c, 'high caff') THEN 'high caffeine' WHEN contains(c, 'low caff') THEN 'low caffeine' WHEN contains(c, 'sucr') THEN 'sucrose' WHEN contains(c, 'starv') THEN 'starved' ELSE '' END AS condition FROM (SELECT o_orderkey, {CONDITION_SQL} AS c FROM orders)""")
def cohort_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The condition of an experiment by the first of several words that its notes hold."""
    return table(spark, sf_dir, "orders").select("o_orderkey", cohort_condition(F.expr(CONDITION_SQL)).alias("condition"))


@query("""WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), u AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e), m AS (SELECT label AS class, i, avg(x) AS m FROM u WHERE vec_id % 2 = 0 GROUP BY ALL),
 s AS (SELECT vec_id, class, 4 * sum(x * m) AS s FROM u JOIN m USING (i) GROUP BY ALL), p AS (SELECT vec_id, class, exp(s - max(s) OVER w) AS x, sum(exp(s - top)) OVER w AS total FROM (SELECT *, max(s) OVER (PARTITION BY vec_id) AS top FROM s) WINDOW w AS (PARTITION BY vec_id))
 SELECT vec_id, CAST(arg_max(class, (round(x / total, 9), -class)) AS INTEGER) AS prediction, round(sum(-x / total * ln(x / total)), 6) + 0.0 AS entropy, round(max(x / total), 6) + 0.0 AS probability FROM p GROUP BY ALL""")
def scored_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each vector by a model of half of them: prediction, entropy, and how
    probable the predicted class is."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("class"), F.col("embedding").cast("array<double>").alias("v"))
    model = scoring.class_means(e.where("vec_id % 2 = 0"), "v", "class")
    got = scoring.scored(e, "v", model, sharpness=4.0)
    return got.select("vec_id", F.col("prediction").cast("int").alias("prediction"), tidy(F.col("entropy")).alias("entropy"), tidy(F.array_max("probabilities")).alias("probability"))


@query("SELECT s_nationkey, s_name || '/behData/images' AS path FROM supplier")
def joined_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of folders with the same parts below each."""
    lists = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list("s_name")).alias("names"))
    return lists.select("s_nationkey", F.explode(joined_each(F.col("names"), "behData", "images")).alias("path"))


@query("""SELECT 'T' || s_suppkey AS trial, CASE WHEN s_suppkey % 4 <> 3 THEN 'sync0.txt' END AS match, CASE WHEN s_suppkey % 4 = 3 THEN 'missing' WHEN s_suppkey % 4 = 2 THEN 'ambiguous' ELSE 'found' END AS state FROM supplier""")
def unique_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a trial's folder holds exactly one file of a name, anywhere below it."""
    path, s = shared_scratch(spark), table(spark, sf_dir, "supplier")
    trial = F.concat(F.lit("T"), F.col("s_suppkey").cast("string"))
    names = F.when(F.col("s_suppkey") % 4 == 3, F.array(F.lit("note.txt"))).when(F.col("s_suppkey") % 4 == 2, F.array(F.lit("a/sync0.txt"), F.lit("b/c/sync1.txt"))).otherwise(F.array(F.lit("a/sync0.txt"), F.lit("note.txt")))
    files = s.select(trial.alias("trial"), F.explode(names).alias("name")).select(F.concat_ws("/", "trial", "name").alias("file"))
    stores.write_files(files.select("file", F.lit(0).cast("long").alias("part"), F.lit("1").cast("binary").alias("content")), path)
    listed = stores.folders(spark, path).select(F.regexp_extract("file", "^[^/]*", 0).alias("trial"), F.regexp_extract("file", "[^/]*$", 0).alias("name"))
    found = unique_match(listed.where(F.col("name").startswith("sync")), F.col("name"), ["trial"])
    return listed.select("trial").distinct().join(found, "trial", "left").select("trial", "match", F.coalesce("state", F.lit("missing")).alias("state"))
