"""Queries over recordings: ``events`` as trials on a frame clock."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronopix.functions import scalar
from chronopix.functions.scalar import tidy
from chronopix.operators import align, ordering, stats, windows
from chronopix.registry import query
from chronopix.sources.roles import FRAMES, SENSORS, STIMULI, frames, sensors, stimuli

VELOCITIES = (
    SENSORS
    + """, vel AS (SELECT *, -(s0y + s1y) * cos(radians(45)) AS vel_forw, (s0y - s1y) * cos(radians(45)) AS vel_side, (s0x + s1x) / 2 AS vel_turn FROM
 (SELECT trial_id, frame, t, event_type, k, s0x * 0.66 AS s0x, s0y * 0.68 AS s0y, s1x * 0.68 AS s1x, s1y * 0.69 AS s1y FROM sensors))"""
)
SLOW = """slow AS (SELECT trial_id, t, row_number() OVER (PARTITION BY trial_id ORDER BY t) - 1 AS slow_index FROM frames WHERE event_type = 'purchase'),
 fast AS (SELECT f.*, s.slow_index FROM (SELECT * FROM frames WHERE event_type <> 'purchase') f ASOF LEFT JOIN slow s ON f.trial_id = s.trial_id AND f.t >= s.t)"""
OVER = "PARTITION BY trial_id ORDER BY frame"


def with_velocities(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sensors(spark, sf_dir)
    calibrated = s.withColumns({c: F.col(c) * g for c, g in zip(("s0x", "s0y", "s1x", "s1y"), scalar.GAINS, strict=True)})
    return calibrated.withColumns(scalar.velocities(*[F.col(c) for c in ("s0x", "s0y", "s1x", "s1y")]))


def on_slow_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir)
    return align.asof_index(f.where("event_type <> 'purchase'"), f.where("event_type = 'purchase'"))


@query(f"""WITH {VELOCITIES}, state AS (SELECT *, (vel_forw >= -0.2) AND sum(CAST(vel_forw >= -0.2 AS INTEGER)) OVER ({OVER} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) / 4.0 >= 0.5 AS walk FROM vel),
 slow AS (SELECT trial_id, t, row_number() OVER (PARTITION BY trial_id ORDER BY t) - 1 AS slow_index FROM frames WHERE event_type = 'purchase'),
 fast AS (SELECT f.*, s.slow_index FROM (SELECT * FROM state WHERE event_type <> 'purchase') f ASOF JOIN slow s ON f.trial_id = s.trial_id AND f.t >= s.t)
 SELECT trial_id, slow_index, round(avg(vel_forw), 6) + 0.0 AS vel_forw, round(avg(vel_side), 6) + 0.0 AS vel_side, bool_and(walk) AS walk, count(*) AS n FROM fast GROUP BY ALL""")
def align_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: calibrated velocities and walking state, aligned to the slow clock and reduced."""
    v = with_velocities(spark, sf_dir)
    v = v.withColumn("walk", windows.held_state(F.col("vel_forw") >= -0.2, 4, 0.5))
    fast = align.asof_index(v.where("event_type <> 'purchase'"), v.where("event_type = 'purchase'")).where("slow_index is not null")
    return fast.groupBy("trial_id", "slow_index").agg(tidy(F.avg("vel_forw")).alias("vel_forw"), tidy(F.avg("vel_side")).alias("vel_side"), F.bool_and("walk").alias("walk"), F.count("*").alias("n"))


@query(f"WITH {FRAMES} SELECT trial_id, frame, round(t - min(t) OVER (PARTITION BY trial_id), 6) + 0.0 AS t, t AS abs_t FROM frames")
def frame_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.min("t").over(Window.partitionBy("trial_id"))
    return frames(spark, sf_dir).select("trial_id", "frame", tidy(F.col("t") - start).alias("t"), F.col("t").alias("abs_t"))


@query(f"WITH {VELOCITIES} SELECT trial_id, frame, round(vel_forw, 6) + 0.0 AS vel_forw, round(vel_side, 6) + 0.0 AS vel_side, round(vel_turn, 6) + 0.0 AS vel_turn FROM vel")
def calibrate_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_velocities(spark, sf_dir).select("trial_id", "frame", *[tidy(F.col(c)).alias(c) for c in ("vel_forw", "vel_side", "vel_turn")])


@query(f"WITH {FRAMES}, n AS (SELECT *, count(*) OVER (PARTITION BY trial_id) AS c FROM frames) SELECT trial_id, frame, value FROM n WHERE frame >= 5 AND frame < c - 5")
def time_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.time_crop(frames(spark, sf_dir), 5).select("trial_id", "frame", "value")


@query(f"""WITH {FRAMES}, p AS (SELECT trial_id, frame, CASE WHEN k % 10 = 3 THEN NULL ELSE CAST(k AS DOUBLE) / 38 END AS power FROM frames)
 SELECT trial_id, frame, CASE WHEN coalesce(power, 0) < 0.02 THEN 0 WHEN power < 0.3 THEN 1 WHEN power < 0.7 THEN 5 WHEN power < 1.4 THEN 10 WHEN power < 2.5 THEN 20 ELSE -1 END AS level FROM p""")
def power_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    power = F.when(F.col("k") % 10 != 3, F.col("k").cast("double") / 38)
    return frames(spark, sf_dir).select("trial_id", "frame", scalar.power_level(power).alias("level"))


@query(f"""WITH {FRAMES}, g AS (SELECT trial_id, frame, round(-1.3 + CAST(k AS DOUBLE) / 100, 4) AS c FROM frames)
 SELECT trial_id, frame, CASE WHEN c < -1.15 THEN 'zero' WHEN c < -0.53 THEN 'front' WHEN c > -0.53 AND c < -0.5 THEN 'head' WHEN c >= -0.5 AND c < -0.48 THEN 'cc'
 WHEN c >= -0.48 AND c < -0.45 THEN 'thorax' WHEN c >= -0.45 THEN 'back' ELSE 'error' END AS part FROM g""")
def galvo_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    position = F.round(F.lit(-1.3) + F.col("k").cast("double") / 100, 4)
    return frames(spark, sf_dir).select("trial_id", "frame", scalar.body_part(position).alias("part"))


@query(f"WITH {FRAMES} SELECT trial_id, frame, CAST(k < 30 AS INTEGER) + 2 * CAST(k >= 50 AS INTEGER) + 4 * CAST(k >= 90 AS INTEGER) AS catvar FROM frames")
def catvar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest, walk, back = F.col("k") < 30, F.col("k") >= 50, F.col("k") >= 90
    return frames(spark, sf_dir).select("trial_id", "frame", (rest.cast("int") + 2 * walk.cast("int") + 4 * back.cast("int")).alias("catvar"))


@query(f"WITH {FRAMES}, {SLOW} SELECT trial_id, frame, slow_index FROM fast")
def asof_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on_slow_clock(spark, sf_dir).select("trial_id", "frame", "slow_index")


@query(f"WITH {FRAMES} SELECT a.trial_id, a.frame, a.value, b.k FROM frames a JOIN frames b USING (trial_id, frame)")
def zip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir)
    return align.zip_join(f.select("trial_id", "frame", "value"), f.select("trial_id", "frame", "k"), tolerance=5)


@query(f"WITH {FRAMES}, inner_part AS (SELECT trial_id, frame - 5 AS frame, k FROM (SELECT *, count(*) OVER (PARTITION BY trial_id) AS c FROM frames) WHERE frame >= 5 AND frame < c - 5) SELECT a.trial_id, a.frame, b.k FROM frames a LEFT JOIN inner_part b ON a.trial_id = b.trial_id AND a.frame = b.frame + 5")
def pad_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir)
    values = windows.time_crop(f, 5).select("trial_id", (F.col("frame") - 5).alias("frame"), "k")
    return align.pad_join(f.select("trial_id", "frame"), values, 5)


@query(f"""WITH {STIMULI} SELECT f.trial_id, f.frame, s.condition IS NOT NULL AS in_stim, s.condition AS stim_condition, s.power AS stim_power
 FROM frames f LEFT JOIN stims s ON f.trial_id = s.trial_id AND f.frame >= s.start_frame AND f.frame < s.stop_frame""")
def interval_paint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.paint_intervals(frames(spark, sf_dir).select("trial_id", "frame"), stimuli(spark, sf_dir), ["condition", "power"])


@query(f"""WITH {STIMULI}, cut AS (SELECT *, CAST(floor((stop_frame - start_frame) * (1 - 0.5) / 2) AS BIGINT) AS c FROM stims),
 lv AS (SELECT c.trial_id, c.start_frame, c.stop_frame, CASE WHEN f.k / 38.0 < 0.02 THEN 0 WHEN f.k / 38.0 < 0.3 THEN 1 WHEN f.k / 38.0 < 0.7 THEN 5 WHEN f.k / 38.0 < 1.4 THEN 10 WHEN f.k / 38.0 < 2.5 THEN 20 ELSE -1 END AS level
 FROM cut c JOIN frames f ON f.trial_id = c.trial_id AND f.frame >= c.start_frame + c.c AND f.frame <= greatest(c.stop_frame - c.c - 1, c.start_frame + c.c)),
 n AS (SELECT *, count(*) AS m FROM lv GROUP BY ALL)
 SELECT trial_id, start_frame, stop_frame, level FROM n QUALIFY row_number() OVER (PARTITION BY trial_id, start_frame ORDER BY m DESC, level) = 1""")
def stim_level_central(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.central_level(frames(spark, sf_dir), stimuli(spark, sf_dir), scalar.power_level(F.col("k").cast("double") / 38), 0.5)


PERI = STIMULI + """, peri AS (SELECT s.trial_id, s.start_frame, s.condition, f.frame - s.start_frame AS rel_frame, f.value FROM stims s JOIN frames f
 ON f.trial_id = s.trial_id AND f.frame BETWEEN s.start_frame - 4 AND s.start_frame + 7)"""


@query(f"WITH {PERI} SELECT trial_id, start_frame, rel_frame, round(rel_frame / 4.0, 6) AS rel_t, value FROM peri")
def peri_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = align.peri_event(frames(spark, sf_dir), stimuli(spark, sf_dir), -1.0, 2.0, 4.0, "value")
    return got.select("trial_id", "start_frame", "rel_frame", F.round("rel_t", 6).alias("rel_t"), "value")


@query(f"""WITH {PERI}, whole AS (SELECT * FROM peri QUALIFY count(*) OVER (PARTITION BY trial_id, start_frame) = 12)
 SELECT condition, rel_frame, round(avg(value), 6) + 0.0 AS mean, round(stddev_pop(value) / sqrt(count(value)), 6) + 0.0 AS sem, round(stddev_pop(value) / sqrt(count(value)) * 1.959963984540054, 6) + 0.0 AS ci, count(value) AS n FROM whole GROUP BY ALL""")
def peri_event_mean_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = align.whole_windows(align.peri_event(frames(spark, sf_dir), stimuli(spark, sf_dir), -1.0, 2.0, 4.0, "value"), 12)
    return align.mean_and_error(got, "value", ["condition", "rel_frame"]).withColumns({c: tidy(F.col(c)) for c in ("mean", "sem", "ci")})


@query(f"""WITH {PERI}, whole AS (SELECT * FROM peri QUALIFY count(*) OVER (PARTITION BY trial_id, start_frame) = 12)
 SELECT trial_id, start_frame, rel_frame, round((sum(value) OVER w - first_value(value) OVER w) / 4, 6) + 0.0 AS integral FROM whole WHERE rel_frame >= 0 WINDOW w AS (PARTITION BY trial_id, start_frame ORDER BY rel_frame)""")
def peri_event_integral(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = align.whole_windows(align.peri_event(frames(spark, sf_dir), stimuli(spark, sf_dir), -1.0, 2.0, 4.0, "value"), 12).where("rel_frame >= 0")
    w = Window.partitionBy("trial_id", "start_frame").orderBy("rel_frame").rowsBetween(Window.unboundedPreceding, 0)
    return got.select("trial_id", "start_frame", "rel_frame", tidy((F.sum("value").over(w) - F.first("value").over(w)) / 4).alias("integral"))


@query(f"WITH {FRAMES} SELECT a.trial_id, round(corr(a.value, b.value), 6) + 0.0 AS corr, count(*) AS n FROM frames a JOIN frames b ON a.trial_id = b.trial_id AND b.frame = a.frame + 3 GROUP BY ALL")
def lag_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = align.lag_join(frames(spark, sf_dir), "value", "value", 3)
    return pairs.groupBy("trial_id").agg(tidy(F.corr("x", "y")).alias("corr"), F.count("*").alias("n"))


@query(f"WITH {FRAMES} SELECT trial_id, frame, value, lead(value) OVER ({OVER}) AS next_value FROM frames QUALIFY next_value IS NOT NULL")
def consecutive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.paired_rows(frames(spark, sf_dir).select("trial_id", "frame", "value"), ["value"])


GROUPED = f"WITH {FRAMES}, {SLOW}, g AS (SELECT * FROM fast WHERE slow_index IS NOT NULL)"


@query(f"{GROUPED} SELECT trial_id, slow_index, round(avg(value), 6) + 0.0 AS mean, round(stddev_pop(value), 6) + 0.0 AS std, min(value) AS min, max(value) AS max FROM g GROUP BY ALL")
def reduce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = on_slow_clock(spark, sf_dir).select("trial_id", "slow_index", "frame", *[F.col("value").alias(c) for c in ("mean", "std", "min", "max")])
    return align.reduce_groups(df, {c: c for c in ("mean", "std", "min", "max")}).withColumns({c: tidy(F.col(c)) for c in ("mean", "std")})


@query(f"""{GROUPED} SELECT trial_id, slow_index, bool_or(k >= 50) AS "any", bool_and(k >= 50) AS "all", avg(CAST(k >= 50 AS INTEGER)) > 0.5 AS bin50, avg(CAST(k >= 50 AS INTEGER)) > 0.75 AS bin75, avg(CAST(k >= 50 AS INTEGER)) > 0.9 AS bin90 FROM g GROUP BY ALL""")
def reduce_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("any", "all", "bin50", "bin75", "bin90")
    df = on_slow_clock(spark, sf_dir).select("trial_id", "slow_index", "frame", *[(F.col("k") >= 50).cast("int").alias(c) for c in names])
    return align.reduce_groups(df, {c: c for c in names})


@query(f"""{GROUPED} SELECT trial_id, slow_index, arg_min(event_type, frame) AS "first", arg_max(event_type, frame) AS "last",
 CASE WHEN arg_min(event_type, frame) = arg_max(event_type, frame) THEN arg_min(event_type, frame) ELSE arg_min(event_type, frame) || arg_max(event_type, frame) END AS first_last FROM g GROUP BY ALL""")
def reduce_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("first", "last", "first_last")
    df = on_slow_clock(spark, sf_dir).select("trial_id", "slow_index", "frame", *[F.col("event_type").alias(c) for c in names])
    return align.reduce_groups(df, {c: c for c in names})


@query(f"""{GROUPED}, n AS (SELECT trial_id, slow_index, event_type, count(*) AS c FROM g GROUP BY ALL), s AS (SELECT *, sum(c) OVER (PARTITION BY trial_id, slow_index) AS total FROM n)
 SELECT trial_id, slow_index, CASE WHEN c < 0.5 * total THEN '' ELSE event_type END AS event_type FROM s QUALIFY row_number() OVER (PARTITION BY trial_id, slow_index ORDER BY c DESC, event_type) = 1""")
def reduce_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.most_frequent(on_slow_clock(spark, sf_dir), "event_type", 0.5, "")


STATES = f"""WITH {VELOCITIES}, raw AS (SELECT *, vel_forw >= 0.03 AS w, abs(vel_forw) <= 0.4 AND abs(vel_side) <= 0.4 AS r FROM vel),
 states AS (SELECT trial_id, frame, w AND sum(CAST(w AS INTEGER)) OVER ({OVER} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) / 4.0 >= 0.75 AS walk,
 r AND sum(CAST(r AS INTEGER)) OVER ({OVER} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) / 4.0 >= 0.75 AS rest FROM raw)"""


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = with_velocities(spark, sf_dir)
    return v.select("trial_id", "frame", windows.walking(F.col("vel_forw"), 0.03, 4).alias("walk"), windows.resting(F.col("vel_forw"), F.col("vel_side"), threshold=0.4, size=4).alias("rest"))


@query(f"{STATES} SELECT trial_id, frame, walk FROM states")
def walk_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states(spark, sf_dir).select("trial_id", "frame", "walk")


@query(f"{STATES} SELECT trial_id, frame, rest FROM states")
def rest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states(spark, sf_dir).select("trial_id", "frame", "rest")


@query(f"{STATES} SELECT trial_id, round(avg(CAST(walk AS INTEGER)), 6) AS walking, round(avg(CAST(rest AS INTEGER)), 6) AS resting FROM states GROUP BY ALL")
def state_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states(spark, sf_dir).groupBy("trial_id").agg(F.round(F.avg(F.col("walk").cast("int")), 6).alias("walking"), F.round(F.avg(F.col("rest").cast("int")), 6).alias("resting"))


ISLANDS = f"WITH {FRAMES}, isl AS (SELECT *, k >= 50 AS s, frame - row_number() OVER (PARTITION BY trial_id, k >= 50 ORDER BY frame) AS island FROM frames)"


def line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).withColumn("s", F.col("k") >= 50)


@query(f"{ISLANDS} SELECT trial_id, frame, s AND row_number() OVER (PARTITION BY trial_id, s, island ORDER BY frame) > 1 AS s FROM isl")
def clean_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.trimmed_runs(line(spark, sf_dir), "s", 1).select("trial_id", "frame", "s")


@query(f"{ISLANDS} SELECT trial_id, s, min(frame) AS start_frame, max(frame) AS end_frame FROM isl GROUP BY trial_id, s, island")
def islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.spans(line(spark, sf_dir), "s")


@query(f"""{GROUPED}, m AS (SELECT trial_id, slow_index AS frame, avg(value) AS value FROM g GROUP BY ALL), cut AS (SELECT * FROM m QUALIFY frame < max(frame) OVER (PARTITION BY trial_id))
 SELECT trial_id, frame, round(value, 6) + 0.0 AS value, value >= 50 AND sum(CAST(value >= 50 AS INTEGER)) OVER ({OVER} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) / 4.0 >= 0.75 AS walk FROM cut""")
def slow_clock_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    slow = align.reduce_groups(on_slow_clock(spark, sf_dir), {"value": "mean"}).withColumnRenamed("slow_index", "frame")
    slow = slow.withColumn("_m", F.max("frame").over(Window.partitionBy("trial_id"))).where("frame < _m")
    return slow.select("trial_id", "frame", tidy(F.col("value")).alias("value"), windows.walking(F.col("value"), 50.0, 4).alias("walk"))


@query(f"WITH {FRAMES} SELECT trial_id, frame, round(sum(value) OVER ({OVER} ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING) / 8, 6) + 0.0 AS smooth FROM frames")
def moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).select("trial_id", "frame", tidy(windows.moving_average(F.col("value"), 8)).alias("smooth"))


WEIGHTS = windows.gaussian_weights(1.0)
REFLECTED = f"""WITH {FRAMES}, n AS (SELECT trial_id, frame, value, count(*) OVER (PARTITION BY trial_id) AS n FROM frames),
 near AS (SELECT a.trial_id, a.frame, o.o, ((a.frame + o.o) % (2 * n) + 2 * n) % (2 * n) AS m, n FROM n a, (SELECT unnest(range(-4, 5)) AS o) o),
 pick AS (SELECT near.trial_id, near.frame, near.o, n.value FROM near JOIN n ON n.trial_id = near.trial_id AND n.frame = least(m, 2 * near.n - 1 - m))"""


@query(f"{REFLECTED} SELECT trial_id, frame, round(sum(value * CASE o {' '.join(f'WHEN {k - 4} THEN CAST({w!r} AS DOUBLE)' for k, w in enumerate(WEIGHTS))} END), 6) + 0.0 AS smooth FROM pick GROUP BY ALL")
def gaussian_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = windows.kernel_filter(frames(spark, sf_dir).select("trial_id", "frame", "value"), "value", WEIGHTS, "smooth")
    return got.select("trial_id", "frame", tidy(F.col("smooth")).alias("smooth"))


@query(f"{REFLECTED} SELECT trial_id, frame, median(value) AS smooth FROM pick WHERE o BETWEEN -2 AND 2 GROUP BY ALL")
def median_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.median_filter(frames(spark, sf_dir).select("trial_id", "frame", "value"), "value", 5, "smooth").select("trial_id", "frame", "smooth")


EDGES = f"WITH {FRAMES}, e AS (SELECT trial_id, frame, k >= 50 AS s, coalesce(lag(k >= 50) OVER ({OVER}), false) AS b FROM frames), marked AS (SELECT trial_id, frame, s, s AND NOT b AS rising, NOT s AND b AS falling FROM e)"


@query(f"{EDGES} SELECT trial_id, frame, rising, falling FROM marked")
def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.edges(line(spark, sf_dir), "s").select("trial_id", "frame", "rising", "falling")


@query(f"""{EDGES}, u AS (SELECT trial_id, frame, row_number() OVER ({OVER}) AS i FROM marked WHERE rising), d AS (SELECT trial_id, frame, row_number() OVER ({OVER}) AS i FROM marked WHERE falling)
 SELECT u.trial_id, u.i, u.frame AS start_frame, d.frame AS stop_frame FROM u JOIN d USING (trial_id, i)""")
def edge_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.edge_pairs(line(spark, sf_dir), "s").withColumn("i", F.col("i").cast("long"))


@query(f"WITH {FRAMES}, q AS (SELECT trial_id, (quantile_cont(value, 0.99) + quantile_cont(value, 0.01)) / 2 AS lim FROM frames GROUP BY ALL) SELECT f.trial_id, f.frame, f.value > q.lim AS high FROM frames f JOIN q USING (trial_id)")
def adaptive_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.adaptive_level(frames(spark, sf_dir), "value").select("trial_id", "frame", "high")


@query(f"WITH {FRAMES} SELECT trial_id, frame, coalesce(last_value(CASE WHEN k >= 50 THEN value END IGNORE NULLS) OVER ({OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS filled FROM frames")
def ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).select("trial_id", "frame", windows.forward_fill(F.when(F.col("k") >= 50, F.col("value"))).alias("filled"))


@query(f"""WITH {SENSORS}, m AS (SELECT trial_id, frame, coalesce(sqrt((s0x - lag(s0x) OVER w) * (s0x - lag(s0x) OVER w) + (s0y - lag(s0y) OVER w) * (s0y - lag(s0y) OVER w)), 0) AS step FROM sensors WINDOW w AS ({OVER}))
 SELECT trial_id, frame, round(sum(step) OVER ({OVER} ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING) / 8, 6) + 0.0 AS energy FROM m""")
def motion_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    step, _ = windows.motion_energy(F.col("s0x"), F.col("s0y"), 8)
    return sensors(spark, sf_dir).select("trial_id", "frame", step.alias("step")).select("trial_id", "frame", tidy(windows.moving_average(F.col("step"), 8)).alias("energy"))


@query(f"WITH {FRAMES} SELECT trial_id, frame, round((sum(value) OVER w - first_value(value) OVER w) / 16, 8) + 0.0 AS integral FROM frames WINDOW w AS ({OVER})")
def cum_integral(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).select("trial_id", "frame", tidy(windows.cumulative_integral(F.col("value"), 16.0), 8).alias("integral"))


@query(f"WITH {FRAMES}, d AS (SELECT trial_id, t - lag(t) OVER ({OVER}) AS d FROM frames) SELECT trial_id, round(1 / avg(d), 9) AS rate_of_mean, round(avg(CASE WHEN d > 0 THEN 1 / d END), 6) AS mean_of_rate FROM d GROUP BY ALL")
def frame_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.frame_rates(frames(spark, sf_dir)).select("trial_id", F.round("rate_of_mean", 9).alias("rate_of_mean"), F.round("mean_of_rate", 6).alias("mean_of_rate"))


@query(f"{EDGES}, c AS (SELECT trial_id, frame, CAST(sum(CAST(rising AS INTEGER)) OVER ({OVER}) - 1 AS BIGINT) AS c FROM marked) SELECT trial_id, frame, CASE WHEN c >= 0 THEN c END AS tick_frame FROM c")
def tick_to_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.tick_to_frame(line(spark, sf_dir), "s").select("trial_id", "frame", "tick_frame")


@query(f"WITH {FRAMES}, s AS (SELECT *, min(CASE WHEN k >= 50 THEN frame END) OVER (PARTITION BY trial_id) AS first FROM frames) SELECT trial_id, frame, value FROM s WHERE k >= 50 OR frame = first - 1")
def clip_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.clipped(line(spark, sf_dir), "s").select("trial_id", "frame", "value")


@query(f"WITH {FRAMES}, b AS (SELECT trial_id, CAST(floor((t - min(t) OVER (PARTITION BY trial_id)) / 86400) AS BIGINT) AS bin, value FROM frames) SELECT trial_id, bin, round(avg(value), 6) + 0.0 AS mean, count(*) AS n FROM b GROUP BY ALL")
def temporal_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.binned(frames(spark, sf_dir), "value", 86400.0).withColumn("mean", tidy(F.col("mean")))


@query(f"WITH {FRAMES} SELECT trial_id, frame, value FROM frames WHERE frame % 4 = 3")
def every_nth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.every_nth(frames(spark, sf_dir), 4).select("trial_id", "frame", "value")


@query(f"WITH {FRAMES}, want AS (SELECT unnest([3, 0, 3, 7]) AS frame, unnest([0, 1, 2, 3]) AS place) SELECT trial_id, place, frames.frame, value FROM frames JOIN want ON want.frame = frames.frame")
def select_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    want = spark.createDataFrame([(i, f) for i, f in enumerate([3, 0, 3, 7])], "place int, frame long")
    return frames(spark, sf_dir).join(F.broadcast(want), "frame").select("trial_id", "place", "frame", "value")


@query(f"""WITH {FRAMES} SELECT trial_id, frame, coalesce(last_value(CASE WHEN k >= 80 THEN true WHEN k < 20 THEN false END IGNORE NULLS) OVER ({OVER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS overlay FROM frames""")
def state_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.state_overlay(frames(spark, sf_dir), F.col("k") >= 80, F.col("k") < 20).select("trial_id", "frame", "overlay")


@query(f"WITH {FRAMES} SELECT trial_id, frame, round((value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0), 6) + 0.0 AS z FROM frames WINDOW w AS (PARTITION BY trial_id)")
def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).select("trial_id", "frame", tidy(stats.zscore(F.col("value"))).alias("z"))


@query(f"WITH {FRAMES} SELECT trial_id, frame, round((value - min(value) OVER w) / nullif(max(value) OVER w - min(value) OVER w, 0), 6) + 0.0 AS scaled FROM frames WINDOW w AS (PARTITION BY trial_id)")
def minmax_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).select("trial_id", "frame", tidy(stats.min_max(F.col("value"))).alias("scaled"))


@query(f"WITH {FRAMES}, q AS (SELECT trial_id, quantile_cont(value, 0.05) AS a, quantile_cont(value, 0.95) AS b FROM frames GROUP BY ALL) SELECT trial_id, frame, round((value - a) / nullif(b - a, 0), 6) + 0.0 AS scaled FROM frames JOIN q USING (trial_id)")
def quantile_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.quantile_normalised(frames(spark, sf_dir), "value", 0.9, "scaled").select("trial_id", "frame", tidy(F.col("scaled")).alias("scaled"))


@query(f"""WITH {FRAMES}, r AS (SELECT trial_id, avg(value) OVER w AS m, count(*) OVER w AS n FROM frames WINDOW w AS ({OVER} ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)), b AS (SELECT trial_id, min(m) AS f0 FROM r WHERE n = 8 GROUP BY ALL)
 SELECT trial_id, frame, CASE WHEN f0 <> 0 THEN round((value - f0) / f0, 5) + 0.0 ELSE 0 END AS dff FROM frames JOIN b USING (trial_id)""")
def dff_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir).select("trial_id", "frame", "value")
    return stats.relative_to_baseline(f, "value", stats.minimum_baseline(f, "value", 8, ["trial_id"]), ["trial_id"], 1.0).select("trial_id", "frame", tidy(F.col("dff"), 5).alias("dff"))


@query(f"WITH {FRAMES} SELECT trial_id, arg_min(frame, (-value, frame)) AS argmax, arg_min(frame, (value, frame)) AS argmin FROM frames GROUP BY ALL")
def argmax_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.argmax_first(frames(spark, sf_dir), "value")


@query(f"WITH {FRAMES} SELECT 'low' AS part, trial_id, frame, value FROM frames WHERE k < 50 UNION ALL SELECT 'high', trial_id, frame, value FROM frames WHERE k >= 50")
def union_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = frames(spark, sf_dir)
    part = lambda name, on: f.where(on).select(F.lit(name).alias("part"), "trial_id", "frame", "value")
    return part("low", F.col("k") < 50).unionByName(part("high", F.col("k") >= 50))


@query(f"WITH {FRAMES} SELECT trial_id, frame, CASE WHEN frame < ceil(count(*) OVER (PARTITION BY trial_id) / 2.0) THEN 0 ELSE 1 END AS half FROM frames")
def split_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.halves(frames(spark, sf_dir)).select("trial_id", "frame", "half")


@query(f"WITH {FRAMES}, s AS (SELECT trial_id, frame, count(*) OVER (PARTITION BY trial_id) // 6 AS s FROM frames) SELECT trial_id, frame, CASE WHEN s = 0 THEN 0 ELSE least(frame // s, 5) END AS fold FROM s")
def cv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.folds(frames(spark, sf_dir), 6).select("trial_id", "frame", "fold")


@query(f"WITH {FRAMES} SELECT trial_id, frame, value FROM frames WHERE frame >= CAST(0.5 * 16 AS INTEGER) AND frame < CAST(0.5 * 16 AS INTEGER) + CAST(1.0 * 16 AS INTEGER)")
def time_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, length = int(0.5 * 16), int(1.0 * 16)
    return frames(spark, sf_dir).where((F.col("frame") >= start) & (F.col("frame") < start + length)).select("trial_id", "frame", "value")


@query(f"WITH {FRAMES} SELECT trial_id, frame, value FROM frames WHERE k < 20 OR k >= 80")
def state_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).where((F.col("k") < 20) | (F.col("k") >= 80)).select("trial_id", "frame", "value")


@query()
def weighted_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampling operator: 500 rows without replacement, by weight."""
    return ordering.weighted_sample(frames(spark, sf_dir).select("trial_id", "frame", "value"), "value", 500, 7)


@query()
def shuffle_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.shuffled(frames(spark, sf_dir).select("trial_id", "frame", "value"), "value", 7)
