"""Queries over filtered images, masks and stamps, detrended and lagged traces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronopix.functions.scalar import circle_arc, tidy
from chronopix.operators import align, framewise, image, linalg, ordering, spatial, stats, trends
from chronopix.plans.stacks import SIZE, centres
from chronopix.registry import query
from chronopix.sources.roles import FRAMES, PIXELS, frames, pixels, table

P = f"WITH {PIXELS}"
FRAME = ["trial_id", "frame"]
#: Neighbours in a disk of two pixels, as rows.
DISK_SQL = "d AS (SELECT dy, dx FROM (SELECT unnest(range(-2, 3)) AS dy), (SELECT unnest(range(-2, 3)) AS dx) WHERE dy * dy + dx * dx <= 4)"
MIRROR = lambda v: f"CASE WHEN {v} < 0 THEN -1 - ({v}) WHEN {v} > 7 THEN 15 - ({v}) ELSE {v} END"


@query(f"""{P}, o AS (SELECT unnest(range(-1, 2)) AS o), n AS (SELECT p.trial_id, p.frame, p.y, p.x, q.value FROM pixels p, o a, o b JOIN pixels q
 ON q.trial_id = p.trial_id AND q.frame = p.frame AND q.y = {MIRROR("p.y + a.o")} AND q.x = {MIRROR("p.x + b.o")}) SELECT trial_id, frame, y, x, round(median(value), 6) + 0.0 AS value FROM n GROUP BY ALL""")
def spatial_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = spatial.framed(pixels(spark, sf_dir), FRAME, SIZE).withColumn("image", spatial.median3(F.col("image"), SIZE, SIZE))
    return spatial.pixelled(got, FRAME, SIZE).withColumn("value", tidy(F.col("value")))


WEIGHTS = spatial.gaussian_weights(1.0, 2.0)


@query(f"""{P}, w AS (SELECT * FROM (VALUES {", ".join(f"({k - 2}, {w!r}::DOUBLE)" for k, w in enumerate(WEIGHTS))}) v(o, w)), n AS (SELECT p.trial_id, p.frame, p.y, p.x, q.value * a.w * b.w AS v FROM pixels p, w a, w b JOIN pixels q
 ON q.trial_id = p.trial_id AND q.frame = p.frame AND q.y = {MIRROR("p.y + a.o")} AND q.x = {MIRROR("p.x + b.o")}) SELECT trial_id, frame, y, x, round(sum(v), 6) + 0.0 AS value FROM n GROUP BY ALL""")
def spatial_gaussian(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = blurred_frames(spark, sf_dir)
    return spatial.pixelled(got, FRAME, SIZE).withColumn("value", tidy(F.col("value")))


def blurred_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return framewise.map_frames(spatial.framed(pixels(spark, sf_dir), FRAME, SIZE), SIZE, SIZE, lambda v: framewise.blurred(v, 1.0, 2.0), ["image"], "image")


BLURRED_SQL = f"""w AS (SELECT * FROM (VALUES {", ".join(f"({k - 2}, {w!r}::DOUBLE)" for k, w in enumerate(WEIGHTS))}) v(o, w)), blurred AS (SELECT p.trial_id, p.frame, p.y, p.x, round(sum(q.value * a.w * b.w), 9) AS value FROM pixels p, w a, w b JOIN pixels q
 ON q.trial_id = p.trial_id AND q.frame = p.frame AND q.y = {MIRROR("p.y + a.o")} AND q.x = {MIRROR("p.x + b.o")} GROUP BY ALL)"""


@query(f"""{P}, {BLURRED_SQL}, q AS (SELECT trial_id, frame, quantile_cont(value, 0.75) AS q FROM blurred GROUP BY ALL), m AS (SELECT trial_id, frame, avg(y) - 4 AS dy, avg(x) - 4 AS dx FROM blurred JOIN q USING (trial_id, frame) WHERE value > q GROUP BY ALL)
 SELECT trial_id, frame, CAST(trunc(dy) AS INTEGER) AS dy, CAST(trunc(dx) AS INTEGER) AS dx FROM m""")
def com_offsets_blurred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centre of what is above a quantile of the blurred frame, less the image's centre."""
    images = spatial.framed(pixels(spark, sf_dir), FRAME, SIZE)
    away = framewise.map_frames(images, SIZE, SIZE, lambda v: framewise.bright_offsets(framewise.blurred(v, 1.0, 2.0).round(9), 0.75), ["image"], "away")
    whole = lambda i: F.col("away")[i].cast("int")
    return away.select(*FRAME, whole(0).alias("dy"), whole(1).alias("dx"))


@query(f"""{P}, off AS (SELECT DISTINCT trial_id, frame, CAST(frame % 3 AS INTEGER) - 1 AS dy, CAST(frame % 2 AS INTEGER) AS dx FROM pixels), m AS (SELECT trial_id, frame, y - dy AS y, x - dx AS x, value FROM pixels JOIN off USING (trial_id, frame)),
 b AS (SELECT trial_id, avg(value) AS border FROM pixels WHERE y < 3 AND x < 3 GROUP BY ALL) SELECT p.trial_id, p.frame, p.y, p.x, round(coalesce(m.value, border), 6) + 0.0 AS value FROM pixels p JOIN b USING (trial_id) LEFT JOIN m USING (trial_id, frame, y, x)""")
def apply_offset_border(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixels(spark, sf_dir)
    off = p.select(*FRAME).distinct().select(*FRAME, ((F.col("frame") % 3).cast("int") - 1).alias("dy"), (F.col("frame") % 2).cast("int").alias("dx"))
    return spatial.apply_border(p, off, 3).withColumn("value", tidy(F.col("value")))


MEANS_SQL = "means AS (SELECT trial_id, y, x, round(avg(value), 9) AS value FROM pixels GROUP BY ALL)"
OTSU_SQL = f"""{MEANS_SQL}, lim AS (SELECT trial_id, min(value) AS lo, max(value) AS hi FROM means GROUP BY ALL),
 h AS (SELECT trial_id, lo, hi, CAST(least(floor((value - lo) / (hi - lo) * 256), 255) AS BIGINT) AS bin, count(*) AS n FROM means JOIN lim USING (trial_id) WHERE hi > lo GROUP BY ALL),
 c AS (SELECT *, lo + (bin + 0.5::DOUBLE) * (hi - lo) / 256 AS c FROM h), s AS (SELECT trial_id, bin, c, sum(n) OVER u AS w0, sum(n * c) OVER u AS s0, sum(n) OVER a AS w, sum(n * c) OVER a AS s FROM c WINDOW u AS (PARTITION BY trial_id ORDER BY bin), a AS (PARTITION BY trial_id)),
 otsu AS (SELECT trial_id, arg_max(c, (between_, -bin)) AS threshold FROM (SELECT *, round(CAST(w0 AS DOUBLE) * (w - w0) * (s0 / w0 - (s - s0) / (w - w0)) * (s0 / w0 - (s - s0) / (w - w0)), 6) AS between_ FROM s WHERE w0 < w) GROUP BY ALL)"""


def trial_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels(spark, sf_dir).groupBy("trial_id", "y", "x").agg(F.round(F.avg("value"), 9).alias("value"))


@query(f"{P}, {OTSU_SQL} SELECT trial_id, round(threshold, 6) + 0.0 AS threshold FROM otsu")
def otsu_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.otsu(trial_means(spark, sf_dir), "value", ["trial_id"]).withColumn("threshold", tidy(F.col("threshold")))


MASK_SQL = f"""{OTSU_SQL}, {DISK_SQL}, m0 AS (SELECT trial_id, y, x, CAST(value > 0.9 * threshold AS INTEGER) AS v FROM means JOIN otsu USING (trial_id)),
 m1 AS (SELECT a.trial_id, a.y, a.x, max(b.v) AS v FROM m0 a, d JOIN m0 b ON b.trial_id = a.trial_id AND b.y = a.y + dy AND b.x = a.x + dx GROUP BY ALL),
 mask AS (SELECT a.trial_id, a.y, a.x, min(b.v) AS v FROM m1 a, d JOIN m1 b ON b.trial_id = a.trial_id AND b.y = a.y + dy AND b.x = a.x + dx GROUP BY ALL)"""


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels above a share of the Otsu threshold, closed: trial_id and ``image`` of 0 and 1."""
    means = trial_means(spark, sf_dir)
    above = means.join(spatial.otsu(means, "value", ["trial_id"]), "trial_id").withColumn("value", (F.col("value") > 0.9 * F.col("threshold")).cast("int"))
    closed = framewise.map_frames(spatial.framed(above, ["trial_id"], SIZE), SIZE, SIZE, lambda m: framewise.closed(m, 2), ["image"], "image")
    return closed.withColumn("image", F.col("image").cast("array<int>"))


@query(f"{P}, {MASK_SQL} SELECT trial_id, y, x, v AS inside FROM mask")
def otsu_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.pixelled(masks(spark, sf_dir), ["trial_id"], SIZE, "inside")


@query(f"{P}, {MASK_SQL} SELECT trial_id, greatest(min(y) - 1, 0) AS y0, least(max(y) + 2, 8) AS y1, greatest(min(x) - 1, 0) AS x0, least(max(x) + 2, 8) AS x1 FROM mask WHERE v = 1 GROUP BY ALL")
def crop_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box around a trial's mask, a pixel wider on each side."""
    inside = spatial.pixelled(masks(spark, sf_dir), ["trial_id"], SIZE, "inside").where("inside = 1")
    low = lambda c: F.greatest(F.min(c) - 1, F.lit(0))
    high = lambda c: F.least(F.max(c) + 2, F.lit(SIZE))
    return inside.groupBy("trial_id").agg(low("y").alias("y0"), high("y").alias("y1"), low("x").alias("x0"), high("x").alias("x1"))


@query(f"{P}, {MASK_SQL} SELECT p.trial_id, frame, p.y, p.x, round(CASE WHEN v = 1 THEN value ELSE 0 END, 6) + 0.0 AS value FROM pixels p JOIN mask USING (trial_id, y, x)")
def masked_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    inside = spatial.pixelled(masks(spark, sf_dir), ["trial_id"], SIZE, "inside")
    return pixels(spark, sf_dir).join(inside, ["trial_id", "y", "x"]).select(*FRAME, "y", "x", tidy(F.when(F.col("inside") == 1, F.col("value")).otherwise(0.0)).alias("value"))


@query(f"{P} SELECT trial_id, frame, CAST(y // 2 AS INTEGER) AS y, CAST(x // 2 AS INTEGER) AS x, round(avg(value), 6) + 0.0 AS value FROM pixels GROUP BY ALL")
def resized_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.block_means(pixels(spark, sf_dir), FRAME, 2).withColumn("value", tidy(F.col("value")))


@query(f"{P}, {DISK_SQL}, r AS (SELECT DISTINCT y, x, CASE WHEN y = 2 AND x = 2 THEN 1 WHEN y = 5 AND x = 6 THEN 2 ELSE 0 END AS v FROM pixels) SELECT a.y, a.x, max(b.v) AS roi_id FROM r a, d JOIN r b ON b.y = a.y + dy AND b.x = a.x + dx GROUP BY ALL")
def dilated_rois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions widened by a disk; where two meet the higher id stays."""
    grid = pixels(spark, sf_dir).select("y", "x").distinct().withColumn("value", F.when(F.expr("y = 2 and x = 2"), 1).when(F.expr("y = 5 and x = 6"), 2).otherwise(0))
    wide = spatial.framed(grid.withColumn("one", F.lit(0)), ["one"], SIZE).withColumn("image", spatial.widest(F.col("image"), SIZE, SIZE, 2))
    return spatial.pixelled(wide, ["one"], SIZE, "roi_id").drop("one")


@query(f"{P} SELECT trial_id, frame, CAST((y + x) % 4 AS INTEGER) AS place, round(avg(value), 6) + 0.0 AS profile FROM pixels WHERE y >= 3 GROUP BY ALL")
def line_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixels(spark, sf_dir)
    places = p.select("y", "x").distinct().where("y >= 3").withColumn("place", ((F.col("y") + F.col("x")) % 4).cast("int"))
    return spatial.line_profile(p, places, FRAME).withColumn("profile", tidy(F.col("profile")))


@query(f"{P}, l AS (SELECT trial_id, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM pixels GROUP BY ALL) SELECT trial_id, frame, y, x, round(greatest(least((value - lo) / nullif(hi - lo, 0), 1), 0), 6) + 0.0 AS shade FROM pixels JOIN l USING (trial_id)")
def colour_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixels(spark, sf_dir)
    limits = p.groupBy("trial_id").agg(F.percentile("value", F.array(F.lit(0.05), F.lit(0.95))).alias("q"))
    shade = (F.col("value") - F.col("q")[0]) / F.nullif(F.col("q")[1] - F.col("q")[0], F.lit(0.0))
    return p.join(limits, "trial_id").select(*FRAME, "y", "x", tidy(F.greatest(F.least(shade, F.lit(1.0)), F.lit(0.0))).alias("shade"))


WIDE = [(1, 8, 8), (2, 10, 12), (3, 20, 20), (4, 1, 22)]


def stamp_sql(rows: tuple[str, ...]) -> str:
    cells = [(y - len(rows) // 2, x - len(r) // 2) for y, r in enumerate(rows) for x, c in enumerate(r) if c == "1"]
    return f"""WITH c AS (SELECT * FROM (VALUES {", ".join(map(str, WIDE))}) v(roi_id, cy, cx)), o AS (SELECT * FROM (VALUES {", ".join(map(str, cells))}) v(dy, dx))
 SELECT cy + dy AS y, cx + dx AS x, CAST((sum(2 * roi_id - 1) + 1) // 2 AS BIGINT) AS roi_id FROM c, o WHERE cy + dy BETWEEN 0 AND 23 AND cx + dx BETWEEN 0 AND 23 GROUP BY ALL HAVING sum(2 * roi_id - 1) % 2 = 1"""


@query(stamp_sql(image.MEDIUM_STAMP))
def roi_stamp_medium(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.stamp_mask(spark.createDataFrame(WIDE, "roi_id int, y int, x int"), 24, 24, image.MEDIUM_STAMP)


@query(stamp_sql(image.LARGE_STAMP))
def roi_stamp_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.stamp_mask(spark.createDataFrame(WIDE, "roi_id int, y int, x int"), 24, 24, image.LARGE_STAMP)


@query("SELECT c_custkey, concat_ws('_', '210910', 'Fly' || c_nationkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN 'test' END) AS run_id FROM customer")
def run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [F.lit("210910"), F.concat(F.lit("Fly"), F.col("c_nationkey").cast("string")), F.col("c_name"), F.when(F.col("c_custkey") % 2 == 0, "test")]
    return table(spark, sf_dir, "customer").select("c_custkey", F.concat_ws("_", *parts).alias("run_id"))


@query("""SELECT s_suppkey, i, CAST(trunc(x - cos(a + i * (b - a) / 11) * r) AS INTEGER) AS x, CAST(trunc(y - sin(a + i * (b - a) / 11) * r) AS INTEGER) AS y FROM
 (SELECT *, asin((480 - y) / r) AS a, 3 * pi() - asin((480 - y) / r) AS b FROM (SELECT s_suppkey, 300.5::DOUBLE AS x, 400.0::DOUBLE + s_suppkey % 50 AS y, 200.0::DOUBLE AS r FROM supplier)), (SELECT unnest(range(0, 12)) AS i)""")
def circle_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = circle_arc(F.lit(300.5), 400.0 + F.col("s_suppkey") % 50, F.lit(200.0), 480)
    got = table(spark, sf_dir, "supplier").select("s_suppkey", F.posexplode(at).alias("i", "p"))
    return got.select("s_suppkey", F.col("i").cast("long").alias("i"), "p.x", "p.y")


@query(f"WITH {FRAMES} SELECT trial_id, frame, CAST(k >= 50 AS INTEGER) + 2 * CAST(event_type = 'error' AS INTEGER) AS code FROM frames")
def two_flag_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames(spark, sf_dir).select("trial_id", "frame", ((F.col("k") >= 50).cast("int") + 2 * (F.col("event_type") == "error").cast("int")).alias("code"))


@query(f"""WITH RECURSIVE {FRAMES}, q AS (SELECT trial_id, frame, k, CAST(floor(k / 34) AS INTEGER) AS level FROM frames),
 s AS (SELECT trial_id, frame, k, level, min(level) OVER w AS lo, max(level) OVER w AS hi, count(*) OVER w AS n FROM q WINDOW w AS (PARTITION BY trial_id ORDER BY frame ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING)),
 v AS (SELECT trial_id, frame FROM s WHERE k > 33 AND frame > 0 AND lo = hi AND lo > 0), r AS (SELECT trial_id, min(frame) AS frame FROM v GROUP BY trial_id
 UNION ALL SELECT r.trial_id, (SELECT min(frame) FROM v WHERE v.trial_id = r.trial_id AND v.frame > r.frame + 5) FROM r WHERE r.frame IS NOT NULL) SELECT trial_id, frame AS start_frame FROM r WHERE frame IS NOT NULL""")
def stim_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts above a threshold after which one level above zero holds; then a pause."""
    w = Window.partitionBy("trial_id").orderBy("frame").rowsBetween(1, 2)
    q = frames(spark, sf_dir).withColumn("level", F.floor(F.col("k") / 34).cast("int"))
    found = q.select("trial_id", "frame", "k", F.min("level").over(w).alias("lo"), F.max("level").over(w).alias("hi")).where("k > 33 and frame > 0 and lo = hi and lo > 0")
    return trends.with_pause(found, "frame", 5).select("trial_id", F.col("frame").alias("start_frame"))


@query(f"""WITH {FRAMES}, t AS (SELECT trial_id, frame, value AS v FROM frames), dir AS (SELECT trial_id, CASE WHEN corr(rf, rv) >= 0 THEN 1 ELSE -1 END AS sign FROM
 (SELECT trial_id, frame AS rf, rank() OVER (PARTITION BY trial_id ORDER BY v) + (count(*) OVER (PARTITION BY trial_id, v) - 1) / 2 AS rv FROM t) GROUP BY ALL),
 c AS (SELECT t.trial_id, frame, sign, sum(v * sign) OVER (PARTITION BY t.trial_id ORDER BY frame) AS c, v FROM t JOIN dir USING (trial_id)),
 ij AS (SELECT a.trial_id, a.frame AS i, b.frame AS j, a.sign, (b.c - a.c + a.v * a.sign) / (b.frame - a.frame + 1) AS m FROM c a JOIN c b ON a.trial_id = b.trial_id AND a.frame <= b.frame),
 lowest AS (SELECT trial_id, i, j AS pos, sign, min(m) OVER (PARTITION BY trial_id, i ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS m FROM ij),
 fit AS (SELECT trial_id, pos AS frame, max(m) * any_value(sign) AS fit FROM lowest GROUP BY trial_id, pos) SELECT trial_id, frame, round(v - fit, 8) + 0.0 AS residual FROM t JOIN fit USING (trial_id, frame)""")
def isotonic_detrend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.detrended(frames(spark, sf_dir).select("trial_id", "frame", "value"), "value", degree=None).withColumn("residual", tidy(F.col("residual"), 8))


@query(f"""WITH {FRAMES}, b AS (SELECT trial_id, frame, CAST(k AS DOUBLE) AS x, value AS y, count(*) OVER (PARTITION BY trial_id) AS n FROM frames), l AS (SELECT a.trial_id, lag.lag, a.frame, a.x, c.y FROM b a, (SELECT unnest(range(0, 4)) AS lag) lag JOIN b c ON c.trial_id = a.trial_id AND c.frame = a.frame + lag.lag),
 z AS (SELECT lag, trial_id % 5 AS fold, (x - avg(x) OVER g) / stddev_pop(x) OVER g AS x, (y - avg(y) OVER g) / stddev_pop(y) OVER g AS y FROM l WINDOW g AS (PARTITION BY lag)),
 s AS (SELECT lag, fold, sum(x * y) AS xy, sum(x * x) AS xx, sum(y) AS sy, sum(x) AS sx, sum(y * y) AS yy, count(*) AS n FROM z GROUP BY ALL), w AS (SELECT *, (sum(xy) OVER g - xy) / (sum(xx) OVER g - xx + 10) AS w FROM s WINDOW g AS (PARTITION BY lag)),
 e AS (SELECT lag, 1 - ((yy - 2 * w * xy + w * w * xx) / n - ((sy - w * sx) / n) ** 2) / (yy / n - (sy / n) ** 2) AS e FROM w) SELECT CAST(lag AS INTEGER) AS lag, round(avg(e), 6) + 0.0 AS var_explained FROM e GROUP BY ALL""")
def lagged_varexp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Explained variance of a later value by an earlier reading, for each lag."""
    f = frames(spark, sf_dir).select("trial_id", "frame", F.col("k").cast("double").alias("x"), F.col("value").alias("y"), (F.col("trial_id") % 5).alias("fold"))
    return trends.lagged_explained(f, "x", "y", "fold", 4, 10.0).withColumn("var_explained", tidy(F.col("var_explained")))


@query()
def variance_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variance between two states against that between two halves of each in time."""
    v = table(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") < 5).alias("state"), F.col("embedding").cast("array<double>").alias("v"))
    half = F.ntile(2).over(Window.partitionBy("state").orderBy("vec_id"))
    return linalg.variance_ratios(v.withColumn("half", half), "v", "state", "half")


@query("""WITH e AS (SELECT label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), l AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS i FROM e),
 s AS (SELECT label, i, count(*) AS n, avg(x) AS m, avg(x * x) AS q FROM l GROUP BY ALL) SELECT a.label AS first, b.label AS second, round(sqrt(sum((CAST(a.n AS DOUBLE) * b.n / (a.n + b.n) / (a.n + b.n) * (a.m - b.m) ** 2) ** 2)), 6) + 0.0 AS apart
 FROM s a JOIN s b ON a.i = b.i AND a.label < b.label GROUP BY ALL""")
def trial_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every pair of trials the norm of the features' variances between the two. Trials
    are compared by their moments, so the pairs' number is that of trials, not of rows."""
    long = table(spark, sf_dir, "embeddings").select("label", F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x"))
    s = long.groupBy("label", "i").agg(F.count("*").alias("n"), F.avg("x").alias("m"))
    other = s.select(F.col("label").alias("second"), "i", F.col("n").alias("n2"), F.col("m").alias("m2"))
    both = s.withColumnRenamed("label", "first").join(other, "i").where("first < second")
    between = F.col("n") * F.col("n2") / (F.col("n") + F.col("n2")) / (F.col("n") + F.col("n2")) * (F.col("m") - F.col("m2")) ** 2
    return both.groupBy("first", "second").agg(tidy(F.sqrt(F.sum(between * between))).alias("apart"))


@query("""WITH needs AS (SELECT * FROM (VALUES ('1-URGENT', 'F', true), ('1-URGENT', 'P', true), ('2-HIGH', 'F', false), ('2-HIGH', 'O', false)) v(task, before, any_of)), todo AS (SELECT DISTINCT o_custkey AS dir, o_orderpriority AS task FROM orders WHERE o_orderpriority < '3'),
 done AS (SELECT DISTINCT o_custkey AS dir, o_orderstatus AS before FROM orders) SELECT t.dir, t.task FROM todo t JOIN needs n USING (task) LEFT JOIN done d ON d.dir = t.dir AND d.before = n.before GROUP BY t.dir, t.task HAVING CASE WHEN bool_or(any_of) THEN bool_or(d.dir IS NOT NULL) ELSE bool_and(d.dir IS NOT NULL) END""")
def ready_any_or_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work whose earlier steps are done, all of them or, where so marked, any."""
    o = table(spark, sf_dir, "orders")
    todo = o.where("o_orderpriority < '3'").select(F.col("o_custkey").alias("dir"), F.col("o_orderpriority").alias("task")).distinct()
    needs = spark.createDataFrame([("1-URGENT", "F", True), ("1-URGENT", "P", True), ("2-HIGH", "F", False), ("2-HIGH", "O", False)], "task string, before string, any_of boolean")
    return ordering.ready_any_or_all(todo, needs, o.select(F.col("o_custkey").alias("dir"), F.col("o_orderstatus").alias("before")).distinct())


CLIPPED_SQL = """clipped AS (SELECT trial_id, frame, y, x, greatest(value, 0) AS value FROM pixels), r AS (SELECT trial_id, y, x, avg(value) OVER w AS m, sum(value) OVER w AS s, count(*) OVER w AS n FROM clipped WINDOW w AS (PARTITION BY trial_id, y, x ORDER BY frame ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING))"""


@query(f"""{P}, {CLIPPED_SQL} SELECT 'convolve' AS mode, trial_id, y, x, round(min(m), 6) + 0.0 AS f0 FROM r WHERE n = 5 GROUP BY ALL
 UNION ALL SELECT 'quantile', trial_id, y, x, round(quantile_cont(s, 0.1), 6) + 0.0 FROM r WHERE n = 5 GROUP BY ALL""")
def baseline_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, keys = pixels(spark, sf_dir), ["trial_id", "y", "x"]
    of = lambda mode: stats.baseline(p, "value", keys, mode, 5, 0.1).select(F.lit(mode).alias("mode"), *keys, tidy(F.col("f0")).alias("f0"))
    return of("convolve").union(of("quantile"))


@query(f"""{P}, {CLIPPED_SQL}, {MASK_SQL}, box AS (SELECT trial_id, min(y) AS y0, max(y) AS y1, min(x) AS x0, max(x) AS x1 FROM mask WHERE v = 1 GROUP BY ALL),
 base AS (SELECT trial_id, y, x, min(m) AS f0 FROM r WHERE n = 5 GROUP BY ALL) SELECT p.trial_id, frame, p.y - y0 AS y, p.x - x0 AS x, CASE WHEN v = 1 AND f0 > 0.01 THEN round((value - f0) / f0 * 100, 3) + 0.0 ELSE 0 END AS dff
 FROM pixels p JOIN mask USING (trial_id, y, x) JOIN base USING (trial_id, y, x) JOIN box ON box.trial_id = p.trial_id AND p.y BETWEEN y0 AND y1 AND p.x BETWEEN x0 AND x1""")
def dff_masked_cropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change against the baseline inside a trial's mask, cut to the mask's box."""
    p, keys = pixels(spark, sf_dir), ["trial_id", "y", "x"]
    inside = spatial.pixelled(masks(spark, sf_dir), ["trial_id"], SIZE, "inside")
    box = inside.where("inside = 1").groupBy("trial_id").agg(F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("x").alias("x0"), F.max("x").alias("x1"))
    base = stats.baseline(p, "value", keys, "convolve", 5)
    cut = p.join(inside, keys).join(base, keys).join(box, "trial_id").where("y between y0 and y1 and x between x0 and x1")
    change = F.when((F.col("inside") == 1) & (F.col("f0") > 0.01), tidy((F.col("value") - F.col("f0")) / F.col("f0") * 100, 3)).otherwise(0.0)
    return cut.select("trial_id", "frame", (F.col("y") - F.col("y0")).alias("y"), (F.col("x") - F.col("x0")).alias("x"), change.alias("dff"))


@query(f"WITH {FRAMES} SELECT trial_id, frame, value, k FROM frames WHERE frame < 10")
def strict_zip_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two channels of equal length side by side, up to a greatest length."""
    f = frames(spark, sf_dir)
    return align.zip_join(f.select("trial_id", "frame", "value"), f.select("trial_id", "frame", "k"), tolerance=0).where("frame < 10")


@query(f"""WITH {FRAMES}, m AS (SELECT trial_id, frame, avg(CAST(value * 0.1 > 3 AS INTEGER)) OVER w AS share_fast, avg(CAST(abs(k - 50) < 10 AS INTEGER)) OVER w AS share_still FROM frames WINDOW w AS (PARTITION BY trial_id ORDER BY frame ROWS BETWEEN 4 PRECEDING AND 3 FOLLOWING)) SELECT trial_id, frame, share_fast >= 0.75 AS walk, share_still >= 0.75 AS rest FROM m""")
def tracker_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walking and resting by a tracker's speed: the share of frames around that are fast,
    or still."""
    w = Window.partitionBy("trial_id").orderBy("frame").rowsBetween(-4, 3)
    share = lambda c: F.avg(c.cast("int")).over(w) >= 0.75
    return frames(spark, sf_dir).select("trial_id", "frame", share(F.col("value") * 0.1 > 3).alias("walk"), share(F.abs(F.col("k") - 50) < 10).alias("rest"))
