"""Queries over whole frames and whole recordings: wavelets, motion fields, covariances of
pairs of trials, orders of features, and the maps that regions are chosen by."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.functions.scalar import tidy
from chronopix.operators import align, clusters, framewise, image, linalg, selection, stats, trends, wavelets
from chronopix.operators.windows import gaussian_weights
from chronopix.plans.filters import BLURRED_SQL, FRAME, MIRROR, P
from chronopix.plans.recordings import GROUPED, on_slow_clock
from chronopix.plans.stacks import BASE, SIZE, STAMP_SQL, vectors
from chronopix.registry import query
from chronopix.sources.roles import FRAMES, KEYPOINTS, frames, keypoints, pixels, table

CHANNELS = ["value", "k"]
_SPREAD = f"({wavelets.CYCLES} + sqrt(2 + {wavelets.CYCLES}::DOUBLE * {wavelets.CYCLES})) / (4 * pi() * pow(50, i / 24.0::DOUBLE))"


@query(f"""WITH {FRAMES}, x AS (SELECT trial_id, frame, unnest([0, 1]) AS channel, unnest([value, CAST(k AS DOUBLE)]) AS x FROM frames), f AS (SELECT CAST(i AS INTEGER) AS i, {_SPREAD} AS s FROM (SELECT unnest(range(0, 25)) AS i)),
 kernel AS MATERIALIZED (SELECT i, d, exp(-0.5 * pow(d / 100.0::DOUBLE / s, 2)) / s AS bell, {wavelets.CYCLES} * d / 100.0::DOUBLE / s AS phase FROM f, (SELECT unnest(range(-400, 401)) AS d) d WHERE abs(d / 100.0 / s) <= {wavelets.REACH}),
 a AS (SELECT n.trial_id, n.frame, n.channel, k.i, sqrt(pow(sum(m.x * k.bell * cos(k.phase)), 2) + pow(sum(m.x * k.bell * sin(k.phase)), 2)) AS a FROM x n JOIN x m ON m.trial_id = n.trial_id AND m.channel = n.channel JOIN kernel k ON k.d = m.frame - n.frame GROUP BY ALL)
 SELECT trial_id, frame, channel, i AS frequency, round(coalesce(a / nullif(sum(a) OVER (PARTITION BY trial_id, frame), 0), 0), 6) + 0.0 AS share FROM a""")
def wavelet_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amplitudes of 25 frequencies of two channels, as shares of a frame's whole power."""
    got = wavelets.wavelet_features(frames(spark, sf_dir), "trial_id", "frame", CHANNELS)
    long = got.select("trial_id", "frame", F.posexplode("share").alias("at", "share"))
    return long.select("trial_id", "frame", F.expr("cast(at div 25 as int)").alias("channel"), (F.col("at") % 25).alias("frequency"), tidy(F.col("share")).alias("share"))


@query()
def cluster_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 64 components, those of alike covariances side by side."""
    return clusters.cluster_order(vectors(spark, sf_dir), "v")


@query("""WITH e AS (SELECT label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), l AS (SELECT row_number() OVER () AS id, label, v FROM e), u AS (SELECT id, label, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS i FROM l),
 s AS (SELECT label, i, count(*) AS n, sum(x) AS s, sum(x * x) AS q FROM u GROUP BY ALL), p AS (SELECT a.label, a.i, b.i AS j, sum(a.x * b.x) AS p FROM u a JOIN u b ON a.id = b.id AND a.i <= b.i GROUP BY ALL),
 f AS (SELECT p.*, a.n, a.s AS sa, a.q AS qa, b.s AS sb, b.q AS qb FROM p JOIN s a ON a.label = p.label AND a.i = p.i JOIN s b ON b.label = p.label AND b.i = p.j),
 g AS (SELECT a.label AS first, b.label AS second, a.i AS a, a.j AS b, a.n + b.n AS n, a.sa + b.sa AS sa, a.sb + b.sb AS sb, a.qa + b.qa AS qa, a.qb + b.qb AS qb, a.p + b.p AS p, a.p - a.sa * a.sb / a.n + b.p - b.sa * b.sb / b.n AS w FROM f a JOIN f b ON a.i = b.i AND a.j = b.j AND a.label < b.label),
 h AS (SELECT *, nullif(sqrt(qa / n - (sa / n) * (sa / n)) * sqrt(qb / n - (sb / n) * (sb / n)), 0) AS scale FROM g)
 SELECT first, second, CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, round((p / n - sa / n * (sb / n)) / scale, 6) + 0.0 AS total, round(w / n / scale, 6) + 0.0 AS intra, round((p / n - sa / n * (sb / n) - w / n) / scale, 6) + 0.0 AS inter FROM h""")
def pair_covariances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole covariance matrices of every two trials, within and between them."""
    return clusters.pair_covariances(vectors(spark, sf_dir), "v", "trial_id").withColumns({c: tidy(F.col(c)) for c in ("total", "intra", "inter")})


#: A motion field that the frames themselves give: to the right by a pixel's value, down by that of its row's mirror image.
FIELD_SQL = "field AS (SELECT p.trial_id, p.frame, p.y, p.x, 6 * p.value AS r, 4 * q.value + 0.25 AS d FROM pixels p JOIN pixels q ON q.trial_id = p.trial_id AND q.frame = p.frame AND q.y = p.y AND q.x = 7 - p.x)"
WARPED_SQL = f"""{FIELD_SQL}, spot AS (SELECT *, greatest(0, least(7, y + d)) AS sy, greatest(0, least(7, x + r)) AS sx FROM field), four AS (SELECT *, CAST(floor(sy) AS INTEGER) AS y0, CAST(floor(sx) AS INTEGER) AS x0, sy - floor(sy) AS fy, sx - floor(sx) AS fx FROM spot),
 c AS (SELECT trial_id, frame, y, x, unnest([y0, y0, least(y0 + 1, 7), least(y0 + 1, 7)]) AS cy, unnest([x0, least(x0 + 1, 7), x0, least(x0 + 1, 7)]) AS cx, unnest([(1 - fy) * (1 - fx), (1 - fy) * fx, fy * (1 - fx), fy * fx]) AS w FROM four),
 warped AS (SELECT c.trial_id, c.frame, c.y, c.x, sum(c.w * p.value) AS value FROM c JOIN pixels p ON p.trial_id = c.trial_id AND p.frame = c.frame AND p.y = c.cy AND p.x = c.cx GROUP BY ALL)"""


def stack_and_field(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    both = framewise.frames_of(pixels(spark, sf_dir), FRAME, SIZE, ["value"]).withColumnRenamed("value", "image")
    mirror = F.expr(f"transform(sequence(0, {SIZE * SIZE - 1}), p -> 4 * image[p - p % {SIZE} + {SIZE - 1} - p % {SIZE}] + 0.25)")
    return both, both.select(*FRAME, F.transform("image", lambda v: v * 6).alias("right"), mirror.alias("down"))


@query(f"{P}, {WARPED_SQL} SELECT trial_id, frame, y, x, round(value, 6) + 0.0 AS value FROM warped")
def motion_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames sampled where a motion field points to, between four pixels."""
    from chronopix.operators.spatial import pixelled

    stack, field = stack_and_field(spark, sf_dir)
    return pixelled(framewise.apply_motion_field(stack, field, FRAME, SIZE, SIZE), FRAME, SIZE, "value").withColumnRenamed("image", "value").withColumn("value", tidy(F.col("value")))


@query(f"""{P}, {WARPED_SQL}, n AS (SELECT trial_id, CAST(ceil((max(frame) + 1) / 4) AS BIGINT) AS n FROM pixels GROUP BY ALL)
 SELECT trial_id, CAST(frame // n AS INTEGER) AS part, count(DISTINCT frame) AS frames, min(frame) AS first, round(sum(value), 4) + 0.0 AS total FROM warped JOIN n USING (trial_id) GROUP BY ALL""")
def warped_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stack warped in four parts, each written for itself, and read again."""
    from chronopix.sources.sinks import write_missing
    from chronopix.sources.files import shared_scratch

    stack, field = stack_and_field(spark, sf_dir)
    parts, path = framewise.parted(stack, 4), shared_scratch(spark)
    write_missing(framewise.apply_motion_field(parts, field, FRAME, SIZE, SIZE), path, ["trial_id", "part"], expected=parts)
    total = F.aggregate("image", F.lit(0.0), lambda a, v: a + v)
    return spark.read.parquet(path).groupBy("trial_id", "part").agg(F.count("*").alias("frames"), F.min("frame").alias("first"), tidy(F.sum(total), 4).alias("total"))


@query(f"""{P}, s AS (SELECT trial_id, frame, greatest(0, least(7, (a.a + 0.5) * 8 / 5.0::DOUBLE - 0.5)) AS sy, greatest(0, least(7, (b.b + 0.5) * 8 / 11.0::DOUBLE - 0.5)) AS sx, a.a AS y, b.b AS x FROM (SELECT DISTINCT trial_id, frame FROM pixels), (SELECT unnest(range(5)) AS a) a, (SELECT unnest(range(11)) AS b) b),
 c AS (SELECT trial_id, frame, y, x, unnest([floor(sy), floor(sy), least(floor(sy) + 1, 7), least(floor(sy) + 1, 7)]) AS cy, unnest([floor(sx), least(floor(sx) + 1, 7), floor(sx), least(floor(sx) + 1, 7)]) AS cx,
 unnest([(1 - sy + floor(sy)) * (1 - sx + floor(sx)), (1 - sy + floor(sy)) * (sx - floor(sx)), (sy - floor(sy)) * (1 - sx + floor(sx)), (sy - floor(sy)) * (sx - floor(sx))]) AS w FROM s)
 SELECT c.trial_id, c.frame, CAST(c.y AS INTEGER) AS y, CAST(c.x AS INTEGER) AS x, round(sum(c.w * p.value), 6) + 0.0 AS value FROM c JOIN pixels p ON p.trial_id = c.trial_id AND p.frame = c.frame AND p.y = c.cy AND p.x = c.cx GROUP BY ALL""")
def resized_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of 8 by 8 as frames of 5 by 11."""
    from chronopix.operators.spatial import pixelled

    stack = framewise.frames_of(pixels(spark, sf_dir), FRAME, SIZE, ["value"])
    new = framewise.map_frames(stack, SIZE, SIZE, lambda v: framewise.resized(v, 5, 11), ["value"], "image")
    return pixelled(new, FRAME, 11, "value").withColumn("value", tidy(F.col("value")))


@query(f"""WITH {FRAMES}, t AS (SELECT trial_id, frame, value AS v, count(*) OVER (PARTITION BY trial_id) AS n FROM frames), c AS (SELECT *, CASE WHEN n > 1 THEN 2.0::DOUBLE * frame / (n - 1) - 1 ELSE 0 END AS t1 FROM t),
 m AS (SELECT trial_id, avg(t1) AS m1, avg(t1 * t1) AS m2, avg(v) AS mv FROM c GROUP BY ALL), z AS (SELECT c.*, m1, m2, mv, t1 - m1 AS a, t1 * t1 - m2 AS b, v - mv AS y FROM c JOIN m USING (trial_id)),
 s AS (SELECT trial_id, sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS "by" FROM z GROUP BY ALL)
 SELECT trial_id, frame, round(y - CASE WHEN n < 2 THEN 0 WHEN n = 2 THEN ay / aa * a ELSE (ay * bb - "by" * ab) / (aa * bb - ab * ab) * a + ("by" * aa - ay * ab) / (aa * bb - ab * ab) * b END, 5) + 0.0 AS residual FROM z JOIN s USING (trial_id)""")
def polynomial_detrend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residuals of each trial after a parabola over time."""
    got = trends.detrended(frames(spark, sf_dir).select("trial_id", "frame", "value"), "value", degree=2, monotone=False)
    return got.withColumn("residual", tidy(F.col("residual"), 5))


@query(f"{GROUPED} SELECT trial_id, slow_index, round(sqrt(avg(value * value)), 6) + 0.0 AS rms, round(median(value), 6) + 0.0 AS middle FROM g GROUP BY ALL")
def user_reducers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two functions of a user's own: one that is put together from parts of a group, and
    one that needs the whole group."""
    rms = align.Reducer("double", partial=lambda v: [float((v * v).sum()), float(len(v))], finish=lambda s: math.sqrt(s[0] / s[1]))
    middle = align.Reducer("double", whole=lambda v: float(v.median()))
    got = align.reduce_by(on_slow_clock(spark, sf_dir).withColumn("middle", F.col("value")).withColumnRenamed("value", "rms"), {"rms": rms, "middle": middle})
    return got.withColumns({c: tidy(F.col(c)) for c in ("rms", "middle")})


OFFSETS_SQL = f"""{BLURRED_SQL}, q AS (SELECT trial_id, frame, quantile_cont(value, 0.75) AS q FROM blurred GROUP BY ALL),
 off AS (SELECT trial_id, frame, CAST(trunc(avg(y) - 4) AS INTEGER) AS dy, CAST(trunc(avg(x) - 4) AS INTEGER) AS dx FROM blurred JOIN q USING (trial_id, frame) WHERE value > q GROUP BY ALL)"""


@query(f"""{P}, {OFFSETS_SQL}, two AS (SELECT 'green' AS channel, * FROM pixels UNION ALL SELECT 'red', trial_id, frame, y, x, 1 - value FROM pixels),
 b AS (SELECT channel, trial_id, avg(value) AS border FROM two WHERE y < 3 AND x < 3 GROUP BY ALL), m AS (SELECT channel, trial_id, frame, y - dy AS y, x - dx AS x, value FROM two JOIN off USING (trial_id, frame))
 SELECT p.channel, p.trial_id, p.frame, p.y - 1 AS y, p.x - 2 AS x, round(coalesce(m.value, border), 6) + 0.0 AS value FROM two p JOIN b USING (channel, trial_id) LEFT JOIN m USING (channel, trial_id, frame, y, x) WHERE p.y BETWEEN 1 AND 6 AND p.x BETWEEN 2 AND 5""")
def centre_and_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two channels moved by the first one's offsets, which are kept as a table, and cropped."""
    from chronopix.sources.files import shared_scratch

    p = pixels(spark, sf_dir)
    green, red = framewise.centred_and_cropped(p, p.withColumn("value", 1 - F.col("value")), shared_scratch(spark), SIZE, SIZE, (1, 7, 2, 6), sigma=1.0, truncate=2.0, quantile=0.75, corner=3)
    of = lambda name, df: df.select(F.lit(name).alias("channel"), "trial_id", "frame", "y", "x", tidy(F.col("value")).alias("value"))
    return of("green", green).union(of("red", red))


def deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each pixel's deviation over time, the mean over trials."""
    own = image.summary(pixels(spark, sf_dir)).groupBy("y", "x").agg(F.avg("std").alias("std"))
    return own.withColumn("std", F.round("std", 9))


@query()
def selection_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six maps of how the pixels of a mask vary together, to choose regions by."""
    own = deviation(spark, sf_dir)
    return selection.selection_maps(pixels(spark, sf_dir), own, mask_of(own, reach=0))


def mask_of(own: DataFrame, reach: int) -> DataFrame:
    return selection.selection_mask(own, SIZE, SIZE, local=1.0, smooth=1.0, reach=reach)


_LOG_WEIGHTS = ", ".join(f"({i - 4}, {w!r}::DOUBLE)" for i, w in enumerate(gaussian_weights(1.0)))


@query(f"""{P}, own AS (SELECT y, x, round(avg(std), 9) AS std FROM (SELECT trial_id, y, x, stddev_pop(value) AS std FROM pixels GROUP BY ALL) GROUP BY ALL), l AS (SELECT y, x, CASE WHEN std > 0 THEN log10(std) ELSE -30 END AS v FROM own), w AS (SELECT * FROM (VALUES {_LOG_WEIGHTS}) v(o, w)),
 around AS (SELECT p.y, p.x, any_value(p.v) AS v, sum(q.v * a.w * b.w) AS a FROM l p, w a, w b JOIN l q ON q.y = {MIRROR("p.y + a.o")} AND q.x = {MIRROR("p.x + b.o")} GROUP BY ALL), r AS (SELECT y, x, v, a, round(a, 9) AS s FROM around), lim AS (SELECT min(s) AS lo, max(s) AS hi FROM r),
 h AS (SELECT lo + (least(floor((s - lo) / (hi - lo) * 256), 255) + 0.5::DOUBLE) * (hi - lo) / 256 AS c, count(*) AS n FROM r, lim WHERE hi > lo GROUP BY ALL), u AS (SELECT c, sum(n) OVER o AS w0, sum(n * c) OVER o AS s0, sum(n) OVER () AS w, sum(n * c) OVER () AS s FROM h WINDOW o AS (ORDER BY c)),
 otsu AS (SELECT arg_max(c, (round(CAST(w0 AS DOUBLE) * (w - w0) * (s0 / w0 - (s - s0) / (w - w0)) * (s0 / w0 - (s - s0) / (w - w0)), 6), -c)) AS t FROM u WHERE w0 < w), m AS (SELECT y, x, CAST(v > a AND s > t AS INTEGER) AS i FROM r, otsu)
 SELECT a.y, a.x, min(b.i) AS inside FROM m a JOIN m b ON abs(a.y - b.y) + abs(a.x - b.x) <= 1 GROUP BY ALL""")
def selection_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixels that vary more than their surroundings and more than most, without the border."""
    return mask_of(deviation(spark, sf_dir), reach=1)


@query(f"""{P}, {BASE.removeprefix(f"{P}, ")}, common AS (SELECT y, x, min(f0) AS f0 FROM base GROUP BY ALL)
 SELECT trial_id, frame, y, x, CASE WHEN f0 > 0.01 THEN round((value - f0) / f0 * 100, 3) + 0.0 ELSE 0 END AS dff FROM pixels JOIN common USING (y, x)""")
def dff_common_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trials' change against the one baseline that is lowest over them."""
    p = pixels(spark, sf_dir)
    common = stats.common_baseline(stats.minimum_baseline(p, "value", 5, ["trial_id", "y", "x"]), ["y", "x"])
    change = F.when(F.col("f0") > 0.01, tidy((F.col("value") - F.col("f0")) / F.col("f0") * 100, 3)).otherwise(0.0)
    return p.join(common, ["y", "x"]).select("trial_id", "frame", "y", "x", change.alias("dff"))


@query(f"""{P}, s AS (SELECT trial_id, y, x, round(stddev_pop(value), 9) AS std FROM pixels GROUP BY ALL), c AS (SELECT trial_id + 1 AS roi_id, arg_max(y, (std, -y, -x)) AS cy, arg_max(x, (std, -y, -x)) AS cx, max(std) AS std FROM s GROUP BY ALL), {STAMP_SQL[STAMP_SQL.index("o AS (") :]}
 SELECT g.y, g.x, mask.roi_id, round(coalesce(c.std, 0), 6) + 0.0 AS value FROM (SELECT DISTINCT y, x FROM pixels) g LEFT JOIN mask USING (y, x) LEFT JOIN c ON c.roi_id = mask.roi_id""")
def stamped_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions around the pixel of each trial that varies most, without where two overlap,
    and what it varies by on the map."""
    p = pixels(spark, sf_dir)
    own = image.summary(p).withColumn("std", F.round("std", 9))
    best = F.max(F.struct("std", (-F.col("y")).alias("y"), (-F.col("x")).alias("x")))
    centres = own.groupBy("trial_id").agg(best.alias("b")).select((F.col("trial_id") + 1).alias("roi_id"), (-F.col("b.y")).alias("y"), (-F.col("b.x")).alias("x"), F.col("b.std").alias("value"))
    mask, grid = image.stamp_mask(centres, SIZE, SIZE), p.select("y", "x").distinct()
    values = image.region_map(mask, centres.select("roi_id", "value"), grid)
    return values.join(mask, ["y", "x"], "left").select("y", "x", "roi_id", tidy(F.col("value")).alias("value"))


LINE_SQL = """CASE WHEN o_orderkey % 7 = 0 THEN '# fly || all || tif' WHEN o_orderkey % 7 = 1 THEN '' ELSE ' fly' || o_custkey || '|| t1,t2 ||' || CASE WHEN o_orderstatus = 'F' THEN '!' ELSE '' END || o_orderpriority || ', tif'
 || CASE WHEN o_orderkey % 2 = 0 THEN ' || x=' || o_orderkey ELSE '' END || CASE WHEN o_orderkey % 5 = 0 THEN ' # later' ELSE '' END END"""


@query("""SELECT 'fly' || o_custkey AS dir, 't1,t2' AS trials, unnest([o_orderpriority, 'tif']) AS task, unnest([o_orderstatus = 'F', false]) AS forced, CASE WHEN o_orderkey % 2 = 0 THEN 'x=' || o_orderkey ELSE '' END AS arguments FROM orders WHERE o_orderkey % 7 > 1""")
def worklist_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Worklists as text, one line for each order, as tasks."""
    from chronopix.operators.ordering import parsed_worklist

    return parsed_worklist(table(spark, sf_dir, "orders").select(F.expr(LINE_SQL).alias("value")))


@query(f"""WITH {KEYPOINTS}, s AS (SELECT trial_id, sum(ay * ay) + 0.5 AS aa, sum(ay * "by") AS ab, sum("by" * "by") + 0.5 AS bb, sum(ay * ax) AS ta, sum("by" * ax) AS tb FROM keypoints GROUP BY ALL)
 SELECT trial_id, frame, round(ay * (ta * bb - tb * ab) / (aa * bb - ab * ab) + "by" * (tb * aa - ta * ab) / (aa * bb - ab * ab), 6) + 0.0 AS fitted FROM keypoints JOIN s USING (trial_id)""")
def ridge_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trial's values fitted by two regressors, with a penalty."""
    k = keypoints(spark, sf_dir)
    weights = linalg.ridge_weights(k, ["ay", "by"], "ax", 0.5, "trial_id")
    return linalg.ridge_predict(k, ["ay", "by"], weights, "trial_id").select("trial_id", "frame", tidy(F.col("fitted")).alias("fitted"))
