"""Queries over image stacks: ``embeddings`` as 8 x 8 images, one trial for each label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.functions import scalar
from chronopix.functions.scalar import tidy
from chronopix.operators import clusters, image, linalg, ordering, stats
from chronopix.registry import query
from chronopix.sources.roles import PIXELS, pixels, table

SIZE = 8
PIXEL = ["trial_id", "y", "x"]
P = f"WITH {PIXELS}"
#: Regions as (roi_id, y, x); the first two stamps overlap.
CENTRES = [(1, 2, 2), (2, 3, 3), (3, 5, 6)]
CENTRES_SQL = "c AS (SELECT * FROM (VALUES (1, 2, 2), (2, 3, 3), (3, 5, 6)) v(roi_id, cy, cx))"
STAMP_SQL = f"""{CENTRES_SQL}, o AS (SELECT * FROM (VALUES (-2, 0), (-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 0), (0, 1), (1, -1), (1, 0), (1, 1), (2, 0)) v(dy, dx)),
 mask AS (SELECT cy + dy AS y, cx + dx AS x, CAST((sum(2 * roi_id - 1) + 1) // 2 AS BIGINT) AS roi_id FROM c, o WHERE cy + dy BETWEEN 0 AND 7 AND cx + dx BETWEEN 0 AND 7 GROUP BY ALL HAVING sum(2 * roi_id - 1) % 2 = 1)"""


def centres(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CENTRES, "roi_id int, y int, x int")


@query(f"{P} SELECT trial_id, frame, y - 2 AS y, x - 1 AS x, value FROM pixels WHERE y >= 2 AND y < 6 AND x >= 1 AND x < 7")
def pixel_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.crop(pixels(spark, sf_dir), 2, 6, 1, 7)


@query(f"WITH {STAMP_SQL} SELECT y, x, roi_id FROM mask")
def roi_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.stamp_mask(centres(spark), SIZE, SIZE)


@query(f"{P}, {STAMP_SQL} SELECT trial_id, frame, roi_id, round(avg(value), 6) + 0.0 AS signal FROM pixels JOIN mask USING (y, x) GROUP BY ALL")
def roi_signal_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.mask_signals(pixels(spark, sf_dir), F.broadcast(image.stamp_mask(centres(spark), SIZE, SIZE))).withColumn("signal", tidy(F.col("signal")))


@query(f"{P}, {CENTRES_SQL} SELECT trial_id, frame, roi_id, round(avg(value), 6) + 0.0 AS signal FROM pixels JOIN c ON y >= cy - 2 AND y < cy + 2 AND x >= cx - 2 AND x < cx + 2 GROUP BY ALL")
def roi_signal_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.box_signals(pixels(spark, sf_dir), centres(spark), 2).withColumn("signal", tidy(F.col("signal")))


@query(f"WITH {STAMP_SQL}, g AS (SELECT a.a AS y, b.b AS x FROM (SELECT unnest(range(8)) AS a) a, (SELECT unnest(range(8)) AS b) b) SELECT g.y, g.x, coalesce(roi_id * 1.5, 0)::DOUBLE AS value FROM g LEFT JOIN mask USING (y, x)")
def roi_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.sequence(F.lit(0), F.lit(SIZE - 1))
    grid = spark.range(1).select(F.explode(side).alias("y")).select("y", F.explode(side).alias("x"))
    mask = image.stamp_mask(centres(spark), SIZE, SIZE)
    return image.region_map(mask, mask.select("roi_id").distinct().withColumn("value", F.col("roi_id") * 1.5), grid).select(F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), "value")


@query(f"""{P}, z AS (SELECT *, (value - avg(value) OVER w) / nullif(stddev_pop(value) OVER w, 0) AS z FROM pixels WINDOW w AS (PARTITION BY trial_id, y, x)),
 r AS (SELECT a.trial_id, a.y, a.x, b.y - a.y AS dy, b.x - a.x AS dx, avg(a.z * b.z) AS rho FROM z a JOIN z b ON a.trial_id = b.trial_id AND a.frame = b.frame AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND (a.y <> b.y OR a.x <> b.x) GROUP BY ALL)
 SELECT trial_id, y, x, round(avg(rho), 6) + 0.0 AS local_corr, count(*) AS neighbours FROM r GROUP BY ALL""")
def local_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.local_correlation(pixels(spark, sf_dir), SIZE, SIZE).withColumn("local_corr", tidy(F.col("local_corr")))


BASE = f"""{P}, r AS (SELECT trial_id, y, x, avg(value) OVER w AS m, sum(value) OVER w AS s, count(*) OVER w AS n FROM pixels WINDOW w AS (PARTITION BY trial_id, y, x ORDER BY frame ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
 base AS (SELECT trial_id, y, x, min(m) AS f0 FROM r WHERE n = 5 GROUP BY ALL)"""


@query(f"{BASE} SELECT trial_id, frame, y, x, CASE WHEN abs(f0) > 0.01 THEN round((value - f0) / f0 * 100, 3) + 0.0 ELSE 0 END AS dff FROM pixels JOIN base USING (trial_id, y, x)")
def dff_pixel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change against the baseline in percent; baselines near zero are suppressed."""
    p = pixels(spark, sf_dir)
    base = stats.minimum_baseline(p, "value", 5, PIXEL).withColumn("f0", F.when(F.abs("f0") > 0.01, F.col("f0")).otherwise(0.0))
    return stats.relative_to_baseline(p, "value", base, PIXEL, 100.0).select("trial_id", "frame", "y", "x", tidy(F.col("dff"), 3).alias("dff"))


@query(f"{BASE} SELECT trial_id, y, x, round(quantile_cont(s, 0.05), 6) + 0.0 AS f0 FROM r WHERE n = 5 GROUP BY ALL")
def baseline_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.quantile_baseline(pixels(spark, sf_dir), "value", 5, 0.05, PIXEL).withColumn("f0", tidy(F.col("f0")))


@query(f"{BASE} SELECT y, x, round(min(f0), 6) + 0.0 AS f0 FROM base GROUP BY ALL")
def baseline_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.common_baseline(stats.minimum_baseline(pixels(spark, sf_dir), "value", 5, PIXEL), ["y", "x"]).withColumn("f0", tidy(F.col("f0")))


@query(f"""{P}, s AS (SELECT trial_id, y, x, avg(value) AS mean, stddev_pop(value) AS std, quantile_cont(value, 0.95) AS p95 FROM pixels GROUP BY ALL)
 SELECT s.trial_id, s.y, s.x, round(s.mean, 6) + 0.0 AS mean, round(s.std, 6) + 0.0 AS std, round(s.p95, 6) + 0.0 AS p95, round(s.mean - r.mean, 6) + 0.0 AS mean_diff FROM s JOIN s r ON r.trial_id = 0 AND r.y = s.y AND r.x = s.x""")
def summary_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.difference_to(image.summary(pixels(spark, sf_dir)), 0, "mean").select("trial_id", "y", "x", *[tidy(F.col(c)).alias(c) for c in ("mean", "std", "p95", "mean_diff")])


@query(f"{P} SELECT trial_id, y, x, round(avg(value), 6) + 0.0 AS mean, round(quantile_cont(value, 0.005), 6) + 0.0 AS low, round(quantile_cont(value, 0.995), 6) + 0.0 AS high FROM pixels WHERE frame % 3 = 0 GROUP BY ALL")
def rest_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps over the frames of one state only."""
    resting = pixels(spark, sf_dir).where("frame % 3 = 0")
    q = F.percentile("value", F.array(F.lit(0.005), F.lit(0.995)))
    return resting.groupBy(*PIXEL).agg(tidy(F.avg("value")).alias("mean"), q.alias("q")).select(*PIXEL, "mean", tidy(F.col("q")[0]).alias("low"), tidy(F.col("q")[1]).alias("high"))


@query(f"{P} SELECT frame, y, x, round(avg(value), 6) + 0.0 AS mean, max(value) AS max, round(stddev_pop(value), 6) + 0.0 AS std FROM pixels GROUP BY GROUPING SETS ((frame, y), (frame, x), (y, x))")
def projections_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.projections(pixels(spark, sf_dir)).withColumns({c: tidy(F.col(c)) for c in ("mean", "std")})


@query(f"""{P}, s AS (SELECT trial_id, y, x, stddev_pop(value) AS std FROM pixels GROUP BY ALL)
 SELECT trial_id, greatest(min(y) - 1, 0) AS y0, least(max(y) + 1, 7) AS y1, greatest(min(x) - 1, 0) AS x0, least(max(x) + 1, 7) AS x1 FROM s WHERE std > 0.125 GROUP BY ALL""")
def std_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.bounding_box(image.summary(pixels(spark, sf_dir)), F.col("std") > 0.125, 1, SIZE, SIZE)


@query(f"{P} SELECT y, x, round(avg(CASE WHEN trial_id < 5 THEN value END) - avg(CASE WHEN NOT trial_id < 5 THEN value END), 6) + 0.0 AS w FROM pixels GROUP BY ALL")
def class_mean_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linalg.class_mean_axis(pixels(spark, sf_dir), "value", F.col("trial_id") < 5, ["y", "x"]).withColumn("w", tidy(F.col("w")))


@query(f"""{P}, b AS (SELECT trial_id, frame, (avg(CASE WHEN y < 2 THEN value END) + avg(CASE WHEN y >= 6 THEN value END)) / 2 AS background FROM pixels GROUP BY ALL)
 SELECT trial_id, frame, y, x, round(background, 6) + 0.0 AS background, round(greatest(value - background, 0), 6) + 0.0 AS corrected FROM pixels JOIN b USING (trial_id, frame)""")
def background_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.without_background(pixels(spark, sf_dir), 2, SIZE).select("trial_id", "frame", "y", "x", tidy(F.col("background")).alias("background"), tidy(F.col("corrected")).alias("corrected"))


@query(f"{P} SELECT trial_id, y, x, arg_min(frame, (-value, frame)) AS peak_frame FROM pixels GROUP BY ALL")
def peak_time_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.peak_time(pixels(spark, sf_dir))


@query(f"""{P}, c AS (SELECT trial_id, x, avg(value) AS level FROM pixels GROUP BY ALL), f AS (SELECT trial_id, regr_slope(level, x) AS slope, regr_intercept(level, x) AS base FROM c WHERE x BETWEEN 1 AND 6 GROUP BY ALL)
 SELECT trial_id, x, round(slope, 6) + 0.0 AS slope, round(base, 6) + 0.0 AS base FROM c JOIN f USING (trial_id)""")
def illumination_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.illumination(pixels(spark, sf_dir), 3, SIZE).select("trial_id", "x", tidy(F.col("slope")).alias("slope"), tidy(F.col("base")).alias("base"))


@query(f"{P}, q AS (SELECT trial_id, y, x, quantile_cont(value, 0.05) AS a, quantile_cont(value, 0.95) AS b FROM pixels GROUP BY ALL), m AS (SELECT y, x, avg(a) AS a, avg(b) AS b FROM q GROUP BY ALL) SELECT trial_id, frame, y, x, round((value - a) / nullif(b - a, 0), 6) + 0.0 AS scaled FROM pixels JOIN m USING (y, x)")
def trial_quantile_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.trial_quantile_normalised(pixels(spark, sf_dir), "value", 0.9, "scaled", ["y", "x"]).select("trial_id", "frame", "y", "x", tidy(F.col("scaled")).alias("scaled"))


@query(f"{P}, l AS (SELECT trial_id, quantile_cont(value, 0.05) AS a, quantile_cont(value, 0.99) AS b FROM pixels GROUP BY ALL) SELECT round(greatest(avg(a), 0), 6) + 0.0 AS vmin, round(avg(b), 6) + 0.0 AS vmax FROM l")
def shared_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = pixels(spark, sf_dir).groupBy("trial_id").agg(F.percentile("value", F.array(F.lit(0.05), F.lit(0.99))).alias("q"))
    return limits.agg(tidy(F.greatest(F.avg(F.col("q")[0]), F.lit(0.0))).alias("vmin"), tidy(F.avg(F.col("q")[1])).alias("vmax"))


@query("""SELECT vec_id, round(list_sum(list_transform(p, lambda x: CASE WHEN x > 0 THEN -x * ln(x) ELSE 0 END)), 6) + 0.0 AS entropy FROM
 (SELECT vec_id, list_transform(e, lambda x: x / list_sum(e)) AS p FROM (SELECT vec_id, list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE))) AS e FROM embeddings))""")
def entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    with_sum = table(spark, sf_dir, "embeddings").select("vec_id", e.alias("e")).withColumn("s", F.aggregate("e", F.lit(0.0), lambda a, x: a + x))
    return with_sum.select("vec_id", tidy(scalar.entropy(F.transform("e", lambda x: x / F.col("s")))).alias("entropy"))


PAIRS_SQL = "e AS (SELECT label AS trial_id, label < 5 AS g, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), ij AS (SELECT i.i, j.j FROM (SELECT unnest(range(1, 65)) AS i) i JOIN (SELECT unnest(range(1, 65)) AS j) j ON i.i <= j.j)"


@query(f"WITH {PAIRS_SQL} SELECT trial_id, 'f' || (i - 1) AS a, 'f' || (j - 1) AS b, round(covar_pop(v[i], v[j]), 8) + 0.0 AS cov FROM e, ij GROUP BY trial_id, i, j")
def trial_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.covariances(vectors(spark, sf_dir), "v", "trial_id").withColumn("cov", tidy(F.col("cov"), 8))


@query(f"""WITH {PAIRS_SQL}, t AS (SELECT i, j, covar_pop(v[i], v[j]) AS total FROM e, ij GROUP BY ALL), c AS (SELECT g, i, j, covar_pop(v[i], v[j]) AS cov, count(*) AS n FROM e, ij GROUP BY ALL),
 w AS (SELECT i, j, sum(cov * n) / sum(n) AS intra FROM c GROUP BY ALL) SELECT 'f' || (i - 1) AS a, 'f' || (j - 1) AS b, round(total, 8) + 0.0 AS total, round(intra, 8) + 0.0 AS intra, round(total - intra, 8) + 0.0 AS inter FROM t JOIN w USING (i, j)""")
def trial_pairs_cov(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = vectors(spark, sf_dir).withColumn("first", F.col("trial_id") < 5)
    return clusters.split_covariances(of, "v", "first").withColumns({c: tidy(F.col(c), 8) for c in ("total", "intra", "inter")})


@query(f"""{P}, q AS (SELECT trial_id, frame, quantile_cont(value, 0.75) AS q FROM pixels GROUP BY ALL), m AS (SELECT trial_id, frame, sum(y * value) / sum(value) - 4 AS dy, sum(x * value) / sum(value) - 4 AS dx FROM pixels JOIN q USING (trial_id, frame) WHERE value > q GROUP BY ALL)
 SELECT trial_id, frame, CAST(trunc(dy) AS INTEGER) AS dy, CAST(trunc(dx) AS INTEGER) AS dx FROM m""")
def com_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.centre_offsets(pixels(spark, sf_dir), 0.75, SIZE, SIZE)


@query(f"""{P}, off AS (SELECT DISTINCT trial_id, frame, CAST(frame % 3 AS INTEGER) - 1 AS dy, CAST(frame % 2 AS INTEGER) AS dx FROM pixels), m AS (SELECT trial_id, frame, y - dy AS y, x - dx AS x, value FROM pixels JOIN off USING (trial_id, frame))
 SELECT p.trial_id, p.frame, p.y, p.x, coalesce(m.value, 0) AS value FROM pixels p LEFT JOIN m USING (trial_id, frame, y, x)""")
def apply_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pixels(spark, sf_dir)
    off = p.select("trial_id", "frame").distinct().select("trial_id", "frame", ((F.col("frame") % 3).cast("int") - 1).alias("dy"), (F.col("frame") % 2).cast("int").alias("dx"))
    return image.shifted_back(p, off, SIZE, SIZE)


@query(f"""{P}, s AS (SELECT trial_id, y, x, round(stddev_pop(value), 9) AS std FROM pixels GROUP BY ALL)
 SELECT a.trial_id, a.y, a.x, a.std FROM s a JOIN s b ON a.trial_id = b.trial_id AND abs(a.y - b.y) <= 2 AND abs(a.x - b.x) <= 2 WHERE a.std >= 0.01 GROUP BY ALL HAVING a.std = max(b.std)""")
def local_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = image.summary(pixels(spark, sf_dir)).select(*PIXEL, F.round("std", 9).alias("std"))
    return image.local_maxima(s, ["trial_id"], "std", 2, 0.01, SIZE, SIZE)


@query(f"""{P}, l AS (SELECT trial_id, frame, x, avg(value) AS v FROM pixels GROUP BY ALL), sh AS (SELECT unnest(range(-2, 3)) AS shift),
 c AS (SELECT a.trial_id, a.frame, sh.shift, round(sum(a.v * b.v) / nullif(sqrt(sum(a.v * a.v)) * sqrt(sum(b.v * b.v)), 0), 9) AS cosine FROM l a, sh JOIN l b ON b.trial_id = a.trial_id AND b.frame = a.frame + 1 AND b.x = a.x + sh.shift GROUP BY ALL)
 SELECT trial_id, frame, CAST(shift AS INTEGER) AS shift FROM c QUALIFY row_number() OVER (PARTITION BY trial_id, frame ORDER BY cosine DESC, shift) = 1""")
def shift_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.best_shift(pixels(spark, sf_dir), 2, SIZE)


@query(f"""{P}, m AS (SELECT trial_id, y, x, avg(value) AS v FROM pixels GROUP BY ALL), sh AS (SELECT unnest(range(-3, 4)) AS shift),
 c AS (SELECT a.trial_id, shift, round(avg(abs(a.v - b.v)), 9) AS cost FROM m a, sh JOIN m b ON a.trial_id = b.trial_id AND a.y % 2 = 1 AND b.y = a.y - 1 AND b.x = a.x + shift GROUP BY ALL)
 SELECT trial_id, CAST(shift AS INTEGER) AS shift, cost FROM c QUALIFY row_number() OVER (PARTITION BY trial_id ORDER BY cost, shift) = 1""")
def twoway_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image.row_shift(pixels(spark, sf_dir), 3)


@query(f"{P} SELECT y, x, CAST(floor(avg(value) * 255) AS BIGINT) AS grey FROM pixels GROUP BY ALL")
def mean_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels(spark, sf_dir).groupBy("y", "x").agg(F.floor(F.avg("value") * 255).alias("grey"))


@query(f"{P} SELECT y, x, frame, value FROM pixels WHERE trial_id = 3 AND frame = 7")
def single_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels(spark, sf_dir).where("trial_id = 3 and frame = 7").select("y", "x", "frame", "value")


@query("SELECT label AS trial_id, max(vec_id) AS vec_id, len(arg_max(embedding, vec_id)) AS n FROM embeddings GROUP BY ALL")
def latest_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = table(spark, sf_dir, "embeddings").groupBy(F.col("label").alias("trial_id")).agg(F.max("vec_id").alias("vec_id"), F.max_by("embedding", "vec_id").alias("e"))
    return last.select("trial_id", "vec_id", F.size("e").cast("long").alias("n"))


@query(f"{P}, f AS (SELECT *, ntile(4) OVER (PARTITION BY trial_id, y, x ORDER BY frame) - 1 AS part FROM pixels) SELECT trial_id, part, count(*) AS n, min(frame) AS first, max(frame) AS last FROM f GROUP BY ALL")
def stack_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.size("embedding").alias("size"))
    from pyspark.sql import Window

    frame = (F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1).cast("long")
    parts = ordering.split_parts(one.select(F.col("label").alias("trial_id"), frame.alias("frame"), "size"), 4)
    return parts.groupBy("trial_id", F.col("part").cast("long").alias("part")).agg(F.sum("size").alias("n"), F.min("frame").alias("first"), F.max("frame").alias("last"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All components of each embedding."""
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("trial_id"), F.col("embedding").cast("array<double>").alias("v"))


@query()
def pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linalg.principal_axes(vectors(spark, sf_dir), "v")


@query()
def lda_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linalg.discriminant_axis(vectors(spark, sf_dir), "v", F.col("trial_id") < 5)
