"""Image stacks in long form: crops, projections, masks, neighbours, registration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRIAL, PIXEL = "trial_id", ["trial_id", "y", "x"]

# fixed values: rows of the 3 x 5 stamp around a centre
SMALL_STAMP = ("010", "111", "111", "111", "010")

# fixed values: rows of the 5 x 9 stamp around a centre
MEDIUM_STAMP = ("00100", "01110", "01110", "11111", "11111", "11111", "01110", "01110", "00100")

# fixed values: rows of the 7 x 11 stamp around a centre
LARGE_STAMP = ("0001000", "0011100", "0111110", "0111110", "1111111", "1111111", "1111111", "0111110", "0111110", "0011100", "0001000")


def crop(df: DataFrame, y0: int, y1: int, x0: int, x1: int) -> DataFrame:
    """Rows y0..y1 and columns x0..x1 (ends exclusive), counted from 0 again."""
    inside = df.where((F.col("y") >= y0) & (F.col("y") < y1) & (F.col("x") >= x0) & (F.col("x") < x1))
    return inside.withColumn("y", F.col("y") - y0).withColumn("x", F.col("x") - x0)


def summary(df: DataFrame, keys: list[str] = PIXEL) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.percentile("value", F.lit(0.95)).alias("p95"))


def difference_to(stats: DataFrame, reference: int, column: str) -> DataFrame:
    """Each trial's image minus that of the reference trial."""
    ref = stats.where(F.col(TRIAL) == reference).select("y", "x", F.col(column).alias("_ref"))
    return stats.join(ref, ["y", "x"]).withColumn(f"{column}_diff", F.col(column) - F.col("_ref")).drop("_ref")


def projections(df: DataFrame) -> DataFrame:
    """Mean, maximum and deviation over each of three axes in one pass."""
    sets = df.groupingSets([["frame", "y"], ["frame", "x"], ["y", "x"]], "frame", "y", "x")
    return sets.agg(F.avg("value").alias("mean"), F.max("value").alias("max"), F.stddev_pop("value").alias("std"))


def bounding_box(df: DataFrame, inside: Column, margin: int, height: int, width: int) -> DataFrame:
    box = df.where(inside).groupBy(TRIAL).agg(*[f(c).alias(f"{n}_{c}") for c in ("y", "x") for n, f in (("min", F.min), ("max", F.max))])
    return box.select(
        TRIAL, F.greatest(F.col("min_y") - margin, F.lit(0)).alias("y0"), F.least(F.col("max_y") + margin, F.lit(height - 1)).alias("y1"),
        F.greatest(F.col("min_x") - margin, F.lit(0)).alias("x0"), F.least(F.col("max_x") + margin, F.lit(width - 1)).alias("x1"),
    )


def stamp_mask(centres: DataFrame, height: int, width: int, pattern: tuple[str, ...] = SMALL_STAMP) -> DataFrame:
    """Pixels of each region around its centre (roi_id from 1, y, x). A pixel adds the odd
    numbers 2*roi_id - 1 of the regions on it, and is left out where the sum is even."""
    h, w = len(pattern) // 2, len(pattern[0]) // 2
    offsets = F.array(*[F.struct(F.lit(i - h).alias("dy"), F.lit(j - w).alias("dx")) for i, row in enumerate(pattern) for j, c in enumerate(row) if c == "1"])
    cells = centres.select("roi_id", "y", "x", F.explode(offsets).alias("o")).select("roi_id", (F.col("y") + F.col("o.dy")).alias("y"), (F.col("x") + F.col("o.dx")).alias("x"))
    inside = cells.where((F.col("y") >= 0) & (F.col("y") < height) & (F.col("x") >= 0) & (F.col("x") < width))
    total = inside.groupBy("y", "x").agg(F.sum(2 * F.col("roi_id") - 1).alias("s")).where(F.col("s") % 2 == 1)
    return total.select("y", "x", ((F.col("s") + 1) / 2).cast("long").alias("roi_id"))


def mask_signals(df: DataFrame, mask: DataFrame) -> DataFrame:
    """Mean over each region's pixels in each frame; ``mask`` is one image."""
    return df.join(mask, ["y", "x"]).groupBy(TRIAL, "frame", "roi_id").agg(F.avg("value").alias("signal"))


def box_signals(df: DataFrame, centres: DataFrame, size: int) -> DataFrame:
    """Mean of the box [c - size, c + size) around each centre; the pixel itself for 0.
    Boxes become pixels first, so the join is on equal places."""
    reach = F.sequence(F.lit(-size), F.lit(max(size - 1, 0)))
    cells = centres.select("*", F.explode(reach).alias("dy")).select("*", F.explode(reach).alias("dx"))
    return mask_signals(df, cells.select("roi_id", (F.col("y") + F.col("dy")).alias("y"), (F.col("x") + F.col("dx")).alias("x")))


def region_map(mask: DataFrame, values: DataFrame, grid: DataFrame) -> DataFrame:
    """Each pixel with its region's value, 0 elsewhere."""
    return grid.join(mask, ["y", "x"], "left").join(values, "roi_id", "left").select("y", "x", F.coalesce("value", F.lit(0.0)).alias("value"))


def local_correlation(df: DataFrame, height: int, width: int) -> DataFrame:
    """Mean correlation of each pixel with its eight neighbours over time. Products of
    neighbours are formed inside each frame's array, in four directions, as the other
    four are the same pairs; sums over frames are partial sums of so many pairs."""
    from chronopix.operators.spatial import framed

    moments = df.groupBy(*PIXEL).agg(F.avg("value").alias("m"), F.nullif(F.stddev_pop("value"), F.lit(0.0)).alias("s"))
    scaled = df.join(moments, PIXEL).select(TRIAL, "frame", "y", "x", ((F.col("value") - F.col("m")) / F.col("s")).alias("value"))
    size, steps = height * width, ((0, 1), (1, -1), (1, 0), (1, 1))
    places = F.sequence(F.lit(0), F.lit(size - 1))

    def beside(dy: int, dx: int) -> Column:
        inside = lambda p: (F.floor(p / width) + dy < height) & (p % width + dx).between(0, width - 1)
        return F.transform(places, lambda p: F.when(inside(p), F.get("image", p) * F.get("image", p + dy * width + dx)))

    products = F.flatten(F.array(*[beside(dy, dx) for dy, dx in steps]))
    long = framed(scaled, [TRIAL, "frame"], width).select(TRIAL, F.posexplode(products).alias("pair", "p")).where(F.col("p").isNotNull())
    rho = long.groupBy(TRIAL, "pair").agg(F.avg("p").alias("rho"))
    step = F.element_at(F.array(*[F.lit(dy * width + dx) for dy, dx in steps]), F.expr(f"cast(pair div {size} as int)") + 1)
    ends = F.explode(F.array(F.col("pair") % size, F.col("pair") % size + step))
    at = rho.select(TRIAL, ends.alias("_p"), "rho").groupBy(TRIAL, "_p").agg(F.avg("rho").alias("local_corr"), F.count("*").alias("neighbours"))
    return at.select(TRIAL, F.expr(f"cast(_p div {width} as int)").alias("y"), (F.col("_p") % width).alias("x"), "local_corr", "neighbours")


def background(df: DataFrame, rows: int, height: int) -> DataFrame:
    """Mean of the top and of the bottom rows of each frame."""
    top, bottom = F.avg(F.when(F.col("y") < rows, F.col("value"))), F.avg(F.when(F.col("y") >= height - rows, F.col("value")))
    return df.groupBy(TRIAL, "frame").agg(((top + bottom) / 2).alias("background"))


def without_background(df: DataFrame, rows: int, height: int) -> DataFrame:
    fixed = df.join(background(df, rows, height), [TRIAL, "frame"])
    return fixed.withColumn("corrected", F.greatest(F.col("value") - F.col("background"), F.lit(0.0)))


def peak_time(df: DataFrame) -> DataFrame:
    """The first frame of each pixel's highest value."""
    return df.groupBy(*PIXEL).agg(F.min_by("frame", F.struct((-F.col("value")).alias("v"), "frame")).alias("peak_frame"))


def illumination(df: DataFrame, reach: int, width: int) -> DataFrame:
    """A straight line over the central columns, and the factor that levels it."""
    columns = df.groupBy(TRIAL, "x").agg(F.avg("value").alias("level"))
    central = F.col("x").between(width // 2 - reach, width // 2 + reach - 1)
    fit = columns.where(central).groupBy(TRIAL).agg(F.regr_slope("level", F.col("x").cast("double")).alias("slope"), F.regr_intercept("level", F.col("x").cast("double")).alias("base"))
    return columns.join(fit, TRIAL).withColumn("correction", 1 / F.nullif(1 + F.col("slope") / F.nullif(F.col("base"), F.lit(0.0)) * F.col("x"), F.lit(0.0)))


def centre_offsets(df: DataFrame, quantile: float, height: int, width: int) -> DataFrame:
    """Centre of mass of each frame's pixels above a quantile, less the image's centre,
    cut to whole pixels."""
    limit = df.groupBy(TRIAL, "frame").agg(F.percentile("value", F.lit(quantile)).alias("_q"))
    bright = df.join(limit, [TRIAL, "frame"]).where(F.col("value") > F.col("_q"))
    return bright.groupBy(TRIAL, "frame").agg((F.sum(F.col("y") * F.col("value")) / F.sum("value") - height / 2).cast("int").alias("dy"), (F.sum(F.col("x") * F.col("value")) / F.sum("value") - width / 2).cast("int").alias("dx"))


def shifted_back(df: DataFrame, offsets: DataFrame, height: int, width: int, border: float = 0.0) -> DataFrame:
    """Every frame moved by minus its offset; pixels from outside get ``border``."""
    moved = df.join(offsets, [TRIAL, "frame"]).select(TRIAL, "frame", (F.col("y") - F.col("dy")).alias("y"), (F.col("x") - F.col("dx")).alias("x"), "value")
    grid = df.select(TRIAL, "frame", "y", "x")
    return grid.join(moved, [TRIAL, "frame", "y", "x"], "left").withColumn("value", F.coalesce("value", F.lit(border)))


def local_maxima(image: DataFrame, keys: list[str], value: str, reach: int, least: float, height: int, width: int) -> DataFrame:
    """Pixels that no other within ``reach`` rows and columns exceeds. Each image is one
    array, whose greatest values around are taken along rows and then along columns."""
    from chronopix.operators import framewise
    from chronopix.operators.spatial import framed, pixelled

    own = framed(image, keys, width, value).withColumn("_top", F.col("image"))
    top = framewise.map_frames(own, height, width, lambda v: framewise.box_maxima(v, reach), ["_top"], "_top")
    both = top.select(*keys, F.arrays_zip("image", "_top").alias("image"))
    long = pixelled(both, keys, width, "_v").select(*keys, "y", "x", F.col("_v.image").alias(value), "_v._top")
    return long.where((F.col(value) == F.col("_top")) & (F.col(value) >= least)).drop("_top")


def best_shift(df: DataFrame, most: int, width: int) -> DataFrame:
    """The shift of each frame's mean line that suits the next frame best, by cosine;
    the smallest on ties."""
    line = df.groupBy(TRIAL, "frame", "x").agg(F.avg("value").alias("v"))
    nxt = line.select(TRIAL, (F.col("frame") - 1).alias("frame"), F.col("x").alias("x2"), F.col("v").alias("v2"))
    tries = line.withColumn("shift", F.explode(F.sequence(F.lit(-most), F.lit(most)))).withColumn("x2", F.col("x") + F.col("shift"))
    both = tries.join(nxt, [TRIAL, "frame", "x2"]).groupBy(TRIAL, "frame", "shift").agg((F.sum(F.col("v") * F.col("v2")) / F.nullif(F.sqrt(F.sum(F.col("v") ** 2)) * F.sqrt(F.sum(F.col("v2") ** 2)), F.lit(0.0))).alias("cosine"))
    best = F.struct((-F.round("cosine", 9)).alias("c"), "shift")
    return both.groupBy(TRIAL, "frame").agg(F.min(best).alias("b")).select(TRIAL, "frame", F.col("b.shift").alias("shift"))


def row_shift(df: DataFrame, most: int) -> DataFrame:
    """The shift of odd rows against the even rows above them with the least mean
    absolute difference of the trial's mean image."""
    mean = df.groupBy(*PIXEL).agg(F.avg("value").alias("v"))
    even = mean.where("y % 2 = 0").select(TRIAL, "y", F.col("x").alias("x2"), F.col("v").alias("v2"))
    odd = mean.where("y % 2 = 1").select(TRIAL, (F.col("y") - 1).alias("y"), "x", "v", F.explode(F.sequence(F.lit(-most), F.lit(most))).alias("shift")).withColumn("x2", F.col("x") + F.col("shift"))
    cost = odd.join(even, [TRIAL, "y", "x2"]).groupBy(TRIAL, "shift").agg(F.avg(F.abs(F.col("v") - F.col("v2"))).alias("cost"))
    return cost.groupBy(TRIAL).agg(F.min(F.struct(F.round("cost", 9).alias("cost"), "shift")).alias("b")).select(TRIAL, F.col("b.shift").alias("shift"), F.col("b.cost").alias("cost"))
