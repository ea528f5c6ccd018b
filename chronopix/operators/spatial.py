"""Filters over single images. A frame is gathered into one array, whose size is the
image's, and filtered in place by array functions: pixels are not joined with their
neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronopix.operators.windows import gaussian_weights


def framed(df: DataFrame, keys: list[str], width: int, value: str = "value") -> DataFrame:
    """Each frame's values, row by row, as the array ``image``."""
    one = F.struct((F.col("y") * width + F.col("x")).alias("p"), F.col(value).alias("v"))
    return df.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(one)), lambda s: s["v"]).alias("image"))


def pixelled(df: DataFrame, keys: list[str], width: int, value: str = "value") -> DataFrame:
    long = df.select(*keys, F.posexplode("image").alias("_p", value))
    return long.select(*keys, F.expr(f"cast(_p div {width} as int)").alias("y"), (F.col("_p") % width).alias("x"), value)


def mirrored(i: Column, n: int) -> Column:
    """Index outside 0..n-1 reflected at the border, which counts twice."""
    return F.when(i < 0, -1 - i).when(i >= n, 2 * n - 1 - i).otherwise(i)


def blurred(image: Column, height: int, width: int, sigma: float, truncate: float = 4.0) -> Column:
    """Gaussian filter along rows and along columns. Each image is filtered as a whole
    array twice, so the inner array is computed once."""
    weights = gaussian_weights(sigma, truncate)
    reach = len(weights) // 2

    def along(values: Column, step: int, n: int) -> Column:
        def one(p: Column) -> Column:
            at = F.floor(p / step) % n
            place = lambda k: p + (mirrored(at + k - reach, n) - at) * step
            return sum((F.get(values, place(k).cast("int")) * w for k, w in enumerate(weights)), F.lit(0.0))

        return F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), one)

    inner = F.array(along(image, 1, width))
    return F.get(F.transform(inner, lambda rows: along(rows, width, height)), F.lit(0))


def median3(image: Column, height: int, width: int) -> Column:
    """Median of 3 x 3 pixels, reflected at the border."""

    def one(p: Column) -> Column:
        y, x = F.floor(p / width), p % width
        at = lambda dy, dx: F.get(image, (mirrored(y + dy, height) * width + mirrored(x + dx, width)).cast("int"))
        return F.get(F.array_sort(F.array(*[at(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)])), F.lit(4))

    return F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), one)


def widest(image: Column, height: int, width: int, reach: int, least: bool = False) -> Column:
    """Greatest (or least) value within ``reach`` pixels of a pixel, the disk's border
    included; pixels outside the image don't count."""
    disk = [(dy, dx) for dy in range(-reach, reach + 1) for dx in range(-reach, reach + 1) if dy * dy + dx * dx <= reach * reach]

    def one(p: Column) -> Column:
        y, x = F.floor(p / width), p % width
        at = lambda dy, dx: F.when((y + dy).between(0, height - 1) & (x + dx).between(0, width - 1), F.get(image, (p + dy * width + dx).cast("int")))
        return (F.least if least else F.greatest)(*[at(dy, dx) for dy, dx in disk])

    return F.transform(F.sequence(F.lit(0), F.lit(height * width - 1)), one)


def closed(image: Column, height: int, width: int, reach: int) -> Column:
    """Morphological closing: the greatest value around, then the least of those."""
    inner = F.array(widest(image, height, width, reach))
    return F.get(F.transform(inner, lambda wide: widest(wide, height, width, reach, least=True)), F.lit(0))


def otsu(df: DataFrame, value: str, keys: list[str], bins: int = 256) -> DataFrame:
    """For each key the centre of the bin that splits the values into two classes of
    greatest variance between them. Values are counted over bins first, so the sums run
    over ``bins`` rows a key."""
    limits = df.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    at = F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    counts = df.join(limits.where("hi > lo"), keys).groupBy(*keys, "lo", "hi", at.alias("bin")).agg(F.count("*").alias("n"))
    centre = F.col("lo") + (F.col("bin") + 0.5) * (F.col("hi") - F.col("lo")) / bins
    upto, whole = Window.partitionBy(*keys).orderBy("bin"), Window.partitionBy(*keys)
    split = counts.withColumn("c", centre).withColumns({"w0": F.sum("n").over(upto), "s0": F.sum(F.col("n") * F.col("c")).over(upto), "w": F.sum("n").over(whole), "s": F.sum(F.col("n") * F.col("c")).over(whole)})
    apart = F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / (F.col("w") - F.col("w0"))
    between = split.where("w0 < w").withColumn("between", F.round(F.col("w0") * (F.col("w") - F.col("w0")) * apart * apart, 6))
    return between.groupBy(*keys).agg(F.max(F.struct("between", (-F.col("bin")).alias("b"), "c")).alias("best")).select(*keys, F.col("best.c").alias("threshold"))


def block_means(df: DataFrame, keys: list[str], factor: int) -> DataFrame:
    """A smaller image: the mean of every ``factor`` x ``factor`` pixels."""
    return df.groupBy(*keys, F.expr(f"y div {factor}").cast("int").alias("y"), F.expr(f"x div {factor}").cast("int").alias("x")).agg(F.avg("value").alias("value"))


def line_profile(df: DataFrame, places: DataFrame, keys: list[str]) -> DataFrame:
    """Mean value over the pixels of each place; ``places`` is the list of an image's
    pixels, so its size is that of an image."""
    return df.join(F.broadcast(places), ["y", "x"]).groupBy(*keys, "place").agg(F.avg("value").alias("profile"))


def apply_border(df: DataFrame, offsets: DataFrame, corner: int) -> DataFrame:
    """Frames moved back by their offsets; what comes in at the border is the mean of the
    top left corner over all frames of the trial."""
    border = df.where((F.col("y") < corner) & (F.col("x") < corner)).groupBy("trial_id").agg(F.avg("value").alias("border"))
    moved = df.join(offsets, ["trial_id", "frame"]).select("trial_id", "frame", (F.col("y") - F.col("dy")).alias("y"), (F.col("x") - F.col("dx")).alias("x"), F.col("value").alias("moved"))
    grid = df.select("trial_id", "frame", "y", "x").join(border, "trial_id")
    return grid.join(moved, ["trial_id", "frame", "y", "x"], "left").select("trial_id", "frame", "y", "x", F.coalesce("moved", "border").alias("value"))
