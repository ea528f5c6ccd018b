"""What is needed to choose regions by hand: a mask of pixels that vary, and maps of how
they vary together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.operators import framewise, spatial
from chronopix.operators.clusters import principal_maps


def selection_mask(deviation: DataFrame, height: int, width: int, *, local: float, smooth: float, reach: int) -> DataFrame:
    """y, x and ``inside``: pixels whose deviation exceeds, as a logarithm, both its own
    surroundings (blurred by ``local``) and, blurred by ``smooth``, Otsu's threshold of the
    image; without those within ``reach`` of others. ``deviation`` is one image: y, x, std;
    a pixel that doesn't vary is never inside."""
    one = deviation.select(F.lit(0).alias("image_id"), "y", "x", F.when(F.col("std") > 0, F.log10("std")).otherwise(-30.0).alias("value"))
    image = spatial.framed(one, ["image_id"], width)
    for name, sigma in (("around", local), ("smoothed", smooth)):
        image = framewise.map_frames(image.withColumn(name, F.col("image")), height, width, lambda v, s=sigma: framewise.blurred(v, s), [name], name)
    zipped = F.posexplode(F.arrays_zip("image", "around", "smoothed"))
    long = image.select("image_id", zipped.alias("p", "v")).select("image_id", F.expr(f"cast(p div {width} as int)").alias("y"), (F.col("p") % width).alias("x"), "v.image", "v.around", F.round("v.smoothed", 9).alias("smoothed"))
    limit = spatial.otsu(long, "smoothed", ["image_id"])
    inside = (F.col("image") > F.col("around")) & (F.col("smoothed") > F.col("threshold"))
    mask = spatial.framed(long.join(limit, "image_id").select("image_id", "y", "x", inside.cast("double").alias("value")), ["image_id"], width)
    shrunk = framewise.map_frames(mask, height, width, lambda m: framewise.eroded(m, reach), ["image"], "image")
    return spatial.pixelled(shrunk, ["image_id"], width, "inside").select("y", "x", F.col("inside").cast("int").alias("inside"))


def drawn_pixels(deviation: DataFrame, mask: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` of the mask's pixels without replacement, in proportion to their deviation: the
    least waiting times, which are made of the pixels' places."""
    share = (F.pmod(F.xxhash64("y", "x", F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return deviation.join(mask.where("inside = 1"), ["y", "x"]).where("std > 0").orderBy(-F.log(share) / F.col("std"), "y", "x").limit(n).select("y", "x")


def selection_maps(pixels: DataFrame, deviation: DataFrame, mask: DataFrame, *, n: int = 5000, maps: int = 6, seed: int = 1) -> DataFrame:
    """map, y, x and ``weight``: the first principal axes of the drawn pixels, standardised
    in each trial, laid on the image; 0 where a pixel wasn't drawn. ``n`` bounds what an axis
    is made of, and so what comes to the driver: products of ``n`` by ``n`` pixels."""
    spark = pixels.sparkSession
    drawn = sorted((r["y"], r["x"]) for r in drawn_pixels(deviation, mask, n, seed).collect())
    places = spark.createDataFrame([(y, x, i) for i, (y, x) in enumerate(drawn)], "y int, x int, place int")
    one = F.struct("place", "value")
    # at most n rows: the size of the broadcast is known
    frames = pixels.join(F.broadcast(places), ["y", "x"]).groupBy("trial_id", "frame").agg(F.transform(F.array_sort(F.collect_list(one)), lambda s: s["value"]).alias("v"))
    axes = principal_maps(frames, "v", maps, "trial_id") if drawn else []
    rows = [(k, y, x, float(w)) for k, axis in enumerate(axes) for (y, x), w in zip(drawn, axis, strict=True)]
    found = spark.createDataFrame(rows, "map int, y int, x int, weight double")
    grid = deviation.select("y", "x", F.explode(F.sequence(F.lit(0), F.lit(max(0, min(maps, len(drawn)) - 1)))).alias("map"))
    return grid.join(F.broadcast(found), ["map", "y", "x"], "left").select("map", "y", "x", F.coalesce("weight", F.lit(0.0)).alias("weight"))
