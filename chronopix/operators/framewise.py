"""Whole frames in NumPy: filters, motion fields and thresholds over Arrow batches.

A frame is one array of its values, row by row, beside its keys; tasks hold a batch of
frames at a time, as many as together have about AT_ONCE pixels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from chronopix.operators.windows import gaussian_weights
from chronopix.session import ship_code

#: Pixels that a task handles at once, beyond a single frame.
AT_ONCE = 1 << 22


def map_frames(df: DataFrame, height: int, width: int, f: Callable[..., np.ndarray], columns: list[str], out: str) -> DataFrame:
    """Adds the array ``out`` that ``f`` makes of the frames in ``columns``, each of shape
    (frames, height, width); ``columns`` go, all others stay. A frame of another size, or
    with nulls in it, is an error."""
    ship_code(df.sparkSession)
    kept = [c for c in df.schema if c.name not in columns]
    schema = StructType([*kept, StructField(out, ArrayType(DoubleType()))])
    rows = max(1, AT_ONCE // (height * width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                b = batch.slice(at, rows)
                frames = [b.column(c).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, height, width) for c in columns]
                flat = np.ascontiguousarray(f(*frames), float).reshape(b.num_rows, -1)
                ends = np.arange(b.num_rows + 1, dtype=np.int32) * flat.shape[1]
                yield pa.RecordBatch.from_arrays([*(b.column(c.name) for c in kept), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))], names=schema.names)

    doubles = [F.col(c).cast("array<double>").alias(c) for c in columns]
    return df.select(*[c.name for c in kept], *doubles).mapInArrow(run, schema)


def blurred(frames: np.ndarray, sigma: float, truncate: float = 4.0) -> np.ndarray:
    """Gaussian filter along rows and columns; borders are reflected and count twice."""
    w = gaussian_weights(sigma, truncate)
    for axis in (2, 1):
        wide = np.pad(frames, [(len(w) // 2,) * 2 if i == axis else (0, 0) for i in range(3)], mode="symmetric")
        n = frames.shape[axis]
        frames = sum(k * (wide[:, :, i : i + n] if axis == 2 else wide[:, i : i + n]) for i, k in enumerate(w))
    return frames


def disk(reach: int) -> list[tuple[int, int]]:
    around = range(-reach, reach + 1)
    return [(dy, dx) for dy in around for dx in around if dy * dy + dx * dx <= reach * reach]


def widest(frames: np.ndarray, places: list[tuple[int, int]], least: bool = False) -> np.ndarray:
    """Greatest, or least, of the values at ``places`` around each pixel; places outside the
    frame don't count."""
    reach = max(max(abs(dy), abs(dx)) for dy, dx in places)
    _, h, w = frames.shape
    wide = np.pad(frames, ((0, 0), (reach, reach), (reach, reach)), constant_values=np.inf if least else -np.inf)
    out = None
    for dy, dx in places:
        part = wide[:, reach + dy : reach + dy + h, reach + dx : reach + dx + w]
        out = part.copy() if out is None else (np.minimum if least else np.maximum)(out, part, out=out)
    return out


def closed(frames: np.ndarray, reach: int) -> np.ndarray:
    return widest(widest(frames, disk(reach)), disk(reach), least=True)


def eroded(frames: np.ndarray, reach: int) -> np.ndarray:
    """Masks of 0 and 1 without the pixels whose disk leaves them; what lies outside the
    frame counts as inside."""
    return widest(frames, disk(reach), least=True)


def box_maxima(frames: np.ndarray, reach: int) -> np.ndarray:
    """Greatest value of the square around each pixel, by rows and then by columns."""
    rows = [(0, d) for d in range(-reach, reach + 1)]
    return widest(widest(frames, rows), [(dx, dy) for dy, dx in rows])


def sampled(frames: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Values at fractional places, between the four pixels around them; places beyond the
    border are taken at the border."""
    n, h, w = frames.shape
    y, x = np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)
    y0, x0 = np.floor(y).astype(np.int64), np.floor(x).astype(np.int64)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx, i = y - y0, x - x0, np.arange(n)[:, None, None]
    above = frames[i, y0, x0] * (1 - fx) + frames[i, y0, x1] * fx
    below = frames[i, y1, x0] * (1 - fx) + frames[i, y1, x1] * fx
    return above * (1 - fy) + below * fy


def moved_by_field(frames: np.ndarray, right: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Each pixel from where its motion vector points to."""
    _, h, w = frames.shape
    return sampled(frames, np.arange(h)[None, :, None] + down, np.arange(w)[None, None, :] + right)


def resized(frames: np.ndarray, height: int, width: int) -> np.ndarray:
    """Frames of any other size: pixels are areas, and a new one takes the value at its
    middle, between the old pixels' middles."""
    n, h, w = frames.shape
    y = np.broadcast_to(((np.arange(height) + 0.5) * h / height - 0.5)[None, :, None], (n, height, width))
    x = np.broadcast_to(((np.arange(width) + 0.5) * w / width - 0.5)[None, None, :], (n, height, width))
    return sampled(frames, y, x)


def apply_motion_field(stack: DataFrame, field: DataFrame, keys: list[str], height: int, width: int) -> DataFrame:
    """``stack`` with keys and ``image``, moved by ``field`` with keys, ``right`` and
    ``down``. A frame without a field is not in the result."""
    return map_frames(stack.join(field, keys), height, width, moved_by_field, ["image", "right", "down"], "image")


def parted(df: DataFrame, parts: int, trial: str = "trial_id", frame: str = "frame") -> DataFrame:
    """``part``: each trial's frames in so many runs of equal length, the last one shorter."""
    each = df.groupBy(trial).agg(F.ceil((F.max(frame) + 1) / parts).alias("_each"))
    return df.join(each, trial).withColumn("part", F.floor(F.col(frame) / F.col("_each")).cast("int")).drop("_each")


def frames_of(df: DataFrame, keys: list[str], width: int, values: list[str]) -> DataFrame:
    """Each frame's ``values`` as arrays of doubles, row by row."""
    one = F.struct((F.col("y") * width + F.col("x")).alias("p"), *values)
    own = df.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("_all"))
    field = lambda name: F.transform("_all", lambda s: s[name].cast("double")).alias(name)
    return own.select(*keys, *map(field, values))


def centred_and_cropped(stack: DataFrame, second: DataFrame | None, offsets: str, height: int, width: int, crop: tuple[int, int, int, int], *, sigma: float, truncate: float, quantile: float, corner: int) -> tuple[DataFrame, DataFrame | None]:
    """``stack`` (trial_id, frame, y, x, value) with every frame's bright middle in the
    centre, and ``second`` moved in the same way, both cropped to rows [0] to [1] and columns
    [2] to [3]. Offsets are a table at the path ``offsets``: a trial that is there is moved
    as it says, the others are computed and added, once."""
    from chronopix.operators.image import crop as cropped
    from chronopix.operators.spatial import apply_border
    from chronopix.sources.sinks import stored, write_missing

    spark, keys = stack.sparkSession, ["trial_id", "frame"]
    known = stored(spark, offsets)
    new = stack if known is None else stack.join(known.select("trial_id").distinct(), "trial_id", "left_anti")
    images = frames_of(new, keys, width, ["value"])
    found = map_frames(images, height, width, lambda v: bright_offsets(blurred(v, sigma, truncate).round(9), quantile), ["value"], "_offset")
    whole = F.transform("_offset", lambda v: v.cast("int"))
    write_missing(found.withColumn("_offset", whole).select(*keys, F.col("_offset")[0].alias("dy"), F.col("_offset")[1].alias("dx")), offsets, ["trial_id"], expected=images)
    moves = spark.read.parquet(offsets)
    one = lambda df: cropped(apply_border(df, moves, corner), *crop)
    return one(stack), None if second is None else one(second)


def bright_offsets(frames: np.ndarray, quantile: float) -> np.ndarray:
    """Rows and columns from the image's centre to the middle of what is above a quantile,
    cut to whole pixels; none where nothing is above it."""
    n, h, w = frames.shape
    bright = frames > np.quantile(frames.reshape(n, -1), quantile, axis=1)[:, None, None]
    many = np.maximum(bright.sum((1, 2)), 1)
    y = (bright * np.arange(h)[None, :, None]).sum((1, 2)) / many - h / 2
    x = (bright * np.arange(w)[None, None, :]).sum((1, 2)) / many - w / 2
    some = bright.any((1, 2))
    return np.where(some[:, None], np.trunc(np.stack([y, x], 1)), 0.0)
