"""Windowed signal processing within trials, on an explicit frame order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRIAL = "trial_id"


def by_frame(*keys: str):
    return Window.partitionBy(*(keys or (TRIAL,))).orderBy("frame")


def moving_average(x: Column, size: int, *keys: str) -> Column:
    """Zero-padded: the sum of the rows around, always over ``size``."""
    before = size // 2
    return F.sum(x).over(by_frame(*keys).rowsBetween(-before, size - 1 - before)) / size


def held_state(raw: Column, size: int, share: float = 0.75) -> Column:
    """True where the raw state holds and at least ``share`` of its surroundings too."""
    return raw & (moving_average(raw.cast("int"), size) >= share)


def walking(velocity: Column, threshold: float = 0.03, size: int = 100) -> Column:
    return held_state(velocity >= threshold, size)


def resting(*velocities: Column, threshold: float = 0.01, size: int = 400) -> Column:
    still = F.lit(True)
    for v in velocities:
        still = still & (F.abs(v) <= threshold)
    return held_state(still, size)


def without_last(df: DataFrame) -> DataFrame:
    """All rows but each trial's last."""
    return df.withColumn("_last", F.max("frame").over(Window.partitionBy(TRIAL))).where(F.col("frame") < F.col("_last")).drop("_last")


def with_islands(df: DataFrame, state: str, name: str = "island") -> DataFrame:
    """Number the runs of equal ``state``: frame number minus rank in the state."""
    rank = F.row_number().over(Window.partitionBy(TRIAL, state).orderBy("frame"))
    return df.withColumn(name, F.col("frame") - rank)


def intervals(df: DataFrame, state: str, *extra: Column) -> DataFrame:
    """Half-open [start_frame, stop_frame) of each run of a true ``state``."""
    runs = with_islands(df, state).where(F.col(state)).groupBy(TRIAL, "island")
    return runs.agg(F.min("frame").alias("start_frame"), (F.max("frame") + 1).alias("stop_frame"), *extra).drop("island")


def spans(df: DataFrame, state: str) -> DataFrame:
    """First and last frame of each run of any ``state``."""
    return with_islands(df, state).groupBy(TRIAL, state, "island").agg(F.min("frame").alias("start_frame"), F.max("frame").alias("end_frame")).drop("island")


def trimmed_runs(df: DataFrame, state: str, n: int) -> DataFrame:
    """Drop the first ``n`` frames of each run of a true ``state``."""
    place = F.row_number().over(Window.partitionBy(TRIAL, state, "island").orderBy("frame"))
    return with_islands(df, state).withColumn(state, F.col(state) & (place > n)).drop("island")


def kernel_filter(df: DataFrame, column: str, weights: list[float], name: str) -> DataFrame:
    """Weighted sum of neighbours with reflected edges (the edge itself repeated). A
    trial's rows are reached by lag and lead, so no row is multiplied."""
    r, w = len(weights) // 2, by_frame()
    n, i = F.count("*").over(Window.partitionBy(TRIAL)), F.row_number().over(w) - 1
    df = df.withColumn("_n", n).withColumn("_i", i).withColumn("_near", F.collect_list(F.col(column)).over(w.rowsBetween(-2 * r, 2 * r)))
    # the collected rows begin at max(0, i - 2r)
    first = F.greatest(F.col("_i") - 2 * r, F.lit(0))

    def at(k: int) -> Column:
        j = F.col("_i") + k
        period = 2 * F.col("_n")
        m = F.pmod(j, period)
        return F.get(F.col("_near"), (F.least(m, period - 1 - m) - first).cast("int"))

    total = F.lit(0.0)
    for k, weight in zip(range(-r, r + 1), weights, strict=True):
        total = total + at(k) * weight
    return df.withColumn(name, total).drop("_n", "_i", "_near")


def gaussian_weights(sigma: float, truncate: float = 4.0) -> list[float]:
    r = int(truncate * sigma + 0.5)
    w = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-r, r + 1)]
    return [x / sum(w) for x in w]


def median_filter(df: DataFrame, column: str, size: int, name: str) -> DataFrame:
    """Median of an odd window with reflected edges."""
    r, w = size // 2, by_frame()
    df = df.withColumn("_n", F.count("*").over(Window.partitionBy(TRIAL))).withColumn("_i", F.row_number().over(w) - 1)
    df = df.withColumn("_near", F.collect_list(F.col(column)).over(w.rowsBetween(-2 * r, 2 * r)))
    first, period = F.greatest(F.col("_i") - 2 * r, F.lit(0)), 2 * F.col("_n")

    def at(k: Column) -> Column:
        m = F.pmod(F.col("_i") + k, period)
        return F.get(F.col("_near"), (F.least(m, period - 1 - m) - first).cast("int"))

    values = F.array_sort(F.transform(F.sequence(F.lit(-r), F.lit(r)), at))
    return df.withColumn(name, F.get(values, F.lit(r))).drop("_n", "_i", "_near")


def edges(df: DataFrame, state: str) -> DataFrame:
    """``rising`` and ``falling`` at the first frame of the new state; a trial that
    begins in a true state rises at its first frame."""
    before = F.coalesce(F.lag(state).over(by_frame()), F.lit(False))
    return df.withColumn("rising", F.col(state) & ~before).withColumn("falling", ~F.col(state) & before)


def edge_pairs(df: DataFrame, state: str) -> DataFrame:
    """The i-th rising edge with the i-th falling edge, as far as both go."""
    marked = edges(df, state)
    rank = F.row_number().over(by_frame())
    ups = marked.where("rising").select(TRIAL, F.col("frame").alias("start_frame"), rank.alias("i"))
    downs = marked.where("falling").select(TRIAL, F.col("frame").alias("stop_frame"), rank.alias("i"))
    return ups.join(downs, [TRIAL, "i"])


def adaptive_level(df: DataFrame, column: str) -> DataFrame:
    """``high`` where the signal is above the middle of its 1% and 99% quantiles."""
    limits = df.groupBy(TRIAL).agg(F.percentile(column, F.array(F.lit(0.01), F.lit(0.99))).alias("_q"))
    return df.join(limits, TRIAL).withColumn("high", F.col(column) > (F.col("_q")[0] + F.col("_q")[1]) / 2).drop("_q")


def forward_fill(x: Column, default: float = 0.0) -> Column:
    """The last value so far; ``default`` before the first."""
    return F.coalesce(F.last(x, ignorenulls=True).over(by_frame().rowsBetween(Window.unboundedPreceding, 0)), F.lit(default))


def motion_energy(x: Column, y: Column, size: int) -> tuple[Column, Column]:
    """Step length (first 0); smooth it with ``moving_average`` in a second projection."""
    w = by_frame()
    dx, dy = x - F.lag(x).over(w), y - F.lag(y).over(w)
    return F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0)), F.lit(size)


def cumulative_integral(x: Column, rate: float) -> Column:
    w = by_frame().rowsBetween(Window.unboundedPreceding, 0)
    return (F.sum(x).over(w) - F.first(x).over(w)) / rate


def frame_rates(df: DataFrame) -> DataFrame:
    """Both definitions: one over the mean step, and the mean of one over the step."""
    step = F.col("t") - F.lag("t").over(by_frame())
    return df.withColumn("_d", step).groupBy(TRIAL).agg((1 / F.nullif(F.avg("_d"), F.lit(0.0))).alias("rate_of_mean"), F.avg(F.when(F.col("_d") > 0, 1 / F.nullif(F.col("_d"), F.lit(0.0)))).alias("mean_of_rate")).drop("_d")


def tick_to_frame(df: DataFrame, state: str) -> DataFrame:
    """Count of rising edges so far, from 0; null before the first."""
    count = F.sum(F.col("rising").cast("int")).over(by_frame().rowsBetween(Window.unboundedPreceding, 0)) - 1
    return edges(df, state).withColumn("tick_frame", F.when(count >= 0, count))


def clipped(df: DataFrame, inside: str) -> DataFrame:
    """Rows where ``inside`` holds, and the one row before the first of them."""
    start = F.min(F.when(F.col(inside), F.col("frame"))).over(Window.partitionBy(TRIAL))
    return df.withColumn("_s", start).where(F.col(inside) | (F.col("frame") == F.col("_s") - 1)).drop("_s")


def state_overlay(df: DataFrame, start: Column, stop: Column) -> DataFrame:
    """On from a start to the next stop; a row that is both is on."""
    event = F.when(start, True).when(stop, False)
    return df.withColumn("overlay", F.coalesce(F.last(event, ignorenulls=True).over(by_frame().rowsBetween(Window.unboundedPreceding, 0)), F.lit(False)))


def time_crop(df: DataFrame, k: int) -> DataFrame:
    """Without the first and the last ``k`` frames of each trial."""
    if not k:
        return df
    return df.withColumn("_n", F.count("*").over(Window.partitionBy(TRIAL))).where((F.col("frame") >= k) & (F.col("frame") < F.col("_n") - k)).drop("_n")


def every_nth(df: DataFrame, n: int) -> DataFrame:
    return df.where(F.col("frame") % n == n - 1)


def binned(df: DataFrame, column: str, width: float) -> DataFrame:
    """Mean and size of each time bin, counted from the trial's start."""
    start = F.min("t").over(Window.partitionBy(TRIAL))
    return df.withColumn("bin", F.floor((F.col("t") - start) / width)).groupBy(TRIAL, "bin").agg(F.avg(column).alias("mean"), F.count("*").alias("n"))
