"""Trends of single trials, lags between traces, and events with a pause after each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronopix.session import ship_code


def isotonic(v: np.ndarray) -> np.ndarray:
    """Least squares among non-decreasing sequences: pools of adjacent violators."""
    level, weight = [], []
    for x in v.tolist():
        level.append(x)
        weight.append(1)
        while len(level) > 1 and level[-2] > level[-1]:
            w = weight[-2] + weight[-1]
            level[-2:] = [(level[-2] * weight[-2] + level[-1] * weight[-1]) / w]
            weight[-2:] = [w]
    return np.repeat(level, weight)


def detrended(df: DataFrame, value: str, degree: int | None = 3, monotone: bool = True) -> DataFrame:
    """trial_id, frame and the residual after a monotone trend (rising or falling by the
    sign of the rank correlation) and a polynomial. A trial is fitted as a whole; its
    length is that of a recording."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("frame")
        v = rows[value].to_numpy(float)
        if monotone:
            ranks = pd.Series(v).rank().to_numpy()
            sign = 1.0 if len(v) < 2 or np.ptp(v) == 0 or np.corrcoef(np.arange(len(v)), ranks)[0, 1] >= 0 else -1.0
            v = v - sign * isotonic(sign * v)
        if degree:
            t = np.linspace(-1, 1, len(v))
            v = v - np.polyval(np.polyfit(t, v, min(degree, len(v) - 1)), t)
        return pd.DataFrame({"trial_id": rows["trial_id"], "frame": rows["frame"], "residual": v})

    ship_code(df.sparkSession)
    return df.select("trial_id", "frame", value).groupBy("trial_id").applyInPandas(fit, "trial_id long, frame long, residual double")


def with_pause(events: DataFrame, at: str, pause: int, key: str = "trial_id") -> DataFrame:
    """Events more than ``pause`` after the one that was kept before them. Rows come sorted
    within each partition, so only the last kept place is held, however many there are."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trial, last = None, 0
        for rows in batches:
            kept = []
            for i, (k, x) in enumerate(zip(rows[key].tolist(), rows[at].tolist(), strict=True)):
                if k != trial or x > last + pause:
                    kept.append(i)
                    trial, last = k, x
            yield rows.iloc[kept]

    return events.select(key, at).repartition(key).sortWithinPartitions(key, at).mapInPandas(keep, f"{key} long, {at} long")


def lagged_explained(df: DataFrame, x: str, y: str, fold: str, lags: int, alpha: float) -> DataFrame:
    """For each lag the mean over folds of the variance of ``y`` that ``x``, so many frames
    before, explains in rows that were not fitted on; both are standardised by lag."""
    clock = Window.partitionBy("trial_id").orderBy("frame")
    later = F.array(*[F.struct(F.lit(k).alias("lag"), F.lead(y, k).over(clock).alias("y")) for k in range(lags)])
    ahead = df.select(fold, F.col(x).alias("_x"), later.alias("_later"))
    pairs = ahead.select(fold, F.col("_x").alias("x"), F.inline("_later")).where(F.col("y").isNotNull())
    # all sums in one pass; standardised ones follow from them
    s = pairs.groupBy("lag", fold).agg(F.count("*").alias("n"), *[F.sum(e).alias(c) for c, e in (("sx", F.col("x")), ("sy", F.col("y")), ("xx", F.col("x") ** 2), ("yy", F.col("y") ** 2), ("xy", F.col("x") * F.col("y")))])
    g = Window.partitionBy("lag")
    total = lambda c: F.sum(c).over(g)
    s = s.withColumns({"mx": total("sx") / total("n"), "my": total("sy") / total("n")})
    s = s.withColumns({"dx": F.sqrt(total("xx") / total("n") - F.col("mx") ** 2), "dy": F.sqrt(total("yy") / total("n") - F.col("my") ** 2)})
    n, mx, my = F.col("n"), F.col("mx"), F.col("my")
    z = s.select(
        "lag", "n", ((F.col("sx") - n * mx) / F.col("dx")).alias("sx"), ((F.col("sy") - n * my) / F.col("dy")).alias("sy"), ((F.col("xx") - 2 * mx * F.col("sx") + n * mx**2) / F.col("dx") ** 2).alias("xx"),
        ((F.col("yy") - 2 * my * F.col("sy") + n * my**2) / F.col("dy") ** 2).alias("yy"), ((F.col("xy") - mx * F.col("sy") - my * F.col("sx") + n * mx * my) / F.col("dx") / F.col("dy")).alias("xy"),
    )
    z = z.withColumn("w", (total("xy") - F.col("xy")) / (total("xx") - F.col("xx") + alpha))
    w = F.col("w")
    error = (F.col("yy") - 2 * w * F.col("xy") + w * w * F.col("xx")) / n - ((F.col("sy") - w * F.col("sx")) / n) ** 2
    return z.groupBy("lag").agg(F.avg(1 - error / (F.col("yy") / n - (F.col("sy") / n) ** 2)).alias("var_explained"))
