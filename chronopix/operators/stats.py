"""Normalisation, explained variance and baselines of traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronopix.functions.scalar import relative_change

TRIAL = "trial_id"


def zscore(x: Column, *keys: str) -> Column:
    """Null where the deviation is zero."""
    w = Window.partitionBy(*(keys or (TRIAL,)))
    return (x - F.avg(x).over(w)) / F.nullif(F.stddev_pop(x).over(w), F.lit(0.0))


def min_max(x: Column, *keys: str, low: float = 0.0, high: float = 1.0) -> Column:
    w = Window.partitionBy(*(keys or (TRIAL,)))
    least = F.min(x).over(w)
    return (x - least) / F.nullif(F.max(x).over(w) - least, F.lit(0.0)) * (high - low) + low


def quantile_normalised(df: DataFrame, column: str, mass: float, name: str, keys: tuple[str, ...] = (TRIAL,)) -> DataFrame:
    """The central ``mass`` of each group is mapped to 0..1."""
    q = df.groupBy(*keys).agg(F.percentile(column, F.array(F.lit((1 - mass) / 2), F.lit((1 + mass) / 2))).alias("_q"))
    return df.join(q, list(keys)).withColumn(name, (F.col(column) - F.col("_q")[0]) / F.nullif(F.col("_q")[1] - F.col("_q")[0], F.lit(0.0))).drop("_q")


def trial_quantile_normalised(df: DataFrame, column: str, mass: float, name: str, signal: list[str]) -> DataFrame:
    """Quantiles of each trial and signal, averaged over trials, then applied to all."""
    q = df.groupBy(TRIAL, *signal).agg(F.percentile(column, F.array(F.lit((1 - mass) / 2), F.lit((1 + mass) / 2))).alias("q"))
    limits = q.groupBy(*signal).agg(F.avg(F.col("q")[0]).alias("_lo"), F.avg(F.col("q")[1]).alias("_hi"))
    return df.join(limits, signal).withColumn(name, (F.col(column) - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))).drop("_lo", "_hi")


def rolling(df: DataFrame, column: str, n: int, keys: list[str], how: str = "avg") -> DataFrame:
    """Only full windows of ``n`` frames, at their first frame."""
    w = Window.partitionBy(*keys).orderBy("frame").rowsBetween(0, n - 1)
    value = F.avg(column).over(w) if how == "avg" else F.sum(column).over(w)
    return df.withColumn("rolled", value).withColumn("_n", F.count("*").over(w)).where(F.col("_n") == n).drop("_n")


def minimum_baseline(df: DataFrame, column: str, n: int, keys: list[str]) -> DataFrame:
    """The least mean of ``n`` successive frames."""
    return rolling(df, column, n, keys).groupBy(*keys).agg(F.min("rolled").alias("f0"))


def quantile_baseline(df: DataFrame, column: str, n: int, quantile: float, keys: list[str]) -> DataFrame:
    """An exact quantile of the sums of ``n`` successive frames (sums, not means)."""
    return rolling(df, column, n, keys, "sum").groupBy(*keys).agg(F.percentile("rolled", F.lit(quantile)).alias("f0"))


def common_baseline(baselines: DataFrame, keys: list[str]) -> DataFrame:
    """The least baseline over trials."""
    return baselines.groupBy(*keys).agg(F.min("f0").alias("f0"))


BASELINES = {"convolve": minimum_baseline, "quantile": quantile_baseline}


def baseline(df: DataFrame, column: str, keys: list[str], mode: str = "convolve", n: int = 10, quantile: float = 0.05, given: DataFrame | None = None) -> DataFrame:
    """``f0`` for each of ``keys`` by the named way, or as given; values under 0 count as 0."""
    clipped = df.withColumn(column, F.greatest(F.col(column), F.lit(0.0)))
    if mode == "given" and given is not None:
        return given
    if mode not in BASELINES:
        raise NotImplementedError(f"no such baseline: {mode}")
    return BASELINES[mode](clipped, column, n, keys) if mode == "convolve" else BASELINES[mode](clipped, column, n, quantile, keys)


def relative_to_baseline(df: DataFrame, column: str, baseline: DataFrame, keys: list[str], scale: float) -> DataFrame:
    return df.join(baseline, keys).withColumn("dff", relative_change(F.col(column), F.col("f0"), scale))


def variance_explained(y: Column, fitted: Column) -> Column:
    return 1 - F.var_pop(y - fitted) / F.nullif(F.var_pop(y), F.lit(0.0))


def ellipse(df: DataFrame, x: str, y: str, n_std: float, keys: list[str]) -> DataFrame:
    """Centre, radii and scales of the confidence ellipse; sample statistics."""
    r = F.corr(x, y)
    return df.groupBy(*keys).agg(
        F.avg(x).alias("centre_x"), F.avg(y).alias("centre_y"), F.sqrt(1 + r).alias("radius_x"), F.sqrt(1 - r).alias("radius_y"), (F.sqrt(F.var_samp(x)) * n_std).alias("scale_x"), (F.sqrt(F.var_samp(y)) * n_std).alias("scale_y")
    )


def ridge_1d(df: DataFrame, x: str, y: str, alpha: float, keys: list[str]) -> DataFrame:
    """Weight of one regressor without intercept."""
    return df.groupBy(*keys).agg((F.sum(F.col(x) * F.col(y)) / (F.sum(F.col(x) * F.col(x)) + alpha)).alias("weight"))


def folds(df: DataFrame, k: int, order: str = "frame") -> DataFrame:
    """Contiguous blocks of equal size within each trial; the last takes the rest."""
    w = Window.partitionBy(TRIAL)
    size = F.floor(F.count("*").over(w) / k)
    place = F.row_number().over(w.orderBy(order)) - 1
    return df.withColumn("_s", size).withColumn("fold", F.when(F.col("_s") == 0, 0).otherwise(F.least(F.floor(place / F.nullif(F.col("_s"), F.lit(0))), F.lit(k - 1))).cast("long")).drop("_s")


def ridge_cv_1d(df: DataFrame, x: str, y: str, alpha: float, k: int) -> DataFrame:
    """Out-of-fold explained variance. Each fold's training sums are the trial's sums
    without the fold's, so no row is read twice."""
    parts = folds(df, k)
    sums = parts.groupBy(TRIAL, "fold").agg(F.sum(F.col(x) * F.col(y)).alias("xy"), F.sum(F.col(x) * F.col(x)).alias("xx"))
    all_folds = Window.partitionBy(TRIAL)
    weight = (F.sum("xy").over(all_folds) - F.col("xy")) / (F.sum("xx").over(all_folds) - F.col("xx") + alpha)
    fitted = parts.join(sums.select(TRIAL, "fold", weight.alias("w")), [TRIAL, "fold"])
    return fitted.groupBy(TRIAL).agg(variance_explained(F.col(y), F.col("w") * F.col(x)).alias("var_explained"))
