"""Covariances, class axes, principal axes and ridge regression from sums.

Sums over rows run in Spark; only matrices of features by features, whose size does
not depend on the rows, are solved on the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronopix.session import ship_code


def covariance(df: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """Population covariance of every pair i <= j of features, in long form."""
    pairs = [(i, j) for i in range(len(features)) for j in range(i, len(features))]
    wide = df.groupBy(*keys).agg(*[F.covar_pop(features[i], features[j]).alias(f"c_{i}_{j}") for i, j in pairs])
    long = F.explode(F.array(*[F.struct(F.lit(features[i]).alias("a"), F.lit(features[j]).alias("b"), F.col(f"c_{i}_{j}").alias("cov")) for i, j in pairs]))
    return wide.select(*keys, long.alias("p")).select(*keys, "p.a", "p.b", "p.cov")


def split_covariance(df: DataFrame, features: list[str], group: Column) -> DataFrame:
    """Within-class, between-class and total covariance of every pair."""
    of = df.withColumn("_g", group)
    total = covariance(of, features, []).withColumnRenamed("cov", "total")
    n = of.groupBy("_g").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("a", "b"))
    inside = covariance(of, features, ["_g"]).join(n, "_g").withColumn("w", share).groupBy("a", "b").agg(F.sum(F.col("w") * F.col("cov")).alias("intra"))
    return total.join(inside, ["a", "b"]).withColumn("inter", F.col("total") - F.col("intra"))


def class_mean_axis(df: DataFrame, value: str, first: Column, keys: list[str]) -> DataFrame:
    """Mean of the first class minus mean of the other, for each feature."""
    return df.groupBy(*keys).agg((F.avg(F.when(first, F.col(value))) - F.avg(F.when(~first, F.col(value)))).alias("w"))


def matrix(df: DataFrame, vector: str) -> tuple[np.ndarray, np.ndarray]:
    """Means and population covariance of all components of a vector column, as arrays."""
    first = df.select(F.posexplode(vector).alias("i", "x"), vector)
    pairs = first.select("i", "x", F.posexplode(F.expr(f"slice({vector}, i + 1, size({vector}))")).alias("k", "y"))
    rows = pairs.groupBy("i", (F.col("i") + F.col("k")).alias("j")).agg(F.avg("x").alias("mean"), F.covar_pop("x", "y").alias("cov")).collect()
    size = 1 + max(r["j"] for r in rows)
    m, c = np.zeros(size), np.zeros((size, size))
    for r in rows:
        c[r["i"], r["j"]] = c[r["j"], r["i"]] = r["cov"]
        if r["i"] == r["j"]:
            m[r["i"]] = r["mean"]
    return m, c


def principal_axes(df: DataFrame, vector: str) -> DataFrame:
    """Axes by falling variance; the first nonzero weight of each is positive."""
    _, c = matrix(df, vector)
    values, vectors = np.linalg.eigh(c)
    rows = []
    for k, i in enumerate(np.argsort(-values)):
        v = vectors[:, i]
        v = v * np.sign(v[np.flatnonzero(np.abs(v) > 1e-12)[0]])
        rows += [(k, f"f{f}", float(w), float(values[i])) for f, w in enumerate(v)]
    return df.sparkSession.createDataFrame(rows, "axis int, feature string, weight double, variance double")


def discriminant_axis(df: DataFrame, vector: str, first: Column) -> DataFrame:
    """inv(within-class covariance) times the difference of means, of length one."""
    n1, n2 = df.where(first).count(), df.where(~first).count()
    (m1, c1), (m2, c2) = matrix(df.where(first), vector), matrix(df.where(~first), vector)
    w = np.linalg.solve((n1 * c1 + n2 * c2) / (n1 + n2), m1 - m2)
    w = w / np.linalg.norm(w)
    return df.sparkSession.createDataFrame([(f"f{f}", float(x)) for f, x in enumerate(w)], "feature string, weight double")


def fold_sums(df: DataFrame, features: list[str], target: str, fold: str) -> dict[int, tuple[np.ndarray, np.ndarray, float, float, int]]:
    """For each fold X'X, X'y, sum y, sum y*y and the count, in one pass."""
    k = len(features)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    aggs = [F.sum(F.col(features[i]) * F.col(features[j])) for i, j in pairs] + [F.sum(F.col(f) * F.col(target)) for f in features] + [F.sum(f) for f in features]
    rows = df.groupBy(fold).agg(*aggs, F.sum(target), F.sum(F.col(target) ** 2), F.count("*")).collect()
    out = {}
    for r in rows:
        a = np.zeros((k, k))
        for (i, j), v in zip(pairs, r[1 : 1 + len(pairs)], strict=True):
            a[i, j] = a[j, i] = v
        at = 1 + len(pairs)
        out[r[0]] = (a, np.array(r[at : at + k]), np.array(r[at + k : at + 2 * k]), r[-3], r[-2], r[-1])
    return out


def ridge_nested(df: DataFrame, features: list[str], target: str, outer: str, inner: str, alphas: list[float]) -> DataFrame:
    """Nested cross-validation from sums: the inner folds choose alpha, the outer folds
    report the explained variance of rows that were not trained on."""
    sums = fold_sums(df.withColumn("_f", F.concat_ws("/", F.col(outer).cast("string"), F.col(inner).cast("string"))), features, target, "_f")
    key = lambda f: tuple(f.split("/"))
    add = lambda parts: [sum(p[i] for p in parts) for i in range(6)]

    def explained(w: np.ndarray, s: list) -> float:
        xx, xy, sx, sy, syy, n = s
        error = syy - 2 * w @ xy + w @ xx @ w
        mean = (sy - w @ sx) / n
        return float(1 - (error / n - mean**2) / (syy / n - (sy / n) ** 2))

    fit = lambda s, a: np.linalg.solve(s[0] + a * np.eye(len(features)), s[1])
    rows = []
    for o in sorted({key(f)[0] for f in sums}):
        train = {f: s for f, s in sums.items() if key(f)[0] != o}
        score = {}
        for a in alphas:
            got = []
            for i in sorted({key(f)[1] for f in train}):
                got.append(explained(fit(add([s for f, s in train.items() if key(f)[1] != i]), a), add([s for f, s in train.items() if key(f)[1] == i])))
            score[a] = float(np.mean(got))
        best = max(alphas, key=lambda a: score[a])
        rows.append((int(o), float(best), explained(fit(add(list(train.values())), best), add([s for f, s in sums.items() if key(f)[0] == o]))))
    return df.sparkSession.createDataFrame(rows, "fold int, alpha double, var_explained double")


def variance_ratios(df: DataFrame, vector: str, state: str, half: str) -> DataFrame:
    """Norms of the covariance between two states, and between the two halves in time of
    each state, of features standardised over all rows; and their ratio. Only moments of
    the four groups come to the driver, as many as features by features."""
    long = df.select(state, half, F.posexplode(vector).alias("i", "x"))
    rows = long.groupBy(state, half, "i").agg(F.count("*").alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") ** 2).alias("q")).collect()
    k = 1 + max(r["i"] for r in rows)
    n, s, q = {}, {}, {}
    for r in rows:
        at = (r[state], r[half])
        n[at] = r["n"]
        s.setdefault(at, np.zeros(k))[r["i"]], q.setdefault(at, np.zeros(k))[r["i"]] = r["s"], r["q"]
    total = sum(n.values())
    mean = sum(s.values()) / total
    deviation = np.sqrt(sum(q.values()) / total - mean**2)
    centre = lambda groups: (sum(s[g] for g in groups) / sum(n[g] for g in groups) - mean) / deviation

    def between(a: list, b: list) -> float:
        """The covariance between two groups is that of their means: of rank one."""
        na, nb = sum(n[g] for g in a), sum(n[g] for g in b)
        return float(na * nb / (na + nb) ** 2 * ((centre(a) - centre(b)) ** 2).sum() / k)

    of = {v: [g for g in n if g[0] == v] for v in sorted({g[0] for g in n})}
    states = between(*of.values())
    in_time = [between(*[[g] for g in sorted(groups)]) * sum(n[g] for g in groups) / total for groups in of.values()]
    return df.sparkSession.createDataFrame([(sum(in_time) / states, states, in_time[1], in_time[0])], "ratio double, between_states double, first_in_time double, other_in_time double")


def ridge_weights(df: DataFrame, features: list[str], target: str, alpha: float, key: str) -> DataFrame:
    """key and ``weights``, one for each feature: ridge regression without an intercept, of each
    key's rows. Sums of products are all that a key's equations need; they are solved in tasks,
    so there may be any number of keys. A key whose equations have no solution has null weights."""
    ship_code(df.sparkSession)
    k = len(features)
    products = [F.sum(F.col(a).cast("double") * F.col(b).cast("double")) for a in features for b in features] + [F.sum(F.col(a).cast("double") * F.col(target).cast("double")) for a in features]
    sums = df.groupBy(key).agg(F.array(*products).alias("sums"))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            weights = []
            for s in batch["sums"]:
                try:
                    weights.append(np.linalg.solve(np.reshape(s[: k * k], (k, k)) + alpha * np.eye(k), s[k * k :]).tolist())
                except np.linalg.LinAlgError:
                    weights.append(None)
            yield pd.DataFrame({key: batch[key], "weights": pd.Series(weights, dtype=object)})

    return sums.mapInPandas(solve, f"{key} {dict(df.dtypes)[key]}, weights array<double>")


def ridge_predict(df: DataFrame, features: list[str], weights: DataFrame, key: str) -> DataFrame:
    """``df`` with ``fitted``."""
    fitted = sum((F.col(f).cast("double") * F.get("weights", F.lit(i)) for i, f in enumerate(features)), F.lit(0.0))
    return df.join(weights, key).withColumn("fitted", fitted).drop("weights")
