"""Moments of vectors from one pass, and features ordered so that alike ones stand together.

Tasks add up products of all pairs of components in NumPy; what they return, and what comes
to the driver, is as many numbers as pairs of features, whatever the number of rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from chronopix.session import ship_code

#: Numbers that a task turns into products at once.
AT_ONCE = 1 << 20


@dataclass
class Moments:
    """Count, sums of components, and sums of products of all pairs."""

    n: int
    sums: np.ndarray
    products: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.n

    @property
    def covariance(self) -> np.ndarray:
        return self.products / self.n - np.outer(self.mean, self.mean)

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.sums + other.sums, self.products + other.products)

    def standardised(self, mean: np.ndarray, deviation: np.ndarray) -> Moments:
        """Moments of the same rows less ``mean``, over ``deviation`` (components that don't
        vary stay at their distance from it)."""
        d = np.where(deviation > 0, deviation, 1.0)
        products = self.products - np.outer(mean, self.sums) - np.outer(self.sums, mean) + self.n * np.outer(mean, mean)
        return Moments(self.n, (self.sums - self.n * mean) / d, products / np.outer(d, d))


def moment_sums(df: DataFrame, vector: str, key: str | None = None) -> DataFrame:
    """key, row, column and ``s``: sums of products of components, counted from 1, with a
    component 0 that is always one, so (0, 0) is the count and (0, i) the sum of i. Vectors are of
    one length; null ones, and ones with null components, are left out."""
    ship_code(df.sparkSession)
    whole = F.coalesce(F.forall(vector, lambda x: x.isNotNull()), F.lit(False))
    rows = df.where(whole).select((F.col(key) if key else F.lit(None).cast("int")).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    kind = to_arrow_type(rows.schema["key"].dataType)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            k = len(batch.column("v")[0]) if batch.num_rows else 0
            step = max(1, AT_ONCE // max(1, k))
            for at in range(0, batch.num_rows, step):
                b = batch.slice(at, step)
                x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, k)
                keys = np.array(b.column("key").to_pylist(), object)
                for own in dict.fromkeys(keys.tolist()):
                    part = x[[o == own for o in keys]]
                    wide = np.concatenate([np.ones((len(part), 1)), part], 1)
                    total[own] = total.get(own, 0) + wide.T @ wide
        for own, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([own] * len(m), kind), pa.array(np.arange(len(m)), pa.int32()), pa.array(list(m), pa.list_(pa.float64()))], ["key", "row", "sums"])

    schema = StructType([rows.schema["key"], *StructType.fromDDL("row int, sums array<double>")])
    parts = rows.mapInArrow(add, schema).select("key", "row", F.posexplode("sums").alias("column", "s"))
    return parts.groupBy("key", "row", "column").agg(F.sum("s").alias("s"))


def moments(df: DataFrame, vector: str, key: str | None = None) -> dict:
    """Moments of each ``key`` (of all rows under None), for keys of a bounded number."""
    found: dict = {}
    for r in moment_sums(df, vector, key).collect():
        found.setdefault(r["key"], {})[r["row"], r["column"]] = r["s"]
    out = {}
    for own, cells in found.items():
        k = max(i for i, _ in cells) + 1
        m = np.zeros((k, k))
        m[tuple(np.array(list(cells)).T)] = list(cells.values())
        out[own] = Moments(round(m[0, 0]), m[0, 1:], m[1:, 1:])
    return out


def distances(rows: np.ndarray) -> np.ndarray:
    """Distance of every pair of rows."""
    return np.sqrt(np.stack([((rows - r) ** 2).sum(1) for r in rows]))


def complete_linkage(apart: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges of complete linkage by rising height: two clusters and their distance, which
    is that of their members farthest apart; a merge makes the cluster ``n`` + its place. By
    chains of nearest neighbours: a pair that are nearest to each other can be merged at once,
    as no later merge brings a third any nearer."""
    n = len(apart)
    d = apart.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    alive, chain, merges = np.ones(n, bool), [], []
    for _ in range(n - 1):
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            last = chain[-1]
            near = int(np.where(alive, d[last], np.inf).argmin())
            if len(chain) > 1 and d[last, near] >= d[last, chain[-2]]:
                near = chain[-2]
            if len(chain) > 1 and near == chain[-2]:
                break
            chain.append(near)
        a, b = sorted(chain[-2:])
        chain = chain[:-2]
        merges.append((d[a, b], a, b))
        d[b] = d[:, b] = np.maximum(d[a], d[b])  # b goes on as both, a is gone
        d[b, b] = np.inf
        alive[a] = False
    # by height; what a place stood for gets the names of clusters
    out, name = [], {i: i for i in range(n)}
    for k, (height, a, b) in enumerate(sorted(merges, key=lambda m: m[0])):
        out.append((*sorted((name[a], name[b])), float(height)))
        name[b] = n + k
    return out


def cut(n: int, merges: list[tuple[int, int, float]], height: float) -> list[int]:
    """Number of each member's cluster, from 1, where merges above ``height`` are undone;
    clusters are numbered from the top of the tree, the smaller name first."""
    out, number, stack = [0] * n, 0, [(2 * n - 2, True)]
    while stack:
        node, fresh = stack.pop()
        apart = node >= n and merges[node - n][2] > height
        if fresh and not apart:
            number += 1
        if node < n:
            out[node] = number
        else:
            stack += [(child, apart) for child in reversed(merges[node - n][:2])]
    return out


def cluster_order(df: DataFrame, vector: str) -> DataFrame:
    """``feature``, ``cluster`` and ``place``: components whose rows of the covariance matrix are
    less than half the greatest distance apart, by complete linkage, next to each other."""
    found = moments(df, vector).get(None)
    k = len(found.sums) if found else 0
    rows = []
    if k:
        apart = distances(found.covariance)
        numbers = cut(k, complete_linkage(apart), apart.max() / 2)
        for place, feature in enumerate(sorted(range(k), key=lambda i: (numbers[i], i))):
            rows.append((feature, numbers[feature], place))
    return df.sparkSession.createDataFrame(rows, "feature int, cluster int, place int")


def named(df: DataFrame) -> DataFrame:
    """Places of features as names: f0, f1, and so on."""
    name = lambda c: F.concat(F.lit("f"), F.col(c).cast("string")).alias(c)
    return df.select(*[name(c) if c in ("a", "b") else c for c in df.columns])


def pair_sums(df: DataFrame, vector: str, key: str | None) -> DataFrame:
    """key, a <= b, and ``n``, ``sa``, ``sb`` and ``p`` of two features: count, sums and sum of
    products."""
    sums = moment_sums(df, vector, key)
    n = sums.where("row = 0 AND column = 0").select(F.col("key").alias("_k"), F.col("s").alias("n"))
    one = lambda c: sums.where("row = 0 AND column > 0").select(F.col("key").alias(f"_k{c}"), F.col("column").alias(c), F.col("s").alias(f"s{c}"))
    pairs = sums.where("row > 0 AND row <= column").select("key", F.col("row").alias("a"), F.col("column").alias("b"), F.col("s").alias("p"))
    same = lambda c: F.col("key").eqNullSafe(F.col(c))
    for c in ("a", "b"):
        other = one(c).withColumnRenamed(c, "_f")
        pairs = pairs.join(other, same(f"_k{c}") & (F.col(c) == F.col("_f"))).drop(f"_k{c}", "_f")
    return pairs.join(n, same("_k")).select("key", (F.col("a") - 1).alias("a"), (F.col("b") - 1).alias("b"), "n", "sa", "sb", "p")


def covariances(df: DataFrame, vector: str, key: str) -> DataFrame:
    """key, a, b and ``cov``: population covariance of all pairs of features of each key."""
    cov = F.col("p") / F.col("n") - F.col("sa") * F.col("sb") / F.col("n") / F.col("n")
    return named(pair_sums(df, vector, key).select(F.col("key").alias(key), "a", "b", cov.alias("cov")))


def split_covariances(df: DataFrame, vector: str, key: str) -> DataFrame:
    """a, b, ``total``, ``intra`` and ``inter``: the covariance of all rows, its part within
    the keys and its part between them."""
    sums = pair_sums(df, vector, key).withColumn("within", F.col("p") - F.col("sa") * F.col("sb") / F.col("n"))
    all_of = sums.groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "p", "within")])
    total = F.col("p") / F.col("n") - F.col("sa") * F.col("sb") / F.col("n") / F.col("n")
    got = all_of.select("a", "b", total.alias("total"), (F.col("within") / F.col("n")).alias("intra"))
    return named(got).withColumn("inter", F.col("total") - F.col("intra"))


def pair_covariances(df: DataFrame, vector: str, key: str) -> DataFrame:
    """first, second, a, b, ``total``, ``intra`` and ``inter``: for every two keys, of their
    rows standardised together, the covariance matrix (a <= b), the part of it within the two
    and the part between them. Keys are compared by their moments, of which there are as many
    as keys and pairs of features; features that don't vary have null covariances."""
    sums = moment_sums(df, vector, key)
    n = sums.where("row = 0 AND column = 0").select("key", F.col("s").alias("n"))
    one = sums.where("row = 0 AND column > 0").select("key", F.col("column").alias("a"), F.col("s").alias("sa"))
    square = sums.where("row = column AND row > 0").select("key", F.col("row").alias("a"), F.col("s").alias("qa"))
    one = one.join(square, ["key", "a"])
    other = one.select("key", F.col("a").alias("b"), F.col("sa").alias("sb"), F.col("qa").alias("qb"))
    each = sums.where("row > 0 AND row <= column").select("key", F.col("row").alias("a"), F.col("column").alias("b"), F.col("s").alias("p")).join(one, ["key", "a"]).join(other, ["key", "b"]).join(n, "key")
    names = ["n", "sa", "sb", "qa", "qb", "p"]
    side = lambda name: each.select(F.col("key").alias(name), "a", "b", *[F.col(c).alias(f"{name}_{c}") for c in names])
    both = side("first").join(side("second"), ["a", "b"]).where("first < second")
    both = both.withColumns({c: F.col(f"first_{c}") + F.col(f"second_{c}") for c in names})
    cov = lambda prefix="": F.col(f"{prefix}p") / F.col(f"{prefix}n") - F.col(f"{prefix}sa") * F.col(f"{prefix}sb") / F.col(f"{prefix}n") / F.col(f"{prefix}n")
    deviation = lambda c: F.sqrt(F.greatest(F.col(f"q{c}") / F.col("n") - (F.col(f"s{c}") / F.col("n")) ** 2, F.lit(0.0)))
    scale = F.nullif(deviation("a") * deviation("b"), F.lit(0.0))
    within = (F.col("first_n") * cov("first_") + F.col("second_n") * cov("second_")) / F.col("n")
    got = both.select("first", "second", (F.col("a") - 1).alias("a"), (F.col("b") - 1).alias("b"), (cov() / scale).alias("total"), (within / scale).alias("intra"))
    return got.withColumn("inter", F.col("total") - F.col("intra"))


def principal_maps(df: DataFrame, vector: str, n: int, key: str | None = None) -> np.ndarray:
    """The first ``n`` principal axes of vectors standardised within each key, as rows; the
    first weight that isn't zero is positive."""
    parts = moments(df, vector, key)
    each = [m.standardised(m.mean, np.sqrt(np.maximum(np.diag(m.covariance), 0))) for m in parts.values()]
    total = sum(each[1:], each[0])
    values, axes = np.linalg.eigh(total.covariance)
    first = axes[:, np.argsort(-values)[:n]].T
    signs = [v[np.flatnonzero(np.abs(v) > 1e-12)[0]] if (np.abs(v) > 1e-12).any() else 1.0 for v in first]
    return first * np.sign(signs)[:, None]
