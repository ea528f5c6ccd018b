"""Plain Lloyd clustering of vectors in whole numbers.

Vectors become integers, so that distances and means are exact and don't depend on how
rows are dealt. In each round the centroids, ``k`` times 64 numbers, go to all tasks; a
task takes the squared differences to one centroid after the other, and the first that is
nearest wins. Tasks return the sums of their members, one row for each centroid and
component, and a ``groupBy`` merges those; only the merged sums, as many whatever the
number of vectors, come to the driver.

Defined cases: vectors that are null, of another length, or with null or non-finite
components are left out; integers are held to +-2**27, so that a squared distance fits a
long; ids may be null or repeat, and each row counts for itself; a null id comes after all
others when the first centroids are drawn, and of equal ids the smaller vector comes
first; equal distances go to the smaller number; with fewer vectors than centroids each
is one; centroids that lose all members stay; other columns are not read; an empty table,
or one without a usable vector, gives no rows; sums of distances that no long holds are
null."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm._common import written
from chronopix.session import ship_code

#: Components beyond it are held to it: 64 squares of twice as much stay below 2**63.
MOST = 1 << 27
#: Vectors whose differences to a centroid are held at once.
AT_ONCE = 4096


def whole_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id, whether it is ``known`` (a null one is 0, as pandas would turn ids beside
    nulls into doubles), and ``x``, the components, of usable vectors."""
    e = F.col("embedding")
    finite = F.forall(e, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)) & ~F.coalesce(F.isnan(v), F.lit(True)))
    number = lambda v: F.floor(F.greatest(F.least(v.cast("double") * scale, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("int")
    usable = F.coalesce((F.size(e) == dims) & finite, F.lit(False))
    of = F.col("vec_id").cast("long")
    return vectors.where(usable).select(F.coalesce(of, F.lit(0).cast("long")).alias("vec_id"), of.isNotNull().alias("known"), F.transform(e, number).alias("x"))


def first_centroids(whole: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ids come first by their digest."""
    drawn = F.when(F.col("known"), F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    rows = whole.select(drawn.alias("drawn"), "x").orderBy(F.col("drawn").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row, the smallest on ties, and its squared
    distance."""
    d = np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)
    own = d.argmin(1)
    return own, d[np.arange(len(x)), own]


def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for batch in batches:
        for at in range(0, len(batch), AT_ONCE):
            part = batch.iloc[at : at + AT_ONCE]
            yield part, np.stack(part["x"].to_list()).astype(np.int64)


def member_sums(whole: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each centroid, the number of its members and the sum of their components."""
    k, dims = centroids.shape
    shared = whole.sparkSession.sparkContext.broadcast(centroids)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        total = np.zeros((k, dims + 1), np.int64)  # the last column counts
        for _, x in blocks(batches):
            own, _ = nearest(x, c)
            for i in np.unique(own):
                total[i, :dims] += x[own == i].sum(0)
            total[:, dims] += np.bincount(own, minlength=k)
        i, at = np.nonzero(total)
        yield pd.DataFrame({"cluster": i, "at": at, "n": total[i, at]})

    parts = whole.mapInPandas(add, "cluster int, at int, n long")
    total = np.zeros((k, dims + 1), np.int64)
    for r in parts.groupBy("cluster", "at").agg(F.sum("n").alias("n")).collect():
        total[r["cluster"], r["at"]] = r["n"]
    shared.unpersist()
    return total[:, dims], total[:, :dims]


def moved(centroids: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Centroids in the middle of their members, rounded down; empty ones stay."""
    some = counts > 0
    out = centroids.copy()
    out[some] = sums[some] // counts[some, None]
    return out


def lloyd(vectors: DataFrame, *, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every
    usable vector."""
    spark = vectors.sparkSession
    ship_code(spark)
    # each round reads the same integers, whatever became of the tasks that made them
    whole = written(whole_vectors(vectors, dims, scale))
    centroids = first_centroids(whole, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(centroids, *member_sums(whole, centroids))
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, x in blocks(batches):
            own, distance = nearest(x, shared.value)
            yield part[["vec_id", "known"]].assign(cluster=own, distance=distance)

    assigned = whole.mapInPandas(assign, "vec_id long, known boolean, cluster int, distance long")
    inertia = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    fitting = lambda d: d if d < 1 << 63 else None
    # one row for each centroid: the size of the broadcast is known
    about = spark.createDataFrame([(i, fitting(d), fitting(sum(inertia.values())), digests[i]) for i, d in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select(F.when(F.col("known"), F.col("vec_id")).alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
