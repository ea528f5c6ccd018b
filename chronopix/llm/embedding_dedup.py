"""Near-duplicate embeddings through an inverted multi-index.

Two codebooks, learned independently on the halves of unit vectors from a bounded
sample, form a product grid of cells; every vector is listed in its own cell. A
partner at cosine ``least`` is at most r = sqrt(2 - 2*least) away, and its halves lie
at distances whose squares add up to at most r*r. For one half, a vector that lies
in centroid i's region is at least (|q - c_i|^2 - |q - c_k|^2) / (2 |c_i - c_k|)
away, for every other centroid k. So each query visits the cells in order of the sum
of its two squared bounds, by the multi-sequence algorithm over both sorted lists,
and stops when that sum is above r*r: no partner is missed (recall 1). Vectors met
are verified in double precision, block against block.

Equal vectors of a label are joined into one with a count before that. Cells stand
on shelves of about BLOCK vectors, so a query's vector travels once to each shelf
that holds any cell it visits, and a crowded cell takes several shelves. A shelf meets
its queries in blocks; pairs inside them are counted and never listed. Each block pair
is reduced to its own components, and one edge for each vector that has a partner there,
on either side, goes on to the components of the whole table: no link is lost.

Defined cases: null labels and ids, null, empty or zero vectors and vectors with
null or non-finite parts link with nothing; vectors of different lengths link with
nothing; a null id has a null component; each row has a row in the result, also where
ids repeat: a usable vector that repeats an id counts as another vector, and all with
that id are in one component; of several components' names the smallest counts; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronopix.llm._common import discard, materialise, written
from chronopix.llm.components import components
from chronopix.session import ship_code

#: Vectors in one side of a block pair.
BLOCK = 1024
#: Centroids of each half's codebook for a table of so many vectors per label and cell.
PER_CELL = 16
#: Bytes of a table that a join may broadcast. Spark sizes a table by its files, so too low after
#: an explode or where they are packed well; here each join is told by the rows that there can be.
SENT = 8 << 20
#: Most centroids of a half; a vector's bounds take time with their square. With more
#: vectors than fill such a grid, cells are fuller and take more shelves.
MOST_CENTROIDS = 1024


@dataclass
class Half:
    centroids: np.ndarray

    def __post_init__(self):
        d = self.centroids[:, None] - self.centroids[None]
        self.apart = np.sqrt((d**2).sum(-1)) + 1e-300

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's own centroid, and for all centroids the square of the least
        distance from it to their regions."""
        d = (x**2).sum(1)[:, None] - 2 * x @ self.centroids.T + (self.centroids**2).sum(1)[None]
        own = d.argmin(1)
        out = np.empty_like(d)
        for i in range(d.shape[1]):
            gap = (d[:, i, None] - d) / (2 * self.apart[i])
            gap[:, i] = 0.0
            out[:, i] = np.maximum(gap.max(1) - 1e-9, 0.0) ** 2
        return own, out


def learn_half(sample: np.ndarray, k: int, seed: int, rounds: int = 12) -> Half:
    """k-means on a bounded sample."""
    rng = np.random.default_rng(seed)
    c = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        d = -2 * sample @ c.T + (c**2).sum(1)[None]
        own = d.argmin(1)
        for i in range(len(c)):
            if (own == i).any():
                c[i] = sample[own == i].mean(0)
    return Half(np.unique(c, axis=0))


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one, without overflow."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def multi_sequence(first: np.ndarray, second: np.ndarray, limit: float) -> list[tuple[int, int]]:
    """Cells in order of first[i] + second[j] until the sum is above ``limit``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen, cells = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}, []
    while heap:
        cost, i, j = heapq.heappop(heap)
        if cost > limit:
            break
        cells.append((int(a[i]), int(b[j])))
        for n in ((i + 1, j), (i, j + 1)):
            if n[0] < len(a) and n[1] < len(b) and n not in seen:
                seen.add(n)
                heapq.heappush(heap, (first[a[n[0]]] + second[b[n[1]]], *n))
    return cells


def local_roots(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all vectors on both sides of a block pair that have a partner there, and
    with each the id of the root of its component inside the pair."""
    rows, columns, nodes, roots = near.any(1), near.any(0), [], []
    for start in np.flatnonzero(rows):
        edge = np.array([start]) if rows[start] else np.zeros(0, int)
        while len(edge):
            rows[edge] = False
            met = np.flatnonzero(near[edge].any(0) & columns)
            columns[met] = False
            nodes += [left[edge], right[met]]
            roots.append(np.full(len(edge) + len(met), left[start]))
            edge = np.flatnonzero(near[:, met].any(1) & rows)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *nodes]), np.concatenate([none, *roots])


def sized(table: DataFrame, rows: int, width: int) -> DataFrame:
    """A side of a join, to be broadcast if ``rows`` of ``width`` bytes are few, and never if not."""
    return table.hint("broadcast" if rows * width <= SENT else "merge")


def first_by_hash(rows: DataFrame, count: int, size: int) -> DataFrame:
    """The ``size`` rows with the smallest hashes ``h``, of ``count``. The driver merges what each
    task finds, so that rows which can't be among them are dropped before: hashes are even, and
    half as many again are let through."""
    if count > 2 * size:
        rows = rows.where(F.col("h") < int(1.5 * size / count * 2**64) - (1 << 63))
    return rows.orderBy("h", "first").limit(size)


def is_usable() -> Column:
    """Whether a row's vector can link with any other."""
    e = F.col("embedding")
    finite = F.forall(e, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.coalesce(F.isnan(x), F.lit(True)))
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(e) > 0) & finite & F.exists(e, lambda x: x != 0), F.lit(False))


def link_vectors(vectors: DataFrame, *, least: float = 0.98, sample_size: int = 20_000, seed: int = 3) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row. The codebooks are learned on
    at most ``sample_size`` vectors (the documented bound); every vector is indexed."""
    spark = vectors.sparkSession
    ship_code(spark)
    table = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label"))
    rows = table.where(is_usable()).select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("x")).withColumn("h", F.xxhash64("label", "x"))
    same = materialise(rows.groupBy("label", "h", "x").agg(F.min("vec_id").alias("first"), F.count("*").alias("many")))
    dims = [r[0] for r in same.select(F.size("x")).distinct().collect()]
    limit = 2 - 2 * least + 1e-9
    sums, edges = None, None
    for dim in sorted(dims):
        one = same.where(F.size("x") == dim)
        count, letters = one.agg(F.count("*"), F.max(F.octet_length("label"))).first()
        sample = first_by_hash(one.select("h", "first", "x"), count, sample_size).select("x").toPandas()["x"]
        unit = unit_rows(np.array(sample.tolist(), float))
        labels = max(1, one.select("label").distinct().count())
        k = int(np.clip(round((count / labels / PER_CELL) ** 0.5), 4, MOST_CENTROIDS))
        cut = max(1, dim // 2)
        halves = (learn_half(unit[:, :cut], k, seed), learn_half(unit[:, cut:] if cut < dim else np.zeros((len(unit), 1)), k, seed + 1))
        kind = "<f4" if "array<float>" in dict(vectors.dtypes)["embedding"] else "<f8"
        shared = spark.sparkContext.broadcast((halves, cut, dim))

        def place(batches: Iterator[pd.DataFrame], shared=shared, kind=kind) -> Iterator[pd.DataFrame]:
            halves, cut, dim = shared.value
            for batch in batches:
                for at in range(0, len(batch), 1024):
                    part = batch.iloc[at : at + 1024]
                    raw = np.array(part["x"].tolist(), float)
                    x = unit_rows(raw)
                    second = x[:, cut:] if cut < dim else np.zeros((len(x), 1))
                    (own1, b1), (own2, b2) = halves[0].bounds(x[:, :cut]), halves[1].bounds(second)
                    width = b2.shape[1]
                    cells = [[i * width + j for i, j in multi_sequence(p, q, limit)] for p, q in zip(b1, b2, strict=True)]
                    yield pd.DataFrame({"label": part["label"], "first": part["first"], "many": part["many"], "raw": [v.astype(kind).tobytes() for v in raw], "own": own1 * width + own2, "cells": cells})

        placed = written(one.select("label", "first", "many", "x").mapInPandas(place, "label string, first long, many long, raw binary, own int, cells array<int>"))
        # cells, in their order in the grid, are put on shelves of about BLOCK vectors; a crowded cell takes several
        sizes = placed.groupBy("label", F.col("own").alias("cell")).agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("label").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
        shelves = written(sizes.withColumn("upto", upto).select("label", "cell", F.floor((F.col("upto") - F.col("n")) / BLOCK).alias("lo"), F.floor((F.col("upto") - 1) / BLOCK).alias("hi")))
        by_cell = sized(shelves, min(count, labels * k * k), 64 + letters)
        deal = lambda salt, n: F.pmod(F.xxhash64("first", F.lit(salt)), n)
        member = placed.select("label", F.col("own").alias("cell"), "first", "many", "raw").join(by_cell, ["label", "cell"]).withColumn("shelf", F.col("lo") + deal(0, F.col("hi") - F.col("lo") + 1))
        # a query goes once to each shelf that holds any of its cells; only ids are expanded
        visits = written(placed.select("label", "first", F.explode("cells").alias("cell")).join(by_cell, ["label", "cell"]).select("label", "first", F.explode(F.sequence("lo", "hi")).alias("shelf")).distinct())
        turns = sized(visits.groupBy("label", "shelf").agg(F.ceil(F.count("*") / BLOCK).alias("turns")), labels + count // BLOCK, 64 + letters)
        query = visits.join(placed.select("label", "first", "raw").hint("merge"), ["label", "first"]).join(turns, ["label", "shelf"]).withColumn("turn", deal(1, F.col("turns")))
        member = member.join(turns, ["label", "shelf"]).withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)))
        keys = ["label", "shelf", "turn"]

        def compare(left: pa.Table, right: pa.Table) -> pa.Table:
            names = ["first", "links", "other"]
            if not left.num_rows or not right.num_rows:
                return pa.table([pa.array([], pa.int64())] * 3, names)
            q, m = (unit_rows(np.frombuffer(b"".join(t.column(c).to_pylist()), kind).reshape(t.num_rows, -1).astype(float)) for t, c in ((left, "raw"), (right, "m_raw")))
            ids, other, many = left.column("first").to_numpy(), right.column("m_first").to_numpy(), right.column("m_many").to_numpy()
            near = (q @ m.T >= least) & (ids[:, None] != other[None])
            on = near.any(1)
            nodes, roots = local_roots(near, ids, other)
            # rows that count links are edges to themselves; rows that are edges count none
            first, links = np.concatenate([ids[on], nodes]), np.concatenate([(near[on] * many[None]).sum(1), np.zeros(len(nodes), np.int64)])
            return pa.table([pa.array(first), pa.array(links), pa.array(np.concatenate([ids[on], roots]))], names)

        # own names on the other side, as both come from the same table
        other_side = member.select(*[F.col(c).alias(f"m_{c}") for c in (*keys, "first", "many", "raw")])
        pairs = query.select(*keys, "first", "raw").groupBy(*keys).cogroup(other_side.groupBy(*[f"m_{c}" for c in keys])).applyInArrow(compare, "first long, links long, other long")
        pairs = written(pairs)
        discard(placed, shelves, visits)
        part_sums, part_edges = pairs.groupBy("first").agg(F.sum("links").alias("links")), pairs.select(F.col("first").alias("a"), F.col("other").alias("b"))
        sums, edges = (part_sums, part_edges) if sums is None else (sums.union(part_sums), edges.union(part_edges))
    if sums is None:
        return table.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    named = components(edges).withColumnRenamed("node", "first")
    # a set of equal vectors stands for all its members
    groups = same.join(sums.hint("merge"), "first", "left").join(named.hint("merge"), "first", "left").select(F.col("label").alias("g_label"), F.col("h").alias("g_h"), F.col("x").alias("g_x"), (F.col("many") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "first").alias("component_id"))
    got = rows.join(groups.hint("merge"), (F.col("label") == F.col("g_label")) & (F.col("h") == F.col("g_h")) & (F.col("x") == F.col("g_x"))).select("vec_id", "n_links", "component_id")
    rest = table.where(~is_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return got.union(rest).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
