"""Connected components by contraction.

Every round each node takes as its new name that one of its neighbours and itself
which comes first in the round's order; edges are renamed, loops and repeats drop
out. In every other round the order is by falling degree, so that a star goes at once;
in the others it is a fresh random one, in which a constant share of the nodes is
expected to go whatever the graph's shape, so that chains need no more than
logarithmically many rounds. Neighbours are only ever reduced to one of them, never
gathered; in the end each component takes its smallest node as its name.

A round writes two tables in the shared folder; the names of all nodes are followed
through the rounds' tables once, at the end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm._common import discard, written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for all nodes of the
    edges ``a``, ``b``."""
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    turns: list[DataFrame] = []
    while not edges.isEmpty():
        turn = len(turns)
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        degree = both.groupBy(F.col("a").alias("b")).agg(F.count("*").alias("degree"))
        rank = lambda c, d, turn=turn: F.struct((-d if turn % 2 == 0 else F.lit(0).cast("long")).alias("d"), F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("id"))
        if turn % 2 == 0:
            both = both.join(degree, "b")
        own = F.count("*") if turn % 2 == 0 else None
        of_b = rank("b", F.col("degree")) if turn % 2 == 0 else rank("b", None)
        first = both.groupBy(F.col("a").alias("node")).agg(F.min(of_b).alias("m"), *([own.alias("degree")] if turn % 2 == 0 else []))
        of_node = rank("node", F.col("degree")) if turn % 2 == 0 else rank("node", None)
        chosen = written(first.select("node", F.least("m", of_node)["id"].alias("name")))
        turns.append(chosen)
        of = lambda c, chosen=chosen: chosen.select(F.col("node").alias(c), F.col("name").alias(f"{c}2"))
        renamed = edges.join(of("a"), "a").join(of("b"), "b").where("a2 <> b2")
        before, edges = edges, written(renamed.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct())
        discard(before)
    if not turns:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    names = turns[0].select("node", F.col("name").alias("component"))
    for chosen in turns[1:]:
        step = chosen.select(F.col("node").alias("component"), "name")
        names = names.join(step, "component", "left").select("node", F.coalesce("name", "component").alias("component"))
    names = written(names)
    discard(*turns)
    smallest = names.groupBy("component").agg(F.min("node").alias("smallest"))
    return names.join(smallest, "component").select("node", F.col("smallest").alias("component"))
