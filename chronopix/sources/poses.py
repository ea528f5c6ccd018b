"""Poses of many trials: nested maps of angles and joints as one wide row for each frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: markers of the abdomen, in the order of their columns
ABDOMEN = ["RStripe1", "RStripe2", "RStripe3", "LStripe1", "LStripe2", "LStripe3"]
AXES = ["x", "y", "z"]
HEAD = "Head"
DDL = "trial string, angles map<string,map<string,array<double>>>, joints map<string,map<string,struct<raw_pos_aligned:array<array<double>>>>>, points3d array<array<array<double>>>"


def read_poses(spark: SparkSession, path: str) -> DataFrame:
    """Documents of trials, one a line: trial, angles[leg][angle], joints[leg][joint] and,
    where a trial has them, points3d[frame][point]."""
    return spark.read.schema(DDL).json(path)


def names_of(docs: DataFrame) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """Pairs of leg and angle, and of leg and joint, that any trial has, in order. The head
    has joints only."""
    pairs = lambda c: docs.select(F.explode(c).alias("leg", "of")).select("leg", F.explode(F.map_keys("of")).alias("name")).distinct()
    both = pairs("angles").withColumn("kind", F.lit(0)).union(pairs("joints").withColumn("kind", F.lit(1))).collect()
    of = lambda kind: sorted((r["leg"], r["name"]) for r in both if r["kind"] == kind)
    return [p for p in of(0) if p[0] != HEAD], of(1)


def flat_poses(docs: DataFrame, *, abdomen: dict[str, int] | None = None, names: tuple[list[tuple[str, str]], list[tuple[str, str]]] | None = None) -> DataFrame:
    """trial, frame and a column for each angle (angle_<leg>_<angle>), each joint and axis
    (joint_<leg>_<joint>_<axis>) and, with ``abdomen`` (a marker's place among the points),
    each of its markers. What a trial lacks is null; ``names`` spares a pass that looks for
    them. A document's arrays are zipped before they become rows, so a row has one frame
    only."""
    angles, joints = names or names_of(docs)
    inner = lambda c, leg, name: F.element_at(F.element_at(c, F.lit(leg)), F.lit(name))
    columns: dict[str, Column] = {f"angle_{leg}_{angle}": inner("angles", leg, angle) for leg, angle in angles}
    at = lambda i: lambda p: F.get(p, F.lit(i))
    for leg, joint in joints:
        where = inner("joints", leg, joint)["raw_pos_aligned"]
        columns |= {f"joint_{leg}_{joint}_{axis}": F.transform(where, at(i)) for i, axis in enumerate(AXES)}
    for marker, place in (abdomen or {}).items():
        one = F.transform("points3d", at(place))
        columns |= {f"joint_Abd_{marker}_{axis}": F.transform(one, at(i)) for i, axis in enumerate(AXES)}
    n = F.greatest(*[F.coalesce(F.size(v), F.lit(0)) for v in columns.values()], F.lit(0))
    arrays = [F.coalesce(v, F.array().cast("array<double>")).alias(c) for c, v in columns.items()]
    sized = docs.select("trial", F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: i.cast("long"))).otherwise(F.array().cast("array<long>")).alias("frame"), *arrays)
    return sized.select("trial", F.inline(F.arrays_zip("frame", *columns)))
