"""Joins between clocks: as-of alignment, interval painting, peri-event windows."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from chronopix.functions.reducers import REDUCERS
from chronopix.operators import groups
from chronopix.session import ship_code

TRIAL = "trial_id"


def asof_index(fast: DataFrame, slow: DataFrame) -> DataFrame:
    """For each fast row the index ``slow_index`` of the last slow row at or before its
    time; null before the first. One sorted pass over the union of both clocks, so no
    pair of rows is ever compared."""
    index = (F.row_number().over(Window.partitionBy(TRIAL).orderBy("t")) - 1).cast("long")
    marks = slow.select(TRIAL, "t", index.alias("slow_index"))
    both = fast.withColumn("_fast", F.lit(1)).unionByName(marks.withColumn("_fast", F.lit(0)), allowMissingColumns=True)
    seen = Window.partitionBy(TRIAL).orderBy("t", "_fast").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("slow_index", F.last("slow_index", ignorenulls=True).over(seen)).where("_fast = 1").drop("_fast")


def reduce_groups(df: DataFrame, reducers: dict[str, str], keys: tuple[str, ...] = (TRIAL, "slow_index"), order: str = "frame") -> DataFrame:
    """One row for each group, each column by its named reducer; rows without a group
    drop out."""
    present = df.where(F.col(keys[-1]).isNotNull())
    return present.groupBy(*keys).agg(*[REDUCERS[how](F.col(c), F.col(order)).alias(c) for c, how in reducers.items()])


def mapped_groups(slow: DataFrame, fast: DataFrame, columns: dict[str, tuple[str, str]], keys: tuple[str, ...] = (TRIAL, "slow_index")) -> DataFrame:
    """Every row of ``slow`` with columns of ``fast`` reduced to it, by a map from a column's
    name to its name there and its reducer. Columns that ``fast`` lacks are skipped; a row
    without fast ones gets 0, false or an empty text."""
    known = {c: to for c, to in columns.items() if c in fast.columns}
    renamed = fast.select(*keys, "frame", *[F.col(c).alias(name) for c, (name, _) in known.items()])
    reduced = reduce_groups(renamed, dict(known.values()), keys)
    empty = lambda kind: F.lit("") if kind == "string" else F.lit(False) if kind == "boolean" else F.lit(0)
    kinds = dict(reduced.dtypes)
    return slow.join(reduced, list(keys), "left").select(*slow.columns, *[F.coalesce(F.col(n), empty(kinds[n]).cast(kinds[n])).alias(n) for n, _ in known.values()])


@dataclass
class Reducer:
    """A function of a user's own over a column's values in a group, a pandas Series in
    any order and without nulls, and the type of what it returns. ``whole`` takes all values of a
    group at once. Where groups can be large, give ``partial`` instead, which makes a list
    of numbers of some of the values, and ``finish``, which takes the sums of these lists over
    the group; another ``merge`` than adding takes two such lists."""

    kind: str
    whole: Callable[[pd.Series], object] | None = None
    partial: Callable[[pd.Series], list[float]] | None = None
    finish: Callable[[list[float]], object] | None = None
    merge: Callable[[list[float], list[float]], list[float]] = lambda a, b: [x + y for x, y in zip(a, b, strict=True)]


def reduce_by(df: DataFrame, reducers: dict[str, Reducer], keys: tuple[str, ...] = (TRIAL, "slow_index")) -> DataFrame:
    """One row for each group, each column by its user's reducer; rows without a group drop
    out, and groups without a value are null. Partial reducers see a group's values batch
    by batch before the shuffle, and only their lists move. One call of Python serves many groups."""
    ship_code(df.sparkSession)
    present = df.where(F.col(keys[-1]).isNotNull())
    kinds = dict(df.dtypes)
    named = lambda own, kind=None: ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], *[f"`{c}` {kind or r.kind}" for c, r in own.items()]])
    types = {c: to_arrow_type(DataType.fromDDL(r.kind)) for c, r in reducers.items()}

    def applied(rows: pa.RecordBatch, bounds: np.ndarray, functions: dict[str, tuple[Callable, pa.DataType]], nan_too: bool = False) -> pa.RecordBatch:
        """Functions of a column's values in each group that aren't null, or not a number either."""
        columns = [rows.column(k).take(pa.array(bounds[:-1])) for k in keys]
        for c, (function, kind) in functions.items():
            values, there = rows.column(c).to_pandas(), rows.column(c).is_valid().to_numpy(zero_copy_only=False)
            if nan_too:
                there &= values.notna().to_numpy()
            out = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                v = values.iloc[a:b] if there[a:b].all() else values.iloc[a:b][there[a:b]]
                out.append(function(v) if len(v) else None)
            columns.append(pa.array(out, kind))
        return pa.RecordBatch.from_arrays(columns, [*keys, *functions])

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = batch.sort_by([(k, "ascending") for k in keys])
                yield applied(rows, np.concatenate([[0], groups.changes(rows, list(keys)), [rows.num_rows]]), {c: (r.partial, pa.list_(pa.float64())) for c, r in parts.items()}, nan_too=True)

    whole, parts = ({c: r for c, r in reducers.items() if bool(r.partial) == partial} for partial in (False, True))
    out = []
    if whole:
        own = {c: (r.whole, types[c]) for c, r in whole.items()}
        out.append(groups.map_groups(present.select(*keys, *whole), list(keys), [], lambda rows, bounds: applied(rows, bounds, own), named(whole)))
    if parts:
        united = {c: (lambda lists, r=r: r.finish(reduce(r.merge, map(list, lists))), types[c]) for c, r in parts.items()}
        lists = present.select(*keys, *parts).mapInArrow(shrink, named(parts, "array<double>"))
        out.append(groups.map_groups(lists, list(keys), [], lambda rows, bounds: applied(rows, bounds, united), named(parts)))
    if len(out) == 1:
        return out[0].select(*keys, *reducers)
    renamed = out[1].withColumnsRenamed({k: f"_{i}" for i, k in enumerate(keys)})
    both = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)])
    return out[0].join(renamed, both).select(*keys, *reducers)


def most_frequent(df: DataFrame, column: str, threshold: float, default, keys: tuple[str, ...] = (TRIAL, "slow_index")) -> DataFrame:
    """The most frequent value of each group, the smallest on ties; ``default`` where it
    makes up less than ``threshold`` of the group."""
    counts = df.where(F.col(keys[-1]).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("_n"))
    top = counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v"))).alias("_top"), F.sum("_n").alias("_all"))
    return top.select(*keys, F.when(-F.col("_top.n") < threshold * F.col("_all"), F.lit(default)).otherwise(F.col("_top.v")).alias(column))


def zip_join(left: DataFrame, right: DataFrame, tolerance: int = 0, at: str = "frame") -> DataFrame:
    """Rows of equal position; trials whose lengths differ by more than ``tolerance``
    are an error."""
    n = left.groupBy(TRIAL).agg(F.count("*").alias("_l")).join(right.groupBy(TRIAL).agg(F.count("*").alias("_r")), TRIAL)
    fits = n.select(TRIAL, F.assert_true(F.abs(F.col("_l") - F.col("_r")) <= tolerance, "lengths differ by more than the tolerance").alias("_ok"))
    return left.join(right, [TRIAL, at]).join(fits, TRIAL).where(F.col("_ok").isNull()).drop("_ok")


def pad_join(index: DataFrame, values: DataFrame, pad: int) -> DataFrame:
    """Values that lack ``pad`` frames at either end, on the full index (null there)."""
    return index.join(values.withColumn("frame", F.col("frame") + pad), [TRIAL, "frame"], "left")


def paint_intervals(frames: DataFrame, stims: DataFrame, columns: list[str]) -> DataFrame:
    """Each frame with the columns of the interval [start_frame, stop_frame) it is in;
    of overlapping ones that of the latest start. Intervals are met as marks on the
    frame clock: the latest start seen so far, while its end is not reached."""
    marks = stims.groupBy(TRIAL, F.col("start_frame").alias("frame")).agg(F.max(F.struct("stop_frame", *columns)).alias("_stim"))
    seen = Window.partitionBy(TRIAL).orderBy("frame").rowsBetween(Window.unboundedPreceding, 0)
    on = frames.join(marks, [TRIAL, "frame"], "left").withColumn("_stim", F.last("_stim", ignorenulls=True).over(seen))
    inside = F.coalesce(F.col("frame") < F.col("_stim.stop_frame"), F.lit(False))
    return on.withColumn("in_stim", inside).withColumns({f"stim_{c}": F.when(inside, F.col(f"_stim.{c}")) for c in columns}).drop("_stim")


def central_level(frames: DataFrame, stims: DataFrame, level: Column, fraction: float) -> DataFrame:
    """The most frequent level in each interval's centred ``fraction``."""
    size = F.col("stop_frame") - F.col("start_frame")
    cut = F.floor(size * (1 - fraction) / 2)
    wanted = stims.select(TRIAL, "start_frame", "stop_frame", F.explode(F.sequence(F.col("start_frame") + cut, F.greatest(F.col("stop_frame") - cut - 1, F.col("start_frame") + cut))).alias("frame"))
    return wanted.join(frames.withColumn("level", level), [TRIAL, "frame"]).groupBy(TRIAL, "start_frame", "stop_frame").agg(F.mode("level", True).alias("level"))


def peri_event(frames: DataFrame, events: DataFrame, before: float, after: float, rate: float, value: str) -> DataFrame:
    """The frames from ``before`` to ``after`` seconds around each event's start."""
    lo, hi = math.floor(before * rate), math.ceil(after * rate)
    wanted = events.select(TRIAL, "start_frame", *[c for c in events.columns if c == "condition"], F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi - 1).cast("long"))).alias("rel_frame"))
    wanted = wanted.withColumn("frame", F.col("start_frame") + F.col("rel_frame"))
    return wanted.join(frames.select(TRIAL, "frame", F.col(value).alias("value")), [TRIAL, "frame"]).withColumn("rel_t", F.col("rel_frame") / rate)


def whole_windows(aligned: DataFrame, size: int) -> DataFrame:
    """Only events whose window lies fully inside the recording."""
    n = F.count("*").over(Window.partitionBy(TRIAL, "start_frame"))
    return aligned.withColumn("_n", n).where(F.col("_n") == size).drop("_n")


def mean_and_error(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Mean, standard error and half-width of the 95% interval of each group."""
    sem = F.stddev_pop(value) / F.sqrt(F.count(value).cast("double"))
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), sem.alias("sem"), (sem * 1.959963984540054).alias("ci"), F.count(value).alias("n"))


def lag_join(df: DataFrame, x: str, y: str, lag: int) -> DataFrame:
    """x at each frame with y ``lag`` frames later, where there is one."""
    later = df.select(TRIAL, (F.col("frame") - lag).alias("frame"), F.col(y).alias("y"))
    return df.select(TRIAL, "frame", F.col(x).alias("x")).join(later, [TRIAL, "frame"])


def paired_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each row beside the one after it in its trial."""
    w = Window.partitionBy(TRIAL).orderBy("frame")
    return df.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns}).where(F.col(f"next_{columns[0]}").isNotNull())
