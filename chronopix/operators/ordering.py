"""Orders, picks, unions and worklists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRIAL = "trial_id"


def numbered(df: DataFrame, keys: list[str], order: list[str], by: Column, buckets: int = 64) -> DataFrame:
    """Places from 1 within ``keys``, by ``order``. Rows are dealt to buckets of ``by``, a
    number that never falls along the order, and are ranked within their bucket after
    the rows of earlier ones, so a key of any size is ranked by many tasks. Only the
    buckets' bounds come to the driver."""
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    bounds = sorted(set(df.agg(F.percentile_approx(by, shares, 10_000)).first()[0] or []))
    placed = df.withColumn("_bucket", F.size(F.filter(F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<double>"), lambda c: c <= by)))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    earlier = placed.groupBy(*keys, "_bucket").agg(F.count("*").alias("n")).select(*keys, "_bucket", before.alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    return placed.join(earlier, [*keys, "_bucket"]).withColumn("place", (F.col("_before") + rank).cast("long")).drop("_bucket", "_before")


def argmax_first(df: DataFrame, value: str) -> DataFrame:
    """First frame of each trial's greatest and of its least value."""
    return df.groupBy(TRIAL).agg(F.min_by("frame", F.struct((-F.col(value)).alias("v"), "frame")).alias("argmax"), F.min_by("frame", F.struct(F.col(value).alias("v"), "frame")).alias("argmin"))


def halves(df: DataFrame) -> DataFrame:
    """0 for a trial's first half, which takes the odd row, 1 for its second."""
    n = F.count("*").over(Window.partitionBy(TRIAL))
    return df.withColumn("half", F.when(F.col("frame") < F.ceil(n / 2), 0).otherwise(1))


def split_parts(df: DataFrame, k: int) -> DataFrame:
    return df.withColumn("part", F.ntile(k).over(Window.partitionBy(TRIAL).orderBy("frame")) - 1)


def weighted_sample(df: DataFrame, weight: str, n: int, seed: int) -> DataFrame:
    """``n`` rows without replacement, in proportion to their weights: the least
    exponential waiting times, so one top-n pass is enough."""
    return df.where(F.col(weight) > 0).orderBy(-F.log(F.rand(seed)) / F.col(weight)).limit(n)


def shuffled(df: DataFrame, column: str, seed: int) -> DataFrame:
    """The column's values permuted within each trial."""
    w = Window.partitionBy(TRIAL)
    old = df.withColumn("_i", F.row_number().over(w.orderBy("frame")))
    new = df.select(TRIAL, F.col(column).alias(f"{column}_shuffled"), F.row_number().over(w.orderBy(F.xxhash64("frame", F.lit(seed)))).alias("_i"))
    return old.join(new, [TRIAL, "_i"]).drop("_i")


def still_to_do(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(done, keys, "left_anti")


def picked_by_prefix(df: DataFrame, column: str, prefixes: DataFrame) -> DataFrame:
    """The one name that each prefix begins; prefixes of several names give none. Names are
    cut to each length that prefixes have, so the join is one of equal strings."""
    lengths = sorted(r[0] for r in prefixes.select(F.length("prefix")).distinct().collect())
    cut = F.explode(F.array(*[F.substring(column, 1, n) for n in lengths])) if lengths else F.lit("")
    found = df.withColumn("prefix", cut).join(prefixes.distinct(), "prefix").dropDuplicates(["prefix", column]) if lengths else df.withColumn("prefix", cut).where("false")
    alone = found.groupBy("prefix").agg(F.count("*").alias("_n")).where("_n = 1")
    return found.join(alone.select("prefix"), "prefix", "left_semi")


def parsed_worklist(lines: DataFrame) -> DataFrame:
    """dir || trials || tasks || arguments; # begins a comment; a task behind ! is forced."""
    text = lines.select(F.trim(F.split("value", "#")[0]).alias("line")).where("line <> ''")
    parts = text.select(F.transform(F.split("line", r"\|\|"), lambda p: F.trim(p)).alias("p"))
    rows = parts.select(F.col("p")[0].alias("dir"), F.col("p")[1].alias("trials"), F.explode(F.split(F.col("p")[2], ",")).alias("task"), F.coalesce(F.get("p", F.lit(3)), F.lit("")).alias("arguments"))
    task = F.trim("task")
    return rows.select("dir", "trials", F.regexp_replace(task, "^!", "").alias("task"), task.startswith("!").alias("forced"), "arguments")


def ready_tasks(todo: DataFrame, needs: DataFrame, done: DataFrame) -> DataFrame:
    """Tasks all of whose predecessors are done."""
    missing = todo.join(needs, "task").join(done.select(F.col("task").alias("before"), "dir"), ["dir", "before"], "left_anti")
    return todo.join(missing.select("dir", "task").distinct(), ["dir", "task"], "left_anti")


def ready_any_or_all(todo: DataFrame, needs: DataFrame, done: DataFrame) -> DataFrame:
    """Tasks of a directory whose earlier steps are done there: all of them or, where a
    task's needs are marked ``any_of``, at least one."""
    held = todo.join(needs, "task").join(done.withColumn("_done", F.lit(True)), ["dir", "before"], "left")
    met = F.coalesce("_done", F.lit(False))
    ready = F.when(F.bool_or("any_of"), F.bool_or(met)).otherwise(F.bool_and(met))
    return held.groupBy("dir", "task").agg(ready.alias("_ready")).where("_ready").drop("_ready")
