"""Tables written part by part, so that a second run writes only what is missing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def unfinished(expected: DataFrame, path: str, parts: list[str]) -> DataFrame:
    """Parts, as values of ``parts``, that at ``path`` don't have as many rows as in
    ``expected``. Only the columns of ``parts``, which are folders there, are read."""
    want = expected.groupBy(*parts).agg(F.count("*").alias("_want"))
    there = stored(expected.sparkSession, path)
    if there is None:
        return want.select(*parts)
    have = there.groupBy(*parts).agg(F.count("*").alias("_have")).select(*[F.col(c).cast(want.schema[c].dataType).alias(c) for c in parts], "_have")
    return want.join(have, parts, "left").where(~F.col("_want").eqNullSafe(F.col("_have"))).select(*parts)


def write_missing(df: DataFrame, path: str, parts: list[str], *, expected: DataFrame | None = None, overwrite: bool = False) -> int:
    """Write those parts of ``df`` that are not whole at ``path`` yet, each to its own
    folder, and return their number. A part appears when the job that writes it has ended; one
    with too few or too many rows is written anew. ``expected`` has a row for each row
    of ``df``, where counting them is cheaper than making them."""
    todo = (df if expected is None else expected).select(*parts).distinct() if overwrite else unfinished(df if expected is None else expected, path, parts)
    n = todo.count()
    if n:
        mine = df.join(todo, parts, "left_semi")
        mine.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    return n
