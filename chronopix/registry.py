"""All registered queries by name, with the SQL that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "align_clocks"


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its own name."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def load() -> None:
    """Import all modules that register queries."""
    from chronopix.plans import analysis, behaviour, files, filters, recorded, recordings, stacks, tables  # noqa: F401
