"""Aggregates that turn many rows of a fast clock into one of a slow clock."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def mean(v: Column, order: Column) -> Column:
    return F.avg(v.cast("double"))


def std(v: Column, order: Column) -> Column:
    """Of the whole group, not of a sample."""
    return F.stddev_pop(v.cast("double"))


def minimum(v: Column, order: Column) -> Column:
    return F.min(v)


def maximum(v: Column, order: Column) -> Column:
    return F.max(v)


def any_of(v: Column, order: Column) -> Column:
    return F.bool_or(v.cast("boolean"))


def all_of(v: Column, order: Column) -> Column:
    return F.bool_and(v.cast("boolean"))


def share_above(threshold: float) -> Callable[[Column, Column], Column]:
    return lambda v, order: F.avg(v.cast("double")) > threshold


def first(v: Column, order: Column) -> Column:
    return F.min_by(v, order)


def last(v: Column, order: Column) -> Column:
    return F.max_by(v, order)


def first_and_last(v: Column, order: Column) -> Column:
    """The first text, and the last one behind it where it differs."""
    a, b = F.min_by(v, order), F.max_by(v, order)
    return F.when(a == b, a).otherwise(F.concat(a, b))


#: By name, for column maps such as {"velocity": "mean", "walking": "all"}.
REDUCERS: dict[str, Callable[[Column, Column], Column]] = {
    "mean": mean, "std": std, "min": minimum, "max": maximum, "any": any_of, "all": all_of, "bin50": share_above(0.5), "bin75": share_above(0.75), "bin90": share_above(0.9),
    "first": first, "last": last, "first_last": first_and_last, "mode": lambda v, order: F.mode(v, True),
}
