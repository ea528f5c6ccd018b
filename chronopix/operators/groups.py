"""Whole groups of rows inside tasks that hold many of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from chronopix.session import ship_code

#: Rows that are handed to a function, or to Spark, at once, beyond a single group.
ROWS = 1 << 14


def changes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Places of rows whose keys aren't those of the row before; nulls are alike."""
    out = np.zeros(max(0, batch.num_rows - 1), bool)
    for k in keys:
        a, b = batch.column(k)[1:], batch.column(k)[:-1]
        out |= pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(a.is_null(), b.is_null())).to_numpy(zero_copy_only=False)
    return np.flatnonzero(out) + 1


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows that come in the order of ``keys`` as batches of whole groups, with the places at
    which each group begins and the last one ends."""

    def united() -> tuple[pa.RecordBatch, np.ndarray]:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        return whole, np.concatenate([[0], changes(whole, keys), [whole.num_rows]])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows and rows >= ROWS:
            both = pa.Table.from_batches([held[-1][-1:], batch.select(batch.schema.names)]).combine_chunks().to_batches()[0]
            # up to where a new group begins, if it does in this batch
            if (at := changes(both, keys)).size:
                held.append(batch[: at[0] - 1])
                held = [h for h in held if h.num_rows]
                yield united()
                held, rows, batch = [], 0, batch[at[0] - 1 :]
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
    if held:
        yield united()


def map_groups(df: DataFrame, keys: list[str], order: list[str], function: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """``function`` of batches of whole groups, each group in ``order``, with their bounds. One call
    serves many small groups; a group is in one task."""
    ship_code(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in whole_groups(batches, keys):
            yield function(batch, bounds)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)
