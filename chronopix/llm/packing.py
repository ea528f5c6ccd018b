"""Bounded-space best-fit packing of tokenised documents into fixed sequences.

Each task tokenises its documents, cuts longer ones into pieces, and packs the
pieces while at most ``open_bins`` sequences are open. The open sequences are
found through a bitset keyed by free space: a piece goes where it leaves the least
space; if a new sequence would exceed the bound, the fullest open one closes
first. Each piece is placed as it comes. No shuffle is needed: only the sequences open
at the end of a task stay partly filled. A sequence's id holds the task's partition
number, so a task that is run again gives the same ids.

Defined cases: a null text counts as empty and still has its end token; a document
of exactly ``capacity`` tokens is one piece; texts of any length are taken whole; of
sequences with equal free space the one that reached it last is taken; repeated rows
are packed as separate documents; null ids stay null; an empty table gives no rows;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm._common import documents, small_batches, written
from chronopix.llm.bpe import default_vocabulary, load
from chronopix.session import ship_code


class BestFit:
    """Open bins in a bitset keyed by free space."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.most = capacity, open_bins
        self.bits, self.at = 0, [[] for _ in range(capacity + 1)]
        self.open = self.made = 0

    def _take(self, free: int) -> tuple[int, int]:
        sequence = self.at[free].pop()
        if not self.at[free]:
            self.bits ^= 1 << free
        self.open -= 1
        return sequence, self.capacity - free

    def put(self, length: int) -> tuple[int, int, list[int]]:
        """The sequence and the offset for a piece, and the sequences that close by it."""
        fits = self.bits >> length
        if fits:
            sequence, offset = self._take(length + (fits & -fits).bit_length() - 1)
        else:
            sequence, offset = self.made, 0
            self.made += 1
        free = self.capacity - offset - length
        if not free:
            return sequence, offset, [sequence]
        closed = [self._take((self.bits & -self.bits).bit_length() - 1)[0]] if self.open == self.most else []
        self.at[free].append(sequence)
        self.bits |= 1 << free
        self.open += 1
        return sequence, offset, closed


class Packer:
    """Pieces in their sequences: ``ready`` ones, whose sequence has closed, and others."""

    def __init__(self, capacity: int, open_bins: int, first: int):
        self.bins, self.first = BestFit(capacity, open_bins), first
        self.held: dict[int, list[tuple]] = {}
        self.ready: list[tuple] = []

    def add(self, piece: tuple, length: int) -> None:
        sequence, offset, closed = self.bins.put(length)
        self.held.setdefault(sequence, []).append((*piece, self.first + sequence, offset))
        for c in closed:
            self.ready += self.held.pop(c)

    def batch(self, names: list[str], kinds: list[pa.DataType], rest: bool = False) -> pa.RecordBatch:
        """The ready pieces, or those that are left; whether they are is the last column."""
        rows = [p for of in self.held.values() for p in of] if rest else self.ready
        columns = zip(*rows, strict=True) if rows else [[]] * (len(names) - 1)
        self.ready = []
        return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds, strict=False)), pa.array([not rest] * len(rows), pa.bool_())], names)


SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "done"]
KINDS = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
#: Full sequences' worth of pieces that a task of the second pass takes.
SEQUENCES = 20_000
#: What the sequences of each pass begin their ids with, beside the partition's number.
PASS = 1 << 60


def pack_documents(docs: DataFrame, path: str | None = None, *, capacity: int = 4096, end_id: int = 1, open_bins: int = 1024) -> DataFrame:
    """One row for each piece with its sequence and its offset there."""
    path = path or default_vocabulary()
    end = end_id.to_bytes(4, "little")
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, packer = load(path), Packer(capacity, open_bins, TaskContext.get().partitionId() << 36)
        for batch in (part for b in batches for part in small_batches(b)):
            for doc_id, words in zip(batch.column("doc_id").to_pylist(), bpe.encode_batch(batch.column("text").to_pylist()), strict=True):
                ids = b"".join(words) + end
                for k, start in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + capacity)]
                    packer.add((doc_id, k, start, len(part) // 4, zlib.crc32(part)), len(part) // 4)
            yield packer.batch(NAMES, KINDS)
        yield packer.batch(NAMES, KINDS, rest=True)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, open_bins, PASS + (TaskContext.get().partitionId() << 36))
        for b in batches:
            for piece in zip(*(b.column(c).to_pylist() for c in NAMES[:5]), strict=True):
                packer.add(piece, piece[3])
            yield packer.batch(NAMES, KINDS)
        yield packer.batch(NAMES, KINDS, rest=True)

    packed = written(documents(docs).mapInArrow(run, f"{SCHEMA}, done boolean"))
    left = packed.where(~F.col("done"))
    tokens = left.agg(F.sum("length").alias("n")).first()["n"] or 0
    parts = max(1, tokens // (capacity * SEQUENCES))
    longest = left.repartition(parts).sortWithinPartitions(F.col("length").desc(), "doc_id", "piece", "ids_crc32")
    names = NAMES[:-1]
    return packed.where("done").select(*names).unionByName(longest.mapInArrow(again, f"{SCHEMA}, done boolean").select(*names))
