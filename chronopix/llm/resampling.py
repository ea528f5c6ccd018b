"""Importance resampling of documents towards a target distribution.

Texts become rows of a sparse matrix, documents by hashed runs of one to three words,
which is written once as blocks of compressed sparse rows: ids, row starts, columns and
counts as packed arrays. Column sums over the blocks of the corpus and of the target give
two distributions, whose logarithmic ratio is each column's gain; the product of the
matrix with the gains is read from the same blocks and is each document's weight. A draw
without replacement in proportion to the weights takes the greatest sums of a weight and
a Gumbel noise made of the id.

Columns in a row rise, so a block holds their steps, as numbers of as few bytes as hold them,
like the counts; Parquet compresses both. A task holds one block of about BLOCK entries, or one document's columns,
whose number has a bound; long texts are cut at word ends while they are counted. Ranks come
from a range partition by score, of which only the partitions' sizes come to the driver.

Defined cases: null and empty texts have no features, a weight of 0, and are never drawn,
nor are other documents of fewer than ``least_words`` words; a null id has the noise of the
empty string and comes after all others of its score; rows that repeat an id count and are drawn
each for itself; ties go to the smaller id; texts of any length are counted whole; an empty
target gives each column the gain of a count of 0; other columns are not read; an empty
table gives no rows."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronopix.llm._common import discard, materialise, small_batches, written
from chronopix.session import ship_code

#: Bytes of a text as they count: capitals as small letters, what is in no word as a blank.
BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Entries of a block, beyond a single document, and bytes of text that are cut into words at once.
BLOCK, PIECE = 1 << 18, 1 << 20
#: Bytes of blocks that Parquet's reader holds at once.
ROW_GROUP = 4 << 20

BLOCKS = "ids binary, known binary, words binary, starts binary, steps binary, counts binary"


def pieces(text: str) -> Iterator[list[bytes]]:
    """Words of a text, some PIECE bytes at a time."""
    data = text.encode("utf-8", "surrogatepass").translate(BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def hashed(text: str, columns: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of words, and the columns that hold runs of one to three words with counts. A
    checksum is carried on from a run's first words to its next one, so no run is put
    together."""
    n, one, two, parts = 0, [], [], []
    total = None
    for words in pieces(text):
        if not words:
            continue
        n += len(words)
        spaced = [b" " + w for w in words]
        singles = list(map(crc32, words))
        before = one + singles[:-1]  # the word before each word but a text's first
        pairs = list(map(crc32, spaced[len(spaced) - len(before) :], before))
        earlier = two + pairs[:-1]
        triples = list(map(crc32, spaced[len(spaced) - len(earlier) :], earlier))
        one, two = singles[-1:], pairs[-1:]
        parts.append(np.array(singles + pairs + triples, np.int64) % columns)
        if sum(map(len, parts)) > 3 * PIECE:
            total = np.bincount(np.concatenate(parts), minlength=columns) + (0 if total is None else total)
            parts = []
    if total is None:
        at, counts = np.unique(np.concatenate(parts or [np.zeros(0, np.int64)]), return_counts=True)
        return n, at, counts
    total += np.bincount(np.concatenate(parts or [np.zeros(0, np.int64)]), minlength=columns)
    at = np.flatnonzero(total)
    return n, at, total[at]


class Block:
    """Rows of a sparse matrix: ids, numbers of words, and each row's columns and counts."""

    def __init__(self):
        self.ids, self.known, self.words, self.rows, self.counts, self.entries = [], [], [], [], [], 0

    def add(self, doc_id: int | None, n: int, at: np.ndarray, counts: np.ndarray) -> None:
        self.ids.append(doc_id or 0)
        self.known.append(doc_id is not None)
        self.words.append(n)
        self.rows.append(at)
        self.counts.append(counts)
        self.entries += len(at)

    def packed(self) -> pa.RecordBatch:
        starts = np.cumsum([0, *map(len, self.rows)]).astype("<i8")
        steps, counts = np.concatenate([np.diff(r, prepend=0) for r in self.rows]), np.concatenate(self.counts)
        values = [np.array(self.ids, "<i8"), np.array(self.known, bool), np.array(self.words, "<i8"), starts, narrow(steps), narrow(counts)]
        return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in values], [f.split()[0] for f in BLOCKS.split(", ")])


def narrow(a: np.ndarray) -> np.ndarray:
    """Numbers from 0 in as few bytes as hold the greatest."""
    return a.astype(next(k for k in ("<u1", "<u2", "<u4", "<i8") if not len(a) or a.max() <= np.iinfo(k).max))


def opened(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """ids, known, words, starts, columns and counts of each block."""
    for i in range(batch.num_rows):
        ids, known, words, starts, steps, counts = (np.frombuffer(c[i].as_buffer(), np.uint8) for c in batch.columns)
        starts = starts.view("<i8")
        wide = lambda a, n=int(starts[-1]): a.view({1: "<u1", 2: "<u2", 4: "<u4", 8: "<i8"}[len(a) // n]).astype(np.int64) if n else np.zeros(0, np.int64)
        # steps summed over the whole block, less what stood before each row
        upto = np.concatenate([[0], np.cumsum(wide(steps))])
        yield ids.view("<i8"), known.view(bool), words.view("<i8"), starts, upto[1:] - np.repeat(upto[starts[:-1]], np.diff(starts)), wide(counts)


def count_matrix(docs: DataFrame, doc_id: str, columns: int) -> DataFrame:
    """The written matrix of ``text``, as blocks."""
    ship_code(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            for b in small_batches(batch):
                for i, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                    block.add(i, *hashed(text.as_py() or "", columns))
                    if block.entries >= BLOCK or len(block.ids) >= BLOCK // 16:
                        yield block.packed()
                        block = Block()
        if block.ids:
            yield block.packed()

    return written(docs.select(F.col(doc_id).cast("long").alias("doc_id"), "text").mapInArrow(run, BLOCKS), **{"parquet.block.size": ROW_GROUP, "parquet.enable.dictionary": "false"})


def column_sums(matrix: DataFrame, columns: int) -> np.ndarray:
    """Sum of each column; as many numbers come to the driver as there are columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(columns, np.int64)
        for batch in batches:
            for *_, at, counts in opened(batch):
                total += np.bincount(at, counts, columns).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["at", "n"])

    out = np.zeros(columns, np.int64)
    for r in matrix.mapInArrow(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[r["at"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of how much likelier each column is in the target,
    with one count more for each column, rounded down."""
    s, t, more = float(corpus.sum()), float(target.sum()), float(len(corpus))
    one = lambda a, b: math.floor(1000 * math.log((b + 1) * (s + more) / ((a + 1) * (t + more))))
    return np.array([one(a, b) for a, b in zip(corpus.astype(float).tolist(), target.astype(float).tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """A thousand times a Gumbel number made of the id, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(matrix: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight, score: the matrix times the gains."""
    shared = matrix.sparkSession.sparkContext.broadcast(gain)  # as many numbers as columns
    names = ["doc_id", "n_words", "n_features", "weight", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, known, words, starts, at, counts in opened(batch):
                upto = lambda v, starts=starts: np.diff(np.concatenate([[0], np.cumsum(v)])[starts])
                weight = upto(counts * shared.value[at])
                own = [i if k else None for i, k in zip(ids.tolist(), known.tolist(), strict=True)]
                score = weight + np.array([noise(i, seed) for i in own], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(words), pa.array(upto(counts)), pa.array(weight), pa.array(score)], names)

    return matrix.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def ranked(df: DataFrame, order: list, n: int) -> DataFrame:
    """``rank`` from 1 along the order for the first ``n`` rows, null for the others. Rows
    are dealt by ranges and numbered inside each; only sizes of partitions are summed up."""
    inside = F.monotonically_increasing_id()
    placed = materialise(df.orderBy(*order).select("*", F.shiftright(inside, 33).alias("_part"), inside.bitwiseAND((1 << 33) - 1).alias("_at")))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    rank = F.col("_before") + F.col("_at") + 1
    # one row for each partition: the size of the broadcast is known
    return placed.join(F.broadcast(before), "_part").withColumn("rank", F.when(rank <= n, rank)).drop("_part", "_at", "_before")


def resample(docs: DataFrame, target: DataFrame, *, target_id: str = "item_id", columns: int = 10_000, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every document."""
    matrix, aim = count_matrix(docs, "doc_id", columns), count_matrix(target, target_id, columns)
    gain = gains(column_sums(matrix, columns), column_sums(aim, columns))
    discard(aim)
    scored = written(weighted(matrix, gain, seed))
    discard(matrix)
    able = F.col("n_words") >= least_words
    n = scored.where(able).count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "n_features", "weight"]
    drawn = ranked(scored.where(able), order, n)
    names = ["doc_id", "n_features", "weight", "score"]
    return drawn.select(*names, "rank").union(scored.where(~able).select(*names, F.lit(None).cast("long")))
