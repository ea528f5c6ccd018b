"""Language-model scores by a probabilistic suffix tree over words.

Every word is a symbol, as are the end of a text and the place before its start. The
tree's nodes are contexts of up to DEPTH symbols. A node's next symbols are those that
follow it at least ``least_count`` times; all others share what is left. A context is
kept if the shorter one (without its first symbol) is, and if its next symbols differ
enough from those of the shorter one: count times Kullback-Leibler divergence, over the
node's next symbols and the rest, of ``least_gain`` nats for each of them. Where
that fails the branch ends, so contexts are as long as the corpus bears out. With n
occurrences of a context, k next symbols and n(s) for one of them, its probability is
n(s) / (n + k), and the share of n + k that is left over goes to the shorter context's
distribution, down to add-one over words. So the probabilities of all known words and
of one unknown word add up to one, as they do in the base score.

A text's score is the base score and a sum over the runs of up to DEPTH + 1 symbols in
it: a run that is a context adds the logarithm of the share it hands down, and one that
is a context with a next symbol adds what that symbol gains over the shorter context.
The sum is each token's logarithm at its longest suffix state.

Words are counted by 64-bit hashes, contexts by hashes of their symbols, which are the
lower halves of the words' hashes. Counts are summed in tasks and sent to partitions of
the hash space in packed arrays. Only runs whose shorter runs count are looked at, told by
a table of bits of bounded size that never says a wrong no. Runs
and words that make up 1/HOT of all tokens, which are at most HOT for each length, are
broadcast; all others are asked for at the partition that holds them.

Defined cases: a null or empty text is its end token alone; texts of any length are
taken whole; a null id is trained on; repeated rows count repeatedly and are scored
alike; a gain that ties with the threshold keeps the context; without any training text
all counts are 0 and scores come from add-one alone; an empty table gives no rows;
columns other than doc_id and text are not read. Words with equal lower halves (about
one pair in four thousand million) share their contexts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm._common import bits_of, discard, documents, has_bit, release, remainder, small_batches, written
from chronopix.session import ship_code

#: Symbols of the longest contexts.
DEPTH = 5
#: Runs of at least 1/HOT of all tokens are broadcast.
HOT = 500_000
#: Runs that a task sums up, and requests that it gathers, before it hands them on; runs
#: that one partition of the hash space takes.
HELD, PART = 2_000_000, 2_000_000
END, START = xxhash.xxh3_64_intdigest(b""), xxhash.xxh3_64_intdigest(b" ")
LOW, MIX, STEP = np.uint64(0xFFFFFFFF), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
PACKED_RUNS = "part int, size int, symbols binary, n binary"


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: different numbers stay different."""
    x = (x ^ (x >> np.uint64(32))) * STEP
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def run_hash(context: np.ndarray, later: np.ndarray, size: int) -> np.ndarray:
    """Of a run of ``size`` symbols, from its hashes without the last and without the first."""
    if size == 2:
        return mixed(context << np.uint64(32) | later)
    return mixed(mixed(context * MIX + np.uint64(size)) + later)


#: Which bytes part words: the six separators alone.
PARTS = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
#: A number for each byte, capitals like small letters, and the base in whose powers they are added up.
DIGITS = mixed(np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64) + MIX)
DIGITS[PARTS] = 0
BASE = int(STEP) | 1
#: Bytes that are hashed at once, and those of a word that is hashed by itself.
PIECE, GIANT = 1 << 20, 1 << 16
SEPARATOR = re.compile(rb"[ \t-\r]")


class Reader:
    """Word hashes of texts: START, words, END for each. Words are hashed where they stand:
    digits times falling powers of a base are summed up over all bytes, a word's hash is the
    difference of two sums, taken back to its start, mixed with its length."""

    def __init__(self):
        size = PIECE + GIANT
        self.up = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size, BASE, np.uint64))])
        self.down = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size, pow(BASE, -1, 1 << 64), np.uint64))])

    def hashed(self, piece: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where the words of a piece begin, and their hashes."""
        raw = np.frombuffer(piece, np.uint8)
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = ~PARTS[raw]
        edge = np.diff(inside)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(DIGITS[raw] * self.down[: len(raw)], out=sums[1:])
        h = mixed((sums[end] - sums[start]) * self.up[start] + (end - start).astype(np.uint64) * MIX)
        for i in np.flatnonzero(end - start > GIANT).tolist():
            h[i] = xxhash.xxh3_64_intdigest(piece[start[i] : end[i]].lower())
        return start, h

    def pieces(self, data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same of data of any length, cut between words; a giant word is alone."""
        at = 0
        while at < len(data):
            stop = at + PIECE
            if stop < len(data):
                found = SEPARATOR.search(data, stop, stop + GIANT)
                if not found:  # no separator near: the word that stands there is cut out
                    before = max((data.rfind(c, at, stop) for c in (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")), default=-1) + 1
                    first = max(at, before)
                    after = SEPARATOR.search(data, stop + GIANT)
                    end = after.start() if after else len(data)
                    if first > at:
                        start, h = self.hashed(data[at:first])
                        yield start + at, h
                    if end - first > GIANT:
                        yield np.array([first]), np.array([xxhash.xxh3_64_intdigest(data[first:end].lower())], np.uint64)
                    else:
                        start, h = self.hashed(data[first:end])
                        yield start + first, h
                    at = end
                    continue
                stop = found.start()
            start, h = self.hashed(data[at:stop])
            yield start + at, h
            at = stop

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All hashes one after the other, and each one's place in its text."""
        data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, data), np.int64, len(data)) + 1)])
        found = list(self.pieces(b" ".join(data)))
        starts = np.concatenate([np.zeros(0, np.int64), *(x for x, _ in found)])
        many = np.diff(np.searchsorted(starts, offsets)) + 2
        ends = np.cumsum(many)
        first, inner = ends - many, np.ones(many.sum(), bool)
        h = np.empty(len(inner), np.uint64)
        h[first], h[ends - 1] = START, END
        inner[first] = inner[ends - 1] = False
        h[inner] = np.concatenate([np.zeros(0, np.uint64), *(x for _, x in found)])
        return h, np.arange(len(h)) - np.repeat(first, many)


def runs_in(h: np.ndarray, place: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size from 2 to ``most``: where runs end, and their hashes."""
    run = h & LOW
    for size in range(2, most + 1):
        at = np.flatnonzero(place >= size - 1)
        longer = np.zeros(len(h), np.uint64)
        longer[at] = run_hash(run[at - 1], run[at], size)
        run = longer
        yield at, run[at]


def hashes_of(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of runs in rows: without the last symbol, without the first, and whole."""
    level = [c.astype(np.uint64) for c in symbols.T]
    for size in range(2, symbols.shape[1]):
        level = [run_hash(x, y, size) for x, y in zip(level, level[1:])]
    return level[0], level[1], run_hash(level[0], level[1], symbols.shape[1])


def packed(size: int, key: np.ndarray, symbols: np.ndarray, n: np.ndarray, parts: int) -> pa.RecordBatch:
    part = (key >> np.uint64(33)).astype(np.int64) % parts
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    rows = [(int(part[i[0]]), size, symbols[i].tobytes(), n[i].astype(np.uint32).tobytes()) for i in np.split(order, cuts)]
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 2]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "size", "symbols", "n"])


def count_words(texts: DataFrame, parts: int) -> DataFrame:
    """Words' hashes ``h`` and counts ``n`` over all texts; START counts the texts."""
    ship_code(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, held, size = Reader(), [], 0

        def flush() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return packed(1, mixed(h), h, n, parts)

        for batch in (part for b in batches for part in small_batches(b)):
            held.append(read(batch.column("text").to_pylist())[0])
            size += len(held[-1])
            if size > HELD:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        h = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["symbols"], np.uint64) for r in rows)])
        n = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(r["n"], np.uint32) for r in rows)])
        if len(h):
            h, back = np.unique(h, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.bincount(back, n, len(h)).astype(np.int64))], ["h", "n"])

    return texts.select("text").mapInArrow(run, PACKED_RUNS).repartition(parts, "part").mapInArrow(add, "h long, n long")


def count_runs(texts: DataFrame, sizes: range, stored: np.ndarray, parts: int, least: int) -> DataFrame:
    """Runs of the given sizes that occur ``least`` times: size, hash ``g``, those of
    context ``a`` and later part ``b``, count ``n``. ``stored``: bits of the runs one symbol
    shorter than the least size; a run counts only if all of those in it are there."""
    shared = texts.sparkSession.sparkContext.broadcast(stored)
    base = sizes[0] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, stored, held, many = Reader(), shared.value, {k: [] for k in sizes}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            for size, parts_of in held.items():
                if size == 2:  # both symbols are the key, which is sorted faster by itself
                    pair, n = np.unique(np.concatenate(parts_of), return_counts=True)
                    key, symbols = mixed(pair), np.column_stack([pair >> np.uint64(32), pair & LOW]).astype(np.uint32)
                else:
                    key, symbols = (np.concatenate(c) for c in zip(*parts_of, strict=True))
                    key, first, n = np.unique(key, return_index=True, return_counts=True)
                    symbols = symbols[first]
                if len(key):
                    yield packed(size, key, symbols, n, parts)

        for batch in (part for b in batches for part in small_batches(b)):
            h, place = read(batch.column("text").to_pylist())
            if base == 1:
                live = has_bit(stored, h & LOW)
                at = np.flatnonzero((place > 0) & live & np.concatenate([live[:1], live[:-1]]))
                held[2].append(h[at - 1] << np.uint64(32) | h[at] & LOW)
                many += len(at)
            low = (h & LOW).astype(np.uint32)
            for size, (at, key) in enumerate(runs_in(h, place, sizes[-1]) if base > 1 else (), 2):
                if size == base:
                    live = np.zeros(len(h), bool)
                    live[at[has_bit(stored, key)]] = True
                elif size in sizes:
                    on = live[at]
                    for back in range(1, size - base + 1):
                        on &= live[at - back]
                    at, key = at[on], key[on]
                    held[size].append((key, np.column_stack([low[at - k] for k in range(size - 1, -1, -1)])))
                    many += len(key)
            if many > HELD:
                yield from flush()
                held, many = {k: [] for k in sizes}, 0
        if many:
            yield from flush()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        for size in sizes:
            mine = [r for r in rows if r["size"] == size]
            if mine:
                symbols = np.concatenate([np.frombuffer(r["symbols"], np.uint32) for r in mine]).reshape(-1, size)
                a, b, key = hashes_of(symbols)
                key, first, back = np.unique(key, return_index=True, return_inverse=True)
                total = np.bincount(back, np.concatenate([np.frombuffer(r["n"], np.uint32) for r in mine]), len(key)).astype(np.int64)
                on = total >= least
                if on.any():
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(on.sum(), size, np.int32)), *[pa.array(x) for x in (key[on].view(np.int64), a[first[on]].view(np.int64), b[first[on]].view(np.int64), total[on])]], ["size", "g", "a", "b", "n"])

    return texts.select("text").mapInArrow(run, PACKED_RUNS).repartition(parts, "part").mapInArrow(add, "size int, g long, a long, b long, n long")


#: Sizes of runs that are counted in one pass.
PASSES = (range(2, 3), range(3, 4), range(4, DEPTH + 2))


def grow_tree(texts: DataFrame, words: DataFrame, n_train: int, vocabulary: int, parts: int, least: int, gain: float) -> DataFrame:
    """``key`` and ``w``: what each run of a text adds to its score. Runs are counted in
    PASSES over the texts, until no context is kept."""
    # all words of a symbol count, rare ones too, as runs count them: no context is followed more often than it occurs
    symbols = words.groupBy(F.col("h").bitwiseAND(0xFFFFFFFF).alias("g")).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    # of runs of the length before: count, that of the later part, and the symbol's logarithm at the later part's context
    before = written(symbols.select("g", "n", F.lit(n_train).cast("long").alias("n_b"), F.log10((F.col("n") + 1) / (n_train + vocabulary + 1)).alias("lp")))
    contexts = before.where(F.col("g") != END & 0xFFFFFFFF)
    weights, tables = [], []
    for depth in range(1, DEPTH + 1):
        for sizes in PASSES:
            if sizes[0] == depth + 1:
                stored = bits_of(contexts.select(F.col("g").alias("h")).union(before.select(F.col("g").alias("h"))))
                tables.append(written(count_runs(texts, sizes, stored, parts, least)))
                release(texts.sparkSession)
        runs = tables[-1].where(F.col("size") == depth + 1)
        if runs.isEmpty():
            break
        at = contexts.select(F.col("g").alias("a"), F.col("n").alias("n_a"), F.col("n_b").alias("n_short"))
        later = before.select(F.col("g").alias("b"), F.col("n").alias("n_b"), "lp")
        nodes = written(runs.join(at, "a").join(later, "b"))
        # a node's next symbols against those of the shorter context, and the rest against the rest
        expected = F.col("n_b") / F.col("n_short")
        sums = nodes.groupBy("a").agg(F.first("n_a").alias("n_a"), F.sum("n").alias("stored"), F.sum(expected).alias("expected"), F.count("*").alias("kinds"), F.sum(F.col("n") * F.log(F.col("n") / F.col("n_a") / expected)).alias("gain"))
        rest, others = F.col("n_a") - F.col("stored"), F.greatest(1 - F.col("expected"), F.lit(1e-9))
        total = F.col("gain") + F.when(rest > 0, rest * F.log(rest / F.col("n_a") / others)).otherwise(0.0)
        share = (rest + F.col("kinds")) / (F.col("n_a") + F.col("kinds"))
        kept = written(sums.where(total >= gain * F.col("kinds")).select("a", F.col("n_a").alias("n"), (F.col("n_a") + F.col("kinds")).alias("total"), share.alias("share")))
        if kept.isEmpty():
            break
        p = F.col("n") / F.col("total") + F.col("share") * F.pow(F.lit(10.0), "lp")
        grown = written(nodes.join(kept.drop("n"), "a").select("g", "n", "n_b", F.log10(p).alias("lp"), (F.log10(p) - F.log10("share") - F.col("lp")).alias("w")))
        weights.append(kept.select(F.col("a").alias("key"), F.log10("share").alias("w"), F.col("n"), F.lit(depth == 1).alias("word")))
        weights.append(grown.select(F.col("g").alias("key"), "w", "n", F.lit(False).alias("word")))
        # a longer context is looked at only where the shorter one, without its first symbol, is kept
        contexts, before = written(nodes.select("g", "n", "n_b", "b").join(kept.select(F.col("a").alias("b")), "b", "left_semi")), grown
        discard(nodes)
    discard(*tables)
    if not weights:
        return written(before.where(F.lit(False)).select(F.col("g").alias("key"), F.col("lp").alias("w"), "n", F.lit(False).alias("word")))
    out = weights[0]
    for more in weights[1:]:
        out = out.union(more)
    return written(out.groupBy("key", "word").agg(F.sum("w").alias("w"), F.max("n").alias("n")))


ASKED = "part int, kind int, rows binary, at binary, keys binary, logs binary, ws binary, row long, doc_id long, held_out boolean, n_tokens long, n_known long, common double, gained double"
NAMES = [x.split()[0] for x in ASKED.split(", ")]
MODEL, TEXT, REQUEST = 0, 1, 2


def as_batch(n: int, **columns: pa.Array) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, kinds[k])) for c, k in (x.split() for x in ASKED.split(", "))], NAMES)


def by_part(key: np.ndarray, parts: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The parts that keys go to, and which keys go to each."""
    part = (mixed(key) >> np.uint64(33)).astype(np.int64) % parts
    order = np.argsort(part, kind="stable")
    return np.unique(part), np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(key) else []


def blobs(groups: list[np.ndarray], values: np.ndarray) -> pa.Array:
    return pa.array([values[i].tobytes() for i in groups], pa.binary())


def model_rows(words: DataFrame, weights: DataFrame, parts: int) -> DataFrame:
    """The tables of words and runs, packed for the partitions that requests go to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = batch.column("key").to_numpy().view(np.uint64)
                part, groups = by_part(key, parts)
                yield as_batch(len(part), part=pa.array(part, pa.int32()), kind=pa.array([MODEL] * len(part), pa.int32()), keys=blobs(groups, key), logs=blobs(groups, batch.column("log").to_numpy()), ws=blobs(groups, batch.column("w").to_numpy()))

    rows = words.select(F.col("h").alias("key"), F.log10(F.col("n") + 1).alias("log"), "w").union(weights.where(~F.col("word")).select("key", F.lit(0.0).alias("log"), "w"))
    return rows.mapInArrow(run, ASKED)


def text_rows(texts: DataFrame, hot: tuple, parts: int, start: float) -> DataFrame:
    """One row for each text with what the hot words and runs give, and requests for others."""
    shared = texts.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (word_keys, word_logs, word_ws), (run_keys, run_ws), bits, word_bits = shared.value
        read, rows, at, keys, many = Reader(), [], [], [], 0

        def requests() -> pa.RecordBatch:
            key, of, row = np.concatenate(keys), np.concatenate(at), np.concatenate(rows)
            part, groups = by_part(key, parts)
            return as_batch(len(part), part=pa.array(part, pa.int32()), kind=pa.array([REQUEST] * len(part), pa.int32()), rows=blobs([np.unique(of[i]) for i in groups], row), at=blobs(groups, of), keys=blobs(groups, key))

        for batch in (part for b in batches for part in small_batches(b)):
            h, place = read(batch.column("text").to_pylist())
            of, n = np.cumsum(place == 0) - 1, batch.num_rows
            token = np.flatnonzero(place > 0)
            found = found_in(word_keys, h[token])
            hit = found >= 0
            known, known_at = of[token[hit]], found[hit]
            common = np.bincount(known, word_logs[known_at], n)
            gained = start + np.bincount(known, word_ws[known_at], n)
            # words that training has never seen give nothing, however often they are met
            other = token[~hit]
            other = other[has_bit(word_bits, h[other])]
            asked = [(of[other], h[other])]
            live = np.ones(len(h), bool)
            for ends, key in runs_in(h, place, DEPTH + 1):
                # of a run that counts, the later part counts
                ends, key = ends[live[ends]], key[live[ends]]
                on = has_bit(bits, key)
                ends, key = ends[on], key[on]
                live = np.zeros(len(h), bool)
                live[ends] = True
                found = found_in(run_keys, key)
                gained += np.bincount(of[ends[found >= 0]], run_ws[found[found >= 0]], n)
                asked.append((of[ends[found < 0]], key[found < 0]))
            turn = pa.array(np.full(n, hash((int(batch.column("row")[0].as_py()), n)) % parts), pa.int32())
            yield as_batch(n, part=turn, kind=pa.array([TEXT] * n, pa.int32()), **{c: batch.column(c) for c in ("row", "doc_id", "held_out")}, n_tokens=pa.array(np.bincount(of, minlength=n) - 1, pa.int64()), n_known=pa.array(np.bincount(known, minlength=n), pa.int64()), common=pa.array(common.astype(float)), gained=pa.array(gained.astype(float)))
            shift = sum(map(len, rows))
            rows.append(batch.column("row").to_numpy())
            at += [(x + shift).astype(np.int32) for x, _ in asked]
            keys += [k for _, k in asked]
            many += sum(len(k) for _, k in asked)
            if many > HELD:
                yield requests()
                rows, at, keys, many = [], [], [], 0
        if many:
            yield requests()

    return texts.select("row", "doc_id", "held_out", "text").mapInArrow(run, ASKED)


def found_in(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted table, -1 where it is missing."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def answered(rows: DataFrame, parts: int) -> DataFrame:
    """Texts' rows, and for each text what a partition's words and runs add to it."""
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "common", "gained"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, requests = [], []
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            if (kind == TEXT).any():
                yield batch.filter(pa.array(kind == TEXT)).select(names)
            for r in batch.filter(pa.array(kind != TEXT)).select(["kind", "rows", "at", "keys", "logs", "ws"]).to_pylist():
                key = np.frombuffer(r["keys"], np.uint64)
                if r["kind"] == MODEL:
                    model.append((key, np.frombuffer(r["logs"]), np.frombuffer(r["ws"])))
                else:
                    requests.append((np.frombuffer(r["rows"], np.int64), np.frombuffer(r["at"], np.int32), key))
        if not model:
            return
        table, logs, ws = (np.concatenate(c) for c in zip(*model, strict=True))
        order = np.argsort(table)
        table, logs, ws = table[order], logs[order], ws[order]
        for row, at, key in requests:
            found = found_in(table, key)
            hit = found >= 0
            of, found = np.searchsorted(np.unique(at), at[hit]), found[hit]
            known = np.bincount(of, logs[found] > 0, len(row)).astype(np.int64)
            columns = [pa.array(row), pa.nulls(len(row), pa.int64()), pa.nulls(len(row), pa.bool_()), pa.nulls(len(row), pa.int64()), pa.array(known), pa.array(np.bincount(of, logs[found], len(row)).astype(float)), pa.array(np.bincount(of, ws[found], len(row)).astype(float))]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(np.bincount(of, minlength=len(row)) > 0))

    return rows.repartition(parts, "part").mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, common double, gained double")


def score_texts(docs: DataFrame, *, modulus: int = 7, held_out: int = 2, least_count: int = 6, least_gain: float = 2.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every text."""
    texts = documents(docs).withColumn("held_out", remainder(F.col("doc_id"), modulus) == held_out).withColumn("row", F.monotonically_increasing_id())
    training = texts.where(~F.col("held_out"))
    letters = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(64, letters // (6 * PART))
    counts = written(count_words(training, parts))
    release(docs.sparkSession)
    is_start = F.col("h") == F.lit(START - (1 << 64) if START >> 63 else START)
    size = counts.where(~is_start).agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n_train, vocabulary = size["n"] or 0, size["v"]
    weights = grow_tree(training, counts, n_train, vocabulary, parts, least_count, least_gain)
    of_words = weights.where("word").select(F.col("key").alias("g"), "w")
    words = counts.where(~is_start).withColumn("g", F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).join(of_words, "g", "left")
    words = written(words.select("h", "n", F.coalesce("w", F.lit(0.0)).alias("w")))
    discard(counts)
    release(docs.sparkSession)
    frequent = F.col("n") * HOT >= n_train
    hot_words = words.where(frequent).toPandas()
    hot_runs = weights.where(~F.col("word") & frequent).select("key", "w").toPandas()
    first = of_words.where(F.col("g") == F.lit(START & 0xFFFFFFFF)).first()

    def arrays(key, *values) -> tuple[np.ndarray, ...]:
        key = key.to_numpy(np.int64).view(np.uint64)
        order = np.argsort(key)
        return tuple(x[order] for x in (key, *(v.to_numpy(float) for v in values)))

    hot = (arrays(hot_words["h"], np.log10(hot_words["n"].astype(float) + 1), hot_words["w"]), arrays(hot_runs["key"], hot_runs["w"]), bits_of(weights.select(F.col("key").alias("h"))), bits_of(words.select("h")))
    asked = text_rows(texts, hot, parts, first["w"] if first else 0.0).union(model_rows(words, weights, parts))
    got = answered(asked, parts).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("common").alias("common"), F.sum("gained").alias("gained"))
    base = F.col("common") - F.col("n_tokens") * F.log10(F.lit(float(n_train + vocabulary + 1)))
    return got.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("gained")).alias("score"))
