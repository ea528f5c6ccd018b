"""N-gram Jaccard join by rare-first prefix filtering.

A text's set holds the 64-bit hashes of its 5-word shingles. All sets are ordered
alike, rare shingles first; how often a shingle occurs is read from a table of
counts over BUCKETS hash buckets, summed over all texts (any common order is exact;
the counts only make prefixes rare). Two sets can only reach the similarity if they
share a shingle among their first n - ceil(t*n) + 1, so only those are shuffled, in
packed arrays, and joined. Candidates pass a length filter and a positional filter,
which holds a shared shingle to be the first one that the two share, and then a suffix
filter: a set's sketch has the parity of how many of its shingles lie in each of many
cells, and cells of different parity each hold a shingle that only one of the two has,
so their number bounds the sets' Hamming distance from below. Pairs that pass all three
are verified on the whole sets, each once.

Only components are asked for, so a shingle's group of more than SMALL texts is not
expanded into all its pairs. First its texts are compared with CENTRES of them, among
them that with the fewest rare shingles before the shared one: the least changed of a
family of copies. Of the pairs that are left, only those count whose texts are in different
components by then. A group's texts are put into lots by size, those that the length and
positional filters leave no partner in a lot are dropped, and the rest meets in blocks of two
sides inside tasks, where only pairs that pass the filters are listed. Groups of the same
texts are looked at once. No link between components is lost.

Defined cases: null and empty texts have empty sets and link with nothing; fewer
than five words make one shingle; texts of any length are taken whole; rows with a
null id link with nothing and have a null component; rows that repeat an id are one
document in the components; equal sets are linked through the smallest id; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronopix.llm._common import bits_of, discard, documents, has_bit, quoted, small_batches, written
from chronopix.llm.components import components
from chronopix.session import ship_code

SHINGLE = 5
#: Buckets of the table of counts, and slices in which it is summed.
BUCKET_BITS, SLICES = 20, 16
BUCKETS = 1 << BUCKET_BITS
#: Groups of up to so many texts are compared pair by pair.
SMALL = 8
#: Prefix entries that a task packs together, and that one partition joins.
PACKED, JOINED = 1_000_000, 1_000_000
CACHED_WORDS = 400_000
#: Texts of a crowded group that all others are compared with first.
CENTRES = 4
#: Texts on a side of a block of a crowded group.
BLOCK = 2048
MIX, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser: multiply and fold, twice."""
    x = (x ^ (x >> np.uint64(32)) ^ np.uint64(salt)) * STEP
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """Word hashes, remembered."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    """Sorted arrays of distinct shingle hashes."""

    def __init__(self):
        self.known = WordHashes()

    def __call__(self, text: str) -> np.ndarray:
        # of bytes, lower() changes A-Z alone and split() parts at the six separators alone
        words, known = text.encode("utf-8", "surrogatepass").lower().split(), self.known
        if not words:
            return np.zeros(0, np.uint64)
        if len(known) > CACHED_WORDS:
            known.clear()
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(h) - SHINGLE + 1)
        code = np.full(n, min(len(h), SHINGLE), np.uint64)
        for k in range(min(len(h), SHINGLE)):
            code = code * MIX + h[k : k + n]
        return np.unique(mixed(code))


def sketch_of(s: np.ndarray) -> bytes:
    """Parities of a set's counts in 2n to 4n cells, at least 64, by the lowest bits."""
    cells = 1 << max(6, (2 * len(s)).bit_length())
    return np.packbits(np.bincount((s & np.uint64(cells - 1)).astype(np.int64), minlength=cells).astype(np.uint8) & 1, bitorder="little").tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    """Of fewer cells, as their lowest bits tell them apart."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, size), 0)


def least_differences(sketches: list[bytes], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Suffix filter: for each pair of places, at least so many shingles are in one of the
    two sets only. The larger sketch is folded."""
    sizes = np.fromiter(map(len, sketches), np.int64, len(sketches))
    size, out = np.minimum(sizes[x], sizes[y]), np.zeros(len(x), np.int64)
    for m in np.unique(size):
        on = np.flatnonzero(size == m)
        some = np.unique(np.concatenate([x[on], y[on]]))
        table = np.stack([folded(sketches[i], m) for i in some])
        for at in range(0, len(on), 4096):
            part = on[at : at + 4096]
            out[part] = np.bitwise_count(table[np.searchsorted(some, x[part])] ^ table[np.searchsorted(some, y[part])]).sum(1)
    return out


def scan(docs: DataFrame) -> DataFrame:
    """One row for each text (doc_id, n, fingerprint and sketch of its set) and, from each
    task, rows of how many of its different sets hold a shingle of each bucket."""
    ship_code(docs.sparkSession)
    names = ["doc_id", "n", "f1", "f2", "sketch", "slice", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, table, seen = Shingler(), np.zeros(BUCKETS, np.uint32), set()
        for batch in batches:
            for part in small_batches(batch):
                rows, new = [], []
                for text in part.column("text").to_pylist():
                    s = shingles(text)
                    f1, f2 = int(mixed(s, 1).sum().astype(np.int64)), int(mixed(s, 2).sum().astype(np.int64))
                    rows.append((len(s), f1, f2, sketch_of(s)))
                    if f1 not in seen:
                        seen.add(f1)
                        new.append(s)
                        if len(seen) > CACHED_WORDS:
                            seen.clear()
                if new:
                    np.add.at(table, (np.concatenate(new) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.uint32(1))
                if rows:
                    cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 3 + [pa.binary()], strict=True)]
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), *cols, pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())], names)
        if seen:
            slices = [p.tobytes() for p in np.split(table, SLICES)]
            yield pa.RecordBatch.from_arrays([*[pa.nulls(SLICES, pa.int64())] * 4, pa.nulls(SLICES, pa.binary()), pa.array(range(SLICES), pa.int32()), pa.array(slices, pa.binary())], names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, f1 long, f2 long, sketch binary, slice int, counts binary")


def bucket_counts(scanned: DataFrame) -> np.ndarray:
    """The tasks' tables, summed in tasks slice by slice; 8 bytes for each of BUCKETS."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
                counts = np.frombuffer(part.as_buffer(), np.uint32).astype(np.int64)
                total[i] = total[i] + counts if i in total else counts
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([t.tobytes() for t in total.values()], pa.binary())], ["slice", "counts"])

    rows = scanned.where("slice is not null").select("slice", "counts").repartition(SLICES, "slice").mapInArrow(add, "slice int, counts binary").collect()
    table = np.zeros((SLICES, BUCKETS // SLICES), np.int64)
    for r in rows:
        table[r["slice"]] += np.frombuffer(r["counts"], np.int64)
    return table.ravel()


def needed_share(n: np.ndarray | int, percent: int):
    """Least overlap with any partner for a set of n: ceil(percent * n / 100)."""
    return -(-percent * n // 100)


def packed_prefixes(docs: DataFrame, counts: np.ndarray, parts: int, percent: int) -> DataFrame:
    """Prefixes of all sets in packed arrays, one row for each part of the hash space;
    shingles of crowded buckets apart (``crowded``), as their groups have no bound."""
    ship_code(docs.sparkSession)
    crowd = counts.mean() + 8 * np.sqrt(counts.mean()) + 4 * SMALL
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    names = ["part", "crowded", "docs", "sizes", "entries", "keys", "places"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, table = Shingler(), shared.value
        held, size, seen, turn = [], 0, set(), 0

        def packed() -> pa.RecordBatch:
            nonlocal turn
            ids, sizes = np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.int32)
            keys, each = np.concatenate([h[2] for h in held]), np.array([len(h[2]) for h in held])
            places = np.concatenate([np.arange(n, dtype=np.int32) for n in each])
            of = np.repeat(np.arange(len(held)), each)
            crowded = table[(keys >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)] > crowd
            part = ((keys & np.uint64(0xFFFFFFFF)) % np.uint64(parts)).astype(np.int64)
            turn += 1
            part[crowded] = parts + (turn * 7919 + len(ids)) % parts
            order = np.argsort(part, kind="stable")
            rows = []
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            for i in np.split(order, cuts):
                d, entries = np.unique(of[i], return_counts=True)
                p = int(part[i[0]])
                rows.append((p % parts, p >= parts, ids[d].tobytes(), sizes[d].tobytes(), entries.astype(np.int32).tobytes(), keys[i].tobytes(), places[i].tobytes()))
            kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        parts_of = (part for batch in batches for part in small_batches(batch))
        for doc_id, text in (x for part in parts_of for x in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)):
            s = shingles(text)
            if doc_id is None or not len(s):
                continue
            f = (int(mixed(s, 1).sum()), int(mixed(s, 2).sum()))
            if f in seen:
                continue  # an equal set of this pack stands for it; they are linked by fingerprint
            seen.add(f)
            order = np.argsort(table[(s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)], kind="stable")  # s is sorted
            prefix = s[order[: len(s) - needed_share(len(s), percent) + 1]]
            held.append((doc_id, len(s), prefix))
            size += len(prefix)
            if size > PACKED:
                yield packed()
                held, size = [], 0
                seen.clear()
        if held:
            yield packed()

    return docs.select("doc_id", "text").mapInArrow(run, "part int, crowded boolean, docs binary, sizes binary, entries binary, keys binary, places binary")


def may_link(n1, p1, n2, p2, percent: int):
    """Length and positional filters for two sets whose first shared entries are those
    at p1 and p2: nothing before them is shared. For later shared entries the bound is
    too low, but a pair that links passes at its first."""
    small, large = np.minimum(n1, n2).astype(np.int64), np.maximum(n1, n2).astype(np.int64)
    most = np.minimum(n1 - p1, n2 - p2)
    return (100 * small >= percent * large) & ((100 + percent) * most.astype(np.int64) >= percent * (small + large))


def candidates(packs: DataFrame, parts: int, percent: int) -> DataFrame:
    """Rows (a, b): pairs of small groups that pass the filters; rows (a, key, size,
    place) without b: members of larger groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kept = ["a", "b", "key", "size", "place"], []

        def members(x: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x[0]), pa.nulls(len(x[0]), pa.int64()), pa.array(x[3].view(np.int64)), pa.array(x[1]), pa.array(x[2])], names)

        for batch in batches:
            for r in batch.to_pylist():
                entries = np.frombuffer(r["entries"], np.int32)
                x = [np.repeat(np.frombuffer(r["docs"], np.int64), entries), np.repeat(np.frombuffer(r["sizes"], np.int32), entries), np.frombuffer(r["places"], np.int32), np.frombuffer(r["keys"], np.uint64)]
                if r["crowded"]:
                    yield members(x)
                else:
                    kept.append(x)
        if not kept:
            return
        doc, size, place, key = (np.concatenate(c) for c in zip(*kept, strict=True))
        kept.clear()
        order = np.argsort(key)
        doc, size, place, key = doc[order], size[order], place[order], key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        many = np.diff(np.append(first, len(key)))
        in_group = np.repeat(many, many)
        if (on := in_group > SMALL).any():
            yield members([doc[on], size[on], place[on], key[on]])
        on = (in_group > 1) & (in_group <= SMALL)
        doc, size, place, key = doc[on], size[on], place[on], key[on]
        pairs = []
        for d in range(1, SMALL):
            i = np.flatnonzero(key[d:] == key[:-d])
            if not len(i):
                break
            ok = (doc[i] != doc[i + d]) & may_link(size[i], place[i], size[i + d], place[i + d], percent)
            i = i[ok]
            pairs.append(np.column_stack([np.minimum(doc[i], doc[i + d]), np.maximum(doc[i], doc[i + d])]))
        if pairs:
            p = np.unique(np.concatenate(pairs), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1]), *[pa.nulls(len(p), t) for t in (pa.int64(), pa.int32(), pa.int32())]], names)

    return packs.repartition(parts, "part").mapInArrow(run, "a long, b long, key long, size int, place int")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return bool(100 * shared >= percent * (len(x) + len(y) - shared))


def near_enough(sizes: np.ndarray, apart: np.ndarray, percent: int) -> np.ndarray:
    """Sets that reach the similarity have at most (100 - percent) / (100 + percent) of
    their sizes' sum to themselves."""
    return (100 + percent) * apart <= (100 - percent) * sizes.astype(np.int64)


def may_be_near(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` that pass the suffix filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, n = batch.column("na").to_numpy() + batch.column("nb").to_numpy(), batch.num_rows
            both = batch.column("sa").to_pylist() + batch.column("sb").to_pylist()
            yield batch.select(["a", "b"]).filter(pa.array(near_enough(sizes, least_differences(both, np.arange(n), np.arange(n, 2 * n)), percent)))

    side = lambda c: sketches.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long").distinct()


def marked(rows: DataFrame, bits: np.ndarray, wanted: bool = True) -> DataFrame:
    """The rows whose hash ``h`` of an id has its bit set or, if not ``wanted``, has not;
    without ``h``."""
    shared = rows.sparkSession.sparkContext.broadcast(bits)
    names = [c for c in rows.columns if c != "h"]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            yield batch.filter(pa.array(has_bit(table, batch.column("h").to_numpy()) == wanted)).select(names)

    return rows.mapInArrow(pick, rows.drop("h").schema)


def verified(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the similarity. ``pairs`` is a written table."""
    bits = bits_of(pairs.select(F.explode(F.array("a", "b")).alias("id")).select(F.xxhash64("id").alias("h")))
    some = marked(docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), "text", F.xxhash64("doc_id").alias("h")), bits)
    as_side = lambda c: some.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, last = Shingler(), (None, None)
        for batch in batches:
            for part in small_batches(batch, "text_b"):
                out = []
                for a, b, ta, tb in zip(*(part.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                    if last[0] != ta:
                        last = (ta, shingles(ta))
                    if linked(last[1], shingles(tb), percent):
                        out.append((a, b))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    return pairs.join(as_side("b"), "b").join(as_side("a"), "a").select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long")


def pair_columns(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def passes(s1: str, p1: str, s2: str, p2: str, percent: int) -> Column:
    """``may_link`` as an expression."""
    small, large = F.least(s1, s2), F.greatest(s1, s2)
    most = F.least(F.col(s1) - F.col(p1), F.col(s2) - F.col(p2))
    return (100 * small >= percent * large) & ((100 + percent) * most >= percent * (small + large))


def different_groups(members: DataFrame) -> DataFrame:
    """One group for each set of texts: that of the key which comes first in the order
    of shingles, in the smallest text as in all, so that it is the first shared one."""
    marks = members.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("doc", "place")).alias("first"), *[F.bit_xor(F.xxhash64("doc", F.lit(i))).alias(f"x{i}") for i in (0, 1)])
    keys = marks.where("n > 1").groupBy("n", "x0", "x1").agg(F.min_by("key", "first.place").alias("key"))
    return members.join(keys.select("key"), "key", "left_semi")


def star_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Each text of a group with the group's centres: the least changed text, by the share
    of rarer shingles before the shared one in steps of a sixteenth, and CENTRES - 1 that
    come first by hashes of their ids."""
    fields = ["doc", "size", "place"]
    least = F.struct(F.floor(16 * F.col("place") / F.col("size")).alias("share"), F.xxhash64("doc").alias("h"), *fields)
    others = [F.struct(F.xxhash64("doc", F.lit(i)).alias("h"), *fields) for i in range(1, CENTRES)]
    found = members.groupBy("key").agg(F.min(least).alias("c0"), *[F.min(x).alias(f"c{i}") for i, x in enumerate(others, 1)])
    bare = lambda i: F.struct(*[F.col(f"c{i}.{c}").alias(f"{c}2") for c in fields])
    centres = found.select("key", F.array_distinct(F.array(*map(bare, range(CENTRES)))).alias("centres"))
    pairs = members.join(centres, "key").select("doc", "size", "place", F.inline("centres"))
    pairs = pairs.where((F.col("doc") != F.col("doc2")) & passes("size", "place", "size2", "place2", percent))
    return pairs.select(*pair_columns("doc", "doc2"))


def blocks_across(members: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """Members of crowded groups that may still have a partner in another component, dealt
    to blocks: key, lot, kind, left, right (which name a block), side (0 for those that ask, 1
    for those that are asked), doc, size, place, component.

    A text asks for partners that are no larger than itself (of equal size, with a smaller id).
    By the length and positional filters their sizes lie between two bounds, so sizes are put
    into lots by their logarithm and a text asks in three lots at most. Of the group's
    largest component only texts outside it are asked for (kind 1), by all others everyone is
    (kind 0). Texts that no size on the other side suits go before anything is copied. What is
    left of a lot is split on both sides into blocks of BLOCK, so a text is copied as often as
    there are blocks on the other side."""
    rows = members.join(named.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    least = F.ceil(percent * F.col("size") / 100)
    most = F.floor((100 * F.col("size").cast("long") - (100 + percent) * F.col("place").cast("long")) / percent)
    rows = rows.withColumns({"least": least, "most": most}).where("most >= least")
    extremes = {"size_lo": ("size", F.min), "size_hi": ("size", F.max), "most_hi": ("most", F.max)}
    # by component and then by key, with and without the largest component: what all and what those outside it reach
    by = rows.groupBy("key", "component").agg(F.count("*").alias("n"), *[f(c).alias(name) for name, (c, f) in extremes.items()])
    largest = by.groupBy("key").agg(F.max(F.struct("n", "component"))["component"].alias("largest"))
    by = by.join(largest, "key")
    outside = F.col("component") != F.col("largest")
    groups = by.groupBy("key", "largest").agg(*[f(name).alias(f"all_{name}") for name, (_, f) in extremes.items()], *[f(F.when(outside, F.col(name))).alias(f"out_{name}") for name, (_, f) in extremes.items()]).where("out_size_lo IS NOT NULL")
    fits = lambda of: (F.col("most") >= F.col(f"{of}_size_lo")) & (F.col("least") <= F.col(f"{of}_size_hi")) & (F.col(f"{of}_most_hi") >= F.col("size"))
    rows = rows.join(groups, "key").withColumns({"out": outside, "suits_all": fits("all"), "suits_out": fits("out")})
    lot = lambda n: F.floor(F.log(n.cast("double")) / np.log(100 / percent)).cast("int")
    asks = F.when(F.col("out") & F.col("suits_all"), 0).when(~F.col("out") & F.col("suits_out"), 1)
    asking = rows.withColumn("kind", asks).where("kind IS NOT NULL AND least <= size").withColumn("lot", F.explode(F.sequence(lot(F.col("least")), lot(F.least("most", "size")))))
    told = F.array_compact(F.array(F.when(F.col("suits_out"), 0), F.when(F.col("out") & F.col("suits_all"), 1)))
    asked = rows.withColumn("lot", lot(F.col("size"))).withColumn("kind", F.explode(told))
    fields = ["key", "lot", "kind", "doc", "size", "place", "component", "least", "most"]
    both = asking.select(*fields, F.lit(0).alias("side")).unionByName(asked.select(*fields, F.lit(1).alias("side")))
    own = ["key", "lot", "kind"]
    # the same once more in each lot, of the other side
    side = lambda s: F.col("side") == s
    ends = both.groupBy(*own).agg(*[f(F.when(side(1 - s), F.col(c))).alias(f"{name}_{s}") for s in (0, 1) for name, (c, f) in extremes.items()])
    there = lambda c: F.when(side(0), F.col(f"{c}_0")).otherwise(F.col(f"{c}_1"))
    suits = (F.col("most") >= there("size_lo")) & (F.col("least") <= there("size_hi")) & (there("most_hi") >= F.col("size"))
    left = written(both.join(ends, own).where(suits).select(*fields, "side"))
    count = lambda s: F.ceil(F.count_if(side(s)) / BLOCK).cast("int")
    many = left.groupBy(*own).agg(count(0).alias("lefts"), count(1).alias("rights")).where("lefts > 0 and rights > 0")
    deal = lambda salt, n: F.pmod(F.xxhash64("doc", F.lit(salt)), F.col(n)).cast("int")
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    dealt = left.join(many, own).withColumn("left", F.explode(F.when(side(0), F.array(deal(6, "lefts"))).otherwise(each("lefts"))))
    dealt = dealt.withColumn("right", F.explode(F.when(side(0), each("rights")).otherwise(F.array(deal(7, "rights")))))
    return dealt.select(*own, "left", "right", "side", "doc", "size", "place", "component")


def pairs_across(members: DataFrame, named: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of the crowded groups that pass all filters and whose texts are in different
    components."""
    own = ["key", "lot", "kind", "left", "right"]
    rows = blocks_across(members, named, percent).join(sketches.select(F.col("doc_id").alias("doc"), "sketch"), "doc")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block, and those that ask first."""
        rest: pa.Table | None = None
        for batch in chain(batches, [None]):
            if batch is not None:
                table = pa.Table.from_batches([batch])
                rest = table if rest is None else pa.concat_tables([rest, table])
            if rest is None or not rest.num_rows:
                continue
            names = np.stack([rest.column(c).to_numpy() for c in own], 1)
            cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1).tolist(), len(names)]
            if batch is not None:
                cuts.pop()  # the last block may go on in the next batch
            found = [within(rest.slice(a, b - a)) for a, b in zip(cuts, cuts[1:])]
            rest = rest.slice(cuts[-1])
            if found:
                p = np.unique(np.concatenate(found), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], ["a", "b"])

    def within(block: pa.Table) -> np.ndarray:
        side, doc, size, place, component = (block.column(c).to_numpy() for c in ("side", "doc", "size", "place", "component"))
        asks, asked, found = np.flatnonzero(side == 0), np.flatnonzero(side == 1), [np.zeros((0, 2), np.int64)]
        for at in range(0, len(asks), 256):
            i, j = asks[at : at + 256, None], asked[None]
            later = (size[j] < size[i]) | ((size[j] == size[i]) & (doc[j] < doc[i]))
            x, y = np.nonzero(later & (component[i] != component[j]) & may_link(size[i], place[i], size[j], place[j], percent))
            found.append(np.column_stack([i[x, 0], asked[y]]))
        x, y = np.concatenate(found).T
        near = near_enough(size[x] + size[y], least_differences(block.column("sketch").to_pylist(), x, y), percent) if len(x) else np.zeros(0, bool)
        x, y = doc[x[near]], doc[y[near]]
        return np.column_stack([np.minimum(x, y), np.maximum(x, y)])

    return rows.repartition(*own).sortWithinPartitions(*own, "side").mapInArrow(look, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, *, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    texts = documents(docs)
    scanned = written(scan(texts))
    sets = scanned.where("slice is null").select("doc_id", "n", "f1", "f2")
    sketches = scanned.where("slice is null and doc_id is not null and n > 0").select("doc_id", "n", "sketch")
    counts = bucket_counts(scanned)
    parts = max(64, int(counts.sum() * (100 - percent) / 100 / JOINED))
    found = written(candidates(packed_prefixes(texts, counts, parts, percent), parts, percent))
    # equal sets: each is linked to the smallest id that has it, and only that takes part
    groups = sets.where(F.col("doc_id").isNotNull() & (F.col("n") > 0)).groupBy("f1", "f2").agg(F.min("doc_id").alias("a"), F.count("*").alias("many")).where("many > 1")
    equal = written(sets.where(F.col("n") > 0).join(groups.drop("many"), ["f1", "f2"]).select("a", F.col("doc_id").alias("b")).where("a <> b").distinct())
    as_first = lambda c: equal.select(F.col("b").alias(c), F.col("a").alias(f"{c}_first"))
    members = found.where("b is null").select(F.col("a").alias("doc"), "key", "size", "place").join(as_first("doc"), "doc", "left")
    members = written(members.select(F.coalesce("doc_first", "doc").alias("doc"), "key", "size", "place").distinct())
    some = written(different_groups(members))
    small = found.where("b is not null").select("a", "b").join(as_first("a"), "a", "left").join(as_first("b"), "b", "left")
    small = small.select(F.coalesce("a_first", "a").alias("a"), F.coalesce("b_first", "b").alias("b")).where("a <> b").select(*pair_columns("a", "b"))
    pairs = written(may_be_near(small.union(star_pairs(some, percent)).distinct(), sketches, percent))
    discard(found, members)
    edges = written(verified(texts, pairs, percent).union(equal))
    named = written(components(edges))
    # pairs that were verified before do not link their components
    across = written(pairs_across(some, named, sketches, percent).join(pairs, ["a", "b"], "left_anti"))
    discard(pairs, edges, some)
    if not across.isEmpty():
        name = lambda c: named.select(F.col("node").alias(c), F.col("component").alias(f"{c}_name"))
        more = written(verified(texts, across, percent))
        joined = more.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("a_name", "a").alias("a"), F.coalesce("b_name", "b").alias("b"))
        wider = components(joined).select(F.col("node").alias("component"), F.col("component").alias("wider"))
        alone = joined.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("component"))
        both = named.union(alone.join(named.select("node"), "node", "left_anti"))
        named = both.join(wider, "component", "left").select("node", F.coalesce("wider", "component").alias("component"))
    of = named.withColumnRenamed("node", "doc_id")
    return sets.join(of, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One row for each component, that of its smallest id, with the columns of
    ``docs``; of rows that repeat that id, the one whose text comes first. Rows with a
    null id stay. Only rows that may go, or whose id is repeated, are shuffled."""
    found = written(near_duplicates(docs, **options).where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("component_id").alias("component_id"), F.count("*").alias("rows")))
    unsure = found.where("doc_id <> component_id or rows > 1").select(F.col("doc_id").alias("id"))
    bits = bits_of(unsure.select(F.xxhash64("id").alias("h")))
    rows = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("document"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("doc_id").cast("long")).alias("h"))
    null = F.col("id").isNull()
    sure = marked(rows.where(~null), bits, wanted=False).select("document.*")
    first = found.where("doc_id = component_id").select(F.col("doc_id").alias("id"))
    turn = F.row_number().over(Window.partitionBy("id").orderBy("document.text"))
    rest = marked(rows.where(~null), bits).join(first, "id", "left_semi").withColumn("turn", turn).where("turn = 1").select("document.*")
    return sure.unionByName(rest).unionByName(docs.where(F.col("doc_id").isNull()))
