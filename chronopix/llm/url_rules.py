"""URL filtering by association rules.

A URL is a set of tokens: its scheme, the labels of its host, the segments of its path,
the ending of its last segment and the keys of its query. FP-growth mines which
combinations of tokens occur often enough among labelled URLs together with a verdict.
A combination of up to LONGEST tokens becomes a rule if its verdict holds for a share of
``confidence`` of the labelled URLs that have it, and if no part of it is a rule for the
same verdict that is as sure. Rules are listed by their rarest token, so a URL is tried
against those only whose rarest token it has, and the surest that fits decides.

Fixed rules come first. They are also the examples that are never in doubt: what they
decide is labelled by them, all else by the given labels.

Every token that is common among the labelled URLs counts, however many a URL has. FP-growth
has no limit to the size of what it mines, so it takes the URLs of at most BASKET common tokens;
what longer ones have is counted outright, together with the same combinations of the short
ones, so that all counts are those of all labelled URLs. A long URL of m common tokens costs
some m^3 / 6 rows of a shuffle. At most (tokens of a URL, on average) / ``support`` tokens are common,
whatever the number of URLs; matching takes all tokens of every URL.

Defined cases: a null URL and one without ``://`` have an empty host and path, and only
fixed rules for all hosts would fit them; the verdict is then ``allow``, as where no rule
fits; without labels, or with too few, nothing is mined; ids may be null or repeat, each
row is judged for itself; labels may be null or repeat, of several the one that
blocks counts; of rules that are equally sure the one seen more often decides, then the
first in alphabetical order; columns but page_id and url are not read; an empty table
gives no rows."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations, islice

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronopix.llm._common import discard, written
from chronopix.session import ship_code

#: Tokens of a rule and of a basket for FP-growth at most, and examples of a rule at least.
LONGEST, BASKET, LEAST = 3, 12, 5
#: Combinations that are handed to Spark at once.
ROWS = 1 << 14
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed rules of the query: a verdict, and a host followed by the start of a path.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def parts(url: Column) -> tuple[Column, Column]:
    """Host, in small letters, and path."""
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    after = F.coalesce(after, F.lit(""))
    return F.translate(F.regexp_extract(after, "^[^/?#]*", 0), CAPITALS, SMALL), F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits: a struct of ``verdict`` and ``rule``, or null."""
    found = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        own, slash, start = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}") if own else F.lit(True)) & path.startswith(slash + start)
        found.append(F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))))
    return F.coalesce(*found) if found else F.lit(None).cast("struct<verdict:string,rule:string>")


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The distinct tokens of a URL."""
    named = lambda kind, values: F.transform(F.filter(values, lambda v: v != ""), lambda v: F.concat(F.lit(f"{kind}:"), v))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    ending = r"\.([A-Za-z0-9]+)$"
    scheme = F.when(F.instr(url, "://") > 1, F.substring_index(url, "://", 1)).otherwise("")
    return F.array_distinct(F.concat(
        named("scheme", F.array(F.coalesce(scheme, F.lit("")))), named("host", F.split(host, r"\.")), named("path", F.split(F.regexp_replace(path, ending, ""), "/")), named("ending", F.array(F.regexp_extract(path, ending, 1))), named("query", keys)
    ))


def common_tokens(examples: DataFrame, least: int, vocabulary: int | None = None) -> list[str]:
    """Tokens of ``least`` examples or more; with ``vocabulary`` no more than so many, first
    those of most examples."""
    counts = examples.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.col("n").desc(), "token")
    return [r["token"] for r in (counts if vocabulary is None else counts.limit(vocabulary)).collect()]


def baskets(examples: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``items``: all tokens of each example in the vocabulary, sorted; and its ``verdict``."""
    shared = examples.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            items = [sorted(t for t in own if t in known) for own in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.list_(pa.string())), batch.column("verdict")], ["items", "verdict"])

    return examples.select("tokens", "verdict").mapInArrow(run, "items array<string>, verdict string")


def parts_of(own: DataFrame) -> DataFrame:
    """All combinations of up to LONGEST items of each basket, and its verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for items, verdict in zip(batch.column("items").to_pylist(), batch.column("verdict").to_pylist(), strict=True):
                found = chain.from_iterable(combinations(items, k) for k in range(1, LONGEST + 1))
                while some := list(islice(found, ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.list_(pa.string())), pa.array([verdict] * len(some), pa.string())], ["items", "verdict"])

    return own.select("items", "verdict").mapInArrow(run, "items array<string>, verdict string")


def frequent_sets(own: DataFrame, least: int) -> DataFrame:
    """``items``, ``verdict`` and ``n`` of all combinations of up to LONGEST items in ``least``
    baskets or more: of all of them where ``verdict`` is null, else of those with it."""
    short, long = own.where(F.size("items") <= BASKET), own.where(F.size("items") > BASKET)
    n, is_verdict = short.count(), lambda i: i.startswith("verdict:")
    if n:
        model = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / n), minConfidence=1.0).fit(short.select(F.array_append("items", F.concat(F.lit("verdict:"), "verdict")).alias("items")))
        sets = model.freqItemsets.select(F.array_sort(F.filter("items", lambda i: ~is_verdict(i))).alias("items"), F.substring(F.get(F.filter("items", is_verdict), F.lit(0)), len("verdict:") + 1, 1 << 20).alias("verdict"), F.col("freq").cast("long").alias("n"))
        sets = sets.where(F.size("items").between(1, LONGEST) & (F.col("n") >= least))
    else:
        sets = own.sparkSession.createDataFrame([], "items array<string>, verdict string, n long")
    if long.isEmpty():
        return sets
    # what a long basket has is counted in all of them; the rest is in short ones only
    counted = lambda df: df.groupBy("items", "verdict").agg(F.count("*").alias("n"))
    of_long = written(counted(parts_of(long)))
    theirs = of_long.select("items").distinct()
    of_short = counted(parts_of(short).join(theirs, "items", "left_semi"))
    both = written(of_long.union(of_short).groupBy("items", "verdict").agg(F.sum("n").alias("n")))
    whole = both.groupBy("items").agg(F.lit(None).cast("string").alias("verdict"), F.sum("n").alias("n"))
    return sets.join(theirs, "items", "left_anti").unionByName(both.unionByName(whole).where(F.col("n") >= least))


def mined_rules(examples: DataFrame, support: float, confidence: float, vocabulary: int | None = None) -> DataFrame:
    """``items``, ``verdict``, ``n`` (examples with all items), ``share`` (of these, those
    with the verdict), from examples with ``tokens`` and ``verdict``."""
    spark = examples.sparkSession
    many = examples.count()
    least = max(LEAST, -int(-many * support // 1))
    words = common_tokens(examples, least, vocabulary) if many else []
    if not words:
        return spark.createDataFrame([], "items array<string>, verdict string, n long, share double")
    sets = written(frequent_sets(written(baskets(examples, words)), least))
    whole = sets.where("verdict IS NULL").select("items", "n")
    some = sets.where("verdict IS NOT NULL").select("items", "verdict", F.col("n").alias("with_verdict"))
    sure = some.join(whole, "items").withColumn("share", F.col("with_verdict") / F.col("n")).where(F.col("share") >= confidence)
    # a rule goes where a part of it is as sure
    size, item = F.size("items"), lambda i: F.get("items", F.lit(i))
    singles = F.when(size > 1, F.transform("items", lambda i: F.array(i)))
    pairs = F.when(size > 2, F.array(F.array(item(0), item(1)), F.array(item(0), item(2)), F.array(item(1), item(2))))
    inside = F.concat(F.coalesce(singles, F.array().cast("array<array<string>>")), F.coalesce(pairs, F.array().cast("array<array<string>>")))
    part = sure.select(F.col("items").alias("part"), "verdict", F.col("share").alias("part_share"))
    weaker = sure.select("items", "verdict", "share", F.explode(inside).alias("part")).join(part, ["part", "verdict"]).where("part_share >= share").select("items", "verdict").distinct()
    return sure.join(weaker, ["items", "verdict"], "left_anti").select("items", "verdict", "n", "share")


def inverted_index(rules: list, vocabulary: dict[str, int]) -> dict[str, list[tuple[int, frozenset[str]]]]:
    """For each token the rules of which it is the rarest, the surest first, by place."""
    out: dict[str, list[tuple[int, frozenset[str]]]] = {}
    for place, r in enumerate(rules):
        out.setdefault(min(r["items"], key=lambda t: (vocabulary.get(t, 0), t)), []).append((place, frozenset(r["items"])))
    return out


def first_fit(own: list[str], index: dict[str, list[tuple[int, frozenset[str]]]]) -> int | None:
    """Place of the surest rule all of whose tokens a URL has."""
    found, have = None, set(own)
    for t in own:
        for place, items in index.get(t, ()):
            if found is not None and place >= found:
                break
            if items <= have:
                found = place
                break
    return found


def judge(pages: DataFrame, labels: DataFrame | None = None, *, rules: list[tuple[str, str]] = RULES, support: float = 0.002, confidence: float = 0.75, vocabulary: int | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, mined, share for every page; ``labels`` has an
    id ``page_id`` and a boolean ``blocked``."""
    ship_code(pages.sparkSession)
    host, path = parts(F.col("url"))
    cut = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).withColumns({"host": host, "path": path})
    cut = cut.withColumns({"fixed": fixed_rule(F.col("host"), F.col("path"), rules), "tokens": tokens(F.col("url"), F.col("host"), F.col("path"))})
    examples = cut.where("fixed IS NOT NULL").select("tokens", F.col("fixed.verdict").alias("verdict"))
    if labels is not None:
        told = labels.select(F.col("page_id").cast("long").alias("page_id"), "blocked").where("page_id IS NOT NULL AND blocked IS NOT NULL").groupBy("page_id").agg(F.max("blocked").alias("blocked"))
        others = cut.where("fixed IS NULL").join(told, "page_id").select("tokens", F.when(F.col("blocked"), "block").otherwise("allow").alias("verdict"))
        examples = examples.union(others)
    examples = written(examples)
    mined = mined_rules(examples, support, confidence, vocabulary)
    found = mined.orderBy(F.col("share").desc(), F.col("n").desc(), F.array_join("items", " ")).collect()
    seen: dict[str, int] = {}
    for r in found:
        if len(r["items"]) == 1:
            seen[r["items"][0]] = r["n"]
    discard(examples)
    shared = pages.sparkSession.sparkContext.broadcast((inverted_index(found, seen), [(r["verdict"], " ".join(r["items"]), r["share"]) for r in found]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, about = shared.value
        for batch in batches:
            fits = [first_fit(own, index) for own in batch.column("tokens").to_pylist()]
            verdict = [v or (about[f][0] if f is not None else "allow") for v, f in zip(batch.column("fixed").to_pylist(), fits, strict=True)]
            used = [None if v or f is None else about[f] for v, f in zip(batch.column("fixed").to_pylist(), fits, strict=True)]
            new = [pa.array(verdict, pa.string()), pa.array([u and u[1] for u in used], pa.string()), pa.array([u and u[2] for u in used], pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "host", "path", "rule")), *new], ["page_id", "host", "path", "rule", "verdict", "mined", "share"])

    plain = cut.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), F.col("fixed.verdict").alias("fixed"), "tokens")
    return plain.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, mined string, share double")
