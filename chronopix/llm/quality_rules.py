"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Every text gets plain statistics; two fixed rules reject at once. The others are
judged by four transformed statistics (word length, symbols, repeated lines and
repeated words, as logarithms). For each language and source the centre and the
covariance are estimated from the three quarters of its documents that lie closest
together: starting at medians and median deviations, each concentration step
refits to the documents of least distance, which never raises the covariance's
determinant. The estimate of a source is mixed with its language's, and that of a language
with that of all documents, half and half at ``prior`` documents, so small groups lean on
the wider one and large ones stand alone, without a limit in between. A document is
rejected if its squared Mahalanobis distance is above ``cutoff``.

All of it is DataFrame expressions. Statistics are computed inside each row, so no
text is shuffled; statistics are kept at multiples of 1/1024, so sums do not depend
on the order of rows; quantiles come from counts over bins, which are summed before
they are shuffled, so a source that holds a third of all rows is no hot spot.

Defined cases: a null or empty text has no words and fails the fixed rules; null
languages and sources form groups of their own; texts of any length are taken whole;
repeated rows are judged alike, ids may be null or repeat; where distances tie at the
share, all that tie are taken; an empty table gives no rows; columns other than doc_id,
text, lang and source are not read. Repeated word windows are found by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronopix.llm._common import SPACE, quoted, written

WINDOW = 8
DIM = 4
#: Least standard deviation of each transformed statistic: word length, symbols, repeated lines, repeated words.
#: It takes the place of a smaller one only. The last two can be as far off as log(101)
#: and log(31); among documents without any, about one repeated line or word in ten is too much.
FLOOR = (0.12, 0.35, 0.5, 0.5)
#: The share of documents that estimates rest on, and the factor that makes the
#: covariance of that share consistent at the normal distribution in DIM dimensions.
SHARE, CONSISTENT = 0.75, 1.488
GRID = 1024.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for use in ``body``, also inside further lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def covered_words(positions: Column) -> Column:
    """Words under windows that begin at the given sorted positions."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    step = lambda a, p: F.struct((a["n"] + WINDOW - F.greatest(a["end"] - p, F.lit(0))).alias("n"), (p + WINDOW).alias("end"))
    return F.aggregate(positions, start, step, lambda a: a["n"])


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of WINDOW words that occurs twice or more."""

    def of_windows(windows: Column) -> Column:
        pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        alike = lambda s, i: lambda x: F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))
        twice = let(pairs, lambda s: F.filter(s, lambda x, i: alike(s, i - 1)(x) | alike(s, i + 1)(x)))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(covered_words(F.array_sort(F.transform(twice, lambda x: x["p"]))))

    def of_hashes(h: Column) -> Column:
        return let(F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])), of_windows)

    return F.when(F.size(words) <= WINDOW, 0).otherwise(let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes))


def text_statistics(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, lang, source and the statistics of every whole text, and ``more`` columns."""
    column = lambda c: (F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")).alias(c)
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    # one generated row holds the word and line arrays, so that neither is built twice
    in_words = let(words, lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("r")))
    dup_lines = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    bare = F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    got = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), column("lang"), column("source"), in_words.alias("w"), dup_lines.cast("long").alias("n_dup_lines"), bare.cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"), *more
    )
    n, r = F.col("w.n").cast("long"), F.col("w.r").cast("long")
    rest = got.columns[len(got.columns) - len(more) :] if more else []
    return got.select(*rest, "doc_id", "lang", "source", n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", r.alias("n_repeat_words"), ((n < 20) | (100 * r > 30 * n)).alias("base_failed"))


def transformed(stats: DataFrame) -> DataFrame:
    """The four transformed statistics, at multiples of 1/GRID."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    raw = [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), *[F.log1p(100.0 * F.col(c) / n) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")]]
    return stats.withColumns({f"x{i}": F.round(x * GRID) / GRID for i, x in enumerate(raw)})


def with_levels(df: DataFrame) -> DataFrame:
    """Each row three times: for its language and source, for its language, and for all."""
    lang, source = F.coalesce("lang", F.lit("\0")), F.coalesce("source", F.lit("\0"))
    return df.withColumn("level", F.explode(F.array(F.lit(0), F.lit(1), F.lit(ALL)))).withColumn("of", F.when(F.col("level") == 0, F.concat(lang, F.lit("\1"), source)).when(F.col("level") == 1, lang).otherwise(""))


KEY, ALL = ["level", "of"], 2


def beside(rows: DataFrame, few: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Rows with what ``few`` has for their group. The one group of all rows is not
    dealt by its key, as it would land in one task."""
    groups = rows.where(F.col("level") != ALL).join(few.where(F.col("level") != ALL), keys)
    return groups.unionByName(rows.where(F.col("level") == ALL).join(F.broadcast(few.where(F.col("level") == ALL)), keys))


def bin_reached(df: DataFrame, value: Column, keys: list[str], share: float, name: str) -> DataFrame:
    """For each key the least bin at or under which ``share`` of the rows lie."""
    counts = df.groupBy(*keys, value.alias("bin")).count()
    upto, total = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*keys)
    ranked = counts.select(*keys, "bin", F.sum("count").over(upto).alias("upto"), F.sum("count").over(total).alias("total"))
    return ranked.where(F.col("upto") >= F.ceil(F.col("total") * share)).groupBy(*keys).agg(F.min("bin").alias(name))


def spread(df: DataFrame) -> DataFrame:
    """One row for each statistic of each row."""
    return df.select(*KEY, F.posexplode(F.array(*[F.col(f"x{i}") for i in range(DIM)])).alias("i", "x"))


def start_estimates(points: DataFrame) -> DataFrame:
    """Medians and median deviations as centre ``m`` and factor ``l`` (row-wise lower triangle)."""
    long = spread(points)
    median = bin_reached(long, F.round(F.col("x") * 64), [*KEY, "i"], 0.5, "mid")
    far = beside(long, median, [*KEY, "i"]).withColumn("off", F.abs(F.col("x") - F.col("mid") / 64))
    mad = bin_reached(far, F.ceil(F.col("off") * 64), [*KEY, "i"], 0.5, "mad")
    both = median.join(mad, [*KEY, "i"]).groupBy(*KEY).agg(*[F.max(F.when(F.col("i") == i, F.col(c) / 64)).alias(f"{c}{i}") for i in range(DIM) for c in ("mid", "mad")])
    deviation = lambda i: F.greatest(1.4826 * F.col(f"mad{i}"), F.lit(FLOOR[i]))
    return both.select(*KEY, *[F.col(f"mid{i}").alias(f"m{i}") for i in range(DIM)], *[(deviation(i) if i == j else F.lit(0.0)).alias(f"l{i}{j}") for i in range(DIM) for j in range(i + 1)])


def distance(df: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d2`` by forward substitution with the Cholesky factor."""
    for i in range(DIM):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"y{j}")
        df = df.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    return df.withColumn("d2", sum((F.col(f"y{i}") ** 2 for i in range(1, DIM)), F.col("y0") ** 2)).drop(*[f"y{i}" for i in range(DIM)])


MOMENTS = ["n", *[f"m{i}" for i in range(DIM)], *[f"c{i}{j}" for i in range(DIM) for j in range(i + 1)]]


def moments(points: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step: number, means ``m`` and covariances ``c`` of the SHARE of
    least distance."""
    near = distance(beside(points, estimates)).select(*KEY, *[f"x{i}" for i in range(DIM)], F.floor(F.log1p("d2") * 64).alias("bin"))
    limit = bin_reached(near, F.col("bin"), KEY, SHARE, "limit")
    half = beside(near, limit).where(F.col("bin") <= F.col("limit"))
    sums = half.groupBy(*KEY).agg(
        F.count("*").alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(DIM)], *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i in range(DIM) for j in range(i + 1)]
    )
    got = sums.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(DIM)})
    return got.select(*KEY, "n", *[f"m{i}" for i in range(DIM)], *[(CONSISTENT * (F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))).alias(f"c{i}{j}") for i in range(DIM) for j in range(i + 1)])


def factored(got: DataFrame) -> DataFrame:
    """Centres and Cholesky factors of moments, with FLOOR in the place of smaller deviations."""
    for i in range(DIM):
        for j in range(i + 1):
            rest = F.greatest(F.col(f"c{i}{j}"), F.lit(FLOOR[i] ** 2)) if i == j else F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            got = got.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(FLOOR[i] ** 2 / 4))) if i == j else rest / F.col(f"l{j}{j}"))
    return got.drop(*MOMENTS[1 + DIM :], "n")


def shrunk(groups: DataFrame, wider: DataFrame, prior: float) -> DataFrame:
    """Moments of groups, mixed with those of the wider group ``up``: half and half at
    ``prior`` documents. The weight falls with the square of fewer ones, as in a group of a
    few documents the share that is left out is too small to keep an outlier away."""
    few = wider.select(F.col("of").alias("up"), *[F.col(c).alias(f"w_{c}") for c in MOMENTS])
    both = groups.join(few, "up")
    own = F.col("n") ** 2 / (F.col("n") ** 2 + prior**2)
    apart = [F.col(f"m{i}") - F.col(f"w_m{i}") for i in range(DIM)]
    mean = [(own * F.col(f"m{i}") + (1 - own) * F.col(f"w_m{i}")).alias(f"m{i}") for i in range(DIM)]
    around = [(own * F.col(f"c{i}{j}") + (1 - own) * F.col(f"w_c{i}{j}") + own * (1 - own) * apart[i] * apart[j]).alias(f"c{i}{j}") for i in range(DIM) for j in range(i + 1)]
    return both.select("of", "n", *mean, *around)


def estimated(stats: DataFrame, prior: float, steps: int) -> DataFrame:
    """``of`` (language and source), centre and factor for each group of the rows that
    pass the fixed rules. Groups are in a written table, so that its size is known: if
    it is small it is broadcast, otherwise Spark splits the groups that are large."""
    points = with_levels(stats.where(~F.col("base_failed"))).select(*KEY, *[f"x{i}" for i in range(DIM)])
    estimates = written(start_estimates(points))
    for _ in range(steps - 1):
        estimates = written(factored(moments(points, estimates)))
    found = written(moments(points, estimates))
    level = lambda n: found.where(F.col("level") == n)
    languages = shrunk(level(1).withColumn("up", F.lit("")), level(ALL), prior)
    sources = shrunk(level(0).withColumn("up", F.substring_index("of", "\1", 1)), languages, prior)
    return written(factored(sources))


def group_of() -> Column:
    return F.concat(F.coalesce("lang", F.lit("\0")), F.lit("\1"), F.coalesce("source", F.lit("\0"))).alias("of")


def quality_rules(docs: DataFrame, *, cutoff: float = 23.51, prior: float = 30.0, steps: int = 3) -> DataFrame:
    """doc_id, the statistics, base_failed, kept and the squared distance ``d2`` (null
    where the fixed rules reject). ``cutoff``: the 0.9999 quantile of chi-square in DIM
    dimensions; ``prior``: at how many documents a group weighs as much as the wider one."""
    stats = written(transformed(text_statistics(docs)))
    judged = distance(stats.withColumn("of", group_of()).join(estimated(stats, prior, steps), "of", "left"))
    d2 = F.when(~F.col("base_failed"), F.col("d2"))
    kept = ~F.col("base_failed") & (F.coalesce(d2, F.lit(0.0)) <= cutoff)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), d2.alias("d2"))


def kept_documents(docs: DataFrame, *, cutoff: float = 23.51, prior: float = 30.0, steps: int = 3) -> DataFrame:
    """The rows of ``docs`` that are kept, with the columns of ``docs``. Statistics are
    computed again beside each text, which is cheaper than shuffling the texts."""
    stats = written(transformed(text_statistics(docs)).select("lang", "source", "base_failed", *[f"x{i}" for i in range(DIM)]))
    rows = transformed(text_statistics(docs, F.struct(*[quoted(c) for c in docs.columns]).alias("document"))).where(~F.col("base_failed"))
    rows = rows.select("document", *[f"x{i}" for i in range(DIM)], group_of()).join(estimated(stats, prior, steps), "of", "left")
    return distance(rows).where(F.coalesce(F.col("d2"), F.lit(0.0)) <= cutoff).select("document.*")
