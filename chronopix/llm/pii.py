"""Personal data: information-theoretic sanitisation.

Base patterns find protected entities (e-mail addresses, IP addresses, card and
phone numbers). Then the corpus tells which words give an entity away: for an entity
e in n(e) of N documents and a term t in n(t), of which n(e,t) hold both anywhere, the
pointwise mutual information log2(N * n(e,t) / (n(e) * n(t))) is set against the
entity's information log2(N / n(e)). Where the ratio reaches ``disclosure`` and at
least ``support`` documents bear it out, the term almost names the entity, and each of
its occurrences outside entities, in every document, is reported as a ``term`` span,
to be removed with the entity. Words inside an entity are terms like others.

All of it is DataFrame expressions. Spans are found inside each row; word counts are
summed before they move. Pairs are formed only of entities and words that can still
reach support and ratio by their own counts, which loses no pair.

Defined cases: a null or empty text has no spans; repeated rows are documents of
their own, ids may be null or repeat; texts of any length are taken whole; parts of IP
addresses are read as numbers whatever their leading zeros; words are compared in lower
case, as Spark's ``lower`` makes it of the word alone; ratios that tie with the threshold
count as reaching it; positions are code points, ends exclusive; an empty table gives no
rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronopix.llm._common import documents, materialise, written
from chronopix.llm.quality_rules import let

#: Patterns in the order in which kinds are listed. Repeats that can't give anything
#: back are possessive, and a look-behind or \G keeps the search linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold before its pattern is tried.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
WORD = r"[\p{L}\p{N}]+"
SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"


def located(text: Column, pattern: str) -> Column:
    """All matches as (start, value): lengths of gaps and matches added up. The sums
    run in blocks, so that a text with very many matches is not copied for each."""
    block = 256
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), 0).alias("m"), F.split(text, pattern, -1).alias("g"))
    none = F.array().cast("array<struct<start:bigint,value:string>>")

    def steps(x: Column) -> Column:
        n = F.size(x["m"])

        def one(acc: Column, i: Column) -> Column:
            start = acc["pos"] + F.length(F.get(x["g"], i))
            value = F.get(x["m"], i)
            return F.struct((start + F.length(value)).alias("pos"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), value.alias("value")))).alias("out"))

        def many(acc: Column, first: Column) -> Column:
            inner = F.aggregate(F.sequence(first, F.least(first + block, n) - 1), F.struct(acc["pos"].alias("pos"), none.alias("out")), one)
            return let(inner, lambda y: F.struct(y["pos"].alias("pos"), F.concat(acc["out"], F.array(y["out"])).alias("out")))

        zero = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast("array<array<struct<start:bigint,value:string>>>").alias("out"))
        blocks = F.aggregate(F.sequence(F.lit(0), n - 1, F.lit(block)), zero, many, lambda a: F.flatten(a["out"]))
        return F.when(n == 0, none).otherwise(blocks)

    return let(both, steps)


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        x = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * (i % 2 + 1)
        return total + F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Valid matches of all kinds, in the order of kinds and starts."""
    none = F.array().cast(SPAN)

    def of(kind: str) -> Column:
        found = F.filter(located(text, PATTERNS[kind]), lambda s: valid(kind, s["value"]))
        span = lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), (s["start"] + F.length(s["value"])).alias("end"), s["value"].alias("value"))
        return F.when(text.rlike(HINTS[kind]), F.transform(found, span)).otherwise(none)

    return F.concat(*[of(k) for k in PATTERNS])


def terms_of(text: Column) -> Column:
    """Different words of a text in lower case."""
    return F.array_distinct(F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), 0)), F.lower))


def with_entities(texts: DataFrame) -> DataFrame:
    """row, doc_id, text, spans and the different entities of each text."""
    found = texts.select("row", "doc_id", "text", base_spans(F.col("text")).alias("spans"))
    entity = lambda s: F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))
    spans = F.transform("spans", lambda s: s.dropFields("value"))
    return found.select("row", "doc_id", "text", spans.alias("spans"), F.array_distinct(F.transform("spans", entity)).alias("entities"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def revealing_terms(found: DataFrame, disclosure: float, support: int) -> DataFrame:
    """term: words whose mutual information with any entity reaches the threshold."""
    # a single row: the size of the broadcast is known
    total = F.broadcast(found.agg(F.count("*").alias("total")))
    held = found.select("row", F.explode("entities").alias("entity"))
    # n(e,t) <= n(e), so the ratio is out of reach for words in more documents than this
    most = F.pow("total", F.lit(1 - disclosure)) * F.pow("n_e", F.lit(disclosure)) * (1 + 1e-9)
    entities = held.groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= support)
    entities = materialise(entities.join(total).where(F.col("n_e") < F.col("total")).withColumn("most", most))
    words = found.select(F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t")).where(F.col("n_t") >= support)
    # in Parquet, so that the size is known and small tables are broadcast
    words = written(words.join(F.broadcast(entities.agg(F.max("most").alias("any")))).where(F.col("n_t") <= F.col("any")).drop("any"))
    held = held.join(entities, "entity")
    beside = found.where(F.size("entities") > 0).select("row", F.explode(terms_of(F.col("text"))).alias("term")).join(words, "term")
    pairs = held.join(beside, "row").where(F.col("n_t") <= F.col("most")).groupBy("entity", "n_e", "term", "n_t", "total").agg(F.count("*").alias("n_et"))
    known, about = F.log2(F.col("total") * F.col("n_et") / (F.col("n_e") * F.col("n_t"))), F.log2(F.col("total") / F.col("n_e"))
    return pairs.where((F.col("n_et") >= support) & (known >= disclosure * about)).select("term").distinct()


def with_terms(docs: DataFrame, disclosure: float, support: int) -> DataFrame:
    """doc_id, text, ``spans`` of entities and ``terms`` that disclose an entity, of every row."""
    texts = documents(docs).withColumn("row", F.monotonically_increasing_id())
    found = written(with_entities(texts))
    revealing = written(revealing_terms(found, disclosure, support))
    holders = found.select("row", F.explode(terms_of(F.col("text"))).alias("term")).join(revealing, "term").groupBy("row").agg(F.collect_set("term").alias("held"))
    free = lambda w: ~F.exists("spans", lambda s: (w["start"] < s["end"]) & (w["start"] + F.length(w["value"]) > s["start"]))
    marked = F.filter(located(F.col("text"), WORD), lambda w: F.array_contains("held", F.lower(w["value"])) & free(w))
    terms = F.transform(marked, lambda w: F.struct(F.lit("term").alias("kind"), w["start"].alias("start"), (w["start"] + F.length(w["value"])).alias("end")))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return found.join(holders, "row", "left").select("doc_id", "text", "spans", F.when(F.col("held").isNull(), none).otherwise(terms).alias("terms"))


def find_personal_data(docs: DataFrame, *, disclosure: float = 0.9, support: int = 3) -> DataFrame:
    """doc_id, counts and digest of the base spans, and all spans with the terms that
    disclose an entity (kind ``term``, listed last)."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return with_terms(docs, disclosure, support).select(
        "doc_id", *[count(k) for k in PATTERNS], F.sha2(listed(F.col("spans")), 256).alias("base_sha256"), listed(F.concat("spans", "terms")).alias("spans"), F.size("terms").cast("long").alias("n_term")
    )


def sanitise(docs: DataFrame, *, disclosure: float = 0.9, support: int = 3) -> DataFrame:
    """doc_id and text of every row, with entities generalised to their kind and disclosing
    terms removed. Each row is changed by its own spans, so ids may be null or repeat."""

    def put(acc: Column, s: Column) -> Column:
        mark = F.when(s["kind"] == "term", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (F.greatest(s["start"] - acc["at"], F.lit(0))).cast("int"))
        # what overlaps a span before it goes too, without a mark of its own
        over = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, mark).alias("out"))).otherwise(over)

    by_start = F.array_sort(F.transform(F.concat("spans", "terms"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    done = F.aggregate(by_start, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), put, lambda a: F.concat(a["out"], F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.length("text"))))
    return with_terms(docs, disclosure, support).select("doc_id", done.alias("text"))
