"""Registered queries of the corpus operators: thin digests over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopix.llm._common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f, sql: str | None = None):
    QUERIES[f.__name__] = f
    if sql:
        ORACLE_SQL[f.__name__] = sql
    return f


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.quality_classifier import quality_classifier

    return quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.secrets import find_secrets

    return find_secrets(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


@query
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.pii import find_personal_data

    return find_personal_data(table(spark, sf_dir, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.suffix_tree import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


@query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.ngram_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_embedding_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.embedding_dedup import link_vectors

    return link_vectors(table(spark, sf_dir, "embeddings"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.centroids import lloyd

    return lloyd(table(spark, sf_dir, "embeddings"))


#: Every vector's nearest centroid c{r}, and the centroids after that.
_ROUND = """, d{r} AS (SELECT v.id, c.cluster, sum((v.x - c.x) * (v.x - c.x)) AS distance FROM v JOIN c{r} c USING (pos) GROUP BY ALL),
 a{r} AS (SELECT id, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM d{r} GROUP BY ALL)"""
_MOVE = """, c{n} AS (SELECT c.cluster, c.pos, coalesce((s - ((s % n) + n) % n) // n, c.x) AS x FROM c{r} c
 LEFT JOIN (SELECT cluster, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{r} USING (id) GROUP BY ALL) m ON m.cluster = c.cluster AND m.pos = c.pos)"""
query(
    op13_centroid_clusters,
    f"""WITH k AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
 v AS MATERIALIZED (SELECT id, vec_id, generate_subscripts(embedding, 1) AS pos, CAST(floor(64 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS x FROM k),
 f AS (SELECT id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM k ORDER BY sha256('1:' || vec_id) LIMIT 16), c0 AS (SELECT f.cluster, v.pos, v.x FROM f JOIN v USING (id))
 {"".join(_ROUND.format(r=r) + (_MOVE.format(r=r, n=r + 1) if r < 3 else "") for r in range(4))},
 h AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM c3 GROUP BY ALL)
 SELECT k.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, h.centroid_sha256
 FROM a3 a JOIN k USING (id) JOIN h ON h.cluster = a.cluster""",
)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.resampling import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
query(
    op12_importance_resampling,
    rf"""WITH m AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
 texts AS (SELECT row_number() OVER () AS id, doc_id, {_WORDS} AS w, true AS own FROM documents UNION ALL SELECT -row_number() OVER (), item_id, {_WORDS}, false FROM benchmark),
 words AS (SELECT id, own, unnest(w) AS w, generate_subscripts(w, 1) AS pos FROM texts),
 runs AS (SELECT id, own, unnest([w, w || ' ' || lead(w) OVER o, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o]) AS f FROM words WINDOW o AS (PARTITION BY id ORDER BY pos)),
 uses AS (SELECT id, own, f, count(*) AS n FROM runs WHERE f IS NOT NULL GROUP BY ALL),
 crc AS MATERIALIZED (SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(encode(f))), lambda i: CAST('0x' || hex(encode(f))[2 * i + 1 : 2 * i + 2] AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM (SELECT DISTINCT f FROM uses), m),
 cells AS MATERIALIZED (SELECT id, own, bucket, sum(n) AS n FROM uses JOIN crc USING (f) GROUP BY ALL),
 totals AS (SELECT sum(n) FILTER (own) AS s, sum(n) FILTER (NOT own) AS t FROM cells),
 gain AS (SELECT bucket, floor(1000 * ln((coalesce(sum(n) FILTER (NOT own), 0) + 1)::DOUBLE * (any_value(totals.s) + 10000)::DOUBLE / ((coalesce(sum(n) FILTER (own), 0) + 1)::DOUBLE * (coalesce(any_value(totals.t), 0) + 10000)::DOUBLE))) AS g FROM cells, totals GROUP BY bucket),
 sums AS (SELECT id, sum(n) AS n_features, sum(n * g) AS weight FROM cells JOIN gain USING (bucket) WHERE own GROUP BY id),
 scored AS (SELECT doc_id, len(w) >= 20 AS able, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
 CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' || doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM texts LEFT JOIN sums USING (id) WHERE own),
 placed AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) FILTER (able) OVER () AS n FROM scored)
 SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * n // 100 THEN place END AS rank FROM placed""",
)


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from chronopix.llm.url_rules import judge

    # labels go by a document's id: a page takes those of the document with its own
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("blocked"))
    return judge(table(spark, sf_dir, "pages"), labels)


_AFTER = "CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END"
_ALPHABETS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_ITEMS = ["a.token", "a.token || ' ' || b.token", "a.token || ' ' || b.token || ' ' || c.token"]
_JOINED = ["", " JOIN basket b ON b.id = a.id AND a.token < b.token", " JOIN basket b ON b.id = a.id AND a.token < b.token JOIN basket c ON c.id = a.id AND b.token < c.token"]
query(
    op11_url_rules,
    rf"""WITH p0 AS (SELECT row_number() OVER () AS id, page_id, coalesce(url, '') AS url, coalesce({_AFTER}, '') AS rest FROM pages),
 p AS MATERIALIZED (SELECT id, page_id, url, translate(regexp_extract(rest, '^[^/?#]*', 0), {_ALPHABETS}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p0),
 fixed AS MATERIALIZED (SELECT p.*, CASE WHEN '.' || host LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/' WHEN '.' || host LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
 WHEN '.' || host LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/' WHEN '.' || host LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM p),
 tokens AS MATERIALIZED (SELECT DISTINCT id, token FROM (SELECT id, 'scheme:' || CASE WHEN strpos(url, '://') > 1 THEN url[:strpos(url, '://') - 1] END AS token FROM fixed UNION ALL SELECT id, 'host:' || h FROM (SELECT id, unnest(string_split(host, '.')) AS h FROM fixed) WHERE h <> ''
 UNION ALL SELECT id, 'path:' || h FROM (SELECT id, unnest(string_split(regexp_replace(path, '\.([A-Za-z0-9]+)$', ''), '/')) AS h FROM fixed) WHERE h <> '' UNION ALL SELECT id, 'ending:' || h FROM (SELECT id, regexp_extract(path, '\.([A-Za-z0-9]+)$', 1) AS h FROM fixed) WHERE h <> ''
 UNION ALL SELECT id, 'query:' || h FROM (SELECT id, string_split(unnest(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&')), '=')[1] AS h FROM fixed) WHERE h <> '') WHERE token IS NOT NULL),
 told AS (SELECT doc_id, max(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS blocked FROM labels WHERE ((quality = 0) OR (toxic = 1)) IS NOT NULL GROUP BY ALL),
 examples AS MATERIALIZED (SELECT id, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN blocked THEN 'block' ELSE 'allow' END AS verdict FROM fixed LEFT JOIN told ON doc_id = page_id WHERE rule IS NOT NULL OR blocked IS NOT NULL),
 need AS (SELECT greatest(5, CAST(ceil(0.002 * count(*)) AS BIGINT)) AS least FROM examples),
 whole AS (SELECT count(*) AS many, count(*) FILTER (verdict = 'block') AS whole FROM examples),
 common AS (SELECT token, n, abs(CAST(k AS DOUBLE) * many - CAST(n AS DOUBLE) * whole) AS beyond FROM (SELECT token, count(*) AS n, count(*) FILTER (verdict = 'block') AS k FROM tokens JOIN examples USING (id) GROUP BY token), need, whole WHERE n >= least ORDER BY beyond DESC, n DESC, token LIMIT 10000),
 basket AS MATERIALIZED (SELECT id, token FROM tokens JOIN examples USING (id) JOIN common USING (token) QUALIFY row_number() OVER (PARTITION BY id ORDER BY beyond DESC, n DESC, token) <= 12),
 sets AS ({" UNION ALL ".join(f"SELECT a.id, {i} AS items, {k + 1} AS size FROM basket a{j}" for k, (i, j) in enumerate(zip(_ITEMS, _JOINED)))}),
 counts AS (SELECT items, size, verdict, count(*) AS k FROM sets JOIN examples USING (id) GROUP BY ALL), sums AS (SELECT items, sum(k) AS n FROM counts GROUP BY ALL),
 sure AS MATERIALIZED (SELECT items, size, verdict, n, CAST(k AS DOUBLE) / CAST(n AS DOUBLE) AS share FROM counts JOIN sums USING (items), need WHERE k >= least AND CAST(k AS DOUBLE) / CAST(n AS DOUBLE) >= 0.75),
 inside AS (SELECT items, verdict, share, unnest(CASE size WHEN 1 THEN [] WHEN 2 THEN s ELSE s || [s[1] || ' ' || s[2], s[1] || ' ' || s[3], s[2] || ' ' || s[3]] END) AS part FROM (SELECT *, string_split(items, ' ') AS s FROM sure)),
 rules AS MATERIALIZED (SELECT row_number() OVER (ORDER BY share DESC, n DESC, items) AS place, * FROM sure WHERE (items, verdict) NOT IN (SELECT (i.items, i.verdict) FROM inside i JOIN sure s ON s.items = i.part AND s.verdict = i.verdict WHERE s.share >= i.share)),
 needed AS (SELECT place, size, unnest(string_split(items, ' ')) AS token FROM rules), fits AS (SELECT id, place FROM needed JOIN tokens USING (token) GROUP BY id, place, size HAVING count(*) = size), first AS (SELECT id, min(place) AS place FROM fits GROUP BY id)
 SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' ELSE coalesce(verdict, 'allow') END AS verdict,
 CASE WHEN rule IS NULL THEN items END AS mined, CASE WHEN rule IS NULL THEN share END AS share FROM fixed LEFT JOIN first USING (id) LEFT JOIN rules USING (place)""",
)
