"""Crowded groups of the n-gram join: whole results, and work that grows with the texts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronopix.llm import ngram_join
from chronopix.llm._common import written
from tests.llm.test_corpus import jaccard_components


@pytest.fixture
def sent(monkeypatch):
    """Rows dealt to blocks, and pairs that a block can look at."""
    seen = []
    plain = ngram_join.blocks_across

    def counted(*args):
        rows = written(plain(*args))
        by = rows.groupBy("key", "lot", "kind", "left", "right").agg(F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b"))
        seen.append((rows.count(), by.agg(F.sum(F.col("a") * F.col("b"))).first()[0] or 0, by.agg(F.max(F.col("a") + F.col("b"))).first()[0] or 0))
        return rows

    monkeypatch.setattr(ngram_join, "blocks_across", counted)
    return seen


def around(passage, own, seed=1):
    """Texts that share a passage and have words of their own."""
    rng = np.random.default_rng(seed)
    return [(i, " ".join([*passage, *[f"w{x}" for x in rng.integers(0, 10**9, n)]])) for i, n in enumerate(own)]


@pytest.mark.parametrize(("least", "most"), [(24, 25), (13, 40), (2, 40)])
def test_texts_around_a_passage(spark, sent, least, most):
    """Most of these link with nothing, though all share one passage: they aren't copied
    or paired."""
    passage = [f"p{i}" for i in range(77)]
    rng = np.random.default_rng(2)
    for n in (1000, 2000):
        rows = around(passage, rng.integers(least, most, n))
        got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
        if n == 1000:
            assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard_components(rows)
    rows, pairs, widest = zip(*sent, strict=True)
    assert all(r <= 0.5 * n and w <= 2 * ngram_join.BLOCK for r, w, n in zip(rows, widest, (1000, 2000), strict=True))
    assert all(p <= 50 * n for p, n in zip(pairs, (1000, 2000), strict=True))


@pytest.mark.parametrize("block", [7, 2048])
def test_pairs_between_components(spark, monkeypatch, block):
    """Of two groups, whatever the blocks, all pairs in different components that pass all
    filters, and no others."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = np.random.default_rng(3)
    base, docs = rng.integers(0, 2**62, 60), []
    for i in range(260):
        own = np.unique(np.concatenate([rng.choice(base, rng.integers(30, 58), replace=False), rng.integers(0, 2**62, rng.integers(0, 6))]).astype(np.uint64))
        docs.append((i, len(own), int(rng.integers(0, 8)), int(rng.choice([0, 0, 0, rng.integers(1, 40)])), own))
    keys = {11: range(200), 12: range(150, 260), 13: [3]}
    members = spark.createDataFrame([(i, k, docs[i][1], docs[i][2]) for k, own in keys.items() for i in own], "doc long, key long, size int, place int")
    named = spark.createDataFrame([(i, 1000 + c) for i, _, _, c, _ in docs if c < 30], "node long, component long")
    sketches = spark.createDataFrame([(i, n, ngram_join.sketch_of(own)) for i, n, _, _, own in docs], "doc_id long, n long, sketch binary")
    component = {i: 1000 + c if c < 30 else i for i, _, _, c, _ in docs}
    want = set()
    for own in keys.values():
        for i in own:
            for j in own:
                (_, n1, p1, _, s1), (_, n2, p2, _, s2) = docs[i], docs[j]
                if i < j and component[i] != component[j] and ngram_join.may_link(np.int64(n1), p1, np.int64(n2), p2, 75):
                    apart = ngram_join.least_differences([ngram_join.sketch_of(s1), ngram_join.sketch_of(s2)], np.array([0]), np.array([1]))
                    if ngram_join.near_enough(np.array([n1 + n2]), apart, 75)[0]:
                        want.add((i, j))
    assert len(want) > 300
    assert {(r.a, r.b) for r in ngram_join.pairs_across(members, named, sketches, 75).collect()} == want
    dealt = ngram_join.blocks_across(members, named, 75)
    widest = dealt.groupBy("key", "lot", "kind", "left", "right").count().agg(F.max("count")).first()[0]
    assert widest <= 2 * block + 40


def test_bounds_of_a_partners_size():
    """What blocks are dealt by agrees with the filters on each pair of sizes and places."""
    n, p = np.meshgrid(np.arange(1, 40), np.arange(0, 12))
    n, p = n[p < n], p[p < n]
    least, most = -(-75 * n // 100), (100 * n - 175 * p) // 75
    x, y = np.meshgrid(np.arange(len(n)), np.arange(len(n)))
    want = ngram_join.may_link(n[x], p[x], n[y], p[y], 75)
    assert np.array_equal(want, (n[y] >= least[x]) & (n[x] >= least[y]) & (n[y] <= most[x]) & (n[x] <= most[y]))


def below_broadcasts(plan):
    """The operators of a physical plan that stand below an exchange that broadcasts."""
    inside, found = None, []
    for line in plan.splitlines():
        name = line.lstrip(" :+-*()0123456789")
        depth = len(line) - len(name)
        if inside is not None and depth > inside:
            found.append(name)
        else:
            inside = depth if name.startswith("BroadcastExchange") else None
    return found


@pytest.mark.parametrize("sent", [0, 8 << 20])
def test_exploded_cells_are_not_broadcast(spark, monkeypatch, sent):
    """Spark takes the table of visits for as small as that of vectors, and would send it to the driver."""
    from chronopix.llm import embedding_dedup

    plans = []

    def noted(df, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, **options)

    monkeypatch.setattr(embedding_dedup, "written", noted)
    monkeypatch.setattr(embedding_dedup, "SENT", sent, raising=False)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 8))
    rows = [(i, (base[i % 40] + 0.1 * rng.normal(size=8)).tolist(), i % 2) for i in range(600)]
    got = embedding_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    plans.append(got._jdf.queryExecution().executedPlan().toString())
    unit = np.array([x for _, x, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (np.arange(600)[:, None] % 2 == np.arange(600) % 2)
    assert {r.vec_id: r.n_links for r in got.collect()} == dict(enumerate((near.sum(1) - 1).tolist()))
    assert any("Generate" in p for p in plans)
    assert not [x for p in plans for x in below_broadcasts(p) if "Generate" in x]
    assert sent or not any("BroadcastExchange" in p for p in plans[:-1])


def test_a_sample_is_merged_from_few_rows(spark):
    """The driver merges what each task finds: of the smallest hashes, few others come along."""
    from chronopix.llm.embedding_dedup import first_by_hash

    rows = spark.range(0, 40_000, 1, 50).select(F.xxhash64("id").alias("h"), F.col("id").alias("first"))
    got = first_by_hash(rows, 40_000, 500)
    assert got.collect() == rows.orderBy("h", "first").limit(500).collect()
    plan = got._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() not in ("Sort",):
        plan = plan.children().apply(0)
    merged = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan).count()
    assert 500 <= merged <= 1000
