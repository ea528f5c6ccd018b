"""URL rules, resampling and clustering against their SQL and plain versions, on the
supplied tables and on odd ones."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronopix.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import database, rows

FOLDER = "/root/testdata/sf0.001"
CLASH = ("score", "rank", "weight", "n", "x", "known", "cluster", "tokens", "verdict", "rule", "fixed", "host", "id", "items", "_part", "a.b")


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns})


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    got, want = QUERIES[name](spark, FOLDER).toPandas(), database(FOLDER).sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


# resampling


def features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return len(words), Counter(zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1))


def resampled(docs, target):
    parts = [(i, *features(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, c in parts:
        s.update(c)
    for x in target:
        t.update(features(x)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 10_000) / ((s[b] + 1) * (t.total() + 10_000))))
    out = []
    for i, n, c in parts:
        weight = sum(k * gain(b) for b, k in c.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((n, i, c.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((o for o in out if o[0] >= 20), key=lambda o: (-o[4], o[1] is None, o[1] or 0, o[2], o[3]))
    drawn = [(*o[1:], k + 1 if k < 5 * len(able) // 100 else None) for k, o in enumerate(able)]
    return Counter(drawn + [(*o[1:], None) for o in out if o[0] < 20])


def test_resampling_of_odd_texts(spark):
    from chronopix.llm.resampling import resample

    rng = np.random.default_rng(3)
    words = ["Alpha", "beta2", "Ünï", "漢字", "x\x00y", "a-b", "\x85z", "q" * 70_000]
    texts = [None, "", " \t", "one", "Two words", *[" ".join(rng.choice(words[:-1], 60)) for _ in range(50)], " ".join(words) * 3, "lorem ipsum dolor " * 200_000]
    docs = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, "short"), (None, texts[9]), (None, None), (2**53 + 1, texts[11])]
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string"))
    target = clashing(spark.createDataFrame([(1, "alpha Beta2 ünï alpha"), (None, None), (1, "漢字 漢字")], "item_id long, text string"))
    assert Counter(map(tuple, resample(df, target).collect())) == resampled(docs, ["alpha Beta2 ünï alpha", None, "漢字 漢字"])
    assert Counter(map(tuple, resample(df, target.where("false")).collect())) == resampled(docs, [])
    assert resample(df.where("false"), target).count() == 0


def test_pieces_of_a_long_text(monkeypatch):
    """However a text is cut, runs over the cuts are the same."""
    from chronopix.llm import resampling

    text = "Some words, MORE words and über 漢字 words; " * 50
    n, c = features(text)
    for piece in (1, 7, 40, 1 << 20):
        monkeypatch.setattr(resampling, "PIECE", piece)
        words, at, counts = resampling.hashed(text, 10_000)
        assert words == n and dict(zip(at.tolist(), counts.tolist(), strict=True)) == c


def test_blocks_hold_what_was_added():
    from chronopix.llm.resampling import Block, opened

    block = Block()
    rows = [(5, 3, [0, 9, 9999], [1, 300, 2]), (None, 0, [], []), (-(2**60), 1, [7], [70_000])]
    for i, n, at, counts in rows:
        block.add(i, n, np.array(at, np.int64), np.array(counts, np.int64))
    ((ids, known, words, starts, at, counts),) = opened(block.packed())
    assert [i if k else None for i, k in zip(ids.tolist(), known.tolist(), strict=True)] == [r[0] for r in rows] and words.tolist() == [3, 0, 1]
    assert [(at[a:b].tolist(), counts[a:b].tolist()) for a, b in zip(starts, starts[1:], strict=False)] == [(r[2], r[3]) for r in rows]


# clustering


def clustered(vectors, k=16, dims=64):
    keep = [(i, [math.floor(max(-(2**27), min(2**27, 64 * x))) for x in v]) for i, v in vectors if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(keep, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(3):
        own = [near(v)[1] for _, v in keep]
        for j in range(len(centroids)):
            members = [v for (_, v), o in zip(keep, own, strict=True) if o == j]
            if members:
                centroids[j] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    last = [near(v) for _, v in keep]
    inertia = Counter()
    for d, j in last:
        inertia[j] += d
    return Counter((i, j, d, inertia[j], inertia.total(), hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(keep, last, strict=True))


@pytest.mark.parametrize("few", [False, True])
def test_clusters_of_odd_vectors(spark, few):
    from chronopix.llm.centroids import lloyd

    rng = np.random.default_rng(5)
    plain = [(i, rng.normal(size=64).round(2).tolist()) for i in range(5 if few else 90)]
    odd = [None, [], [1.0] * 63, [1.0] * 65, [None] + [0.0] * 63, [float("nan")] + [0.0] * 63, [float("inf")] + [0.0] * 63]
    vectors = plain + [(1000 + i, v) for i, v in enumerate(odd)] + [plain[3], (3, plain[4][1]), (None, plain[2][1]), (2**53 + 1, [0.0] * 64), (50, [-1e300] + [1e300] * 63), (51, [-0.0, -1e-9] * 32)]
    df = clashing(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"))
    assert Counter(map(tuple, lloyd(df).collect())) == clustered(vectors)


def test_no_usable_vectors(spark):
    from chronopix.llm.centroids import lloyd

    df = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<double>")
    assert lloyd(df).count() == 0 and lloyd(df.where("false")).count() == 0


# URL rules

URLS = [
    None, "", "example.net/en/1", "http://", "http:///en/", "http://A.Example.NET/en/1?x=/y#z", "https://example.net/en", "http://net/", "http://net", "http://fox.net?x", "http://fox.net/?x", "ftp://user@a.ORG:80/fr/x.html#a?b", "http://org/fr/", "http://xorg/fr/",
    "http://xexample.com/de/", "http://example.com/DE/", "http://example.com/de/Ä b", "a://b://c.net/", "http://a.net#/en/", "http://İ.NET/x", "://a.net/", "http://a..net//x//?&&=&k", "http://a.net/\nx/y?q=1\n#z",
]


def judged(url):
    after = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", after)[0]
    path = re.match("[^?#]*", after[len(host) :])[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [(len(h + p), h + p, v) for v, h, p in (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")) if f".{host}".endswith(f".{h}") and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


def test_fixed_rules(spark):
    from chronopix.llm.url_rules import judge

    df = clashing(spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(None, URLS[5]), (5, URLS[5])], "page_id long, url string"))
    got = judge(df).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule, verdict = judged(URLS[5 if r.page_id is None else r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block") and (r.mined is None or rule is None)
    assert judge(df.where("false"), df.select("page_id", F.lit(True).alias("blocked")).where("false")).count() == 0


def test_mined_rules_decide(spark):
    """Two tokens together tell what neither tells alone; rare and unsure ones tell nothing."""
    from chronopix.llm.url_rules import judge

    pages, labels = [], []
    for i in range(400):
        a, b = i % 2, i // 2 % 2
        pages.append((i, f"http://{'win' if a else 'tea'}.shop/{'bet' if b else 'cup'}/{i}"))
        if i < 300:
            labels.append((i, bool(a and b)))
    pages += [(1000, "http://new.shop/bet/7"), (1001, "http://win.info/bet/x"), (1002, "http://rare.shop/q")]
    labels += [(5, True), (None, True), (7, None), (1002, True)]
    got = {r.page_id: r for r in judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, blocked boolean"), rules=[]).collect()}
    for i in range(400):
        assert got[i].verdict == ("block" if i % 4 == 3 else "allow"), got[i]
    assert got[3].mined == "host:win path:bet" and got[3].share == 1.0
    assert (got[1000].verdict, got[1001].verdict, got[1002].verdict) == ("allow", "block", "allow")


def test_long_urls_are_matched_whole(spark):
    from chronopix.llm.url_rules import judge

    pages = [(i, "http://a.b/" + "/".join(f"s{j}" for j in range(40)) + ("/bad" if i % 2 else "/good")) for i in range(60)] + [(100, "http://z/" + "y/" * 50_000 + "bad")]
    labels = spark.createDataFrame([(i, i % 2 == 1) for i in range(60)], "page_id long, blocked boolean")
    got = {r.page_id: r.verdict for r in judge(spark.createDataFrame(pages, "page_id long, url string"), labels, rules=[]).collect()}
    assert all(got[i] == ("block" if i % 2 else "allow") for i in range(60))


def test_all_tokens_of_long_urls_are_mined(spark):
    """Only the first 12 of an example's common tokens were; long and short examples count together."""
    from itertools import combinations

    from chronopix.llm.url_rules import mined_rules

    rng = random.Random(4)
    names = [f"t{i:02}" for i in range(18)]
    examples = [(sorted(rng.sample(names, 16 if i % 3 == 0 else rng.randint(1, 6))), i) for i in range(90)]
    examples = [(own, "block" if {"t03", "t11"} <= set(own) or rng.random() < 0.3 else "allow") for own, _ in examples]
    counts = {}
    for own, verdict in examples:
        for k in (1, 2, 3):
            for items in combinations(own, k):
                counts.setdefault(items, {}).setdefault(verdict, 0)
                counts[items][verdict] += 1
    sure = {(items, v): (sum(of.values()), k / sum(of.values())) for items, of in counts.items() for v, k in of.items() if k >= 5 and k / sum(of.values()) >= 0.75}
    inside = lambda items: [p for k in range(1, len(items)) for p in combinations(items, k)]
    want = {(items, v, n, share) for (items, v), (n, share) in sure.items() if not any(sure.get((p, v), (0, 0))[1] >= share for p in inside(items))}
    got = mined_rules(spark.createDataFrame(examples, "tokens array<string>, verdict string"), 0.002, 0.75, 10_000)
    assert {(tuple(r["items"]), r.verdict, r.n, r.share) for r in got.collect()} == want and any(len(items) == 3 for items, *_ in want)
