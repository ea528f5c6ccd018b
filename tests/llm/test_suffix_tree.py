"""The suffix tree against a plain one, built and walked text by text."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
START, END = "<s>", "</s>"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


class Tree:
    """Contexts as tuples of words; the same rules as the operator's, one text at a time."""

    def __init__(self, texts, depth, least, gain):
        runs = [Counter() for _ in range(depth + 2)]
        for t in texts:
            s = [START, *tokens(t), END]
            for size in range(1, depth + 2):
                runs[size].update(tuple(s[i : i + size]) for i in range(len(s) - size + 1))
        self.words = Counter({w: n for (w,), n in runs[1].items() if w != START})
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.share, self.own = {}, {}
        for d in range(1, depth + 1):
            after = defaultdict(dict)
            for run, n in runs[d + 1].items():
                context = run[:-1]
                if n >= least and runs[d][context] >= least and (d == 1 or context[1:] in self.share):
                    after[context][run[-1]] = n
            kept = {}
            for c, nexts in after.items():
                n_c = runs[d][c]
                q = {s: (self.words[s] / self.n if d == 1 else runs[d][(*c[1:], s)] / runs[d - 1][c[1:]]) for s in nexts}
                rest, others = n_c - sum(nexts.values()), max(1 - sum(q.values()), 1e-9)
                total = sum(n * math.log(n / n_c / q[s]) for s, n in nexts.items()) + (rest * math.log(rest / n_c / others) if rest else 0)
                if total >= gain * len(nexts):
                    kept[c] = (n_c, nexts)
            if not kept:
                break
            for c, (n_c, nexts) in kept.items():
                self.share[c] = (n_c - sum(nexts.values()) + len(nexts)) / (n_c + len(nexts))
                self.own[c] = {s: n / (n_c + len(nexts)) for s, n in nexts.items()}

    def probability(self, history, word):
        p = (self.words[word] + 1) / (self.n + self.v + 1)
        for d in range(1, len(history) + 1):
            c = tuple(history[-d:])
            if c not in self.share:
                break
            p = self.own[c].get(word, 0) + self.share[c] * p
        return p

    def score(self, text):
        s = [START, *tokens(text), END]
        return sum(math.log10(self.probability(s[max(0, i - 5) : i], s[i])) for i in range(1, len(s)))


def test_scores_are_those_of_a_plain_tree(spark):
    from chronopix.llm.suffix_tree import score_texts

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(100_001, None), (100_002, ""), (100_003, "never seen words of any kind"), (None, "a text without an id"), (None, "a text without an id"), (100_004, "lorem ipsum dolor " * 30_000)], "doc_id long, text string")
    docs = docs.union(odd).withColumns({c: F.lit("clash") for c in ("row", "held_out", "key", "n", "h")})
    rows = docs.select("doc_id", "text").collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    for least, gain in ((2, 2.0), (3, 0.5)):
        tree = Tree([r.text for r in rows if not held(r.doc_id)], 5, least, gain)
        assert max(map(len, tree.share)) >= 3
        got = score_texts(docs, least_count=least, least_gain=gain).collect()
        assert len(got) == len(rows)
        by_id = {r.doc_id: r for r in got}
        for r in rows:
            g, words = by_id[r.doc_id], [*tokens(r.text), END]
            assert (g.n_tokens, g.n_known, g.train_tokens, g.held_out) == (len(words), sum(w in tree.words for w in words), tree.n, held(r.doc_id))
            base = sum(math.log10((tree.words[w] + 1) / (tree.n + tree.v + 1)) for w in words)
            assert math.isclose(g.base_score, base, rel_tol=1e-9, abs_tol=1e-6)
            assert math.isclose(g.score, tree.score(r.text), rel_tol=1e-9, abs_tol=1e-6)


def test_probabilities_add_up_to_one(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").limit(60).collect()
    tree = Tree([r.text for r in rows], 5, 2, 0.5)
    contexts = sorted(tree.share, key=len)
    for c in [*contexts[:5], *contexts[-5:], ("no", "such", "context")]:
        assert math.isclose(sum(tree.probability(c, w) for w in [*tree.words, "an unknown word "]), 1, rel_tol=1e-9)


def test_empty_and_untrained_tables(spark):
    from chronopix.llm.suffix_tree import score_texts

    empty = spark.createDataFrame([], "doc_id long, text string")
    assert score_texts(empty).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (got,) = score_texts(spark.createDataFrame([(held, "not learned from")], "doc_id long, text string")).collect()
    assert (got.n_tokens, got.n_known, got.train_tokens, got.base_score, got.score) == (4, 0, 0, 0.0, 0.0)


def test_words_have_one_hash_wherever_they_stand(monkeypatch):
    """Of texts cut into pieces of any size, with words longer than a piece; different words
    have different hashes."""
    import random

    from chronopix.llm import suffix_tree

    of, word = {}, {}
    for piece, giant in ((64, 16), (50, 200), (1 << 20, 1 << 16)):
        monkeypatch.setattr(suffix_tree, "PIECE", piece)
        monkeypatch.setattr(suffix_tree, "GIANT", giant)
        read, rng = suffix_tree.Reader(), random.Random(piece)
        hashes, seen = {}, {}
        for _ in range(400):
            texts = [None if rng.random() < 0.1 else "".join(rng.choice(["a", "B", "é", "\x1c", " ", "\n", "xyz", "q" * rng.choice([1, 5, 17, 40, 90, 200, 700])]) for _ in range(rng.randrange(40))) for _ in range(rng.randrange(1, 4))]
            h, place = read(texts)
            want = [w for t in texts for w in (START, *tokens(t), END)]
            assert len(h) == len(place) == len(want) and [p == 0 for p in place] == [w == START for w in want]
            for w, x in zip(want, h.tolist(), strict=True):
                assert hashes.setdefault(w, x) == x and seen.setdefault(x, w) == w
        short = {w: x for w, x in hashes.items() if len(w.encode()) <= 16}
        assert all(of.setdefault(w, x) == x and word.setdefault(x, w) == w for w, x in short.items())
    assert read([])[0].size == 0


@pytest.mark.parametrize(("often", "seldom"), [(6, 5), (5, 1), (6, 1)])
def test_words_with_equal_lower_halves_share_their_contexts(spark, often, seldom):
    """Whatever their counts: a rare word's runs are also those of its twin, which is not followed
    more often than it occurs."""
    from chronopix.llm.suffix_tree import LOW, Reader, score_texts

    names = [f"word{i}" for i in range(400_000)]
    low = Reader()([" ".join(names)])[0][1:-1] & LOW
    order = np.argsort(low, kind="stable")
    k = int(np.flatnonzero(np.diff(low[order]) == 0)[0])
    first, twin = names[order[k]], names[order[k + 1]]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    texts = [f"a{i} b{i % 7} {first} after c{i % 5}" for i in range(often)] + [f"d{i} e{i % 3} {twin} after f{i % 4}" for i in range(seldom)] + [f"g{i % 9} after h{i % 8} i{i}" for i in range(40)]
    rows = list(zip((i for i in range(1000) if not held(i)), texts)) + [(next(i for i in range(1000, 2000) if held(i)), f"x {first} after {twin} after")]
    words = Counter(w for i, t in rows if not held(i) for w in t.split())
    one = lambda t: t.replace(twin, first)
    tree = Tree([one(t) for i, t in rows if not held(i)], 5, 6, 2.0)
    tree.v += 1
    assert (first,) in tree.share
    got = {r.doc_id: r for r in score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        own = sum(math.log10((words[w] + 1) / (tree.words[first] + 1)) for w in t.split() if w in (first, twin))
        assert math.isclose(got[i].score, tree.score(one(t)) + own, rel_tol=1e-9, abs_tol=1e-6)
