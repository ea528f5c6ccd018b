"""Toxicity by maximum-scoring segments.

Token scores are log-odds between toxic and other labelled texts under a Dirichlet
prior in proportion to the tokens' overall frequency, counted in documents. Words
and their stems (first letters) are counted alike, and a word takes the score of
the longest entry it begins with. Only entries with clearly positive log-odds (by
size and by likelihood ratio) keep a score of their own; all other words share a small negative one.
A linear-time scan finds every maximal segment of a text's scores. The scores'
decay rate lambda (the root of sum p*exp(lambda*s) = 1 over other texts) turns a
segment's sum S into its extreme-value form lambda*S - ln(K*n) for a text of n
tokens; segments above ``significant`` are the toxic passages. A logistic curve,
fitted on labelled texts that did not give token scores, turns the best segment's
value, the passages' total and their number into one probability.

Only the text is an input of a score. Defined cases: null and empty texts have no
segment and get the curve's value there; unlabelled rows are not learned from;
without labels of both kinds every score is 0; texts of any length are scanned whole;
repeated rows are scored alike, null ids are scored but not learned from; segments that
tie are all kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm._common import documents, map_texts, remainder, written
from chronopix.llm.quality_classifier import sigmoid, training_sample

TOKENS = re.compile(r"[^\W\d_]+").findall
#: Marks an entry as a stem; lengths of stems; words whose scores a task keeps.
STEM, STEM_LENGTHS, CACHED_WORDS = "*", (4, 8), 200_000
#: Karlin's constant K in front of n; its logarithm only shifts the fitted curve.
KARLIN_K = 0.1


@dataclass
class Model:
    scores: dict[str, float]  # of words, and of stems with STEM at their end
    other: float  # the score of all other words
    rate: float  # lambda
    significant: float
    weights: np.ndarray | None = None  # of the features, and a constant


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum), in time linear in the tokens:
    runs without a positive score count only by their sum."""
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    upto = np.concatenate([[0.0], np.cumsum(scores)])
    left, right = upto[up], upto[up + 1]
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, nearest lower one
    for a, lo, hi in zip(up.tolist(), left.tolist(), right.tolist(), strict=True):
        start = a
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= lo:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= hi:
                stack.append((start, a + 1, lo, hi, j))
                break
            start, lo = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, hi - lo) for s, e, lo, hi, _ in stack]


class Scorer:
    """Scores of words, remembered up to CACHED_WORDS."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def of(self, word: str) -> float:
        entries = self.model.scores
        score = entries.get(word)
        for n in range(min(STEM_LENGTHS[1], len(word) - 1), STEM_LENGTHS[0] - 1, -1):
            if score is not None:
                break
            score = entries.get(word[:n] + STEM)
        return self.model.other if score is None else score

    def __call__(self, text: str) -> np.ndarray:
        words, known = TOKENS(text.lower()), self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = self.of(w)
        return np.array([known[w] for w in words], float)


def passages(model: Model, text: str) -> list[tuple[int, int, float]]:
    """Significant segments by token positions, with their extreme-value form."""
    s = Scorer(model)(text)
    base = np.log(KARLIN_K * max(len(s), 1))
    return [(a, b, v) for a, b, total in segments(s) if (v := model.rate * total - base) >= model.significant]


def features(model: Model, s: np.ndarray) -> tuple[float, float, float, float]:
    """Of a text's word scores: the best segment, its extreme-value form, the
    passages' total, and the text's length."""
    found = [x for _, _, x in segments(s)]
    size = np.log(max(len(s), 1))
    if not found:
        return 0.0, 0.0, 0.0, size
    values = model.rate * np.array(found) - np.log(KARLIN_K) - size
    kept = values[values >= model.significant]
    return float(model.rate * max(found)), float(values.max()), float(np.log1p(kept.sum())) if len(kept) else 0.0, size


def log_odds(counts: list[tuple[str, float, float]], n_toxic: float, n_other: float, words: float, *, prior: float, least_z: float, least_odds: float, share: float) -> Model:
    """Scores from the numbers of toxic and other documents that hold each entry.
    ``words``: distinct words of an average document; ``share``: how many of a toxic
    passage's words have scores of their own."""
    y1, y0 = np.array([c[1] for c in counts], float), np.array([c[2] for c in counts], float)
    a = prior * (y1 + y0) / (n_toxic + n_other)
    d = np.log((y1 + a) / (n_toxic + prior)) - np.log((y0 + a) / (n_other + prior))
    expected = np.array([n_toxic, n_other]) / (n_toxic + n_other) * (y1 + y0)[:, None]
    ratio = sum(y * np.log(np.maximum(y, 1e-9) / e) for y, e in ((y1, expected[:, 0]), (y0, expected[:, 1])))
    kept = (d >= least_odds) & (np.sqrt(2 * np.maximum(ratio, 0)) >= least_z)
    other = float(np.log(1 - share))
    p = (y0[kept] + a[kept]) / ((n_other + prior) * max(words, 1))
    s, p = np.append(d[kept], other), np.append(p, max(1 - p.sum(), 0.5))
    lo, hi = 1e-3, 5.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(np.minimum(mid * s, 50))).sum() < 1 else (lo, mid)
    return Model({c[0]: float(x) for c, x, k in zip(counts, d, kept, strict=True) if k}, other, lo, 2.0)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method; the constant comes last."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def feature_rows(docs: DataFrame, model: Model) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        scorer = Scorer(m)

        def run(texts: list[str]) -> dict[str, list]:
            got = [features(m, scorer(t)) for t in texts]
            p = sigmoid(np.column_stack([np.array(got), np.ones(len(got))]) @ m.weights) if m.weights is not None else np.zeros(len(got))
            return {f"f{i}": [g[i] for g in got] for i in range(4)} | {"score": p.tolist()}

        return run

    return map_texts(docs, make, {f"f{i}": "double" for i in range(4)} | {"score": "double"})


def entries_of(docs: DataFrame) -> DataFrame:
    """label, the number of different words, and the different words and stems of each
    text, by the scorer's own tokens."""

    def make():
        def run(texts: list[str]) -> dict[str, list]:
            words = [set(TOKENS(t.lower())) for t in texts]
            stems = lambda w: {w[:n] + STEM for n in range(STEM_LENGTHS[0], min(STEM_LENGTHS[1], len(w) - 1) + 1)}
            return {"n_words": [len(w) for w in words], "entries": [sorted(w.union(*map(stems, w))) for w in words]}

        return run

    return map_texts(docs.select("label", "text"), make, {"n_words": "long", "entries": "array<string>"})


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, max_train_docs: int = 9_000, least_docs: int = 4, prior: float = 50.0, least_z: float = 4.5, least_odds: float = 1.5, share: float = 0.05, modulus: int = 5, held_out: int = 0) -> Model | None:
    """Learn from at most ``max_train_docs`` labelled documents (the documented bound, which
    bounds the entries as well): two thirds give scores to entries, the rest fit the curve.
    Equal texts count once, with the label of the smallest id."""
    sample = training_sample(docs, labels, "toxic", modulus, held_out, max_train_docs).groupBy("text").agg(F.min(F.struct("doc_id", "label")).alias("first"))
    sample = sample.select("text", "first.doc_id", "first.label", F.pmod(F.xxhash64("first.doc_id", F.lit(7)), F.lit(3)).alias("part"))
    held = written(entries_of(sample.where("part < 2")))
    totals = held.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other"), F.avg("n_words").alias("words")).first()
    if not totals["toxic"] or not totals["other"]:
        return None
    table = held.select("label", F.explode("entries").alias("entry")).groupBy("entry").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other"))
    # log-odds are positive only where toxic documents are likelier to hold an entry than others
    likelier = F.col("toxic") * totals["other"] > F.col("other") * totals["toxic"]
    counts = sorted(table.where((F.col("toxic") >= least_docs) & likelier).collect())
    model = log_odds([tuple(r) for r in counts], totals["toxic"], totals["other"], totals["words"], prior=prior, least_z=least_z, least_odds=least_odds, share=share)
    rows = feature_rows(sample.where("part = 2").select("doc_id", "label", "text"), model).orderBy("doc_id").collect()
    y = np.array([r["label"] for r in rows])
    if len(y):
        model.weights = logistic(np.array([[r[f"f{i}"] for i in range(4)] for r in rows]), y)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    modulus, held_out = options.get("modulus", 5), options.get("held_out", 0)
    model = fit_toxicity(docs, labels, **options)
    texts = documents(docs).select("doc_id", "text", (remainder(F.col("doc_id"), modulus) == held_out).alias("held_out"))
    if model is None:
        return texts.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    return feature_rows(texts, model).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
