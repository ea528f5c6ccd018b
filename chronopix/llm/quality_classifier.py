"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it.
Learned filters run over every byte position of a chunk, each filter's largest
response in the chunk is kept, and the chunks' responses (their mean and their
maximum) enter one logistic output. The filters look only at local bytes, so a
text of any length is scored in bounded memory, block by block.

Defined cases: a null text counts as empty; an empty text is scored as one chunk
of padding; rows without a label, with a null label or with a null id are not
trained on, but scored; repeated rows are scored alike; of responses that tie in a chunk
the first is taken; without any label every score is 0.5; an empty table gives no rows;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm._common import documents, filter_texts, map_texts, remainder, written

#: Filter width in bytes (even), number of filters, and size of a byte's embedding.
WIDTH, FILTERS, EMBED = 6, 16, 6
#: Bytes of a chunk and the step between chunks; neighbours overlap by the difference.
CHUNK, STEP = 512, 448
#: Bytes that are convolved at once; bounds the memory of scoring.
BLOCK = 1 << 18


@dataclass
class ByteCNN:
    taps: np.ndarray  # WIDTH x 256 x FILTERS: each byte's share of each filter at each place
    bias: np.ndarray
    out: np.ndarray  # 2 * FILTERS
    out_bias: float

    def pair_tables(self) -> np.ndarray:
        """WIDTH/2 tables of 65536 rows: two neighbouring bytes at a time."""
        return np.stack([(self.taps[k + 1][:, None] + self.taps[k][None, :]).reshape(65536, -1) for k in range(0, WIDTH, 2)]).astype(np.float32)


def as_bytes(text: str) -> np.ndarray:
    raw = text.encode("utf-8", "surrogatepass")
    return np.frombuffer(raw + b"\0" * max(WIDTH, CHUNK - len(raw)) if len(raw) < CHUNK else raw + b"\0" * WIDTH, np.uint8)


def chunk_starts(n_bytes: int) -> np.ndarray:
    """Starts of chunks of CHUNK bytes, STEP apart; the last one reaches the end."""
    return np.arange(0, max(1, -(-(n_bytes - (CHUNK - STEP)) // STEP))) * STEP


def chunk_maxima(tables: np.ndarray, data: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Each filter's largest response in each chunk, and where it is."""
    n = len(data) - WIDTH + 1
    pairs = data[:-1].astype(np.uint16) | (data[1:].astype(np.uint16) << 8)
    starts = chunk_starts(n)
    most, where = [], []
    per = max(1, BLOCK // STEP)
    for at in range(0, len(starts), per):
        part = starts[at : at + per]
        lo, hi = part[0], min(n, part[-1] + CHUNK)
        conv = tables[0][pairs[lo:hi]]
        for k in range(1, WIDTH // 2):
            conv += tables[k][pairs[lo + 2 * k : hi + 2 * k]]
        if places:
            for s in part - lo:
                p = conv[s : s + CHUNK].argmax(0)
                where.append(lo + s + p)
                most.append(conv[s + p, np.arange(conv.shape[1])])
        else:
            # a chunk is its own STEP bytes and the overlap with the next one
            own = np.maximum.reduceat(conv, part - lo, 0)
            if len(part) > 1:
                heads = np.stack([conv[s : s + CHUNK - STEP].max(0) for s in (part - lo)[1:]])
                own[:-1] = np.maximum(own[:-1], heads)
            most.append(own)
    return (np.array(most), np.array(where)) if places else (np.concatenate(most), None)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(texts: list[str], labels: np.ndarray, epochs: int = 5, seed: int = 5) -> ByteCNN:
    """Adam on the log loss; gradients flow to the bytes at each chunk's maxima."""
    rng = np.random.default_rng(seed)
    p = {
        "embed": rng.normal(0, 0.5, (256, EMBED)), "kernel": rng.normal(0, 0.4, (WIDTH, EMBED, FILTERS)), "bias": np.zeros(FILTERS),
        "out": rng.normal(0, 0.1, 2 * FILTERS), "out_bias": np.zeros(1),
    }
    share = np.clip(labels.mean(), 0.02, 0.98) if len(labels) else 0.5
    p["out_bias"][0] = np.log(share / (1 - share))
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    data, step, batch = [as_bytes(t) for t in texts], 0, 16
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), batch):
            g = {k: np.zeros_like(v) for k, v in p.items()}
            taps = np.einsum("be,wef->wbf", p["embed"], p["kernel"])
            tables = ByteCNN(taps, p["bias"], p["out"], 0.0).pair_tables()
            some = order[at : at + batch]
            g_taps = np.zeros_like(taps)
            for i in some:
                top, where = chunk_maxima(tables, data[i], places=True)
                h = np.maximum(top + p["bias"], 0)
                best = h.argmax(0)
                x = np.concatenate([h.mean(0), h.max(0)])
                d = (sigmoid(x @ p["out"] + p["out_bias"][0]) - labels[i]) / len(some)
                g["out"] += d * x
                g["out_bias"] += d
                dh = np.repeat((d * p["out"][:FILTERS] / len(h))[None], len(h), 0)
                dh[best, np.arange(FILTERS)] += d * p["out"][FILTERS:]
                dh *= h > 0
                g["bias"] += dh.sum(0)
                for w in range(WIDTH):
                    np.add.at(g_taps[w], (data[i][where + w], np.arange(FILTERS)[None]), dh)
            g["embed"] = np.einsum("wbf,wef->be", g_taps, p["kernel"])
            g["kernel"] = np.einsum("wbf,be->wef", g_taps, p["embed"])
            step += 1
            rate = 0.02 * (1 - 0.9 * epoch / epochs)
            for k in p:
                m, v = moment[k]
                m += 0.1 * (g[k] - m)
                v += 0.01 * (g[k] ** 2 - v)
                p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return ByteCNN(np.einsum("be,wef->wbf", p["embed"], p["kernel"]), p["bias"], p["out"], float(p["out_bias"][0]))


def score_text(model: ByteCNN, tables: np.ndarray, text: str) -> float:
    h = np.maximum(chunk_maxima(tables, as_bytes(text))[0] + model.bias, 0)
    return float(sigmoid(np.concatenate([h.mean(0), h.max(0)]) @ model.out + model.out_bias))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, limit: int) -> DataFrame:
    """At most ``limit`` labelled texts outside the held-out fold, in the order of a
    hash of their id. The sample's ids are bounded by ``limit``, so they are broadcast. Of
    labels or texts that conflict for one id the smallest counts."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0.0, 1.0) & (remainder(F.col("doc_id"), modulus) != held_out))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    return documents(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fit_quality(docs: DataFrame, labels: DataFrame, *, max_train_docs: int = 1500, max_train_letters: int = 64_000_000, modulus: int = 4, held_out: int = 2) -> ByteCNN | None:
    """Train on at most ``max_train_docs`` labelled documents with ``max_train_letters``
    letters in all (the documented bounds); a document that would exceed them is left out
    whole."""
    sample = written(training_sample(docs, labels, "quality", modulus, held_out, max_train_docs))
    chosen, left = [], max_train_letters
    for r in sorted(sample.select("doc_id", F.length("text").alias("n")).collect()):
        if r.n <= left:
            chosen.append(r.doc_id)
            left -= r.n
    rows = sorted(sample.where(F.col("doc_id").isin(chosen)).collect()) if chosen else []
    if not rows:
        return None
    return train([r.text for r in rows], np.array([r.label for r in rows]))


def scorer(shared):
    """A function that scores a batch of texts, for use inside tasks."""

    def make():
        net = shared.value
        tables = net.pair_tables() if net else None
        return lambda texts: [score_text(net, tables, t) if net else 0.5 for t in texts]

    return make


def score_quality(docs: DataFrame, model: ByteCNN | None, *, threshold: float = 0.7, modulus: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    make = scorer(docs.sparkSession.sparkContext.broadcast(model))

    def column():
        score = make()
        return lambda texts: {"score": score(texts)}

    texts = documents(docs).select("doc_id", "text", (remainder(F.col("doc_id"), modulus) == held_out).alias("held_out"))
    return map_texts(texts, column, {"score": "double"}).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, **options) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``; all of them without labels."""
    model = fit_quality(docs, labels, **options)
    if model is None:
        return docs
    make = scorer(docs.sparkSession.sparkContext.broadcast(model))

    def test():
        score = make()
        return lambda texts: [s >= threshold for s in score(texts)]

    return filter_texts(docs, test)


def quality_classifier(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score_quality(docs, fit_quality(docs, labels, **options))
