"""BPE encoding and decoding: speculate and verify.

For every new word the longest vocabulary entries are taken greedily from the
left (the proposal). A proposal is the word's true encoding if each token encodes
to itself and no merge across any border of two neighbouring tokens would have
come before the merges that built them. That test depends on the two tokens only,
so all borders of all new words of a batch are tested at once with numpy. Only
words with a failing border are merged exactly, rank by rank.

Words repeat, so each Python worker keeps the encodings of words it has met, up
to ``CACHED_WORDS``; a text is then the concatenation of its words' ids.

Defined cases: a null text counts as empty and has no ids; special-token strings
in a text become their single ids, as the library does by default; texts and words of
any length are taken whole, in time linear but for a logarithm; equal ranks merge from
the left; repeated rows give repeated results; null ids stay null and ids pass through
unchanged; an empty table gives no rows; columns other than doc_id and text are not
read. The vocabulary file's path is a parameter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import repeat
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chronopix.llm._common import documents, small_batches
from chronopix.session import ship_code

#: Words whose encodings a Python worker keeps before it starts anew, and the letters
#: beyond which a word is not kept and is merged through a heap.
CACHED_WORDS, LONG_WORD = 600_000, 64
#: Texts whose new words are tested together.
TEXTS_AT_ONCE = 256
NEVER = 1 << 40


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    return letters | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in letters)}


class WordBPE:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.end = model["end_of_word_suffix"]
        self.size = max(*self.vocab.values(), *self.special.values()) + 1
        self.names = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            left, right, whole = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.merges[left, right] = (rank, whole)
            made.setdefault(whole, (rank, left, right))
        # ranks alone, as small numbers compare fastest, and what each of them makes.
        self.ranks = {pair: rank for pair, (rank, _) in self.merges.items()}
        self.wholes = [self.vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        self._spines(made)
        library = Tokenizer.from_file(path)
        self.normal, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.special_at = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.to_letters = {b: c for b, c in _byte_letters().items() if chr(b) != c}
        # code points under U+0130 have the same classes in every Unicode version
        kinds = {k: "".join(re.escape(chr(c)) for c in range(33, 0x130) if not 127 <= c <= 160 and unicodedata.category(chr(c))[0] in k) for k in ("L", "N", "PSMC")}
        self.simple = re.compile(f"[ \\t-\\r{kinds['L']}{kinds['N']}{kinds['PSMC']}]*").fullmatch
        self.pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{kinds['L']}]+|[{kinds['N']}]|[{kinds['PSMC']}]+").findall
        self.prefixes = {t[:k]: -1 for t in self.vocab if not t.endswith(self.end) for k in range(1, len(t))} | {t: i for t, i in self.vocab.items() if not t.endswith(self.end)}
        self.longest = max(map(len, self.vocab))
        self.cache: dict[str, bytes] = {s: i.to_bytes(4, "little") for s, i in self.special.items()}
        self.text: dict[bytes, bytes] = {}

    def _spines(self, made: dict[int, tuple[int, int, int]]) -> None:
        """For each token, the tokens along its right and its left edge, and the rank at
        which each of them is merged away (NEVER for the token itself)."""
        proper = np.ones(self.size, bool)
        rank = {t: r for t, (r, _, _) in made.items()}
        for t, (r, a, b) in made.items():
            if rank.get(a, -1) >= r or rank.get(b, -1) >= r:
                proper[t] = False

        def walk(side: int) -> tuple[np.ndarray, np.ndarray]:
            rows = []
            for t in range(self.size):
                row, gone = [(t, NEVER)], made.get(t)
                while gone:
                    row.append((gone[side], gone[0]))
                    gone = made.get(gone[side])
                rows.append(row)
            deep = max(map(len, rows))
            token, until = np.full((self.size, deep), -1), np.full((self.size, deep), -1)
            for t, row in enumerate(rows):
                token[t, : len(row)], until[t, : len(row)] = zip(*row, strict=True)
            return token, until

        self.right, self.left = walk(2), walk(1)
        key = np.array([a * self.size + b for a, b in self.merges], np.int64)
        order = key.argsort()
        self.merge_key, self.merge_rank = key[order], np.array([r for r, _ in self.merges.values()])[order]
        self.known_key, self.known_ok = np.zeros(0, np.int64), np.zeros(0, bool)
        self.canonical = np.ones(self.size, bool)
        for t, (_, a, b) in made.items():
            self.canonical[t] = proper[t] and proper[a] and proper[b]
        pairs = np.array([(a, b, r) for r, a, b in made.values()]).reshape(-1, 3)
        ok = self.compatible(pairs[:, 0], pairs[:, 1], pairs[:, 2])
        self.canonical[np.fromiter(made, int, len(made))[~ok]] = False

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | int = NEVER) -> np.ndarray:
        """Whether no merge across the border of a and b, of a rank under ``before``, comes
        while its two sides are still whole. Equal ranks: the left one goes first."""
        bad = np.zeros(len(a), bool)
        (rt, ru), (lt, lu) = self.right, self.left
        for i in range(rt.shape[1]):
            on = np.flatnonzero(rt[a, i] >= 0)
            if not len(on):
                break
            for j in range(lt.shape[1]):
                on = on[lt[b[on], j] >= 0]
                if not len(on):
                    break
                key = rt[a[on], i] * self.size + lt[b[on], j]
                at = np.minimum(np.searchsorted(self.merge_key, key), len(self.merge_key) - 1)
                r = np.where(self.merge_key[at] == key, self.merge_rank[at], NEVER)
                limit = before[on] if isinstance(before, np.ndarray) else before
                bad[on] |= (r < limit) & (r < ru[a[on], i]) & (r <= lu[b[on], j])
        return ~bad

    def _borders_ok(self, key: np.ndarray) -> np.ndarray:
        unique, back = np.unique(key, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known_key, unique), max(0, len(self.known_key) - 1))
        new = unique if not len(self.known_key) else unique[self.known_key[at] != unique]
        if len(new):
            if len(self.known_key) > 1_000_000:
                self.known_key, self.known_ok, new = self.known_key[:0], self.known_ok[:0], unique
            a, b = new // self.size, new % self.size
            ok = self.compatible(a, b) & self.canonical[a] & self.canonical[b]
            key = np.concatenate([self.known_key, new])
            order = key.argsort()
            self.known_key, self.known_ok = key[order], np.concatenate([self.known_ok, ok])[order]
            at = np.searchsorted(self.known_key, unique)
        return self.known_ok[at][back]

    def propose(self, word: str) -> list[int]:
        """Greedy longest match; the last token carries the end-of-word mark."""
        vocab, follow, out, at, n, longest, end = self.vocab.get, self.prefixes.get, [], 0, len(word), self.longest, self.end
        while True:
            if n - at <= longest and (t := vocab(word[at:] + end)) is not None:
                out.append(t)
                return out
            # a letter is always a token; what begins with two is known by them
            best, after = -1, at + 1
            for stop in range(at + 2, n):
                t = follow(word[at:stop])
                if t is None:
                    break
                if t >= 0:
                    best, after = t, stop
            out.append(best if best >= 0 else follow(word[at]))
            at = after

    def merge(self, word: str) -> list[int]:
        """Exact encoding: the pair of lowest rank first, leftmost on ties."""
        vocab, get, wholes, never = self.vocab, self.ranks.get, self.wholes, len(self.wholes)
        ids = [vocab[c] for c in word[:-1]]
        ids.append(vocab[word[-1] + self.end])
        if len(ids) > LONG_WORD:
            return self.merge_long(ids)
        pair = list(map(get, zip(ids, ids[1:]), repeat(never)))
        while pair:
            low = min(pair)
            if low == never:
                break
            i = pair.index(low)
            ids[i] = wholes[low]
            del ids[i + 1], pair[i]
            if i < len(pair):
                pair[i] = get((ids[i], ids[i + 1]), never)
            if i:
                pair[i - 1] = get((ids[i - 1], ids[i]), never)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same through a heap of ranks and places; tokens are linked to their neighbours."""
        merges, end = self.merges, len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(merges[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            found = merges.get((ids[i], ids[j])) if j < end else None
            if found is None or found[0] != rank:
                continue  # one of the two has been merged since
            ids[i], ids[j], after[i] = found[1], -1, after[j]
            if after[i] < end:
                before[after[i]] = i
                if (right := merges.get((ids[i], ids[after[i]]))) is not None:
                    heapq.heappush(heap, (right[0], i))
            if before[i] >= 0 and (left := merges.get((ids[before[i]], ids[i]))) is not None:
                heapq.heappush(heap, (left[0], before[i]))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Encodings of words given in byte letters."""
        found = [self.propose(w) for w in words]
        flat = np.fromiter((t for ids in found for t in ids), np.int64)
        of = np.repeat(np.arange(len(found)), np.fromiter(map(len, found), np.int64, len(found)))
        inner = np.flatnonzero(of[1:] == of[:-1])
        ok = self._borders_ok(flat[inner] * self.size + flat[inner + 1])
        failed = np.zeros(len(found), bool)
        failed[of[inner[~ok]]] = True
        failed[of[~self.canonical[flat]]] = True
        for i in np.flatnonzero(failed).tolist():
            found[i] = self.merge(words[i])
        return found

    def words_of(self, text: str) -> list[str]:
        """The tokenizer's words, lower-cased, and special tokens."""
        if "<|" in text and self.special_at and self.special_at.search(text):
            return [w for x in self.special_at.split(text) for w in ([x] if x in self.special else self.words_of(x))]
        if self.simple(text):
            return self.pieces(text.lower())
        return [w for x in RUNS(text) for w in (self.pieces(x.lower()) if self.simple(x) else self.split_other(x))]

    def split_other(self, run: str) -> list[str]:
        """Words of a run with rarer characters, by the library's own splitter. They are
        marked by a leading space, as they are in byte letters already."""
        return [" " + w for w, _ in self.split(self.normal(run))]

    def learn(self, words: list[str]) -> None:
        letters = [w[1:] if w[0] == " " else w if w.isascii() else w.encode().decode("latin-1").translate(self.to_letters) for w in words]
        for w, ids in zip(words, self.encode_words(letters), strict=True):
            self.cache[w] = pack(f"<{len(ids)}I", *ids)

    def encode_batch(self, texts: list[str]) -> Iterator[list[bytes]]:
        """For each text its words' ids as little-endian unsigned 32-bit integers."""
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            words = [self.words_of(t) for t in texts[at : at + TEXTS_AT_ONCE]]
            if len(self.cache) > CACHED_WORDS:
                self.cache = {s: self.cache[s] for s in self.special}
                self.text.clear()
            known = self.cache
            new = [w for w in set().union(*words) if w not in known]
            if new:
                self.learn(new)
            get = self.cache.__getitem__
            for w in words:
                yield list(map(get, w))
            for w in new:
                if len(w) > LONG_WORD:
                    del self.cache[w]

    def decode(self, ids: bytes) -> bytes:
        """Token strings joined by spaces, in UTF-8."""
        names = self.names
        return " ".join([names[i] for i in np.frombuffer(ids, "<u4").tolist()]).encode()

    def decode_runs(self, runs: list[bytes]) -> bytes:
        text = self.text
        new = [r for r in set(runs) if r not in text]
        for r in new:
            text[r] = self.decode(r)
        whole = b" ".join([text[r] for r in runs])
        for r in new:
            if len(r) > 4 * LONG_WORD:
                del text[r]
        return whole


#: Runs without the white space of ASCII; the library splits at any other.
RUNS = re.compile("[^ \t-\r]+").findall
_loaded: dict[str, WordBPE] = {}


def load(path: str) -> WordBPE:
    """One encoder for each vocabulary file and Python worker."""
    if path not in _loaded:
        _loaded[path] = WordBPE(path)
    return _loaded[path]


def encode_decode(docs: DataFrame, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the decoded text; with ``keep_ids``
    also the ids and the decoded text themselves."""
    path = path or default_vocabulary()
    ship_code(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if keep_ids else [])]
    kinds = [pa.int64(), pa.string(), pa.string(), *([pa.list_(pa.int32()), pa.string()] if keep_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in (part for b in batches for part in small_batches(b)):
            rows = []
            for runs in bpe.encode_batch(batch.column("text").to_pylist()):
                ids, text = b"".join(runs), bpe.decode_runs(runs)
                row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest())
                rows.append((*row, np.frombuffer(ids, "<u4").astype(np.int32), text.decode()) if keep_ids else row)
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    more = ", ids array<int>, decoded string" if keep_ids else ""
    return documents(docs).mapInArrow(run, f"doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
