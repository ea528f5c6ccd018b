"""Secret scans with structural confirmation.

Three plain patterns give the base spans: assignments to a secret-like name,
access-key ids and long hex strings. Beyond them, base64 and hex candidates are
decoded and reported only if the bytes are what they look like: DER private keys
whose nested lengths add up (PKCS#1, PKCS#8 plain or encrypted, SEC1, DSA), OpenSSH
private keys, PEM blocks around either or around data that its header says is
encrypted, and signed tokens whose header and payload are JSON objects with a signing
algorithm and a signature. A key may stand behind other letters of its alphabet and may
go on over single line breaks; its own lengths tell where it ends.

Defined cases: a null or empty text has no spans (an empty digest input); repeated
rows are scanned alike, null ids stay null; texts of any length are scanned whole, in time
that grows with their length whatever they hold; positions are code points; spans with equal starts are listed by kind, then by end; an
empty table gives no rows; columns other than doc_id and text are not read, and stay
untouched where texts are redacted, whatever their names.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm._common import documents, map_texts, quoted

#: Kinds in the order in which equal starts are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
# no part of these gives back what it took, and none begins anew inside what an earlier try has passed
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----\s*+((?:[A-Za-z-]++: (?:(?!-----)[^\n])*+\n)*+)([A-Za-z0-9+/=\s]{16,}+)-----END \1-----")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]{4,})*={0,2}")
#: Letters that base64 gives to the first bytes of a DER sequence and of an OpenSSH key.
KEY_START = re.compile(r"M[A-P][A-Za-z0-9+/_-]{2}|b3BlbnNzaC1rZXktdjE")
HEX_BYTES = re.compile(r"(?:[0-9a-fA-F]{2}){32,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+(eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{2,}+\.[A-Za-z0-9_-]*+)")
#: Items that a key's sequences have at most.
MOST_ITEMS = 16
SEQUENCE, INTEGER, OCTETS, OBJECT_ID = 0x30, 0x02, 0x04, 0x06


@dataclass
class Window:
    """Bytes that are looked at here and there: ``get(at, n)`` gives up to n of them."""

    get: Callable[[int, int], bytes]
    size: int

    @classmethod
    def of(cls, data: bytes) -> Window:
        return cls(lambda at, n: data[at : at + n], len(data))

    @classmethod
    def coded(cls, run: str, start: int, stop: int) -> Window:
        """Of base64 letters [start, stop) of a run, in the plain alphabet; only those that are
        asked for are decoded."""
        letters = stop - start

        def get(at: int, n: int) -> bytes:
            first = start + 4 * (at // 3)
            some = run[first : min(stop, start + 4 * -(-(at + n) // 3))]
            some = some[: len(some) - (len(some) % 4 == 1)]
            return binascii.a2b_base64(some + "=" * (-len(some) % 4))[at % 3 : at % 3 + n]

        return cls(get, (letters - (letters % 4 == 1)) * 3 // 4)


def der_items(data: Window, start: int, stop: int) -> list[tuple[int, int, int]] | None:
    """Tag, and the place and end of the value, of each item; None unless the lengths fill
    the place exactly, or where there are more items than a key has. Only headers are read."""
    items, at = [], start
    while at < stop:
        head = data.get(at, 6)
        if len(head) < 2 or at + 2 > stop or len(items) == MOST_ITEMS:
            return None
        tag, length, at = head[0], head[1], at + 2
        if length & 0x80:
            n = length & 0x7F
            if not 1 <= n <= 4 or at + n > stop:
                return None
            length, at = int.from_bytes(head[2 : 2 + n], "big"), at + n
        if at + length > stop:
            return None
        items.append((tag, at, at + length))
        at += length
    return items


def der_length(data: bytes) -> int | None:
    """Bytes that a sequence takes by its own header."""
    if len(data) < 6 or data[0] != SEQUENCE:
        return None
    n = data[1] & 0x7F if data[1] & 0x80 else 0
    return 2 + data[1] if not data[1] & 0x80 else 2 + n + int.from_bytes(data[2 : 2 + n], "big") if 1 <= n <= 4 else None


def is_private_der(data: Window) -> bool:
    outer = der_items(data, 0, data.size)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    inner = der_items(data, *outer[0][1:])
    if not inner:
        return False
    tags, sizes = [i[0] for i in inner], [i[2] - i[1] for i in inner]
    if tags == [SEQUENCE, OCTETS] and sizes[1] >= 32 and sizes[1] % 8 == 0:
        algorithm = der_items(data, *inner[0][1:])  # PKCS#8, encrypted: algorithm and parameters, then the cipher text
        return bool(algorithm) and [i[0] for i in algorithm] == [OBJECT_ID, SEQUENCE]
    if tags[0] != INTEGER or sizes[0] != 1:
        return False
    version = data.get(inner[0][1], 1)[0]
    if tags[:9] == [INTEGER] * 9 and version in (0, 1):
        return True
    if tags == [INTEGER] * 6 and version == 0:
        return True  # DSA
    if tags[1:3] == [SEQUENCE, OCTETS] and version in (0, 1):
        algorithm = der_items(data, *inner[1][1:])
        return bool(algorithm) and algorithm[0][0] == OBJECT_ID
    return version == 1 and len(tags) > 1 and tags[1] == OCTETS and 16 <= sizes[1] <= 80


def is_private_ssh(data: Window) -> bool:
    """The OpenSSH container: magic, then fields that each fit into what is left."""
    magic = b"openssh-key-v1\0"
    if data.get(0, len(magic)) != magic:
        return False
    at = len(magic)
    for _ in range(3):
        if at + 4 > data.size:
            return False
        at += 4 + int.from_bytes(data.get(at, 4), "big")
    return at + 4 <= data.size and 1 <= int.from_bytes(data.get(at, 4), "big") <= 16


def from_base64(text: str) -> bytes:
    text = re.sub(r"\s+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text[: len(text) - (len(text) % 4 == 1)] + "=" * (-len(text) % 4 % 3))
    except (binascii.Error, ValueError):
        return b""


def is_signed_token(text: str) -> bool:
    try:
        head, body = (json.loads(from_base64(p)) for p in text.split(".")[:2])
    except (ValueError, RecursionError):
        return False
    signed = isinstance(head, dict) and isinstance(head.get("alg"), str) and head["alg"].lower() != "none" and text.rpartition(".")[2] != ""
    return signed and isinstance(body, dict)


def key_spans(text: str, at: int) -> list[tuple[str, int, int]]:
    """Keys in a run of base64 letters and line breaks that begins at ``at``. Each place where
    one may begin is told by some headers; what a key takes up is not looked at again."""
    places = [i for i, c in enumerate(text) if not c.isspace()]
    run, spans, after = "".join(text.split()), [], 0
    letters, plain = len(run.rstrip("=")), run.replace("-", "+").replace("_", "/")
    for m in KEY_START.finditer(run):
        start = m.start()
        if start < after:
            continue
        if run[start] == "M":
            head = Window.coded(plain, start, min(start + 12, letters)).get(0, 8)
            inside = 2 + (head[1] & 0x7F) * (head[1] >> 7) if len(head) > 1 else 0
            size = der_length(head) if head[inside : inside + 1] in (b"\x02", b"\x30") else None
            # the letters of that many bytes, without what fills them up
            end = start + -(-4 * size // 3) if size and size >= 30 else letters + 1
            if end <= letters and is_private_der(Window(Window.coded(plain, start, end).get, size)):
                end = len(run) if end == letters else end
                spans.append(("der", at + places[start], at + places[end - 1] + 1))
                after = end
        elif is_private_ssh(Window.coded(plain, start, letters)):
            spans.append(("ssh", at + places[start], at + places[-1] + 1))
            after = len(run)
    return spans


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    return spans + [("hex", *m.span()) for m in HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    spans = []
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            data = Window.of(from_base64(m[3]))
            if is_private_der(data) or is_private_ssh(data) or "DEK-Info:" in m[2] and data.size and data.size % 8 == 0:
                spans.append(("pem", *m.span()))
    for m in BASE64.finditer(text):
        spans += key_spans(m[0], m.start())
    for m in HEX_BYTES.finditer(text):
        data = Window.of(bytes.fromhex(m[0]))
        if is_private_der(data) or is_private_ssh(data):
            spans.append(("der" if data.get(0, 1)[0] == SEQUENCE else "ssh", *m.span()))
    if "eyJ" in text:
        spans += [("jwt", *m.span(1)) for m in TOKEN.finditer(text) if is_signed_token(m[1])]
    return spans


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, the base's counts and digest, and all spans of every text."""

    def make():
        def scan(texts: list[str]) -> dict[str, list]:
            base = [base_spans(t) for t in texts]
            return {
                **{f"n_{k}": [sum(s[0] == k for s in b) for b in base] for k in KINDS[:3]},
                "base_sha256": [hashlib.sha256(listed(b).encode()).hexdigest() for b in base],
                "spans": [listed(b + confirmed_spans(t)) for b, t in zip(base, texts, strict=True)],
            }

        return scan

    return map_texts(documents(docs), make, {"n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string", "spans": "string"})


def redacted(text: str, mark: str) -> str:
    out, at = [], 0
    for _, a, b in sorted(set(base_spans(text) + confirmed_spans(text)), key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` and n_chars brought up to date.
    Null texts stay null; all columns of ``docs`` stay."""

    name = "clean"
    while name in docs.columns:
        name += "_"

    def make():
        return lambda texts: {name: [t if t is None else redacted(t, mark) for t in texts]}

    clean = map_texts(docs, make, {name: "string"}).withColumnRenamed(name, "text")
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return clean.select(*[quoted(c) for c in docs.columns])
