"""Secret scan with multipart credential linking.

Base spans are found by fixed patterns: ``assign`` (a named secret with a value of 12+ characters), ``access`` (access
key ids) and ``hex`` (16+ hex digits). They are always reported.

Weak candidates say little alone: ``secret40`` (a bare run of exactly 40 key characters that mixes cases and digits),
``user`` (a named login or client id) and ``endpoint`` (a URL's or cloud service's host). They are reported only where
a complementary part co-occurs: an interval join, within a document, of identifiers (access, user), secrets (assign,
secret40) and endpoints. Parts join when they share a scope (a paragraph: text between blank lines) and at most
``REACH`` code points lie between them. Parts of any two of these three roles complement each other; only a user and an
endpoint, both weak, need an access, assign or secret40 span in their paragraph as well, at any distance. Text outside a
paragraph has no part in it. The join is a sweep over the document's sorted spans, so its cost follows the
spans near each other; a document is one row and never split.

Positions are code points, end exclusive. Letters of the names match in either case, ASCII only. Defined results: null
and empty texts have no spans; repeated rows repeat their spans. ``scan`` ignores extra columns, ``redact`` keeps them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import offsets_of, prepare, slices, texts

# in the order in which spans with the same start are listed
KINDS = ("assign", "access", "hex", "secret40", "user", "endpoint")
BASE = KINDS[:3]
REACH = 200
MASK = "[secret]"

# Patterns work on UTF-8 bytes; those without upper case on bytes whose A-Z were lowered.
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_USER = re.compile(rb"""(?:user(?:_?name)?|login|client_id|account_id)["']?\x20*[:=]\x20*["']?([a-z0-9_.@-]{3,})""")
_ENDPOINT = re.compile(rb"""https?://[a-z0-9.-]+(?::[0-9]+)?|(?:[a-z0-9-]+\.)+(?:amazonaws\.com|cloudapp\.net|windows\.net)""")
_BLANK = re.compile(rb"\n[\x20\t\r]*\n")

_ROLE = {"access": "id", "user": "id", "assign": "secret", "secret40": "secret", "endpoint": "endpoint"}
_WEAK = frozenset(KINDS[3:])
_PUBLIC = frozenset(("user", "endpoint"))


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_DIGITS, _UPPER, _LOWER = b"0123456789", bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
_HEX_BYTE = _table(_DIGITS + b"abcdef")
_KEY_BYTE = _table(_DIGITS + _UPPER + _LOWER + b"+/")


def _runs(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs in ``mask``, cut at text borders."""
    begin, end = mask.copy(), mask.copy()
    begin[1:] &= ~mask[:-1]
    end[:-1] &= ~mask[1:]
    edge = off[(off > 0) & (off < len(mask))]
    begin[edge] = mask[edge]
    end[edge - 1] = mask[edge - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def _mixed(run: bytes) -> bool:
    return all(any(c in kind for c in run) for kind in (_DIGITS, _UPPER, _LOWER))


def linked(spans: list[tuple[int, int, int]], blanks: list[int]) -> list[tuple[int, int, int]]:
    """Of ``spans`` (start, kind number, end; sorted): base ones, and weak ones with a complementary part in scope."""
    keep = [KINDS[k] not in _WEAK for _, k, _ in spans]
    scope = np.searchsorted(blanks, [s for s, _, _ in spans]) if blanks else np.zeros(len(spans), int)
    secret = {p for p, (_, k, _) in zip(scope.tolist(), spans, strict=True) if KINDS[k] in _ROLE and KINDS[k] not in _PUBLIC}
    active: list[int] = []  # earlier parts that still reach this far
    for i, (start, kind, _) in enumerate(spans):
        role = _ROLE.get(KINDS[kind])
        if role is None:
            continue
        active = [j for j in active if scope[j] == scope[i] and start - spans[j][2] <= REACH]
        for j in active:
            if _ROLE[KINDS[spans[j][1]]] != role and scope[i] in secret:
                keep[i] = keep[j] = True
        active.append(i)
    return [s for s, k in zip(spans, keep, strict=True) if k]


def _spans(rows: pa.RecordBatch) -> list[list[tuple[int, int, int]]]:
    """Spans (start, kind number, end) in code points of each text of a slice."""
    col = texts(rows.column("text"))
    off = offsets_of(col)
    buf = col.buffers()[2]
    raw = buf.slice(int(off[0]), int(off[-1] - off[0])).to_pybytes() if buf is not None else b""
    data = np.frombuffer(raw, np.uint8)
    off = off - off[0]
    lowered = raw.lower()
    found: dict[int, list[tuple[int, int, int]]] = {}

    def add(kind: str, begin: np.ndarray, end: np.ndarray) -> None:
        k = KINDS.index(kind)
        for d, a, b in zip((np.searchsorted(off, begin, side="right") - 1).tolist(), begin.tolist(), end.tolist(), strict=True):
            found.setdefault(d, []).append((a, k, b))

    a, b = _runs(_HEX_BYTE[data], off)
    long = b - a >= 16
    add("hex", a[long], b[long])
    a, b = _runs(_KEY_BYTE[data], off)
    forty = [(x, y) for x, y in zip(a[b - a == 40].tolist(), b[b - a == 40].tolist(), strict=True) if _mixed(raw[x:y])]
    if forty:
        add("secret40", *np.array(forty).T)

    bounds = off.tolist()
    out = []
    for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        spans = found.get(i, [])
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(lowered, lo, hi) if m.end(1) - m.start(1) >= 12]
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(raw, lo, hi) if m.end() - m.start() >= 18]
        blanks: list[int] = []
        if any(k != 2 for _, k, _ in spans):  # users and endpoints alone complement nothing
            spans += [(m.start(), 4, m.end()) for m in _USER.finditer(lowered, lo, hi)]
            spans += [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(lowered, lo, hi)]
            blanks = [m.start() for m in _BLANK.finditer(raw, lo, hi)]
        if not spans:
            out.append([])
            continue
        spans.sort()
        # bytes to code points: bytes that do not continue a character
        lead = np.cumsum(np.append(0, (data[lo:hi] & 0xC0) != 0x80))
        spans = [(int(lead[a - lo]), k, int(lead[b - lo])) for a, k, b in spans]
        out.append(linked(spans, [int(lead[x - lo]) for x in blanks]))
    return out


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` per row of ``docs(doc_id, text)``; spans (kind, start, end) by start, then as KINDS lists."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for rows in slices(batch, "text"):
                spans = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in s] for s in _spans(rows)]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(spans, _SPANS)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the sha-256 of the base spans and the text of all spans, per row of ``docs``."""
    def of(*kinds):
        return F.filter(F.col("spans"), lambda s: s["kind"].isin(*kinds))

    return scan(docs).select(
        "doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(span_text(of(*BASE)), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``MASK`` (touching spans by one), n_chars kept in step."""
    prepare(docs.sparkSession)
    names = docs.columns

    def run(batches):
        for batch in batches:
            for rows in slices(batch, "text"):
                spans = _spans(rows)
                if not any(spans):
                    yield rows
                    continue
                text = rows.column("text").to_pylist()
                for i, found in enumerate(spans):
                    if found:
                        out, end = [], 0
                        for a, _, b in found:
                            if a >= end:
                                out += [text[i][end:a], MASK]
                            end = max(end, b)
                        text[i] = "".join(out) + text[i][end:]
                columns = list(rows.columns)
                columns[names.index("text")] = pa.array(text, rows.schema.field("text").type)
                if "n_chars" in names:
                    old = rows.column("n_chars")
                    new = [len(t) if s else n for t, s, n in zip(text, spans, old.to_pylist(), strict=True)]
                    columns[names.index("n_chars")] = pa.array(new, old.type)
                yield pa.RecordBatch.from_arrays(columns, schema=rows.schema)

    return docs.mapInArrow(run, docs.schema)
