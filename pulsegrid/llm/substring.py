"""Removing passages that an earlier document holds, by difference-cover anchors.

A window is ``WINDOW`` = 13 consecutive words of one document. A word goes if a window over it also starts in a
document with a smaller doc_id, judged on the input.

{0, 1, 3} modulo 7 is a difference cover: for any two positions some shift of 0 to 6 brings both onto it. So two
equal 13-word windows share an anchor, a 7-word window at a cover position of both documents, and only three of
seven positions are hashed at first:

1. Documents are dealt to chunks of bounded text by a hash of doc_id. Each chunk sends the distinct anchor hashes of
   its documents, packed by hash bucket, with a mark on those that two of its documents share.
   The number of buckets follows the bytes as that of the chunks does, so both hold a bounded share at any size.
2. A bucket returns to each chunk the anchors that two documents share anywhere.
3. Each chunk extends: the 13-word windows around a shared anchor are hashed, and (hash, least and greatest doc_id in
   the chunk) go to their bucket.
4. A bucket returns the least doc_id of all for windows that a chunk holds in a later document.
5. The chunk marks the covered words and writes the rest.

A passage that a third of all documents hold is one entry per chunk, not per document; no pairs are made. All three
passes read one shuffle of the texts by chunk.

Defined results: null text has no words; rows that share a doc_id do not remove each other's words; a null doc_id
counts as larger than any other. Extra columns are ignored. Unicode spaces are parts of words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import U64, Words, grams, prepare, shuffle_partitions, slices, texts

WINDOW = 13
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
CHUNK_BYTES = 8 << 20
# Text whose hashes one bucket holds: 0.6 x as much for anchors of words of 6 bytes, up to 4 x where every window repeats.
BUCKET_BYTES = 32 << 20
_LAST = np.iinfo(np.int64).max


class _Slice:
    """Words, hashes and document of each word for some rows of a chunk."""

    def __init__(self, rows: pa.RecordBatch):
        self.rows = rows
        words = Words(rows.column("text"))
        self.hashes, self.first = words.hashes(), words.first
        count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(count)), count)
        self.place = np.arange(len(self.hashes)) - np.repeat(self.first[:-1], count)  # position in its document
        self.left = np.repeat(self.first[1:], count) - np.arange(len(self.hashes))  # words from here to its end
        ids = rows.column("doc_id")
        self.ids = np.asarray(ids.fill_null(_LAST))

    def anchors(self) -> np.ndarray:
        return np.flatnonzero(np.isin(self.place % PERIOD, COVER) & (self.left >= ANCHOR))

    def windows(self) -> np.ndarray:
        return np.flatnonzero(self.left >= WINDOW)


def _slices(table: pa.Table):
    for batch in table.select(["doc_id", "text"]).combine_chunks().to_batches():
        for rows in slices(batch, "text"):
            yield _Slice(rows)


def _joined(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _known(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ``values`` are among ``sorted_values``, and where."""
    if not len(sorted_values):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values, at


def _per_hash(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes with the least and greatest of their values."""
    if not len(h):
        return h, doc, doc
    order = np.argsort(h, kind="stable")
    h, doc = h[order], doc[order]
    begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[begin], np.minimum.reduceat(doc, begin), np.maximum.reduceat(doc, begin)


def _by_bucket(h: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """Positions of ``h`` (sorted) by bucket; the bucket is a range of hashes."""
    bucket = ((h >> U64(32)) * U64(buckets)) >> U64(32)
    cut = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
    return [(b, np.arange(cut[b], cut[b + 1])) for b in range(buckets) if cut[b + 1] > cut[b]]


_ANCHORS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("many", pa.binary())])
_SHARED = pa.schema([("chunk", pa.int64()), ("hashes", pa.binary())])
_WINDOWS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("least", pa.binary()), ("most", pa.binary())])
_OWNERS = pa.schema([("chunk", pa.int64()), ("hashes", pa.binary()), ("least", pa.binary())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _chunk_anchors(buckets: int):
    def run(key, table):
        hashes, docs, seen = [], [], 0
        for s in _slices(table):
            at = s.anchors()
            hashes.append(grams(s.hashes, ANCHOR, at))
            docs.append(s.doc[at] + seen)
            seen += s.rows.num_rows
        h, low, high = _per_hash(_joined(hashes, np.uint64), _joined(docs, np.int64))
        many = (low != high).astype(np.uint8)
        chunk = key[0].as_py()
        return _table(_ANCHORS, [(b, chunk, h[at].tobytes(), many[at].tobytes()) for b, at in _by_bucket(h, buckets)])

    return run


def _shared_anchors(key, table):
    blobs = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    many = np.frombuffer(b"".join(table.column("many").to_pylist()), np.uint8)
    chunks = table.column("chunk").to_pylist()
    h = np.concatenate(blobs)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    shared = many[order].astype(bool)
    shared[1:] |= same
    shared[:-1] |= same
    begin = np.flatnonzero(np.concatenate([[True], ~same]))
    marked = np.logical_or.reduceat(shared, begin)  # one chunk's mark holds for all chunks
    flag = np.empty(len(h), bool)
    flag[order] = np.repeat(marked, np.diff(np.append(begin, len(h))))
    ends = np.cumsum([len(x) for x in blobs])
    rows = []
    for chunk, blob, end in zip(chunks, blobs, ends.tolist(), strict=True):
        some = blob[flag[end - len(blob):end]]
        if len(some):
            rows.append((chunk, some.tobytes()))
    return _table(_SHARED, rows)


def _chunk_windows(buckets: int):
    def run(key, table, back):
        if not table.num_rows or not back.num_rows:
            return _table(_WINDOWS, [])
        shared = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in back.column("hashes").to_pylist()]))
        hashes, docs = [], []
        for s in _slices(table):
            at = s.anchors()
            hit = np.zeros(len(s.hashes) + 1, np.int32)
            hit[at[_known(shared, grams(s.hashes, ANCHOR, at))[0]] + 1] = 1
            hit = np.cumsum(hit)
            starts = s.windows()
            # an anchor within the window begins at one of its first PERIOD words
            starts = starts[hit[starts + PERIOD] > hit[starts]]
            hashes.append(grams(s.hashes, WINDOW, starts))
            docs.append(s.ids[s.doc[starts]])
        h, low, high = _per_hash(_joined(hashes, np.uint64), _joined(docs, np.int64))
        chunk = key[0].as_py()
        return _table(_WINDOWS, [(b, chunk, h[at].tobytes(), low[at].tobytes(), high[at].tobytes()) for b, at in _by_bucket(h, buckets)])

    return run


def _window_owners(key, table):
    blobs = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    low = np.frombuffer(b"".join(table.column("least").to_pylist()), np.int64)
    high = np.frombuffer(b"".join(table.column("most").to_pylist()), np.int64)
    h, least, _ = _per_hash(np.concatenate(blobs), low)
    rows, begin = [], 0
    for chunk, blob in zip(table.column("chunk").to_pylist(), blobs, strict=True):
        owner = least[np.searchsorted(h, blob)]
        later = owner < high[begin:begin + len(blob)]
        begin += len(blob)
        if later.any():
            rows.append((chunk, blob[later].tobytes(), owner[later].tobytes()))
    return _table(_OWNERS, rows)


def _chunk_kept(key, table, back):
    known = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(x, np.uint64) for x in back.column("hashes").to_pylist())])
    owner = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in back.column("least").to_pylist())])
    order = np.argsort(known)
    known, owner = known[order], owner[order]
    out = []
    for s in _slices(table):
        covered = np.zeros(len(s.hashes) + 1, np.int32)
        if len(known):
            starts = s.windows()
            found, at = _known(known, grams(s.hashes, WINDOW, starts))
            starts = starts[found][owner[at[found]] < s.ids[s.doc[starts[found]]]]
            covered[starts] += 1
            np.add.at(covered, starts + WINDOW, -1)
        gone = np.cumsum(covered[:-1]) > 0
        removed = np.add.reduceat(np.append(gone, False), s.first[:-1]) * (np.diff(s.first) > 0)
        kept = []
        for i, text in enumerate(texts(s.rows.column("text"))):
            words = text.as_buffer().to_pybytes().split()
            if removed[i]:
                words = [w for w, g in zip(words, gone[s.first[i]:s.first[i + 1]].tolist(), strict=True) if not g]
            kept.append(b" ".join(words))
        out.append(pa.table([s.rows.column("doc_id"), pa.array(np.diff(s.first).astype(np.int64)), pa.array(removed.astype(np.int64)),
                             pa.array(kept, pa.binary()).cast(pa.string())], schema=_KEPT))
    return pa.concat_tables(out) if out else _KEPT.empty_table()


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)`` per row of ``docs(doc_id, text)``; kept words joined by one space."""
    spark = prepare(docs.sparkSession)
    n_part = shuffle_partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks = max(2 * n_part, -(-int(size) // CHUNK_BYTES))
    buckets = max(n_part, -(-int(size) // BUCKET_BYTES))
    spread = F.xxhash64(F.coalesce(F.col("doc_id"), F.xxhash64("text")))
    dealt = docs.select(F.pmod(spread, F.lit(n_chunks)).alias("chunk"), "doc_id", "text")

    anchors = dealt.groupBy("chunk").applyInArrow(_chunk_anchors(buckets), "bucket int, chunk long, hashes binary, many binary")
    shared = anchors.groupBy("bucket").applyInArrow(_shared_anchors, "chunk long, hashes binary")
    windows = dealt.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(
        _chunk_windows(buckets), "bucket int, chunk long, hashes binary, least binary, most binary")
    owners = windows.groupBy("bucket").applyInArrow(_window_owners, "chunk long, hashes binary, least binary")
    return dealt.groupBy("chunk").cogroup(owners.groupBy("chunk")).applyInArrow(
        _chunk_kept, "doc_id long, n_words long, n_removed long, kept_text string")
