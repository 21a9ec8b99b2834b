"""Alignment of two tokenizers' tokens over a corpus, by inverted pair bitmaps.

Every text is encoded by both tokenizers; byte offsets where tokens of both end cut it into groups, and each token of
the one is linked with each of the other in its group. No token of either crosses from a visible character into a
space, so every word is aligned once and looked up from then on (see ``Vocabulary``).

A task numbers its documents in blocks; a block holds at most 65,536 documents and closes when it has some millions
of links. For every linked id pair a block holds a compressed
bitmap of its documents (sorted 16-bit numbers, or plain bits from 4,096 documents on) and planes of the links'
multiplicity, one bit of (links - 1) for every document that is set, so that pairs linked once need none. The sorted
postings of a block's slices are OR-merged into its bitmaps as it closes; blocks hold different documents, so the
popcount of the OR over all blocks is the sum of theirs, added up with partial sums.

The counts then meet the postings in one join on the pair (adaptive execution splits a hot pair, whose postings are
one row per block, and broadcasts the counts where they are small). There each posting returns its scores: a task
decodes bitmaps and planes, adds up count and links per document and hands on one small array per block whenever it
has held a bounded number of them. The arrays of a block meet its document rows in the last grouping, which holds at
most one block.

Defined results: null and empty texts, and texts that one tokenizer does not give back byte by byte, have no tokens,
zeros, and an empty digest; every row is a document of its own, also if it repeats a doc_id or is null there; extra
columns are ignored. No documents give no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm import encoding
from pulsegrid.llm.common import materialise, offsets_of, prepare, slices, texts

# Documents and (pair, document) entries of a block; links worked on at once; held score entries of a task.
BLOCK_DOCS = 1 << 16
BLOCK_ENTRIES = 2_000_000
LINKS_AT_ONCE = 4_000_000
HELD_SCORES = 2_000_000
# Words that a Python worker knows, and their letters; a full table starts anew (it saves time only).
HELD_WORDS, HELD_CHARS = 400_000, 8_000_000
# From here on plain bits are smaller than 16-bit numbers.
DENSE = 4096
ROWS_A_BATCH = 50_000


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---- groups and links of texts ---------------------------------------------------------------------------------


class Aligned:
    """Tokens of both tokenizers over a list of texts, with their groups; texts without tokens have none."""

    def __init__(self, pair: TokenPair, found: list[str]):
        want = [(" " + t).encode() if t else b"" for t in found]
        sides = []
        for side, spaced in ((pair.a, True), (pair.b, False)):
            ids, first = encoding.encode(side.lib, [" " + t if spaced and t else t for t in found])
            sides.append((side, ids, first))
        good = np.array([bool(w) for w in want])
        for side, ids, first in sides:
            pieces = list(map(side.bytes.__getitem__, ids))
            if b"".join(pieces) != b"".join(want):
                good &= [b"".join(pieces[x:y]) == w for x, y, w in zip(first[:-1].tolist(), first[1:].tolist(), want, strict=True)]
        size = np.where(good, [len(w) for w in want], 0)
        self.n_docs = len(found)
        self.doc_end = np.cumsum(size)  # byte offsets over all texts that count
        (self.a, self.n_a, end_a), (self.b, self.n_b, end_b) = (self._side(*s, good) for s in sides)
        self.ends = np.intersect1d(end_a, end_b, assume_unique=True)
        self.last_a, self.last_b = np.searchsorted(end_a, self.ends), np.searchsorted(end_b, self.ends)
        # tokens of each group, and the text that it lies in
        self.size_a, self.size_b = np.diff(self.last_a, prepend=-1), np.diff(self.last_b, prepend=-1)
        self.doc = np.searchsorted(self.doc_end, self.ends)

    @staticmethod
    def _side(side: Side, ids: list[int], first: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, n = np.array(ids, np.int64), np.diff(first)
        if not good.all():
            ids, n = ids[np.repeat(good, n)], np.where(good, n, 0)
        return ids, n, np.cumsum(side.size[ids])

    def n_groups(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def n_links(self) -> np.ndarray:
        before = np.concatenate([[0], np.cumsum(self.size_a * self.size_b)])
        return np.diff(before[np.concatenate([[0], np.cumsum(self.n_groups())])])

    def shown(self, pair: TokenPair) -> list[bytes]:
        """Each text's groups, ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        code = np.zeros(len(self.a) + len(self.b), np.int64)
        # every token's text with its separator: a comma inside its side of the group, '|' or ';' at the end
        at_a = np.arange(len(self.a)) + np.repeat(np.cumsum(self.size_b) - self.size_b, self.size_a)
        at_b = np.arange(len(self.b)) + np.repeat(np.cumsum(self.size_a), self.size_b)
        code[at_a], code[at_b] = 2 * self.a, pair.first_b + 2 * self.b
        code[at_a[self.last_a]] += 1
        code[at_b[self.last_b]] += 1
        shown = list(map(pair.shown.__getitem__, code.tolist()))
        bounds = np.concatenate([[0], np.cumsum(self.n_a + self.n_b)]).tolist()
        return [b"".join(shown[x:y])[:-1] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]

    def postings(self, pair: TokenPair, first_doc: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (pair, document number) and how many links each has."""
        links = self.size_a * self.size_b
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        start, before = 0, np.concatenate([[0], np.cumsum(links)])
        while start < len(links):
            end = max(start + 1, int(np.searchsorted(before, before[start] + LINKS_AT_ONCE, side="right")) - 1)
            if end == start + 1 and links[start] > LINKS_AT_ONCE:
                parts += self._large(pair, start, first_doc)
            else:
                n_a, n_b = self.size_a[start:end], self.size_b[start:end]
                each = np.repeat(n_b, n_a)  # links of each token of a
                a0, b0 = self.last_a[start] + 1 - n_a[0], self.last_b[start:end] + 1 - n_b
                a = np.repeat(self.a[a0:a0 + len(each)], each)
                back = np.repeat(np.repeat(b0, n_a) - (np.cumsum(each) - each), each)
                b = self.b[back + np.arange(len(a))]
                doc = np.repeat(np.repeat(self.doc[start:end], n_a), each)
                parts.append(_summed(pair.key(a, b) << 16 | doc + first_doc))
            start = end
        return _merged(parts)

    def _large(self, pair: TokenPair, g: int, first_doc: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """A group of very many links: distinct ids of either side, in blocks of one side's."""
        a, many_a = np.unique(self.a[self.last_a[g] + 1 - self.size_a[g]:self.last_a[g] + 1], return_counts=True)
        b, many_b = np.unique(self.b[self.last_b[g] + 1 - self.size_b[g]:self.last_b[g] + 1], return_counts=True)
        step = max(1, LINKS_AT_ONCE // len(b))
        return [(np.sort((pair.key(np.repeat(a[k:k + step], len(b)), np.tile(b, len(a[k:k + step]))) << 16) | int(self.doc[g]) + first_doc),
                 np.outer(many_a[k:k + step], many_b).ravel()) for k in range(0, len(a), step)]


class Vocabulary:
    """Words that a Python worker has met, each aligned once.

    A text is cut before every space that follows a visible character and does not end the text: there tokens of both
    tokenizers end. So a text's groups are those of its words, one after the other, and its links are sums over its
    words. Where a tokenizer's file gives no such promise, the whole text is one word.
    """

    # the letters that some Unicode version calls white space do not count as visible
    _cut = re.compile("(?<=[^\\s\u180e\u200b\ufeff]) (?!\\Z)")
    LEARN = 50_000  # words aligned together (numbered in 16 bits)

    def __init__(self, pair: TokenPair):
        self.pair = pair
        self.cuts = pair.a.lib.cuts and pair.b.lib.cuts
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.shown: list[bytes] = []
        self.sums = np.zeros((4, 0), np.int64)  # n_a, n_b, n_groups, n_links of each word
        self.first = np.zeros(1, np.int64)  # where each word's pairs begin
        self.pairs, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, words: list[str]) -> None:
        found = Aligned(self.pair, words)
        keys, many = found.postings(self.pair, 0)
        word = keys & 0xFFFF
        order = np.argsort(word, kind="stable")
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.bincount(word, minlength=len(words)))])
        self.pairs, self.links = np.concatenate([self.pairs, keys[order] >> 16]), np.concatenate([self.links, many[order]])
        self.sums = np.hstack([self.sums, [found.n_a, found.n_b, found.n_groups(), found.n_links()]])
        self.shown += found.shown(self.pair)
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words)), strict=True))

    def look_up(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, word) of every word of the texts that count, in order."""
        cut = [(self._cut.split(t) if self.cuts else [t]) if t else [] for t in found]
        flat = list(itertools.chain.from_iterable(cut))
        new = [w for w in dict.fromkeys(flat) if w not in self.index]
        if new and (len(self.index) + len(new) > HELD_WORDS or self.chars > HELD_CHARS):
            self._forget()
            new = list(dict.fromkeys(flat))
        for k in range(0, len(new), self.LEARN):
            self._learn(new[k:k + self.LEARN])
        self.chars += sum(map(len, new))
        word = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
        text = np.repeat(np.arange(len(found)), list(map(len, cut)))
        # a word that one tokenizer does not give back takes its text out
        bad = np.bincount(text, weights=self.sums[0][word] == 0, minlength=len(found)) > 0
        return text[~bad[text]], word[~bad[text]]

    def postings(self, text: np.ndarray, word: np.ndarray, first_doc: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys (pair, document number) and how many links each has."""
        both, times = _summed(word << 32 | text)
        word, text = both >> 32, both & 0xFFFFFFFF
        n = self.first[word + 1] - self.first[word]
        parts, start, before = [], 0, np.concatenate([[0], np.cumsum(n)])
        while start < len(n):
            end = max(start + 1, int(np.searchsorted(before, before[start] + LINKS_AT_ONCE, side="right")) - 1)
            some = n[start:end]
            at = np.repeat(self.first[word[start:end]] - (np.cumsum(some) - some), some) + np.arange(int(some.sum()))
            parts.append(_merged([(self.pairs[at] << 16 | np.repeat(text[start:end], some) + first_doc, self.links[at] * np.repeat(times[start:end], some))], False))
            start = end
        return _merged(parts)


class Side:
    def __init__(self, path: str):
        self.lib = encoding.tokenizer(path, True)
        self.bytes = self.lib.token_bytes()
        self.size = np.array([len(x) for x in self.bytes], np.int64)


class TokenPair:
    """Both tokenizers, their token bytes, and the texts of their ids."""

    _held: dict[tuple[str, str], Vocabulary] = {}

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Side(path_a), Side(path_b)
        self.n_b = len(self.b.bytes)
        self.first_b = 2 * len(self.a.bytes)
        self.shown = [f"{i}{mark}".encode() for n, marks in ((len(self.a.bytes), ",|"), (self.n_b, ",;")) for i in range(n) for mark in marks]

    def key(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * self.n_b + b

    @classmethod
    def vocabulary(cls, paths: tuple[str, str]) -> Vocabulary:
        if paths not in cls._held:
            cls._held[paths] = Vocabulary(cls(*paths))
        return cls._held[paths]


def _summed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.diff(at, append=len(keys))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]], in_order: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Runs of (key, links), each in order or not, merged into one; links of equal keys add up."""
    if not parts or not sum(len(p[0]) for p in parts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(parts) == 1 and in_order:
        return parts[0]
    keys, many = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable" if in_order else None)  # runs in order: a merge
    keys, many = keys[order], many[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(many, at)


# ---- bitmaps and planes ------------------------------------------------------------------------------------------


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def to_bitmaps(keys: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Pairs, popcounts, bitmaps and planes of merged postings."""
    pairs = keys >> 16
    at = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    n = np.diff(at, append=len(keys))
    number = (keys & 0xFFFF).astype("<u2")
    size = np.where(n < DENSE, 2 * n, BLOCK_DOCS // 8)
    to = np.concatenate([[0], np.cumsum(size)])
    if (n < DENSE).all():
        data = number.view(np.uint8)
    else:
        data = np.zeros(to[-1], np.uint8)
        few = np.repeat(n < DENSE, n)
        data[np.repeat(n < DENSE, size)] = number[few].view(np.uint8)
        for k in np.flatnonzero(n >= DENSE).tolist():
            bits = np.zeros(BLOCK_DOCS, np.uint8)
            bits[number[at[k]:at[k] + n[k]]] = 1
            data[to[k]:to[k + 1]] = np.packbits(bits, bitorder="little")
    # plane p of a pair: bit p of (links - 1) of its documents in order
    most = np.maximum.reduceat(many, at) - 1
    planes = np.frexp(most.astype(float))[1].astype(np.int64)
    width = (n + 7) // 8
    plane_to = np.concatenate([[0], np.cumsum(planes * width)])
    plane_data = np.zeros(plane_to[-1], np.uint8)
    extra = np.flatnonzero(many > 1)
    of = np.searchsorted(at, extra, side="right") - 1
    place, rest = extra - at[of], many[extra] - 1
    p = 0
    while len(extra):
        on = (rest & 1).astype(bool)
        np.add.at(plane_data, plane_to[of[on]] + p * width[of[on]] + (place[on] >> 3), (1 << (place[on] & 7)).astype(np.uint8))
        rest >>= 1
        left = rest > 0
        extra, of, place, rest, p = extra[left], of[left], place[left], rest[left], p + 1
    return pairs[at], n, _binary(data, to), _binary(plane_data, plane_to)


def from_bitmaps(bits: pa.Array, planes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every document that is set: the row of its bitmap, its number, its links."""
    off = offsets_of(bits)
    size = np.diff(off)
    data = np.frombuffer(bits.buffers()[2], np.uint8)
    dense = size == BLOCK_DOCS // 8
    n = size // 2
    found = {}
    for k in np.flatnonzero(dense).tolist():
        found[k] = np.flatnonzero(np.unpackbits(data[off[k]:off[k + 1]], bitorder="little"))
        n[k] = len(found[k])
    first = np.cumsum(n) - n
    number = np.zeros(int(n.sum()), np.int64)
    few = np.repeat(~dense, n)
    number[few] = data[off[0]:off[-1]][np.repeat(~dense, size)].view("<u2") if few.any() else 0
    for k, x in found.items():
        number[first[k]:first[k] + n[k]] = x
    row = np.repeat(np.arange(len(n)), n)
    links = np.ones(len(number), np.int64)
    plane_off = offsets_of(planes)
    width = (n + 7) // 8
    depth = np.diff(plane_off) // np.maximum(width, 1)
    if depth.any():
        plane_data = np.frombuffer(planes.buffers()[2], np.uint8)
        for p in range(int(depth.max())):
            rows = np.flatnonzero(depth > p)
            at = np.repeat(first[rows] - (np.cumsum(n[rows]) - n[rows]), n[rows]) + np.arange(int(n[rows].sum()))
            place = at - np.repeat(first[rows], n[rows])
            byte = plane_data[np.repeat(plane_off[:-1][rows] + p * width[rows], n[rows]) + (place >> 3)]
            links[at] += (byte >> (place & 7).astype(np.uint8) & 1).astype(np.int64) << p
    return row, number, links


# ---- the Spark job -----------------------------------------------------------------------------------------------

_DOC = [("block", pa.int64()), ("number", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
_POSTING = [("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32()), ("bits", pa.binary()), ("planes", pa.binary())]
_BLOCKS = "block long, number int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a int, b int, n int, bits binary, planes binary"
_SCORES = "block long, numbers binary, best binary, total binary"
_RESULT = [*_DOC[2:7], ("n_best", pa.int64()), ("count_sum", pa.int64()), _DOC[7]]


def _blocks(paths: tuple[str, str]):
    schema = pa.schema([*_DOC, *_POSTING])

    def batch(n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in schema], schema=schema)

    def closed(pair: TokenPair, block: int, runs: list):
        keys, many = _merged(runs)
        if not len(keys):
            return
        pairs, n, bits, planes = to_bitmaps(keys, many)
        for k in range(0, len(pairs), ROWS_A_BATCH):
            part = slice(k, k + ROWS_A_BATCH)
            rows = len(pairs[part])
            yield batch(rows, {"block": pa.array(np.full(rows, block)), "a": pa.array(pairs[part] // pair.n_b), "b": pa.array(pairs[part] % pair.n_b),
                               "n": pa.array(n[part]), "bits": bits.slice(k, rows), "planes": planes.slice(k, rows)})

    def run(batches):
        known = TokenPair.vocabulary(paths)
        block, docs, entries, runs = TaskContext.get().partitionId() << 20, 0, 0, []
        for given in batches:
            for rows in slices(given, "text"):
                n = rows.num_rows
                if docs + n > BLOCK_DOCS or entries > BLOCK_ENTRIES:
                    yield from closed(known.pair, block, runs)
                    block, docs, entries, runs = block + 1, 0, 0, []
                text, word = known.look_up(texts(rows.column("text")).to_pylist())
                bounds = np.searchsorted(text, np.arange(n + 1)).tolist()
                shown = list(map(known.shown.__getitem__, word.tolist()))
                digests = [hashlib.sha256(b";".join(shown[x:y])).hexdigest() if y > x else "" for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                sums = [pa.array(np.bincount(text, weights=x[word], minlength=n).astype(np.int64)) for x in known.sums]
                yield batch(n, {"block": pa.array(np.full(n, block)), "number": pa.array(np.arange(docs, docs + n)), "doc_id": rows.column("doc_id"),
                                **dict(zip(("n_a", "n_b", "n_groups", "n_links"), sums, strict=True)), "groups_sha256": pa.array(digests)})
                runs.append(known.postings(text, word, docs))
                docs, entries = docs + n, entries + len(runs[-1][0])
        yield from closed(known.pair, block, runs)

    return run


def _totals(keys: list, best: list, total: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums per key (block << 16 | number), keys ascending."""
    keys, best, total = (np.concatenate(x) for x in (keys, best, total))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(best[order], at), np.add.reduceat(total[order], at)


def _return_scores(batches):
    """Per block: sums over a task's postings of the links that are best, and of links times count."""
    held: list[list[np.ndarray]] = [[], [], []]
    waiting = 0

    def out():
        keys, best, total = _totals(*held)
        blocks = np.unique(keys >> 16)
        cut = np.concatenate([np.searchsorted(keys >> 16, blocks), [len(keys)]])
        return pa.RecordBatch.from_arrays(
            [pa.array(blocks), _binary((keys & 0xFFFF).astype("<u2").view(np.uint8), 2 * cut), _binary(best.view(np.uint8), 8 * cut),
             _binary(total.view(np.uint8), 8 * cut)], names=["block", "numbers", "best", "total"])

    for batch in batches:
        if not batch.num_rows:
            continue
        row, number, links = from_bitmaps(batch.column("bits"), batch.column("planes"))
        block = np.asarray(batch.column("block"))
        count, is_best = np.asarray(batch.column("pair_count")), np.asarray(batch.column("is_best")).astype(np.int64)
        for x, y in zip(held, (block[row] << 16 | number, links * is_best[row], links * count[row]), strict=True):
            x.append(y)
        waiting += len(row)
        if waiting > HELD_SCORES:
            held = [[x] for x in _totals(*held)]
            waiting = 0
            if len(held[0][0]) > HELD_SCORES:
                yield out()
                held = [[], [], []]
    if held[0]:
        yield out()


def _with_scores(docs: pa.Table, scores: pa.Table) -> pa.Table:
    number = docs.column("number").to_numpy()
    best, total = np.zeros((2, BLOCK_DOCS), np.int64)
    for found, b, t in zip(*(scores.column(c).to_pylist() for c in ("numbers", "best", "total")), strict=True):
        at = np.frombuffer(found, "<u2")
        best[at] += np.frombuffer(b, np.int64)
        total[at] += np.frombuffer(t, np.int64)
    columns = {"n_best": pa.array(best[number]), "count_sum": pa.array(total[number])}
    return pa.table({name: columns.get(name, docs.column(name) if name in docs.column_names else None) for name, _ in _RESULT})


def align(docs: DataFrame, tokenizers: tuple[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(blocks, counts)``: the written documents and postings, and per linked id pair (a, b) its ``pair_count``
    (documents that hold it linked) and ``is_best`` (the highest of its a, ties included)."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = materialise(docs.mapInArrow(_blocks(tokenizers or default_tokenizers()), _BLOCKS), "align-blocks")
    counts = blocks.where("a is not null").groupBy("a", "b").agg(F.sum("n").alias("pair_count"))
    highest = F.max("pair_count").over(Window.partitionBy("a"))
    counts = counts.withColumn("is_best", F.col("pair_count") == highest)
    return blocks, materialise(counts, "align-counts")


def align_documents(docs: DataFrame, tokenizers: tuple[str, str] | None = None) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    blocks, counts = align(docs, tokenizers)
    # a merge join at any size: what it moves then follows the corpus from small tables on
    postings = blocks.where("a is not null").select("a", "b", "block", "bits", "planes").join(counts.hint("merge"), ["a", "b"])
    scores = postings.select("block", "bits", "planes", "pair_count", "is_best").mapInArrow(_return_scores, _SCORES)
    rows = blocks.where("a is null").select(*(name for name, _ in _DOC))
    ddl = ", ".join(f"{name} {'string' if kind == pa.string() else 'long'}" for name, kind in _RESULT)
    return rows.groupBy("block").cogroup(scores.groupBy("block")).applyInArrow(_with_scores, ddl)
