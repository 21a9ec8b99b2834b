"""Phrase collocations by FM-indexes over word ids, one per shard, with counts summed across shards.

A shard is a run of one task's words of one language, at most ``SHARD_WORDS`` (a longer text counts as it comes). Its
frequent words become small numbers; everything else, like the end of a piece, becomes a break. The shard's index
holds the Burrows-Wheeler transforms of the words and of the reversed words, both sorted to the depth of the longest
phrase. A phrase is a pair of intervals, one in either transform. It is extended to the right in the reversed
transform and to the left in the forward one, in turns; the symbols found in one interval give the new interval there
by LF mapping, and the other one by the number of smaller symbols.

Words are counted first: shards deal theirs, packed, to ranges, which sum them per language and give the frequent ones ids.
Phrases then grow one word at a time, over all shards together: each shard extends its intervals and deals the new phrases,
packed, to ranges by a hash; a range sums the counts of equal phrases, gives those with at least ``least`` occurrences
an id, and sends every shard the ids and intervals of its own. An extension is only kept where the phrase without its first word and the phrase without its last
word both are frequent everywhere, so a phrase of k + 1 words is known by the pair of ids of its two parts of k words;
that pair gives its text, the counts of all its beginnings and ends, and the extensions of its parts to either side.
No dictionary, phrase table or index is ever sent to all tasks unless Spark finds it small; a shard's index meets its
own intervals only. Indexes are written once, in buckets of shards, and read from there for every length; numbers go packed,
rising ones by their differences.

Most pairs of frequent words are rare. Before pairs are dealt, every shard deals their hashes, with their counts; a
range adds up the shards' counts per hash and tells each shard which of its hashes reach ``least``. Hashes only ever
add up, so no frequent pair is lost; those that are left are counted by their words.

Defined results: a null language is ``und``; null, empty and wordless texts have no words; repeated rows count as
often as they come; equal scores are ordered by count, then by the phrase's UTF-8 bytes; a language without candidates
has no rows; extra columns are ignored. No documents give no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import _LOWER, Words, bucketed, materialise, mix, offsets_of, prepare, shuffle_partitions, slices, texts

SHARD_WORDS = 1 << 20
# Bytes of text for each range that adds up words, pair hashes or phrases.
RANGE_BYTES = 16 << 20
# Packed rows hold megabytes: an Arrow buffer grows by doubling and copying, on both sides of a task's pipe.
BATCH_BYTES = 4 << 20
# Bytes from which numbers are compressed, and bits of a pair's hash within its range.
SMALL = 64
HASH_BITS = 20
# Ranges for each bucket of the index beyond the shuffle's partitions, and the most buckets Spark allows.
BUCKET_RANGES, MOST_BUCKETS = 8, 100_000
MAX_WORDS = 5
LEAST = 100
TOP = 2000
NO_LANG = "und"

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BREAK = _PIECE_END.copy()
_BREAK[[0x20, 0x09]] = True


def _packed(raw: bytes) -> bytes:
    """The length, then the bytes, compressed where there are enough of them."""
    return len(raw).to_bytes(4, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if len(raw) >= SMALL else raw)


def _size(packed: bytes) -> int:
    return int.from_bytes(packed[:4], "little")


def _raw(packed: bytes) -> bytes:
    size = _size(packed)
    return pa.decompress(packed[4:], decompressed_size=size, codec="zstd", asbytes=True) if size >= SMALL else packed[4:]


def _bytes(x: np.ndarray, kind: str) -> bytes:
    """Numbers as planes of bytes, the low ones first: planes that hardly change compress to nothing."""
    return _packed(x.astype(kind).view(np.uint8).reshape(len(x), np.dtype(kind).itemsize).T.tobytes())


def _numbers(packed: bytes, kind: str) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    return np.frombuffer(_raw(packed), np.uint8).reshape(wide, -1).T.copy().view(kind).ravel()


def _steps(x: np.ndarray, kind: str) -> bytes:
    """Rising numbers by their differences."""
    return _bytes(np.diff(x, prepend=x[:1] * 0), kind)


def _summed(packed: bytes, kind: str) -> np.ndarray:
    return np.cumsum(_numbers(packed, kind), dtype=kind)


# ---- words of a task's texts -------------------------------------------------------------------------------------


class PieceWords(Words):
    """Words ``[^\\x20\\x09]+`` of the pieces of every text; ``opens`` marks the first word of a piece."""

    def __init__(self, col: pa.Array):
        off = offsets_of(col)
        buf = col.buffers()[2]
        data = np.frombuffer(buf, np.uint8)[off[0]:off[-1]] if buf is not None else np.zeros(0, np.uint8)
        off = off - off[0]
        self.data = _LOWER[data]
        word = ~_BREAK[data]
        begin, end = word.copy(), word.copy()
        begin[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        edge = off[(off > 0) & (off < len(data))]
        begin[edge] = word[edge]
        end[edge - 1] = word[edge - 1]
        self.offsets = off
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, off)
        piece = np.cumsum(_PIECE_END[data])[self.starts]
        self.opens = np.diff(piece, prepend=-1) > 0
        self.opens[self.first[self.first < len(self.starts)]] = True


class _Shard:
    """Word hashes of a run of texts in one language, and each distinct word once a slice."""

    def __init__(self):
        self.hashes: list[np.ndarray] = []
        self.opens: list[np.ndarray] = []
        self.known: list[np.ndarray] = []
        self.words: list[bytes] = []
        self.size = 0

    def add(self, words: PieceWords) -> None:
        hashes = words.hashes()
        known, first = np.unique(hashes, return_index=True)
        raw = words.data.tobytes()
        self.words += [raw[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)]
        self.hashes.append(hashes)
        self.opens.append(words.opens)
        self.known.append(known)
        self.size += len(hashes)

    def closed(self) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """The stream (0 before each piece, else word number + 1), the words, and how often each comes."""
        known, first = np.unique(np.concatenate(self.known), return_index=True)
        at = np.searchsorted(known, np.concatenate(self.hashes)).astype(np.int32)
        n = np.bincount(at, minlength=len(known))
        order = np.argsort(-n, kind="stable")  # small numbers for words that come often
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(1, len(order) + 1)
        opens = np.flatnonzero(np.concatenate(self.opens))
        return np.insert(number[at], opens, 0).astype("<i4"), [self.words[k] for k in first[order].tolist()], n[order]


_SHARDS = pa.schema([("shard", pa.int64()), ("stream", pa.binary()), ("range", pa.int64()), ("lang", pa.string()), ("words", pa.binary()),
                     ("local", pa.binary()), ("n", pa.binary())])
_SHARDS_DDL = "shard long, stream binary, range long, lang string, words binary, local binary, n binary"


def _shards(ranges: int):
    """Shards of a task's texts: a row with the stream, and the words with their counts, packed, a row a range."""
    def closed(shard: int, lang: str, held: _Shard):
        stream, words, n = held.closed()
        # equal words of a language meet in one range
        part = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words))
        part = (part * 0x9E3779B1 + zlib.crc32(lang.encode())) % ((1 << 31) - 1) % ranges
        order = np.argsort(part, kind="stable")
        cut = np.flatnonzero(np.diff(part[order], prepend=-1, append=ranges))
        rows = [{"shard": shard, "range": int(part[own[0]]), "lang": lang, "words": _packed(b"\n".join([words[k] for k in own.tolist()])),
                 "local": _steps(own, "<i4"), "n": _bytes(n[own], "<i8")} for own in np.split(order, cut[1:-1])]
        yield pa.RecordBatch.from_pylist([{"shard": shard, "stream": _bytes(stream, "<i4")}, *rows], schema=_SHARDS)

    def run(batches):
        shard = TaskContext.get().partitionId() << 24
        held: dict[str, _Shard] = {}
        for batch in batches:
            for rows in slices(batch, "text"):
                lang = rows.column("lang")
                for name in pc.unique(lang).to_pylist():
                    held.setdefault(name, _Shard()).add(PieceWords(texts(rows.column("text").filter(pc.equal(lang, name)))))
                    if held[name].size >= SHARD_WORDS:
                        yield from closed(shard, name, held.pop(name))
                        shard += 1
        for name, some in held.items():
            if some.size:
                yield from closed(shard, name, some)
                shard += 1

    return run


_WORDS = pa.schema([("lang", pa.string()), ("id", pa.int64()), ("phrase", pa.string()), ("f", pa.int64()), ("shard", pa.int64()),
                    ("local", pa.binary()), ("ids", pa.binary())])
_WORDS_DDL = "lang string, id long, phrase string, f long, shard long, local binary, ids binary"


def _counted_words(least: int):
    """A range's words: all of a language's as one sum (no phrase), those that come often enough a row each, and for
    each shard the numbers and ids of its own."""
    def run(table: pa.Table) -> pa.Table:
        held = [(shard, lang, _raw(words).split(b"\n"), _summed(local, "<i4"), _numbers(n, "<i8"))
                for shard, lang, words, local, n in zip(*(table.column(c).to_pylist() for c in ("shard", "lang", "words", "local", "n")), strict=True)]
        total: dict[tuple[str, bytes], int] = {}
        all_of: dict[str, int] = {}
        for _, lang, words, _, n in held:
            all_of[lang] = all_of.get(lang, 0) + int(n.sum())
            for word, m in zip(words, n.tolist(), strict=True):
                total[lang, word] = total.get((lang, word), 0) + m
        base = table.column("range")[0].as_py() << 32
        ids = {key: base + k for k, key in enumerate(sorted(key for key, f in total.items() if f >= least))}
        rows = [{"lang": lang, "f": f} for lang, f in all_of.items()]
        rows += [{"lang": key[0], "id": i, "phrase": key[1].decode(), "f": total[key]} for key, i in ids.items()]
        for shard, lang, words, local, _ in held:
            own = np.array([ids.get((lang, w), -1) for w in words], np.int64)
            if (own >= 0).any():
                rows.append({"shard": shard, "local": _steps(local[own >= 0], "<i4"), "ids": _bytes(own[own >= 0], "<i8")})
        return pa.Table.from_pylist(rows, schema=_WORDS)

    return run


# ---- the index ---------------------------------------------------------------------------------------------------


def _transform(symbols: np.ndarray, depth: int) -> np.ndarray:
    """The symbol before every word position, positions in the order of the ``depth`` symbols from them on.

    ``symbols`` begins and ends with a break (0). What follows a break doesn't count; breaks come first.
    """
    at = np.flatnonzero(symbols).astype(np.int32)
    wide = int(symbols.max(initial=0)) + 1
    rank = np.zeros(len(symbols) + depth, np.int32)
    rank[at] = symbols[at]
    base = rank.copy()
    alive = np.arange(len(at), dtype=np.int32)  # of `at`, those whose first `done` symbols are all words
    for done in range(1, depth):
        alive = alive[base[at[alive] + (done - 1)] > 0]
        key = rank[at].astype(np.int64)
        key *= wide
        key[alive] += base[at[alive] + done]
        order = np.argsort(key)
        key = key[order]
        ranks = np.cumsum(np.diff(key, prepend=key[:1]) > 0, dtype=np.int32)
        del key
        rank[at[order]] = ranks
    return symbols[at[np.argsort(rank[at], kind="stable")] - 1].astype("<i4")


class Index:
    """One direction of a shard's index: the transform, and where each symbol's positions begin (``first``)."""

    def __init__(self, bwt: np.ndarray, first: np.ndarray):
        self.bwt, self.wide = bwt, len(first)
        order = np.argsort(bwt, kind="stable")
        count = np.bincount(bwt, minlength=self.wide)
        # positions of a symbol that have a break after them come first, and no row of the transform names them
        missing = np.diff(first, append=len(bwt)) - count
        self.lf = np.zeros(len(bwt), np.int32)
        self.lf[order] = np.arange(len(bwt), dtype=np.int32) + np.repeat((first + missing - (np.cumsum(count) - count)).astype(np.int32), count)

    def extend(self, low: np.ndarray, other: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions by one word of intervals [low, low + n): (which, new low, new other low, new n)."""
        before = np.cumsum(n) - n
        at = np.repeat((low - before).astype(np.int32), n)
        at += np.arange(len(at), dtype=np.int32)
        key = np.repeat(np.arange(len(low)) * self.wide, n)
        key += self.bwt[at]
        order = np.argsort(key, kind="stable")
        key = key[order]
        cut = np.flatnonzero(np.diff(key, prepend=-1))
        many = np.diff(cut, append=len(key))
        which, symbol = np.divmod(key[cut], self.wide)
        new = self.lf[at[order[cut]]]
        del key, order, at, cut
        smaller = np.cumsum(many) - many - before[which]
        word = symbol > 0
        return which[word], new[word], (other[which] + smaller)[word], many[word]


_GROWN = pa.schema([("shard", pa.int64()), ("range", pa.int64()), *((c, pa.binary()) for c in ("prefix", "suffix", "low", "back", "n"))])
_GROWN_DDL = "shard long, range long, prefix binary, suffix binary, low binary, back binary, n binary"
_WIDE = {"prefix": "<i8", "suffix": "<i8", "ids": "<i8", "low": "<i4", "back": "<i4", "n": "<i4"}
_RISING = ("prefix", "ids")  # within a packed row
_BUILT = pa.schema([("shard", pa.int64()), *((c, pa.binary()) for c in ("right", "left", "many", "ids"))])
_BUILT_DDL = "shard long, right binary, left binary, many binary, ids binary"
RIGHT, LEFT = "right", "left"  # the side to extend on: the reversed transform, the forward one


def _grow(index: Index, side: str, ids: np.ndarray, low: np.ndarray, back: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """Extensions on one side whose other part is frequent as well: prefix, suffix, low, back, n."""
    here, there = (back, low) if side == RIGHT else (low, back)
    order = np.argsort(here)
    ids, here, there, n = ids[order], here[order], there[order], n[order]
    which, new, across, many = index.extend(here, there, n)
    # the phrase without the word at its far end: the interval on this side that holds the new one
    part = np.searchsorted(here, new, side="right") - 1
    kept = (part >= 0) & (new < here[part] + n[part]) if len(here) else np.zeros(0, bool)
    which, part, new, across, many = which[kept], part[kept], new[kept], across[kept], many[kept]
    old, found = ids[which], ids[part]
    return {"prefix": old if side == RIGHT else found, "suffix": found if side == RIGHT else old,
            "low": across if side == RIGHT else new, "back": new if side == RIGHT else across, "n": many}


def _hashes(found: dict[str, np.ndarray], ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Range and hash within it of each pair."""
    h = mix(found["prefix"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(found["suffix"].astype(np.uint64) + np.uint64(1)))
    return (h % np.uint64(ranges)).astype(np.int64), (h >> np.uint64(64 - HASH_BITS)).astype(np.int32)


def _column(name: str, x: np.ndarray) -> bytes:
    return (_steps if name in _RISING else _bytes)(x, _WIDE[name])


def _dealt(shard: int, found: dict[str, np.ndarray], ranges: int) -> pa.Table:
    """The extensions of a shard, one packed row a range."""
    part, _ = _hashes(found, ranges)
    order = np.lexsort((found["suffix"], found["prefix"], part))
    part = part[order]
    packed = {c: found[c][order] for c in ("prefix", "suffix", "low", "back", "n")}
    cut = np.flatnonzero(np.diff(part, prepend=-1, append=ranges))
    return pa.Table.from_pylist([{"shard": shard, "range": int(part[a]), **{c: _column(c, x[a:b]) for c, x in packed.items()}}
                                 for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)], schema=_GROWN)


def _unpacked(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [np.concatenate([(_summed if c in _RISING else _numbers)(x, _WIDE[c]) for x in table.column(c).to_pylist()]) for c in names]


_COUNTED = pa.schema([("id", pa.int64()), ("prefix", pa.int64()), ("suffix", pa.int64()), ("f", pa.int64()),
                      ("shard", pa.int64()), *((c, pa.binary()) for c in ("ids", "low", "back", "n"))])
_COUNTED_DDL = "id long, prefix long, suffix long, f long, shard long, ids binary, low binary, back binary, n binary"


def _counted(least: int):
    """A range's phrases that come often enough, a row each; and for each shard the ids and intervals of its own."""
    def run(table: pa.Table) -> pa.Table:
        prefix, suffix, low, back, n = _unpacked(table, "prefix", "suffix", "low", "back", "n")
        order = np.lexsort((suffix, prefix))
        first = np.flatnonzero(np.diff(prefix[order], prepend=-1).astype(bool) | np.diff(suffix[order], prepend=-1).astype(bool))
        f = np.add.reduceat(n[order].astype(np.int64), first)
        often = np.flatnonzero(f >= least)
        ids = np.full(len(f), -1, np.int64)
        ids[often] = (table.column("range")[0].as_py() << 32) + np.arange(len(often))
        of = np.empty(len(order), np.int64)
        of[order] = np.repeat(ids, np.diff(first, append=len(order)))
        at = order[first[often]]
        phrases = pa.table({"id": ids[often], "prefix": prefix[at], "suffix": suffix[at], "f": f[often]})
        cut = np.cumsum([0, *(_size(x) // 4 for x in table.column("n").to_pylist())]).tolist()
        rows = []
        for shard, a, b in zip(table.column("shard").to_pylist(), cut[:-1], cut[1:], strict=True):
            own = a + np.flatnonzero(of[a:b] >= 0)
            if len(own):
                rows.append({"shard": shard, **{c: _column(c, x[own]) for c, x in (("ids", of), ("low", low), ("back", back), ("n", n))}})
        phrases = pa.table([phrases.column(f.name) if f.name in phrases.column_names else pa.nulls(len(often), f.type) for f in _COUNTED], schema=_COUNTED)
        return pa.concat_tables([phrases, pa.Table.from_pylist(rows, schema=_COUNTED)])

    return run


def _build(longest: int):
    """Index a shard over its frequent words: both transforms, how often each symbol comes, and the words' ids."""
    def run(streams: pa.Table, words: pa.Table) -> pa.Table:
        if not streams.num_rows or not words.num_rows:
            return _BUILT.empty_table()
        stream = _numbers(streams.column("stream")[0].as_py(), "<i4")
        local = np.concatenate([_summed(x, "<i4") for x in words.column("local").to_pylist()])
        ids = np.concatenate([_numbers(x, "<i8") for x in words.column("ids").to_pylist()])
        order = np.argsort(local)  # so words that come often have small symbols, too
        local, ids = local[order], ids[order]
        symbol = np.zeros(int(stream.max(initial=0)) + 1, np.int32)
        symbol[local + 1] = np.arange(1, len(local) + 1)
        symbols = np.concatenate([np.zeros(1, np.int32), symbol[stream], np.zeros(1, np.int32)])
        del stream
        symbols = symbols[(symbols > 0) | (np.diff(symbols, prepend=1) != 0)]  # breaks in a row are one
        n = np.bincount(symbols, minlength=len(local) + 1)[1:]
        return pa.Table.from_pylist([{
            "shard": streams.column("shard")[0].as_py(), RIGHT: _bytes(_transform(symbols[::-1], longest), "<i4"),
            LEFT: _bytes(_transform(symbols, longest), "<i4"), "many": _bytes(n, "<i4"), "ids": _bytes(ids, "<i8")}], schema=_BUILT)

    return run


def _index(table: pa.Table, side: str) -> tuple[Index, np.ndarray, np.ndarray, np.ndarray]:
    """A shard's index on one side, and its words: ids, where their intervals begin, how often they come."""
    n = _numbers(table.column("many")[0].as_py(), "<i4").astype(np.int64)
    low = np.cumsum(n) - n
    return Index(_numbers(table.column(side)[0].as_py(), "<i4"), np.concatenate([[0], low])), _numbers(table.column("ids")[0].as_py(), "<i8"), low, n


def _word_pairs(table: pa.Table) -> dict[str, np.ndarray]:
    index, ids, low, n = _index(table, RIGHT)
    return _grow(index, RIGHT, ids, low, low, n)


_HASHED = pa.schema([("shard", pa.int64()), ("range", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])
_HASHED_DDL = "shard long, range long, hashes binary, counts binary"


def _hashed(least: int, ranges: int):
    """The hashes of a shard's word pairs, in order, with their counts, a row a range."""
    clipped = "u1" if least < 256 else "<u4"  # a count of `least` is enough to know

    def run(indexes: pa.Table) -> pa.Table:
        found = _word_pairs(indexes)
        part, hashes = _hashes(found, ranges)
        order = np.lexsort((hashes, part))
        part, hashes, counts = part[order], hashes[order], np.minimum(found["n"][order], least)
        del found, order
        cut = np.flatnonzero(np.diff(part, prepend=-1, append=ranges))
        shard = indexes.column("shard")[0].as_py()
        return pa.Table.from_pylist([{"shard": shard, "range": int(part[a]), "hashes": _steps(hashes[a:b], "<i4"), "counts": _bytes(counts[a:b], clipped)}
                                     for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)], schema=_HASHED)

    return run


def _often(least: int):
    """A range's hashes that all shards together hold ``least`` times: each shard's own, a row a shard."""
    clipped = "u1" if least < 256 else "<u4"

    def run(table: pa.Table) -> pa.Table:
        shards, parts, hashes, counts = (table.column(c).to_pylist() for c in ("shard", "range", "hashes", "counts"))
        own = [_summed(h, "<i4") for h in hashes]
        every, inverse = np.unique(np.concatenate(own), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([_numbers(c, clipped) for c in counts]))
        good = every[total >= least]
        kept = [h[np.isin(h, good)] for h in own]
        return pa.table({"shard": shards, "range": parts, "kept": pa.array([_steps(k, "<i4") for k in kept], pa.binary())},
                        schema=_OFTEN).filter(pa.array([len(k) > 0 for k in kept], pa.bool_()))

    return run


_OFTEN = pa.schema([("shard", pa.int64()), ("range", pa.int64()), ("kept", pa.binary())])
_OFTEN_DDL = "shard long, range long, kept binary"


def _pairs(ranges: int):
    """A shard's word pairs whose hashes come often enough."""
    def run(indexes: pa.Table, often: pa.Table) -> pa.Table:
        if not indexes.num_rows or not often.num_rows:
            return _GROWN.empty_table()
        found = _word_pairs(indexes)
        part, hashes = _hashes(found, ranges)
        good = np.concatenate([_summed(k, "<i4").astype(np.int64) + (r << HASH_BITS)
                               for r, k in zip(often.column("range").to_pylist(), often.column("kept").to_pylist(), strict=True)])
        kept = np.isin(hashes + (part << HASH_BITS), good)
        return _dealt(indexes.column("shard")[0].as_py(), {k: v[kept] for k, v in found.items()}, ranges)

    return run


def _extend(side: str, ranges: int):
    """One more word on one side."""
    def run(indexes: pa.Table, intervals: pa.Table) -> pa.Table:
        if not indexes.num_rows or not intervals.num_rows:
            return _GROWN.empty_table()
        columns = (x.astype(np.int64) for x in _unpacked(intervals, "ids", "low", "back", "n"))
        return _dealt(indexes.column("shard")[0].as_py(), _grow(_index(indexes, side)[0], side, *columns), ranges)

    return run


# ---- the Spark job -----------------------------------------------------------------------------------------------


def _one_side(built: DataFrame, side: str) -> DataFrame:
    # new attributes, since both sides of a cogroup may come from the index
    return built.select(F.col("shard").alias("_shard"), side, "many", "ids").withColumnRenamed("_shard", "shard")


def _frequent_hashes(built: DataFrame, least: int, ranges: int) -> DataFrame:
    """The pair hashes of each shard that all shards together hold ``least`` times."""
    hashed = _one_side(built, RIGHT).groupBy("shard").applyInArrow(_hashed(least, ranges), _HASHED_DDL)
    return hashed.groupBy("range").applyInArrow(_often(least), _OFTEN_DDL)


def _cogrouped(built: DataFrame, side: str, sent: DataFrame, run) -> DataFrame:
    """What ``run`` makes of each shard's index and the rows sent to the shard."""
    return _one_side(built, side).groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(run, _GROWN_DDL)


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = MAX_WORDS) -> tuple[DataFrame, list[DataFrame]]:
    """Words per language ``(lang, n)``, and per length 1 to ``longest`` the phrases that come ``least`` times.

    Phrases: id, lang, phrase, f, begins (counts of its beginnings of 1, 2, ... words, its own last), ends (of its
    ends), and from two words on prefix and suffix (ids of the phrase without its last and first word).
    """
    prepare(docs.sparkSession).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string").alias("text"))
    docs = docs.where("text is not null")
    ranges = 1 + int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // RANGE_BYTES
    shards = materialise(docs.mapInArrow(_shards(ranges), _SHARDS_DDL), "phrase-shards")
    counted = materialise(shards.where("range is not null").select("shard", "range", "lang", "words", "local", "n")
                          .groupBy("range").applyInArrow(_counted_words(least), _WORDS_DDL), "phrase-words")
    totals = counted.where("phrase is null and lang is not null").groupBy("lang").agg(F.sum("f").alias("n"))
    level = materialise(counted.where("id is not null").select(
        "id", "lang", "phrase", "f", F.array("f").alias("begins"), F.array("f").alias("ends")), "phrase-1")
    levels = [level]
    frequent = counted.where("shard is not null").select("shard", "local", "ids")
    streams = shards.where("stream is not null").select("shard", "stream")
    built = streams.groupBy("shard").cogroup(frequent.groupBy("shard")).applyInArrow(_build(longest), _BUILT_DDL)
    # in buckets of shards: what is sent to a shard meets its index where that lies
    built = bucketed(built, "phrase-index", "shard", min(MOST_BUCKETS, max(shuffle_partitions(docs.sparkSession), ranges // BUCKET_RANGES)))
    for size in range(2, longest + 1):
        side = RIGHT if size % 2 == 0 else LEFT
        if size == 2:
            grown = _cogrouped(built, side, _frequent_hashes(built, least, ranges), _pairs(ranges))
        else:
            grown = _cogrouped(built, side, intervals, _extend(side, ranges))
        summed = materialise(grown.groupBy("range").applyInArrow(_counted(least), _COUNTED_DDL), f"phrase-counted-{size}")
        before = level.select(F.col("id").alias("prefix"), "lang", F.col("phrase").alias("_start"), F.col("begins").alias("_begins"))
        after = level.select(F.col("id").alias("suffix"), F.col("phrase").alias("_end"), F.col("ends").alias("_ends"))
        last_word = F.substring_index("_end", " ", -1)
        level = materialise(summed.where("id is not null").select("id", "prefix", "suffix", "f").join(before, "prefix").join(after, "suffix").select(
            "id", "lang", F.concat_ws(" ", "_start", last_word).alias("phrase"), "f",
            F.concat("_begins", F.array("f")).alias("begins"), F.concat("_ends", F.array("f")).alias("ends"), "prefix", "suffix"), f"phrase-{size}")
        levels.append(level)
        intervals = summed.where("shard is not null").select("shard", "ids", "low", "back", "n")
    return totals, levels


# floor(1000 a n / (l r)) in exact decimals: the products keep within 38 digits up to 10^17 words
_SCORE = "(1000 * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast({l} as decimal(17,0)) * cast({r} as decimal(17,0)))"


def collocations(docs: DataFrame, least: int = LEAST, longest: int = MAX_WORDS, top: int = TOP) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score (all numbers longs)."""
    totals, levels = phrase_counts(docs, least, longest)
    scored = None
    for size in range(2, longest + 1):
        level = levels[size - 1].join(totals, "lang").withColumnRenamed("f", "a")
        if size < longest:
            # a phrase goes if some extension by one word, to either side, is as frequent; a longer one implies that
            longer = levels[size].select(F.col("prefix").alias("id"), "f").union(levels[size].select(F.col("suffix").alias("id"), "f"))
            level = level.join(longer.groupBy("id").agg(F.max("f").alias("_longer")), "id", "left").where("_longer is null or 100 * _longer < 100 * a")
        cuts = [f"named_struct('score', {_SCORE.format(l=f'begins[{k - 1}]', r=f'ends[{size - k - 1}]')}, 'k', {k}, "
                f"'l', begins[{k - 1}], 'r', ends[{size - k - 1}])" for k in range(1, size)]
        level = level.withColumn("_cut", F.expr(f"array_min(array({', '.join(cuts)}))"))
        level = level.select("lang", "phrase", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"), "n", F.col("_cut.score").alias("score"))
        scored = level if scored is None else scored.unionByName(level)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = f"""
WITH d AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, unnest(regexp_extract_all(t, '[^.,;:!?\\x0A-\\x0D]+')) AS piece FROM d),
w AS (SELECT lang, row_number() OVER () AS pid, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
t AS (SELECT lang, pid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
x AS (
  SELECT lang, word AS w1, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3, lead(word, 3) OVER o AS w4, lead(word, 4) OVER o AS w5
  FROM t WINDOW o AS (PARTITION BY pid ORDER BY i)),
g AS (
  SELECT lang, 1 AS m, [w1] AS words FROM x
  UNION ALL SELECT lang, 2, [w1, w2] FROM x WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, [w1, w2, w3] FROM x WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, [w1, w2, w3, w4] FROM x WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, 5, [w1, w2, w3, w4, w5] FROM x WHERE w5 IS NOT NULL),
totals AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
f AS (SELECT lang, m, words, array_to_string(words, ' ') AS phrase, count(*) AS f FROM g GROUP BY lang, m, words HAVING count(*) >= {LEAST}),
cuts AS (
  SELECT c.lang, c.m, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, n,
         (1000::HUGEINT * c.f::HUGEINT * n::HUGEINT) // (x.f::HUGEINT * y.f::HUGEINT) AS score
  FROM f c JOIN range(1, {MAX_WORDS}) AS s(k) ON k < c.m
  JOIN f x ON x.lang = c.lang AND x.words = c.words[1:k]
  JOIN f y ON y.lang = c.lang AND y.words = c.words[k + 1:]
  JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM f x WHERE x.lang = b.lang AND x.m > b.m AND 100 * x.f >= 100 * b.a AND contains(' ' || x.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= {TOP}
"""
