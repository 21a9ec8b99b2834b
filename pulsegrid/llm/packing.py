"""Packing documents into fixed-length training sequences, best fit decreasing.

Tokens: each text's ids by the given tokenizer, then one end-of-document id. A document longer than a sequence is
first cut into full windows; what is left is one piece of 1 to ``SEQUENCE`` tokens.

Best fit decreasing only looks at lengths, of which there are at most ``SEQUENCE``, so the plan is made on the driver
from the histogram of piece lengths (2,048 numbers, however many documents). Open windows are kept in runs of
consecutive sequences with equal contents; a segment tree indexed by remaining capacity finds the tightest open
capacity that takes a length. The plan maps (length, rank range) to (first sequence, offset). Its size follows the
steps of the plan, not the documents: every step uses up a length or a run. Ranks of pieces within their length are
given where the pieces were made (a counter per written part) plus a prefix sum over the parts, so that a length that
a third of all pieces share is never one task.

Defined results: null text is empty (its only token is the end id); repeated rows are packed as often as they come;
the tokenizer's special strings in a text are read as the tokenizer reads them. Extra columns are ignored. No
documents give no pieces.
"""

from __future__ import annotations

import array
import sys
import unicodedata
import zlib
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import Words, materialise, prepare, slices

SEQUENCE = 2048
END_ID = 1
# Known words and word parts of a Python worker; a full table starts anew (it saves time only).
WORD_CACHE, PART_CACHE = 800_000, 150_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ---- tokens --------------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _unassigned() -> np.ndarray:
    """By code point: has it no category yet? Splitters of different Unicode versions differ on those."""
    return np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


class WordTokenizer:
    """Ids of texts, equal to the library's on each whole text.

    The tokenizer never joins across white space, so a text's ids are those of its words. Words are hashed over the
    whole buffer; each distinct word is looked up once, in sorted arrays (hash, place and length in a pool of ids), and
    ids are gathered for all words together. New words are split by the tokenizer's own pattern into parts, and
    parts not met before are encoded together by the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.path = path
        # for parts that are already normal, lower case and split
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.plain.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        # fixed value: the tokenizer file's own split pattern (and the line feed, which joins words here)
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n")
        # what depends on more than single letters, on what counts as a space, or on the Unicode version is left to the
        # library
        self.special = regex.compile(r"[Σİ]|<\||[\x00-\x09\x0B-\x1F\x7F-\xA0\p{Z}\uFEFF]")
        self.unassigned = _unassigned()
        self.parts: dict[str, bytes] = {}
        self._forget()

    @cached_property
    def lib(self):
        """The library's tokenizer as the file has it, for the few words that need all of it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _left(self, text: str) -> bool:
        """Is the text, or something in it, left to the library?"""
        if self.special.search(text):
            return True
        return not text.isascii() and bool(self.unassigned[np.frombuffer(text.encode("utf-32-le"), "<u4")].any() or not unicodedata.is_normalized("NFC", text))

    def _forget(self) -> None:
        self.hashes, self.recent = (np.zeros(0, np.uint64) for _ in range(2))
        self.at, self.recent_at = (np.zeros((0, 2), np.int64) for _ in range(2))
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.parts = {"\n": b""}

    def _whole(self, word: str) -> bytes:
        return array.array("I", self.lib.encode(word, add_special_tokens=False).ids).tobytes()

    def _learn_parts(self, new: list[str]) -> None:
        ids = np.array(self.plain.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, np.uint32)
        cut = np.flatnonzero(self.ends[ids]) + 1
        if len(cut) == len(new) and cut[-1] == len(ids):
            raw, begin = ids.tobytes(), 0
            for part, end in zip(new, (cut * 4).tolist(), strict=True):
                self.parts[part] = raw[begin:end]
                begin = end
        else:
            for part in new:
                self.parts[part] = self._whole(part)

    def _learn(self, new: list[bytes]) -> tuple[bytes, np.ndarray]:
        """Ids of the words (as bytes, joined) and how many each has."""
        text = b"\n".join(new).decode()
        if self._left(text.replace("\n", "")):
            words = [w.decode() for w in new]
            odd = [self._left(w) for w in words]
            out: list[bytes] = [self._whole(w) if o else b"" for w, o in zip(words, odd, strict=True)]
            if not all(odd):
                raw, n = self._learn([w for w, o in zip(new, odd, strict=True) if not o])
                cut = [0, *(np.cumsum(n) * 4).tolist()]
                rest = iter(zip(cut[:-1], cut[1:], strict=True))
                out = [x if o else raw[slice(*next(rest))] for x, o in zip(out, odd, strict=True)]
            return b"".join(out), np.array([len(x) // 4 for x in out], np.int64)
        parts = self.pattern.findall(text.lower() + "\n")
        missing = set(parts).difference(self.parts)
        if len(self.parts) + len(missing) > PART_CACHE:
            self.parts = {"\n": b""}
            missing = set(parts) - {"\n"}
        if missing:
            self._learn_parts(list(missing))
        ids = list(map(self.parts.__getitem__, parts))
        size = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        last = size[[i for i, p in enumerate(parts) if p == "\n"]]
        return b"".join(ids), np.diff(last, prepend=0) // 4

    def _find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and length of each hash, and which are known."""
        out, known = np.zeros((len(wanted), 2), np.int64), np.zeros(len(wanted), bool)
        for hashes, at in ((self.hashes, self.at), (self.recent, self.recent_at)):
            if len(hashes):
                i = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
                hit = hashes[i] == wanted
                out[hit] = at[i[hit]]
                known |= hit
        return out, known

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a string array one after the other, and where each text's ids begin (n + 1)."""
        words = Words(col)
        wanted, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        if len(self.hashes) + len(self.recent) + len(wanted) > WORD_CACHE:
            self._forget()
        at, known = self._find(wanted)
        if not known.all():
            new = first[~known]
            raw = words.data.tobytes()
            ids, n = self._learn([raw[a:b] for a, b in zip(words.starts[new].tolist(), words.ends[new].tolist(), strict=True)])
            ids = np.frombuffer(ids, np.uint32)
            if self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool[:self.used], np.zeros(self.used + 2 * len(ids), np.uint32)])
            self.pool[self.used:self.used + len(ids)] = ids
            place = np.stack([self.used + np.cumsum(n) - n, n], axis=1)
            self.used += len(ids)
            at[~known] = place
            self._keep(wanted[~known], place)
        begin, n = at[inverse].T
        bounds = np.concatenate([[0], np.cumsum(n)])
        where = np.repeat(begin - bounds[:-1], n) + np.arange(bounds[-1])
        return self.pool[where], bounds[words.first]

    def _keep(self, hashes: np.ndarray, at: np.ndarray) -> None:
        to = np.searchsorted(self.recent, hashes)
        self.recent, self.recent_at = np.insert(self.recent, to, hashes), np.insert(self.recent_at, to, at, axis=0)
        if len(self.recent) > 1 << 17:
            to = np.searchsorted(self.hashes, self.recent)
            self.hashes, self.at = np.insert(self.hashes, to, self.recent), np.insert(self.at, to, self.recent_at, axis=0)
            self.recent, self.recent_at = np.zeros(0, np.uint64), np.zeros((0, 2), np.int64)


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _pieces(tokenizer_path: str, sequence: int, end_id: int, keep_ids: bool):
    fields = [("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int32()),
              ("local_rank", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    schema = pa.schema([*fields, ("ids", pa.binary())] if keep_ids else fields)

    def run(batches):
        tokens = _tokenizer(tokenizer_path)
        part = TaskContext.get().partitionId()
        seen = [0] * (sequence + 1)
        for batch in batches:
            for rows in slices(batch, "text"):
                ids, bounds = tokens.encode(rows.column("text"))
                raw = memoryview(np.insert(ids, bounds[1:], end_id).astype("<u4").tobytes())
                out: list[list] = [[] for _ in schema]
                ends = (bounds + np.arange(len(bounds))).tolist()  # with the end ids
                for doc, first, last in zip(rows.column("doc_id").to_pylist(), ends[:-1], ends[1:], strict=True):
                    for start in range(first, last, sequence):
                        length = min(sequence, last - start)
                        piece = raw[start * 4:(start + length) * 4]
                        row = (part, doc, start - first, length, seen[length], zlib.crc32(piece), last - first, piece)
                        seen[length] += 1
                        for column, value in zip(out, row, strict=False):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return run, schema


# ---- the plan ------------------------------------------------------------------------------------------------


class _CapacityTree:
    """Segment tree over capacities 0..n: is there an open window with that much room? Finds the least from c on."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.any = bytearray(2 * self.size)

    def set(self, c: int, open_: bool) -> None:
        i = c + self.size
        self.any[i] = open_
        while i > 1:
            i >>= 1
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def least_from(self, c: int) -> int | None:
        i = c + self.size
        if self.any[i]:
            return c
        while i > 1:
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int]]:
    """Plan rows (length, first rank, first sequence, offset) for ``counts[length]`` pieces of each length.

    A row holds for the ranks up to the next row of its length; the piece of rank r goes to sequence
    ``first sequence + (r - first rank)`` at ``offset``.
    """
    tree = _CapacityTree(sequence)
    runs: dict[int, list[tuple[int, int]]] = {}  # room left -> runs (first sequence, how many) of like windows
    plan, opened = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room:
            held = runs.setdefault(room, [])
            if not held:
                tree.set(room, True)
            held.append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.least_from(length)
            if room is None:
                # a new window takes as many of this length as fit, as best fit would place them one by one
                per = sequence // length
                full, rest = divmod(left, per)
                for k in range(per if full else 0):
                    plan.append((length, rank, opened, k * length))
                    rank += full
                if full:
                    put(sequence - per * length, opened, full)
                    opened += full
                for k in range(rest):
                    plan.append((length, rank, opened, k * length))
                    rank += 1
                if rest:
                    put(sequence - rest * length, opened, 1)
                    opened += 1
                break
            first, n = runs[room].pop()
            used = min(n, left)
            if used < n:
                runs[room].append((first + used, n - used))
            if not runs[room]:
                tree.set(room, False)
            plan.append((length, rank, first, sequence - room))
            rank += used
            left -= used
            put(room - length, first, used)
    return plan


def _placed(plan: list[tuple[int, int, int, int]]):
    """Numpy tables of the plan, sorted by (length, first rank), and the function that places pieces by them."""
    table = np.array(sorted(plan), np.int64).reshape(-1, 4)
    bounds = np.searchsorted(table[:, 0], np.arange(int(table[:, 0].max()) + 2 if len(table) else 1))

    def run(batches):
        for batch in batches:
            length = np.asarray(batch.column("length"))
            rank = np.asarray(batch.column("rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                rows = table[bounds[n]:bounds[n + 1]]
                row = rows[np.searchsorted(rows[:, 1], rank[at], side="right") - 1]
                sequence[at] = row[:, 2] + rank[at] - row[:, 1]
                offset[at] = row[:, 3]
            names = [c for c in batch.schema.names if c not in ("part", "local_rank", "rank", "length")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(length.astype(np.int64)), pa.array(sequence), pa.array(offset)],
                names=[*names, "length", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer_path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID,
         keep_ids: bool = False) -> DataFrame:
    """One row per piece of ``docs(doc_id, text)``: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    With ``keep_ids`` also ``ids``: the piece's token ids as little-endian unsigned 32-bit bytes.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    run, schema = _pieces(tokenizer_path or default_tokenizer(), sequence, end_id, keep_ids)
    ddl = "part int, doc_id long, start long, length int, local_rank long, ids_crc32 long, doc_tokens long"
    pieces = materialise(docs.mapInArrow(run, ddl + (", ids binary" if keep_ids else "")), "pieces")
    counts = materialise(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece_counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_decreasing(histogram, sequence)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local_rank")).drop("base")
    columns = [c for c in pieces.columns if c not in ("part", "local_rank", "length")]
    types = dict(pieces.dtypes)
    out = ranked.mapInArrow(_placed(plan), ", ".join([*(f"{c} {types[c]}" for c in columns), "length long, sequence_id long, offset long"]))
    first = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(*first, *(c for c in out.columns if c not in first))
