"""Public tokenizers inside tasks: one library call per batch of bytes, long texts cut where no token can cross.

A cut must not change the ids. Byte-level files with the common split pattern never join across the end of a run
that is not white space, so a text may be cut before a space or line break that follows a visible character; special
strings hold no white space and stay whole. Piece models without normalisation begin every word with the space mark
and hold no piece with the mark after another character, so a text may be cut at a space between two characters that
are not spaces; the model then adds the space that the cut took away. Files of any other kind are given whole texts.
"""

from __future__ import annotations

import itertools
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

# Bytes of one library call, and of one part of a cut text.
CALL_BYTES = 1 << 18
PART_CHARS = 1 << 17
MARK = "▁"  # fixed value: how piece models write a space


class JsonTokenizer:
    """A ``.json`` file read by ``tokenizers``; ``plain`` reads special strings in texts as ordinary text."""

    # a visible character (none of the letters that some Unicode version calls white space) and a space or line break
    _edge = re.compile("[^\\s\x00-\x20\x7f-\xa0᠎​﻿](?=[ \n])")

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has its core, and no more
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.lib.encode_special_tokens = plain
        with open(path, encoding="utf-8") as f:
            shape = json.load(f)
        split = shape.get("pre_tokenizer") or {}
        spaced = any(re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip") for t in shape.get("added_tokens", ()))
        self.cuts = split.get("type") == "ByteLevel" and split.get("use_regex") and not shape.get("normalizer") and not spaced

    def parts(self, text: str) -> list[str]:
        if len(text) <= PART_CHARS or not self.cuts:
            return [text]
        out, start = [], 0
        while edge := self._edge.search(text, start + PART_CHARS):
            out.append(text[start:edge.end()])
            start = edge.end()
        return [*out, text[start:]]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id, byte-level decoded."""
        # the letters that stand for bytes: visible Latin-1 ones for themselves, the others from U+0100 on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        letter = {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
        byte = {c: b for b, c in letter.items()}
        out = [b""] * (max(self.lib.get_vocab().values()) + 1)
        for token, i in self.lib.get_vocab().items():
            out[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        return out


class PieceTokenizer:
    """A ``.model`` file read by ``sentencepiece``, without begin and end ids."""

    _edge = re.compile(f"[^ {MARK}](?= [^ {MARK}])")

    def __init__(self, path: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [self.lib.id_to_piece(i) for i in range(self.lib.get_piece_size())]
        # probed, not assumed: a space is added in front, spaces are kept, letters are not normalised
        probe = "a  ﬁ ①b"
        kept = self.lib.decode(self.lib.encode(probe)) == probe and self.lib.encode("a b") == self.lib.encode("a") + self.lib.encode("b")
        self.cuts = kept and not any(MARK in p.lstrip(MARK) for p in self.pieces)

    def parts(self, text: str) -> list[str]:
        if len(text) <= PART_CHARS or not self.cuts:
            return [text]
        out, start = [], 0
        while edge := self._edge.search(text, start + PART_CHARS):
            out.append(text[start:edge.end()])
            start = edge.end() + 1
        return [*out, text[start:]]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.lib.encode(texts, num_threads=1)

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.ids(texts)]

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id: the mark is a space, byte pieces are their byte."""
        return [bytes([int(p[3:-1], 16)]) if self.lib.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]


@lru_cache(maxsize=4)
def tokenizer(path: str, plain: bool = False) -> JsonTokenizer | PieceTokenizer:
    """The tokenizer of a file, loaded once a Python worker."""
    return JsonTokenizer(path, plain) if path.endswith(".json") else PieceTokenizer(path)


def calls(parts: list[str], limit: int = CALL_BYTES) -> Iterator[slice]:
    """Runs of parts whose bytes come near ``limit`` (a longer part stands alone)."""
    start, held = 0, 0
    for k, part in enumerate(parts):
        size = len(part) if part.isascii() else len(part.encode())
        if held and held + size > limit:
            yield slice(start, k)
            start, held = k, 0
        held += size
    if start < len(parts):
        yield slice(start, len(parts))


def _cut(lib: JsonTokenizer | PieceTokenizer, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The parts of all texts, and where each text's parts begin (n + 1)."""
    cut = [lib.parts(t) for t in texts]
    return list(itertools.chain.from_iterable(cut)), np.cumsum([0, *map(len, cut)])


def count_ids(lib: JsonTokenizer | PieceTokenizer, texts: list[str]) -> np.ndarray:
    """How many ids each text has; only lengths are kept of what the library returns."""
    parts, first = _cut(lib, texts)
    n = np.array([0, *itertools.chain.from_iterable(lib.lengths(parts[run]) for run in calls(parts))], np.int64)
    return np.diff(np.cumsum(n)[first])


def encode(lib: JsonTokenizer | PieceTokenizer, texts: list[str]) -> tuple[list[int], np.ndarray]:
    """The ids of all texts one after the other, and where each text's begin (n + 1)."""
    parts, first = _cut(lib, texts)
    ids: list[int] = []
    bounds = [0]
    for run in calls(parts):
        for found in lib.ids(parts[run]):
            ids += found
            bounds.append(len(ids))
    return ids, np.array(bounds, np.int64)[first]
