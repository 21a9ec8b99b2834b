"""Token counts and the alignment of two tokenizers against the libraries on whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import llm_brute as brute
from conftest import SF_SMALL
from pulsegrid.llm import alignment, encoding, token_counts
from pulsegrid.llm.queries import QUERIES

A, B = alignment.default_tokenizers()
ODD = [" ", "  ", "\n", "a", "b'", "s", "1", "　", "\xa0", "▁", "<|endoftext|>", "é", "中", "\x1c", "᠎", "!", "...", "\t", "\r\n", "<0x41>", "<s>", "😀"]


def odd_texts(n, size, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(size))) for _ in range(n)]


def library(plain=False):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(A)
    t.encode_special_tokens = plain
    return t


def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=B)


def byte_table():
    """The common byte-level table, written out: bytes that show stand for themselves, the rest from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def aligned(texts):
    """What op11 promises, by loops over whole texts."""
    t, sp, byte = library(True), pieces(), byte_table()
    found, links = [], []
    for text in texts:
        text = text or ""
        want = (" " + text).encode()
        a, b = t.encode(" " + text, add_special_tokens=False), sp.encode(text)
        ab = [bytes(byte[c] for c in token) for token in a.tokens]
        bb = [bytes([int(sp.id_to_piece(k)[3:5], 16)]) if sp.is_byte(k) else sp.id_to_piece(k).replace("▁", " ").encode() for k in b]
        if not text or b"".join(ab) != want or b"".join(bb) != want:
            found.append((0, 0, 0, ""))
            links.append(Counter())
            continue
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in (ab, bb)]
        groups, ids, ia, ib = [], a.ids, 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            ja, jb = ends[0].index(end, ia) + 1, ends[1].index(end, ib) + 1
            groups.append((ids[ia:ja], b[ib:jb]))
            ia, ib = ja, jb
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found.append((len(ids), len(b), len(groups), hashlib.sha256(shown.encode()).hexdigest()))
        links.append(Counter((x, y) for ga, gb in groups for x in ga for y in gb))
    count = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [(n_a, n_b, n_groups, sum(c.values()), sum(m for p, m in c.items() if count[p] == best[p[0]]), sum(m * count[p] for p, m in c.items()), digest)
            for (n_a, n_b, n_groups, digest), c in zip(found, links, strict=True)]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def alignment_of(spark, texts, clash=False):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    if clash:
        df = df.withColumns({c: F.lit("x") for c in ("block", "number", "a", "b", "n", "bits", "planes", "pair_count", "is_best", "best", "total")})
    return [tuple(r[c] for c in COLUMNS) for r in alignment.align_documents(df).orderBy("doc_id").collect()]


def test_op11(spark):
    texts = brute.rows(SF_SMALL, "documents", "doc_id, text")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_tokenizer_alignment"](spark, SF_SMALL).collect()}
    want = aligned([t for _, t in texts])
    assert len(got) == len(texts) and [got[i] for i, _ in texts] == want


def test_alignment_edges(spark):
    long = " ".join(f"w{i % 97}" for i in range(60_000))
    texts = [None, "", " ", "   ", "a▁b", "same text", "same text", "aaaaaaaaaaaaa " * 40, "<|endoftext|> <s>", "中文 ok é 😀", long, "x" * 5000, *odd_texts(40, 60)]
    assert alignment_of(spark, texts, clash=True) == aligned(texts)


def test_alignment_words_and_large_groups(spark, monkeypatch):
    """Links by words equal links by whole texts; few links at once, forgotten words and small blocks change nothing."""
    texts = [f"word {i % 7} and {'a' * (i % 30)}  {'no' * (i % 5)} \n x " for i in range(300)] + ["", *odd_texts(60, 50, 3)]
    pair = alignment.TokenPair(A, B)

    def by_words():
        known = alignment.Vocabulary(pair)
        parts = []
        for k in range(0, len(texts), 50):
            parts.append(known.postings(*known.look_up(texts[k:k + 50]), k))
        return alignment._merged(parts)

    want = alignment.Aligned(pair, texts).postings(pair, 0)
    for name, value in (("LINKS_AT_ONCE", 3), ("HELD_WORDS", 10)):
        got = by_words()
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
        monkeypatch.setattr(alignment, name, value)
        few = alignment.Aligned(pair, texts).postings(pair, 0)
        assert (few[0] == want[0]).all() and (few[1] == want[1]).all()
    got = by_words()
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    keys = np.unique(np.concatenate([(p << 16) | rng.choice(65536, n, replace=False) for p, n in ((3, 1), (5, 4095), (6, 4096), (7, 40_000), (900_000, 9))]))
    many = np.where(rng.random(len(keys)) < 0.3, rng.integers(1, 5000, len(keys)), 1)
    pairs, n, bits, planes = alignment.to_bitmaps(keys, many)
    assert pairs.tolist() == [3, 5, 6, 7, 900_000] and n.tolist() == [1, 4095, 4096, 40_000, 9]
    for start in range(5):  # also as slices of a larger batch
        row, number, links = alignment.from_bitmaps(bits.slice(start), planes.slice(start))
        skip = int(n[:start].sum())
        assert ((pairs[start:][row] << 16 | number) == keys[skip:]).all() and (links == many[skip:]).all()


def test_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_documents(none).count() == 0 and token_counts.count_tokens(none).count() == 0


def test_op13(spark):
    t = library()
    want = {i: (len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in brute.rows(SF_SMALL, "documents", "doc_id, text")}
    got = QUERIES["op13_token_counts"](spark, SF_SMALL).collect()
    assert len(got) == len(want)
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in got} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)


@pytest.mark.parametrize("path", [A, B])
def test_counts_edges(spark, path):
    texts = [None, "", " ", "x", "x", "<|endoftext|>a <|endoftext|>", "long text, " * 40_000, "nospace" * 30_000, *odd_texts(50, 40)]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, "nobody")], "doc_id long, text string")
    df = df.withColumns({c: F.lit("x") for c in ("n_bytes", "n_tokens", "over_limit", "lang")})
    lib = library() if path == A else pieces()
    n = [len(lib.encode(t or "", add_special_tokens=False).ids) if path == A else len(lib.encode(t or "")) for t in [*texts, "nobody"]]
    got = token_counts.count_tokens(df, path).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == dict(zip([*range(len(texts)), None], n, strict=True))


@pytest.mark.parametrize(("path", "plain"), [(A, False), (A, True), (B, False)])
def test_cuts_keep_the_ids(monkeypatch, path, plain):
    texts = odd_texts(1500, 400, 7)
    lib = encoding.tokenizer(path, plain)
    want = lib.ids(texts)
    monkeypatch.setattr(encoding, "PART_CHARS", 10)
    monkeypatch.setattr(encoding, "CALL_BYTES", 100)
    assert sum(len(lib.parts(t)) for t in texts) > 2 * len(texts)
    ids, first = encoding.encode(lib, texts)
    assert [ids[a:b] for a, b in zip(first[:-1], first[1:], strict=True)] == want
    assert encoding.count_ids(lib, texts).tolist() == [len(x) for x in want]
