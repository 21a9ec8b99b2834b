"""Phrase collocations against counting by loops, and against the DuckDB twin on the given table."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from pulsegrid.llm import phrases
from pulsegrid.llm.queries import ORACLES, QUERIES

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def counted(docs, least, top=2000):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n = {}, Counter()
    for lang, text in docs:
        lang = lang if lang is not None else "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                f.setdefault(lang, Counter()).update(tuple(w[k:k + m]) for k in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        rows = []
        frequent = {p: a for p, a in c.items() if a >= least}
        for p, a in frequent.items():
            if len(p) < 2 or any(len(q) > len(p) and b >= a and any(q[k:k + len(p)] == p for k in range(len(q))) for q, b in frequent.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def found(df, **limits):
    return sorted(tuple(r[c] for c in COLUMNS) for r in phrases.collocations(df, **limits).collect())


def frame(spark, docs, parts=3):
    df = spark.createDataFrame(docs, "lang string, text string").repartition(parts)
    return df.withColumns({c: F.lit("x") for c in ("shard", "word", "n", "id", "phrase", "a", "score", "doc_id", "prefix", "local")})


def sentences(n, seed):
    rng = random.Random(seed)
    words = ["A", "b", "c", "Dé", "中", "e\x0bf", "x1", "-", "it's", "\x1c"]
    return [(rng.choice(["en", "en", "en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", "\n", ". "])
             for _ in range(rng.randrange(30)))) for _ in range(n)]


def test_op12(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
    want = con.execute(ORACLES["op12_phrase_collocations"]).fetchall()
    got = QUERIES["op12_phrase_collocations"](spark, SF_SMALL)
    assert got.columns == COLUMNS and sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 20


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_equal_counting(spark, seed):
    docs = sentences(250, seed)
    assert found(frame(spark, docs), least=4) == counted(docs, 4)


def test_small_shards_ties_and_top(spark, monkeypatch):
    docs = sentences(150, 3) * 2
    want = counted(docs, 6, 5)
    assert found(frame(spark, docs, 1), least=6, top=5) == want
    assert found(frame(spark, docs, 40), least=6, top=5) == want  # many shards, phrases that no shard has often


def test_edges(spark):
    long = "on and on " * 30_000
    docs = [(None, None), ("en", ""), ("en", " \t\n.,"), ("fr", long), ("fr", "on and"), ("es", "one"), ("x", "a b"), ("x", "a b")]
    assert found(frame(spark, docs), least=2) == counted(docs, 2)
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_exact_score(spark):
    """Products beyond 64 bits: the same expression on large numbers."""
    a, n, left, right = 3 * 10**12 + 7, 9 * 10**14 + 1, 4 * 10**12 + 3, 5 * 10**12 + 9
    df = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert df.select(F.expr(phrases._SCORE.format(l="l", r="r"))).first()[0] == 1000 * a * n // (left * right)


def test_index_intervals():
    """Both intervals of extensions: sizes are counts, starts are ranks among the sorted sequences."""
    rng = np.random.default_rng(2)
    symbols = np.concatenate([[0], rng.integers(0, 4, 400), [0]]).astype(np.int64)
    symbols = symbols[(symbols > 0) | (np.diff(symbols, prepend=1) != 0)]
    n = np.bincount(symbols, minlength=4)[1:]
    first = np.concatenate([[0], np.cumsum(n) - n])

    def after(s, k):  # what follows a position up to the break, at most five symbols
        out = []
        while s[k] and len(out) < 5:
            out.append(int(s[k]))
            k += 1
        return out

    ahead = sorted(after(symbols, k) for k in np.flatnonzero(symbols))
    back = sorted(after(symbols[::-1], k) for k in np.flatnonzero(symbols[::-1]))
    index = phrases.Index(phrases._transform(symbols[::-1], 5), first)
    which, new, other, many = index.extend(first[1:], first[1:], n)
    for w, r, f, m in zip(which.tolist(), new.tolist(), other.tolist(), many.tolist(), strict=True):
        word = back[r][0]
        assert all(x[:2] == [word, w + 1] for x in back[r:r + m]) and all(x[:2] == [w + 1, word] for x in ahead[f:f + m])
        assert m == sum(x[:2] == [w + 1, word] for x in ahead)


def test_index_needs_little_memory():
    rng = np.random.default_rng(3)
    size = 200_000
    words = np.minimum(rng.zipf(1.3, size), 5000).astype(np.int32)
    words[rng.random(size) < 0.15] = 0
    words[[0, -1]] = 0
    n = np.bincount(words, minlength=5001)[1:]
    first = np.concatenate([[0], np.cumsum(n) - n])
    tracemalloc.start()
    bwt = phrases._transform(words[::-1], 5)
    made = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    phrases.Index(bwt, first).extend(first[1:], first[1:], n)
    grown = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made < 60 * size and grown < 45 * size


def test_index_stays_where_it_is(spark, monkeypatch):
    """Phrases are sent to the shards' indexes; no index is shuffled again for a length."""
    plans, materialise = {}, phrases.materialise

    def seen(df, name, *args):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return materialise(df, name, *args)

    monkeypatch.setattr(phrases, "materialise", seen)
    docs = sentences(250, 4)
    assert found(frame(spark, docs), least=4) == counted(docs, 4)
    assert [plans[f"phrase-counted-{k}"].count("Exchange hashpartitioning(shard") for k in range(2, 6)] == [1, 1, 1, 1]
    assert not {t.name for t in spark.catalog.listTables() if "phrase" in t.name}


def test_little_disk(spark):
    """What lies in the shared folder after a run, a byte of text: streams, indexes and what comes of them."""
    from pathlib import Path

    from pulsegrid.llm.common import shared_dir

    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{w}" for w in np.minimum(rng.zipf(1.2, 2000), 20_000).tolist()) for _ in range(200)]
    there = Path(shared_dir(spark).removeprefix("file:")) / "pulsegrid-llm"
    before = set(there.glob("*"))
    phrases.phrase_counts(spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(2), least=20)
    size = sum(f.stat().st_size for d in set(there.glob("*")) - before for f in d.rglob("*.parquet"))
    assert size < 0.9 * sum(map(len, texts))


def test_packed_numbers():
    rng = np.random.default_rng(6)
    for size in (0, 1, 5, 15, 16, 17, 1000):
        for kind, top in (("<i4", 1 << 31), ("<i8", 1 << 62), ("u1", 256)):
            x = rng.integers(0, top, size).astype(kind)
            packed = phrases._bytes(x, kind)
            assert phrases._numbers(packed, kind).tolist() == x.tolist() and phrases._size(packed) == x.nbytes
        rising = np.sort(rng.integers(0, 1 << 40, size))
        assert phrases._summed(phrases._steps(rising, "<i8"), "<i8").tolist() == rising.tolist()
    assert len(phrases._steps(np.arange(1 << 20), "<i4")) < 1000
