"""Nearest neighbours where vec_ids repeat: every vec_id counts once, with its best vector."""

import numpy as np
import pytest

from pulsegrid.llm import ann


def brute(ids, x, every=20, k=20):
    out = []
    for q in sorted({i for i in ids if i % every == 0}):
        best = {}
        for at in np.flatnonzero(ids == q):
            for i, s in zip(ids.tolist(), (x @ x[at]).tolist(), strict=True):
                if i != q:
                    best[i] = max(s, best.get(i, -np.inf))
        ranked = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k]
        out += [(int(q), r + 1, i, round(s, 9)) for r, (i, s) in enumerate(ranked)]
    return out


def found(spark, ids, x):
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    return [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in ann.nearest(df).orderBy("query_id", "rank").collect()]


@pytest.mark.parametrize("copies", [1, 2, 30])
def test_repeated_rows(spark, copies):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((60, 8))
    ids = np.arange(60)
    assert found(spark, np.tile(ids, copies), np.tile(x, (copies, 1))) == brute(ids, x)


def test_ids_with_several_vectors(spark):
    rng = np.random.default_rng(6)
    ids = np.concatenate([np.arange(60), np.arange(60), np.full(200, 7)])  # 7: many vectors near each other
    x = np.concatenate([rng.standard_normal((120, 8)), 3 + 0.1 * rng.standard_normal((200, 8))])
    assert found(spark, ids, x) == brute(ids, x)


def plain_index(x):
    """The library's own fit and lists without Spark."""
    norm = np.sqrt((x * x).sum(axis=1).max())
    sample = x[np.sort(np.random.default_rng(1).choice(len(x), min(len(x), 4_000), replace=False))] / norm
    lifted = np.hstack([sample, np.sqrt(np.maximum(0, 1 - (sample * sample).sum(axis=1)))[:, None]])
    k = -(-len(x) // ann.PER_LIST)
    centroids = ann.balanced_centroids(lifted, k, 6)
    index = ann.Index(norm, centroids, *ann.centroid_graph(centroids), np.zeros(k, np.int64))
    lists = [[] for _ in range(k)]
    for start in range(0, len(x), 20_000):
        row, of = index.place(x[start:start + 20_000])
        for i, c in zip((row + start).tolist(), of.tolist(), strict=True):
            lists[c].append(i)
    index.sizes[:] = [len(c) for c in lists]
    index.settle(sample * norm, len(x), 20)
    return index, lists


def test_recall_on_many_jittered_vectors():
    rng = np.random.default_rng(8)
    base = rng.standard_normal((4_000, 24))
    x = base[rng.integers(0, len(base), 200_000)]
    x += 0.1 * rng.standard_normal(x.shape)
    index, lists = plain_index(x)
    met, found = [], []
    for q in rng.choice(len(x), 60, replace=False).tolist():
        scores = x @ x[q]
        scores[q] = -np.inf
        chosen = index.lists(x[q])
        met.append(np.isin(np.argsort(-scores)[:20], np.concatenate([lists[c] for c in chosen])).mean())
        found.append(len(set(chosen) & set(index.all_lists(x[q]))) / len(index.all_lists(x[q])))
    assert np.mean(met) >= 0.95 and np.mean(found) >= 0.99


def test_scores_do_not_depend_on_the_block(spark):
    """Equal vectors get equal scores wherever they are compared, and ties go to the smaller id."""
    rng = np.random.default_rng(9)
    x = rng.standard_normal((3_000, 64))
    x[1500:] = x[:1500]  # every vector twice
    ids = rng.permutation(3_000).astype(np.int64)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    of = dict(zip(ids.tolist(), x, strict=True))
    rows = ann.nearest(df, every=200).collect()
    by_score = {}
    for r in rows:
        assert r["score"] == (of[r["query_id"]] * of[r["vec_id"]]).sum()
        by_score.setdefault((r["query_id"], r["score"]), []).append((r["rank"], r["vec_id"]))
    assert any(len(v) == 2 for v in by_score.values())
    assert all(sorted(v) == sorted(v, key=lambda p: p[1]) for v in by_score.values())
