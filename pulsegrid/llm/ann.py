"""Approximate nearest neighbours by inner product: balanced posting lists around centroids.

Fit: centroids by k-means with a size penalty (so lists come out balanced) on at most about ``SAMPLE`` vectors, taken
by a hash of the row; about ``PER_LIST`` vectors a list, at most ``MAX_LISTS`` lists. Inner product becomes distance by
one more component: x -> (x / M, sqrt(1 - |x|^2 / M^2)) with M the largest norm, q -> (q / |q|, 0).

Rows equal in vec_id and vector are folded first. Index: every vector goes to the list of its nearest centroid, and, if it lies near a border (distance within
``BORDER`` of the nearest), to the next ones, ``COPIES`` in all.

Search: centroids form an in-memory graph (near ones in all directions, edges both ways, some far ones); a walk over it
selects the lists whose centroid is within a ratio of the nearest one's distance, and goes on by distance until the
selected lists hold ``MIN_CANDIDATES`` entries, or all. After indexing, ratio and width of the walk are held to the
sample: the ratio widens until the lists of the sample's neighbours are chosen, the walk until it finds what the
distances to all centroids would choose (``Index.settle``). Lists and queries meet in blocks (a hot list is cut by a hash of its rows), a task
takes the best score of each vec_id in a block, keeps the best of each query over all its blocks, and a last step merges
these. Lists count distinct vec_ids. Scores are exact inner products in double precision.

Defined results: vectors that are null, empty, zero or hold null or non-finite components neither search nor are
found; so are those of another length than most. Ties go to the smaller vec_id; rows that share a vec_id count once,
with their best score. Null vec_id: no part. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import grouped, materialise, prepare, shuffle_partitions
from pulsegrid.llm.embed_dedup import valid_vectors

SAMPLE = 20_000
PER_LIST, MAX_LISTS = 400, 4096
COPIES, BORDER = 2, 1.1
RATIO = 1.17
MIN_CANDIDATES = 800
NEIGHBOURS, LONG_EDGES = 16, 8
# Width of the walk at first, points on which it is held to the full choice, and the share of lists it must find.
BEAM, PROBES, FOUND = 32, 400, 0.995
# Share of a probe's neighbours whose lists must be chosen, and how far the ratio may widen for it (2: nearly all lists).
COVERED, WIDEST = 0.97, 2.0
# What rounding may add to a block's product, as a share of the largest norms (far above dim * 2^-53).
ROUNDING = 1e-9
LIST_BLOCK, QUERY_BLOCK = 4096, 1024
HELD_QUERIES = 50_000


def _rows(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(axis=1)
    return np.sqrt(np.maximum(d, 0))


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k-means whose assignment charges large clusters more, round by round."""
    rng = np.random.default_rng(31)
    centroids = x[np.sort(rng.choice(len(x), k, replace=False))].copy()
    charge = np.zeros(k)
    for _ in range(rounds):
        d = _distances(x, centroids) ** 2
        own = np.argmin(d + charge, axis=1)
        count = np.bincount(own, minlength=k)
        charge += 0.1 * d.min(axis=1).mean() * (count / count.mean() - 1)
        order = np.argsort(own, kind="stable")
        used = np.flatnonzero(count)
        starts = np.concatenate([[0], np.cumsum(count)[:-1]])[used]
        centroids[used] = np.add.reduceat(x[order], starts, axis=0) / count[used][:, None]
    return centroids


@dataclass
class Index:
    """Centroids, their graph and the lists' counts of vec_ids: at most MAX_LISTS rows, so small enough to go with every task."""

    norm: float
    centroids: np.ndarray
    graph: list[np.ndarray]
    entries: np.ndarray
    sizes: np.ndarray
    beam: int = BEAM
    ratio: float = RATIO

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of each posting of vectors ``x``."""
        scaled = x / self.norm
        rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
        d = _distances(np.hstack([scaled, rest[:, None]]), self.centroids)
        n = min(COPIES, d.shape[1])
        near = np.argsort(d, axis=1, kind="stable")[:, :n]
        far = np.take_along_axis(d, near, axis=1)
        keep = far <= far[:, :1] * BORDER
        keep[:, 0] = True
        row, at = np.nonzero(keep)
        return row, near[row, at]

    def _chosen(self, d: np.ndarray, c: np.ndarray) -> list[int]:
        """Of centroids ``c`` by distance ``d`` (ascending): those near the best, and enough of them."""
        held = np.concatenate([[0], np.cumsum(self.sizes[c])[:-1]])
        return c[(d <= d[0] * self.ratio) | (held < MIN_CANDIDATES)].tolist()

    def lists(self, q: np.ndarray) -> list[int]:
        """The lists to search for query ``q``: a walk over the centroid graph, as wide as ``settle`` found it must be.

        The walk always opens the nearest centroid not yet opened. It ends when that one is farther than the ``beam``
        nearest found so far, and too far to be chosen with what is found.
        """
        point = np.append(q / np.sqrt(q @ q), 0.0)
        k = len(self.centroids)
        seen = np.zeros(k, bool)
        queue: list[tuple[float, int]] = []
        nearest: list[float] = []  # the beam's distances, negative: the farthest first
        met: list[tuple[float, int]] = []

        def push(some: np.ndarray) -> None:
            some = some[~seen[some]]
            seen[some] = True
            for d, c in zip(_distances(point[None], self.centroids[some])[0].tolist(), some.tolist(), strict=True):
                heapq.heappush(queue, (d, c))
                met.append((d, c))
                if len(nearest) < self.beam:
                    heapq.heappush(nearest, -d)
                elif d < -nearest[0]:
                    heapq.heapreplace(nearest, -d)

        push(self.entries)
        best, held = math.inf, 0
        while queue:
            d, c = heapq.heappop(queue)
            best = min(best, d)
            if d > best * self.ratio and held >= MIN_CANDIDATES and len(nearest) == self.beam and d > -nearest[0]:
                break
            held += int(self.sizes[c])
            push(self.graph[c])
            if not queue and not seen.all():  # a part of the graph that no edge led to
                push(np.flatnonzero(~seen))
        d, c = np.array(sorted(met)).T
        return self._chosen(d, c.astype(np.int64))

    def all_lists(self, q: np.ndarray) -> list[int]:
        """The choice of ``lists`` from the distances to all centroids."""
        d = _distances(np.append(q / np.sqrt(q @ q), 0.0)[None], self.centroids)[0]
        order = np.argsort(d, kind="stable")
        return self._chosen(d[order], order)

    def settle(self, sample: np.ndarray, rows: int, k: int) -> tuple[float, float]:
        """Widen the choice until it holds the lists of the probes' neighbours, then the walk until it finds that choice.

        A probe's nearest in the sample stand for its ``k`` nearest among ``rows`` vectors: as many of them as make the
        same share. Returns the shares of neighbours covered and of lists found.
        """
        probes = sample[np.unique(np.linspace(0, len(sample) - 1, PROBES).astype(int))]
        probes = probes[(probes * probes).sum(axis=1) > 0]
        row, of = self.place(sample)
        posted = np.zeros((len(sample), len(self.centroids)), bool)
        posted[row, of] = True
        few = max(1, math.ceil(k * len(sample) / rows))
        scores = probes @ sample.T
        near = np.argsort(-scores, axis=1, kind="stable")[:, :few + 1]  # most often itself, and the others
        while True:
            covered = np.mean([posted[n][:, self.all_lists(q)].any(axis=1).mean() for n, q in zip(near, probes, strict=True)] or [1.0])
            if covered >= COVERED or self.ratio >= WIDEST:
                break
            self.ratio = min(WIDEST, self.ratio * 1.06)
        wanted = [set(self.all_lists(q)) for q in probes]
        while True:
            found = sum(len(w.intersection(self.lists(q))) for w, q in zip(wanted, probes, strict=True)) / max(1, sum(map(len, wanted)))
            if found >= FOUND or self.beam >= len(self.centroids):
                return float(covered), found  # a beam as wide as the graph opens every centroid
            self.beam = min(2 * self.beam, len(self.centroids))


def centroid_graph(centroids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Edges to the nearest centroids in all directions (one that a nearer neighbour is closer to is passed over while
    others are left), back again, and to some far ones; and the entry points, spread evenly."""
    k = len(centroids)
    rng = np.random.default_rng(17)
    edges: list[set[int]] = [set() for _ in range(k)]
    for c in range(k):
        d = _distances(centroids[c][None], centroids)[0]
        near = np.argsort(d, kind="stable")
        near = near[near != c][:4 * NEIGHBOURS]
        kept: list[int] = []
        if len(near):
            between = _distances(centroids[near], centroids[near])
            at: list[int] = []
            for i, c2 in enumerate(near.tolist()):
                if len(kept) < NEIGHBOURS and not (between[i, at] < d[c2]).any():
                    kept.append(c2)
                    at.append(i)
            kept += near[:NEIGHBOURS // 2].tolist()
        edges[c].update(kept)
        for c2 in (*kept, *(rng.choice(k, LONG_EDGES).tolist() if k > LONG_EDGES else ())):
            edges[c].add(c2)
            edges[c2].add(c)
    entries = np.unique(np.linspace(0, k - 1, min(k, 1 + math.isqrt(k))).astype(int))
    return [np.array(sorted(e - {c}), np.int64) for c, e in enumerate(edges)], entries


def fit(vectors: DataFrame, rows: int, norm: float) -> tuple[Index, np.ndarray]:
    """Centroids and graph from a bounded hash sample of ``vectors(vec_id, vector)``, and the sample."""
    share = min(1.0, SAMPLE / rows)
    spread = F.pmod(F.xxhash64(F.lit("ann"), F.col("vec_id"), F.col("vector")), F.lit(1 << 30))
    sample = vectors.where(spread < int(share * (1 << 30)) + 1).select("vec_id", "vector").toArrow().sort_by([("vec_id", "ascending"), ("vector", "ascending")])
    x = _rows(sample.column("vector").to_pylist() or vectors.select("vector").limit(1).toArrow().column("vector").to_pylist()) / norm
    x = np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))[:, None]])
    k = max(1, min(MAX_LISTS, len(x), math.ceil(rows / PER_LIST)))
    centroids = balanced_centroids(x, k)
    return Index(norm, centroids, *centroid_graph(centroids), np.zeros(k, np.int64)), x[:, :-1] * norm


def _with_norm(batches):
    for batch in batches:
        raw = batch.column("vector").to_pylist()
        norms = [None if r is None else float(np.linalg.norm(np.frombuffer(r, np.float64))) for r in raw]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norms, pa.float64()), pa.array([None if r is None else len(r) // 8 for r in raw], pa.int32())],
                                         names=["vec_id", "vector", "copies", "norm", "dim"])


def _postings(index: Index):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                row, of = index.place(_rows(batch.column("vector").to_pylist()))
                part = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(of.astype(np.int32)), part.column("vec_id"), part.column("vector")],
                                                 names=["list", "id", "vector"])

    return run


def _selected(index: Index):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                found = [index.lists(q) for q in _rows(batch.column("vector").to_pylist())]
                row = np.repeat(np.arange(len(found)), [len(f) for f in found])
                part = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array([c for f in found for c in f], pa.int32()), part.column("vec_id"), part.column("vector")],
                                                 names=["list", "id", "vector"])

    return run


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best by score, ties to the smaller id, each id once."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    _, first = np.unique(ids, return_index=True)
    first = np.sort(first)[:k]
    return ids[first], scores[first]


def _search_blocks(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches):
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def flush():
            if held:
                q = np.repeat(np.array(list(held), np.int64), [len(v[0]) for v in held.values()])
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(np.concatenate([v[0] for v in held.values()])),
                                                  pa.array(np.concatenate([v[1] for v in held.values()]))], schema=schema)
                held.clear()

        for table in grouped(batches, ["list", "block", "query_block"]):
            query = np.asarray(table.column("query").combine_chunks().cast(pa.int8())).astype(bool)
            if query.all() or not query.any():
                continue
            ids = np.asarray(table.column("id").combine_chunks())
            x = _rows(table.column("vector").to_pylist())
            others, other_ids = x[~query], ids[~query]
            # the product only says who may be among the best: its last digits depend on the block
            scores = x[query] @ others.T
            slack = ROUNDING * math.sqrt((x[query] ** 2).sum(axis=1).max() * (others ** 2).sum(axis=1).max())
            found, of = np.unique(other_ids, return_inverse=True)
            order = np.argsort(of, kind="stable")
            by_id = np.maximum.reduceat(scores[:, order], np.flatnonzero(np.diff(of[order], prepend=-1)), axis=1)
            for q, v, s, t in zip(ids[query].tolist(), x[query], scores, by_id, strict=True):
                some = np.arange(len(s))
                if len(t) > 2 * k:  # ties at the last place stay in
                    some = np.flatnonzero(s >= np.partition(t, len(t) - k - 1)[len(t) - k - 1] - slack)
                some = some[other_ids[some] != q]
                new_ids, new_scores = other_ids[some], (others[some] * v).sum(axis=1)  # one order of adding up
                if q in held:
                    new_ids = np.concatenate([held[q][0], new_ids])
                    new_scores = np.concatenate([held[q][1], new_scores])
                held[q] = _best(new_ids, new_scores, k)
            if len(held) > HELD_QUERIES:
                yield from flush()
        yield from flush()

    return run


def nearest(embeddings: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for rows whose vec_id is divisible by ``every``, the ``k`` nearest others."""
    spark = prepare(embeddings.sparkSession)
    n_part = shuffle_partitions(spark)
    folded = (valid_vectors(embeddings).where("vector is not null and vec_id is not null")
              .groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies")))
    vectors = materialise(folded.mapInArrow(_with_norm, "vec_id long, vector binary, copies long, norm double, dim int"), "vectors")
    per_dim = (vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("n_rows"), F.max("norm").alias("norm"))
               .orderBy(F.desc("n_rows"), "dim").first())
    out = "query_id long, rank int, vec_id long, score double"
    if per_dim is None:
        return spark.createDataFrame([], out)
    vectors = vectors.where(F.col("dim") == per_dim["dim"]).select("vec_id", "vector")
    index, sample = fit(vectors, per_dim["n"], per_dim["norm"])
    postings = materialise(vectors.mapInArrow(_postings(index), "list int, id long, vector binary"), "postings")
    sizes = (postings.groupBy("list", "id").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("list").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("n_ids")))
    for r in sizes.collect():  # one row per list
        index.sizes[r["list"]] = r["n_ids"]
    index.settle(sample, per_dim["n"], k)
    queries = vectors.where(F.col("vec_id") % every == 0).repartition(n_part)
    asked = materialise(queries.mapInArrow(_selected(index), "list int, id long, vector binary"), "asked")
    load = sizes.join(asked.groupBy("list").agg(F.count(F.lit(1)).alias("asked")), "list")
    load = materialise(load.select("list", F.ceil(F.col("size") / LIST_BLOCK).cast("int").alias("blocks"),
                                   F.ceil(F.col("asked") / QUERY_BLOCK).cast("int").alias("query_blocks")), "load")

    def dealt(df: DataFrame, query: bool) -> DataFrame:
        block = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)) if query else F.pmod(F.xxhash64("id", "vector"), F.col("blocks")).cast("int")
        other = F.pmod(F.xxhash64("id"), F.col("query_blocks")).cast("int") if query else F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1))
        return (df.join(load, "list").withColumn("block", block).withColumn("query_block", other)
                .select("list", "block", "query_block", F.lit(query).alias("query"), "id", "vector"))

    order = ["list", "block", "query_block"]
    met = dealt(postings, False).union(dealt(asked, True)).repartition(n_part, *order).sortWithinPartitions(*order)
    found = met.mapInArrow(_search_blocks(k), "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
