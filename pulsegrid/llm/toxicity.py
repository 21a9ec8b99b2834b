"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; a hash sample of all other texts, their labels hidden, is the unlabelled
set. A logistic model over word, prefix and class features is trained in numpy with the class-prior-corrected risk

    pi * R(positives, +1) + max(0, R(unlabelled, -1) - pi * R(positives, -1))

where a step that finds the second part below zero climbs it instead (the non-negative estimator). pi is the share of
toxic rows among the labelled training rows. Features are the ``FEATURES`` words and word beginnings (4 and 5 bytes)
whose document frequency among positives exceeds that among the unlabelled by most standard errors. A quarter of the
sample is held back to set the decision level, by the same risk with zero-one loss.

Labels are learned only from rows whose crc32(doc_id as text) mod ``FOLDS`` is not 0. The fit uses at most about
``POSITIVES`` + ``UNLABELLED`` documents, taken by a hash of doc_id; these two bounds are its parameters. Every whole
text is scored, in one pass without a shuffle; the model (a few KB) travels with the tasks.

Defined results: null and empty texts get the score of a text without features; without positives or unlabelled rows
every score is 0; a null doc_id is not held out and never learned from. Extra columns are ignored. Labels of repeated
rows: a doc_id is a positive if any of its rows says toxic.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from pulsegrid.llm.common import _BYTE, U64, _pow, mix, offsets_of, prepare, slices, texts

FOLDS = 5
POSITIVES, UNLABELLED = 2000, 6000
FEATURES = 200
MIN_DOCUMENTS, MIN_ERRORS = 4, 4.0
PREFIXES = (4, 5)
COUNTED_AT_ONCE = 1 << 18  # feature occurrences that the fit counts in one step
STEPS, RATE, L2 = 150, 0.1, 1e-4

# letters: ASCII in lower case and every byte of a longer character; all else parts words
_LETTER = np.zeros(256, np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature hash) of every word and word beginning in a string array, repeats included."""
    col = texts(col)
    off = offsets_of(col)
    buf = col.buffers()[2]
    data = _LETTER[np.frombuffer(buf, np.uint8)[off[0]:off[-1]]] if buf is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    up, down = _pow(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=prefix[1:])
    word = data > 0
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    edge = off[(off > 0) & (off < len(data))]
    begin[edge] = word[edge]
    end[edge - 1] = word[edge - 1]
    a, z = np.flatnonzero(begin), np.flatnonzero(end) + 1
    row = np.searchsorted(off, a, side="right") - 1
    rows, hashes = [row], [mix((prefix[z] - prefix[a]) * down[a])]
    for n in PREFIXES:
        long = z - a >= n
        s = a[long]
        rows.append(row[long])
        hashes.append(mix((prefix[s + n] - prefix[s]) * down[s] + U64(n)))
    return np.concatenate(rows), np.concatenate(hashes)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@dataclass
class Model:
    hashes: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def scores(self, col: pa.Array) -> np.ndarray:
        total = np.full(len(col), self.bias)
        if len(self.hashes) and len(col):
            row, h = features(col)
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = self.hashes[at] == h
            once = np.unique(row[hit] * len(self.hashes) + at[hit])  # a feature counts once per text
            total += np.bincount(once // len(self.hashes), weights=self.weights[once % len(self.hashes)], minlength=len(col))
        return 1.0 / (1.0 + np.exp(-np.clip(total, -500, 500)))


def _chosen(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """The features that tell positives best, sorted. Texts hold theirs sorted; ranges of hashes are counted one by one."""
    n_pos, n_unl = len(positive), len(unlabelled)
    parts = 1 + (sum(map(len, positive)) + sum(map(len, unlabelled))) // COUNTED_AT_ONCE
    ends = [U64(i * (1 << 64) // parts) for i in range(1, parts)]
    held: list[tuple[np.ndarray, np.ndarray]] = []
    cuts = [[(0, *np.searchsorted(x, ends).tolist(), len(x)) for x in texts] for texts in (positive, unlabelled)]
    for i in range(parts):
        pos, unl = (np.concatenate([x[c[i]:c[i + 1]] for x, c in zip(texts, cut, strict=True)])
                    for texts, cut in zip((positive, unlabelled), cuts, strict=True))
        known, ids = np.unique(np.concatenate([pos, unl]), return_inverse=True)
        in_pos = np.bincount(ids[:len(pos)], minlength=len(known))
        in_unl = np.bincount(ids[len(pos):], minlength=len(known))
        base = (in_unl + 1) / (n_unl + 2)
        errors = (in_pos / n_pos - base) / np.sqrt(base * (1 - base) * (1 / n_pos + 1 / n_unl))
        kept = (in_pos + in_unl >= MIN_DOCUMENTS) & (errors >= MIN_ERRORS)
        held.append((known[kept], errors[kept]))
    known, errors = (np.concatenate(x) for x in zip(*held, strict=True))
    return np.sort(known[np.argsort(-errors, kind="stable")[:FEATURES]])


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Fit on the distinct feature hashes of each text."""
    if not positive or not unlabelled or not 0 < prior < 1:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -500.0)
    every = positive + unlabelled
    n_pos, n_unl = len(positive), len(unlabelled)
    best = _chosen(positive, unlabelled)
    x1 = np.zeros((len(every), len(best) + 1))  # the last column is the bias
    x1[:, -1] = 1.0
    for i, own in enumerate(every):
        if len(own) and len(best):
            x1[i, :-1] = own[np.minimum(np.searchsorted(own, best), len(own) - 1)] == best

    is_pos = np.arange(len(every)) < n_pos
    back = np.random.default_rng(11).random(len(every)) < 0.25  # held back for the decision level
    pos, unl = is_pos & ~back, ~is_pos & ~back
    if not (pos.any() and unl.any() and (is_pos & back).any() and (~is_pos & back).any()):
        pos, unl, back = is_pos, ~is_pos, np.ones(len(every), bool)
    w = np.zeros(len(best) + 1)
    first, second = np.zeros_like(w), np.zeros_like(w)
    decay = np.append(np.full(len(best), L2), 0.0)
    for step in range(1, STEPS + 1):
        f = x1 @ w
        p = 1 / (1 + np.exp(-np.clip(f, -500, 500)))
        loss = np.logaddexp(0, f)
        negative = loss[unl].mean() - prior * loss[pos].mean()
        gradient = np.where(pos, -prior * p / pos.sum(), np.where(unl, p / unl.sum(), 0.0))
        if negative >= 0:
            gradient -= np.where(pos, prior * (1 - p) / pos.sum(), 0.0)
        else:
            gradient = -gradient
        g = x1.T @ gradient + decay * w
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)

    f = x1 @ w
    p, u = np.sort(f[is_pos & back]), np.sort(f[~is_pos & back])
    levels = np.unique(np.concatenate([p, u]))
    levels = np.concatenate([[levels[0] - 1], (levels[1:] + levels[:-1]) / 2, [levels[-1] + 1]])
    missed = np.searchsorted(p, levels) / len(p)
    fired = 1 - np.searchsorted(u, levels) / len(u)
    risk = prior * missed + np.maximum(0, fired - prior * (1 - missed))
    level = np.median(levels[risk <= risk.min() + 1e-12])
    return Model(best, w[:-1], float(w[-1] - level))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on ``docs(doc_id, text)`` with ``labels(doc_id, toxic)``; see the module text for what is used."""
    prepare(docs.sparkSession)
    usable = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    per = usable.where("toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n, n_toxic = per.agg(F.count(F.lit(1)), F.count(F.when(F.col("toxic") == 1, 1))).first()
    n_rows = docs.count()
    if not n_toxic or not n_rows:
        return train([], [], 0.0)
    spread = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("doc_id").cast("long")), F.lit(1 << 30))
    chosen = per.where("toxic = 1").where(spread < int(min(1.0, POSITIVES / n_toxic) * (1 << 30)))
    positives = sorted(r[0] for r in chosen.select("doc_id").collect())  # about POSITIVES at most
    sample = (docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .withColumn("positive", F.col("doc_id").isin(positives))
              .where(F.col("positive") | (spread < int(min(1.0, UNLABELLED / n_rows) * (1 << 30)))))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                row, h = features(part.column("text"))
                order = np.argsort(row, kind="stable")
                cut = np.searchsorted(row[order], np.arange(part.num_rows + 1))
                h = h[order]
                yield pa.RecordBatch.from_arrays(
                    [part.column("positive"), pa.array([np.unique(h[a:b]).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
                    names=["positive", "hashes"])

    got = sample.select("positive", "text").mapInArrow(run, "positive boolean, hashes binary").toArrow()
    found = [np.frombuffer(x.as_buffer(), np.uint64) for chunk in got.column("hashes").chunks for x in chunk]  # views, no copies
    flag = got.column("positive").to_pylist()
    order = sorted(range(len(found)), key=lambda i: (flag[i], len(found[i])))  # the same however it was read: equal ones by their bytes
    order = [i for _, same in groupby(order, key=lambda i: (flag[i], len(found[i]))) for i in sorted(same, key=lambda i: found[i].tobytes())]
    positive = [found[i] for i in order if flag[i]]
    unlabelled = [found[i] for i in order]  # positives are part of the whole, label hidden
    share = min(1.0, UNLABELLED / n_rows)
    if share < 1:  # among the unlabelled only as many positives as their share of the sample
        keep = np.random.default_rng(5).random(len(order)) < share
        unlabelled = [found[i] for i, k in zip(order, keep, strict=True) if k or not flag[i]]
    return train(positive, unlabelled, n_toxic / n)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every column of ``docs`` (but old ones of these names), with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on) of each whole text."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                s = model.scores(part.column("text"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                                 names=[*part.schema.names, "score", "predicted"])

    prepare(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs(doc_id, text)``."""
    out = score(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is not predicted to be toxic, with their columns."""
    model = fit(docs, labels)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pa.array(model.scores(part.column("text")) < 0.5))

    return docs.mapInArrow(run, docs.schema)
