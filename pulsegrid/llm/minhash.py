"""Near-duplicate documents: universal hash minima, banding, signature check, exact check, components.

1. Each text becomes a set of word shingles; equal sets (exact copies) fold into one class by a grouped minimum.
2. ``BANDS * ROWS`` minima of universal hashes (multiply-shift) make a signature; each band of it is a bucket key.
3. Within a bucket every class is paired with the bucket's smallest (a star: as many pairs as members, however
   large the bucket). Pairs whose signatures agree in ``SIGNATURE_MIN`` of all minima are checked on full sets.
4. Components of these links; then the rest of each bucket that is still in several components is compared across
   components, in blocks inside tasks (signatures first, then full sets), so that no link between different
   components is lost and no bucket's pairs are emitted. No bucket is capped.
5. Components of all links by alternating stars.

At a similarity of 0.8 one band of 5 rows agrees with probability 0.33, at least one of 25 with 0.99995.

Defined results: null or wordless text has an empty set and is linked with nothing; a text with fewer words than a
shingle is one shingle; rows that share a doc_id count as one document (one component); a null doc_id takes no part
(component null, kept true). Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import U64, Words, grams, grouped, materialise, mix, prepare, shuffle_partitions, signed, slices
from pulsegrid.llm.components import connected_components, shared_classes

BANDS, ROWS = 25, 5
HASHES = BANDS * ROWS
# Share of equal minima that lets a pair on to the exact check: 0.8 less four standard deviations of the estimate.
SIGNATURE_MIN = 0.8 - 4 * (0.8 * 0.2 / HASHES) ** 0.5
# Buckets up to SMALL members hand their few open pairs to a join; larger ones are compared inside tasks by blocks.
SMALL, BLOCK = 64, 2048

_rng = np.random.default_rng(4242)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * U64(2) + U64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_C = _rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) | U64(1)


def shingle_sets(col: pa.Array, words_per_shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(col, lower=True)
    h, first = words.hashes(), words.first
    all_grams = grams(h, words_per_shingle)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words_per_shingle:
            yield np.unique(all_grams[a:b - words_per_shingle + 1])
        elif b > a:
            yield grams(h[a:b], int(b - a)) ^ U64(b - a)
        else:
            yield np.zeros(0, np.uint64)


def _minima(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, np.iinfo(np.uint32).max, np.uint64)
    for i in range(0, len(shingles), 256):
        np.minimum(low, ((shingles[i:i + 256, None] * _A + _B) >> U64(32)).min(axis=0), out=low)
    return low


def _signature_rows(sigs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.uint16).reshape(-1, HASHES)


def _band_keys(sigs: np.ndarray) -> np.ndarray:
    """The bucket key of each band of signatures."""
    parts = mix(sigs.astype(np.uint64).reshape(-1, BANDS, ROWS) + U64(1)) * _C
    return signed(mix(parts.sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)))


def _band_rows(batches):
    for batch in batches:
        keys = _band_keys(_signature_rows(batch.column("sig").to_pylist()))
        ids = np.repeat(np.asarray(batch.column("id")), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys.reshape(-1))], names=["id", "key"])


def _signatures(words_per_shingle: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()),
                        ("sig", pa.binary())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, ids, low = [], [], []
                for s in shingle_sets(part.column("text"), words_per_shingle):
                    sizes.append(len(s))
                    ids.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    low.append(_minima(s))
                sig = [x.tobytes() for x in np.array(low, np.uint64).astype(np.uint16)]  # the low 16 bits of each minimum
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
                                                  pa.array(sig, pa.binary())], schema=schema)

    return run


def _full_sets(words_per_shingle: int):
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.binary())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [s.tobytes() for s in shingle_sets(part.column("text"), words_per_shingle)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], schema=schema)

    return run


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= percent * (len(a) + len(b) - both)


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pair_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], schema=_PAIR)


def _signature_filter(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _signature_rows(batch.column("sig_a").to_pylist())
        y = _signature_rows(batch.column("sig_b").to_pylist())
        yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= SIGNATURE_MIN))


def _exact_filter(percent: int):
    def run(batches):
        for batch in batches:
            xs, ys = batch.column("set_a"), batch.column("set_b")
            keep = [_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(xs, ys, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _open_pairs(table: pa.Table):
    """Pairs (i, j) of one block pair that lie in different components, agree in signature and first meet here."""
    comp = np.asarray(table.column("component").combine_chunks())
    side = np.asarray(table.column("side").combine_chunks())
    key = int(table.column("key")[0].as_py())
    lo, hi = int(table.column("lo")[0].as_py()), int(table.column("hi")[0].as_py())
    sig = _signature_rows(table.column("sig").to_pylist())
    bands = _band_keys(sig)
    ids = np.asarray(table.column("id").combine_chunks())
    here = (bands == key).argmax(axis=1)  # the band of this bucket, the same for all
    band = int(here[0])
    left = np.flatnonzero(side == lo)
    right = np.flatnonzero(side == hi)
    values, counts = np.unique(comp, return_counts=True)
    main = values[counts.argmax()]
    least = int(np.ceil(SIGNATURE_MIN * HASHES))
    for i in left:
        other = right[comp[right] != comp[i]]
        if lo == hi:
            # each pair once: from the side outside the block's largest component, or from the smaller id
            other = other[(comp[other] == main) | (ids[other] > ids[i])] if comp[i] != main else other[:0]
        if not len(other):
            continue
        other = other[(sig[other] == sig[i]).sum(axis=1) >= least]
        if band and len(other):
            other = other[~(bands[other, :band] == bands[i, :band]).any(axis=1)]
        for j in other:
            yield int(i), int(j)


def _open_small(batches):
    for table in grouped(batches, ["key", "lo", "hi"]):
        ids = table.column("id").to_pylist()
        if pairs := [(ids[i], ids[j]) for i, j in _open_pairs(table)]:
            yield _pair_batch(pairs)


def _open_large(percent: int):
    def run(batches):
        for table in grouped(batches, ["key", "lo", "hi"]):
            ids = table.column("id").to_pylist()
            sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
            root = {}

            def find(x, root=root):
                while root.setdefault(x, x) != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            comp = table.column("component").to_pylist()
            pairs = []
            for i, j in _open_pairs(table):
                a, b = find(comp[i]), find(comp[j])
                if a != b and _similar(sets[i], sets[j], percent):  # joined components need no second link
                    root[max(a, b)] = min(a, b)
                    pairs.append((ids[i], ids[j]))
            if pairs:
                yield _pair_batch(pairs)

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    with_sets = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
                 .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b"))
    return with_sets.select("a", "b", "set_a", "set_b").mapInArrow(_exact_filter(percent), "a long, b long")


def _possible(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` may be among those of ``wanted``: all that are, and few others (a bit map of hashes, 16 to
    32 bits a key, is broadcast in blocks). A join that follows deals these, and not every text, by their keys."""
    bits = 1 << max(15, (16 * wanted.count()).bit_length())
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(bits)) + 1  # the bit map functions count from 1
    maps = wanted.select(place.alias("_at")).groupBy(F.expr("bitmap_bucket_number(_at)").alias("_block")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(_at))").alias("_map"))
    spot = "cast(bitmap_bit_position(_at) as int)"
    byte = f"cast(conv(hex(substring(_map, {spot} div 8 + 1, 1)), 16, 10) as int)"
    names = rows.columns
    return (rows.withColumn("_at", place).withColumn("_block", F.expr("bitmap_bucket_number(_at)")).join(F.broadcast(maps), "_block")
            .where(F.expr(f"shiftright({byte}, {spot} % 8) % 2 = 1")).select(*names))


def near_duplicates(docs: DataFrame, words_per_shingle: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs(doc_id, text)``.

    Links documents whose sets of ``words_per_shingle``-word shingles have 100 * intersection >= percent * union
    (the bands are laid out for 80 or more); ``component_id`` is the smallest doc_id reachable.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_part = shuffle_partitions(spark)
    signed_rows = materialise(docs.mapInArrow(
        _signatures(words_per_shingle), "doc_id long, n_shingles long, set_id binary, sig binary"), "signatures")
    nodes = signed_rows.where("set_id is not null and doc_id is not null")

    # one class per distinct set; its node is the smallest doc_id
    classes = materialise(nodes.groupBy("set_id").agg(
        F.min("doc_id").alias("id"), F.min_by("sig", "doc_id").alias("sig")), "classes")

    # buckets with more than one member, each paired with its smallest
    members = classes.select("id", "sig").mapInArrow(_band_rows, "id long, key long")
    buckets = materialise(members.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    members = materialise(members.join(buckets, "key"), "members")
    star = members.where("id != least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    star = materialise(
        star.join(classes.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
        .join(classes.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
        .select("a", "b", "sig_a", "sig_b").mapInArrow(_signature_filter, "a long, b long"), "star")

    # full sets of all that share a bucket, from the whole texts
    wanted = materialise(members.select(F.col("id").alias("doc_id")).distinct(), "wanted")
    sets = materialise(_possible(docs, wanted, "doc_id").join(wanted, "doc_id", "left_semi")
                       .mapInArrow(_full_sets(words_per_shingle), "id long, shingles binary"), "sets")
    links = materialise(_verified(star, sets, percent), "links")
    found = materialise(connected_components(links.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "components")

    # buckets that still hold several components: compare across components only
    placed = materialise(members.join(found.select(F.col("node").alias("id"), "component"), "id", "left")
                         .withColumn("component", F.coalesce("component", "id")), "placed")
    open_keys = materialise(placed.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
                            .where("c0 != c1").select("key"), "open")
    rest = placed.join(open_keys, "key", "left_semi")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rest = (rest.withColumn("side", F.pmod(F.xxhash64("id"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other"))
            .join(classes.select("id", "sig"), "id"))
    small = rest.where(F.col("n") <= SMALL).select("key", "lo", "hi", "side", "id", "component", "sig")
    more = materialise(small.repartition(n_part, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "id")
                       .mapInArrow(_open_small, "a long, b long").distinct(), "more")
    large = (rest.where(F.col("n") > SMALL).join(sets, "id")
             .select("key", "lo", "hi", "side", "id", "component", "sig", "shingles"))
    large = materialise(large.repartition(n_part, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "id")
                        .mapInArrow(_open_large(percent), "a long, b long"), "large")
    # rows that repeat a doc_id with another text are one document: their classes are linked
    same = nodes.select("doc_id", "set_id").join(classes.select("set_id", "id"), "set_id").where("doc_id != id")
    same = materialise(same.select("doc_id", "id").distinct(), "same")
    repeated = same.select(F.col("id").alias("a"), F.col("doc_id").alias("b")).join(
        classes.select(F.col("id").alias("b")), "b", "left_semi")
    every = links.union(_verified(more, sets, percent)).union(large).union(repeated.select("a", "b")).union(shared_classes(same, "doc_id"))
    final = materialise(connected_components(every.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "components")

    of_set = materialise(classes.select("set_id", "id").join(final.withColumnRenamed("node", "id"), "id", "left")
                         .select("set_id", F.coalesce("component", "id").alias("component")), "of_set")
    out = signed_rows.select("doc_id", "n_shingles", "set_id").join(of_set, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, words_per_shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` less those of documents whose group holds a smaller doc_id.

    Rows that share a doc_id are one document and stay or go together.
    """
    out = near_duplicates(docs, words_per_shingle, percent)
    gone = materialise(out.where("not kept").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti")
