"""Embedding near-duplicates: random-hyperplane sign hashing in several tables, exact cosine, components.

Equal vectors fold into one class first (a count and the smallest id). Each class gets one key per table: the signs of
its products with the table's hyperplanes. Classes with equal keys in a table meet there; a bucket larger than
``BLOCK`` is cut into blocks by a hash of the id and compared block by block, so no bucket is capped and no task holds
more than two blocks. A pair is compared in the first table where it meets only; tasks emit, per vector, how many
links it has there and the smallest vector of its local group, never the pairs.

The number of signs follows log2 of the rows (about ``PER_BUCKET`` vectors a bucket); the number of tables follows
from the recall that a pair exactly at the threshold is to have: 1 - (1 - p^signs)^tables >= ``RECALL`` with
p = 1 - arccos(threshold) / pi. Links are confirmed by the cosine in double precision; none below it is made.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors
of different lengths do not link; rows that share a vec_id are one for the graph (links counted together, one
component); null vec_id: no links, component null, kept true. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import grouped, materialise, prepare, shuffle_partitions
from pulsegrid.llm.components import connected_components, shared_classes

PER_BUCKET = 50
MIN_SIGNS, MAX_SIGNS = 6, 30
RECALL = 0.9995
BLOCK = 2048


def layout(rows: int, threshold: float, recall: float = RECALL) -> tuple[int, int]:
    """(signs per table, tables) for so many rows."""
    signs = min(MAX_SIGNS, max(MIN_SIGNS, math.ceil(math.log2(max(rows, 1) / PER_BUCKET + 1))))
    same = (1 - math.acos(threshold) / math.pi) ** signs
    return signs, math.ceil(math.log(1 - recall) / math.log(1 - same)) if same < 1 else 1


def vector_bytes(vectors: pa.Array) -> list[bytes | None]:
    """Each valid vector as little-endian doubles, None where it takes no part."""
    out: list[bytes | None] = []
    for x in vectors:
        if not x.is_valid or x.values is None or not len(x.values) or x.values.null_count:
            out.append(None)
            continue
        v = np.asarray(x.values, np.float64)
        out.append((v + 0.0).tobytes() if np.isfinite(v).all() and v.any() else None)  # + 0.0: one form of zero
    return out


def _valid(batches):
    for batch in batches:
        raw = vector_bytes(batch.column("embedding"))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(raw, pa.binary())], names=["vec_id", "vector"])


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, vector)``: the components as little-endian doubles, null where the vector takes no part."""
    return (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .mapInArrow(_valid, "vec_id long, vector binary"))


def _planes(table: int, signs: int, dim: int) -> np.ndarray:
    return np.random.default_rng([977, table, dim]).standard_normal((signs, dim))


def _keys(signs: int, tables: int):
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        bits = 1 << np.arange(signs, dtype=np.int64)
        for batch in batches:
            raw = batch.column("vector").to_pylist()
            keys = np.zeros((len(raw), tables), np.int64)
            dims = np.array([len(x) // 8 for x in raw], np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if dim not in planes:
                    planes[dim] = np.concatenate([_planes(t, signs, int(dim)) for t in range(tables)])
                x = np.frombuffer(b"".join(raw[i] for i in at), np.float64).reshape(len(at), dim)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                keys[at] = ((x @ planes[dim].T > 0).reshape(len(at), tables, signs) * bits).sum(axis=2)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(raw) + 1, dtype=np.int32) * tables), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "keys"])

    return run


def _unit(rows: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


_LINKS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])


def _block_links(threshold: float):
    def links(table: pa.Table):
        key = table.column("table")[0].as_py()
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        side = np.asarray(table.column("side").combine_chunks())
        ids = np.asarray(table.column("id").combine_chunks())
        copies = np.asarray(table.column("copies").combine_chunks())
        raw = table.column("vector").to_pylist()
        keys = np.array(table.column("keys").to_pylist(), np.int64).reshape(len(ids), -1)[:, :key]
        for dim in {len(x) for x in raw}:
            some = np.array([len(x) == dim for x in raw])
            left, right = np.flatnonzero(some & (side == lo)), np.flatnonzero(some & (side == hi))
            if not len(left) or not len(right) or (lo == hi and len(left) < 2):
                continue
            x, y = _unit([raw[i] for i in left]), _unit([raw[i] for i in right])
            near = x @ y.T >= threshold
            if lo == hi:
                near = np.triu(near, 1)
            a, b = np.nonzero(near)
            a, b = left[a], right[b]
            if key and len(a):
                new = np.ones(len(a), bool)
                for t in range(0, len(a), 1 << 16):  # met in an earlier table: counted there
                    new[t:t + (1 << 16)] = ~(keys[a[t:t + (1 << 16)]] == keys[b[t:t + (1 << 16)]]).any(axis=1)
                a, b = a[new], b[new]
            if len(a):
                yield ids, copies, a, b

    def run(batches):
        for table in grouped(batches, ["table", "key", "lo", "hi"]):
            if table.num_rows < 2:
                continue
            for ids, copies, a, b in links(table):
                n = np.bincount(a, weights=copies[b], minlength=len(ids)) + np.bincount(b, weights=copies[a], minlength=len(ids))
                root = np.arange(len(ids))
                while True:  # the least position in each local group
                    low = np.minimum(root[a], root[b])
                    before = root.copy()
                    np.minimum.at(root, a, low)
                    np.minimum.at(root, b, low)
                    root = root[root]
                    if (root == before).all():
                        break
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(n[at].astype(np.int64)), pa.array(ids[root[at]])], schema=_LINKS)

    return run


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95, recall: float = RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``embeddings(vec_id, embedding)``."""
    spark = prepare(embeddings.sparkSession)
    n_part = shuffle_partitions(spark)
    rows = materialise(valid_vectors(embeddings).withColumn("set_id", F.sha2("vector", 256)), "vectors")
    usable = rows.where("vector is not null and vec_id is not null")
    classes = usable.groupBy("set_id").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    classes = materialise(classes, "classes")
    signs, tables = layout(classes.count(), threshold, recall)
    keyed = materialise(classes.select("id", "copies", "vector").mapInArrow(
        _keys(signs, tables), "id long, copies long, vector binary, keys array<long>"), "keys")
    placed = keyed.select("id", F.posexplode("keys").alias("table", "key"))
    counts = materialise(placed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "bucket_sizes")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    met = (keyed.select("*", F.posexplode("keys").alias("table", "key")).join(counts, ["table", "key"])
           .withColumn("side", F.pmod(F.xxhash64("id"), blocks).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
           .withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other"))
           .select("table", "key", "lo", "hi", "side", "id", "copies", "vector", "keys"))
    order = ["table", "key", "lo", "hi"]
    links = materialise(met.repartition(n_part, *order).sortWithinPartitions(*order, "id")
                        .mapInArrow(_block_links(threshold), "id long, n long, root long"), "links")
    linked = links.groupBy("id").agg(F.sum("n").alias("n"))
    edges = links.where("id != root").select(F.col("id").alias("src"), F.col("root").alias("dst")).distinct()
    # rows that share a vec_id share a component
    same = usable.select("vec_id", "set_id").join(classes.select("set_id", "id"), "set_id").where("vec_id != id")
    same = materialise(same.select("vec_id", "id").distinct(), "same")
    own_class = same.join(classes.select(F.col("id").alias("vec_id")), "vec_id", "left_semi")
    edges = edges.union(own_class.select(F.col("id").alias("src"), F.col("vec_id").alias("dst"))).union(shared_classes(same, "vec_id"))
    found = connected_components(edges)
    per_class = materialise(
        classes.select("set_id", "id", "copies").join(linked, "id", "left").join(found.withColumnRenamed("node", "id"), "id", "left")
        .select("set_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "id").alias("component")),
        "per_class")
    out = rows.select("vec_id", "set_id").join(per_class, "set_id", "left")
    own = F.col("vec_id").isNotNull()
    component = F.when(own, F.coalesce("component", "vec_id"))
    return out.select("vec_id", F.when(own, F.coalesce("n", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
