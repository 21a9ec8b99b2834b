"""Helpers shared by the training-data operators: shared storage, Arrow batches, words and hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from pulsegrid.session import configure
from pulsegrid.sources.tables import read_table

__all__ = ["read_table"]

U64 = np.uint64
# Text bytes that one numpy step works on; a longer text is taken alone and whole.
SLICE_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the library, and Arrow batches small enough for rows that hold whole texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, a local master (tests) gets a scratch folder."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="pulsegrid-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/pulsegrid-llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, parts: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors.

    ``parts`` tasks write it, where the caller knows how few rows there are.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    (df.coalesce(parts) if parts else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``df`` written to the shared folder in ``buckets`` by ``key`` and read back: grouping by it shuffles no rows again."""
    spark = df.sparkSession
    table = f"pulsegrid_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).saveAsTable(table, format="parquet", path=shared_path(spark, name))
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")  # the name only: the files stay, and the plan knows them


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- Arrow batches -------------------------------------------------------------------------------------------


def offsets_of(col: pa.Array) -> np.ndarray:
    """Byte offsets (n + 1) of a string or binary array into its data buffer."""
    width = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    return np.frombuffer(col.buffers()[1], width)[col.offset:col.offset + len(col) + 1].astype(np.int64)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` holding about ``limit`` bytes of ``column`` (one longer text stands alone)."""
    n = batch.num_rows
    if not n:
        return
    off = offsets_of(batch.column(column))
    start = 0
    while start < n:
        end = int(np.searchsorted(off, off[start] + limit, side="right")) - 1
        end = min(n, max(start + 1, end))
        yield batch.slice(start, end - start)
        start = end


def texts(col: pa.Array) -> pa.Array:
    """The column with null texts taken as empty."""
    return pc.fill_null(col, "") if col.null_count else col


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal ``keys`` (non-null integers) from a stream sorted by them, whole runs only."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k)) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(int(c[0]) for c in cols)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(int(c[-1]) for c in cols)
    if held:
        yield pa.Table.from_batches(held)


# ---- words and hashes ----------------------------------------------------------------------------------------

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20260707).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_powers: dict[str, np.ndarray] = {}


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > len(_powers.get("up", ())):
        size = max(n, SLICE_BYTES + (1 << 16))
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a bijection)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text of a string array, found and hashed over the whole buffer.

    ``starts`` and ``ends`` are byte offsets into ``data``; the words of text i are ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, col: pa.Array, lower: bool = False):
        col = texts(col)
        off = offsets_of(col)
        buf = col.buffers()[2]
        data = np.frombuffer(buf, np.uint8)[off[0]:off[-1]] if buf is not None else np.zeros(0, np.uint8)
        off = off - off[0]
        self.data = _LOWER[data] if lower else data
        word = ~_SEPARATOR[data]
        begin, end = word.copy(), word.copy()
        begin[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        edge = off[(off > 0) & (off < len(data))]  # a word ends where its text does
        begin[edge] = word[edge]
        end[edge - 1] = word[edge - 1]
        self.offsets = off
        self.starts = np.flatnonzero(begin)
        self.ends = np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.starts, off)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        up, down = _pow(len(self.data) + 1)
        prefix = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * up[:-1], out=prefix[1:])
        return mix((prefix[self.ends] - prefix[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(np.uint64))


_GRAM = np.random.default_rng(77).integers(1, 1 << 63, 64, dtype=np.uint64) | U64(1)


def grams(words: np.ndarray, m: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the sequences of ``m`` word hashes that start at ``at`` (or everywhere)."""
    if at is None:
        at = np.arange(max(0, len(words) - m + 1))
    h = np.zeros(len(at), np.uint64)
    for k in range(m):
        h += words[at + k] * _GRAM[k]
    return mix(h)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
