"""Rate limit and admission without a device in one task, in whole milliseconds.

``ingest.rate_limit`` and ``ingest.admit`` keep the bucket as the reference does, in doubles, and their rounding runs
on from request to request: a device that never pauses is one ordered fold. Here a level is a whole number of
milliseconds of refill (a token is the interval), so that what a time slice does to it is a small exact function, and
slices can be decided side by side. Results are the same but for that rounding: a request in the very millisecond in
which a token is complete gets it here, and a wait is not a millisecond longer because of it.

Idempotency and the bucket depend on each other, because a 429 releases the batch key. They are folded per (device,
hour) from an assumed entry state; hours whose neighbours leave them another state are folded again until none is.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid import constants as K
from pulsegrid.functions.bucket import slice_entries
from pulsegrid.operators.ingest import outcome_of, retry_after_seconds
from pulsegrid.session import written

FOLD_SLICE_MS = 3_600_000


def _slice_of(arrival_ms: Column) -> Column:
    return F.floor(arrival_ms / F.lit(FOLD_SLICE_MS)).cast("bigint")


def _from_entries(rows: DataFrame, entries: DataFrame, tie: str) -> DataFrame:
    """Rows of every (device, slice) in order (``_ms``, ``tie``), behind one row (``_row`` 0) with the slice's entry."""
    both = rows.withColumn("_row", F.lit(1)).unionByName(
        entries.withColumnRenamed("first_ms", "_ms").withColumn("_row", F.lit(0)), allowMissingColumns=True)
    return both.repartition("device_id", "_slice").sortWithinPartitions("device_id", "_slice", "_row", "_ms", tie)


def _lists(batch: pa.RecordBatch, *names: str):
    return zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _with(batch: pa.RecordBatch, keep: list[bool], names: Sequence[str], made: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = batch.filter(pa.array(keep, pa.bool_()))
    return pa.RecordBatch.from_arrays([*(kept.column(n) for n in names), *made.values()], names=[*names, *made])


def _bucket_fold(interval_ms: int, capacity: int):
    """Decide the requests of each (device, slice) from its entry level, all in whole milliseconds of refill."""
    full = capacity * interval_ms

    def run(batches):
        level, since = full, 0
        for batch in batches:
            keep, after, wait = [], [], []
            for row, now, entry in _lists(batch, "_row", "_ms", "entry"):
                keep.append(row == 1)
                if row == 0:
                    level, since = entry, now
                    continue
                level, since = min(full, level + now - since), now
                wait.append(max(0, interval_ms - level))
                if level >= interval_ms:
                    level -= interval_ms
                after.append(level / interval_ms)
            made = {"allowed": pa.array([w == 0 for w in wait], pa.bool_()), "tokens": pa.array(after, pa.float64()),
                    "retry_after_ms": pa.array(wait, pa.int64())}
            yield _with(batch, keep, ["device_id", "seq", "_ms"], made).rename_columns(
                ["device_id", "seq", "arrival_ms", *made])
    return run


def rate_limit_ms(requests: DataFrame, interval_ms: int = K.RATE_INTERVAL_MS, capacity: int = K.RATE_BURST) -> DataFrame:
    """RTL1/RTL2 over ``(device_id, seq, arrival_ms)`` requests in arrival order (then seq). Output adds allowed, tokens
    (after), retry_after_ms, retry_after_s. Two passes over (device, hour) groups and a walk over one row per device
    and hour."""
    rows = requests.select("device_id", "seq", F.col("arrival_ms").cast("bigint").alias("_ms"), _slice_of(F.col("arrival_ms")).alias("_slice"))
    entries = slice_entries(rows.withColumn("_takes", F.lit(True)), ["device_id"], "seq", interval_ms, capacity)
    types = dict(requests.dtypes)
    out = _from_entries(rows, entries, "seq").mapInArrow(
        _bucket_fold(interval_ms, capacity),
        f"device_id {types['device_id']}, seq {types['seq']}, arrival_ms bigint, allowed boolean, tokens double, retry_after_ms bigint")
    return out.withColumn("retry_after_s", F.when(~F.col("allowed"), retry_after_seconds(F.col("retry_after_ms"))))


_RESERVED = "array<struct<batch_id:string,at:bigint>>"
_EXITS = f"device_id string, _slice bigint, level bigint, since bigint, kept {_RESERVED}"
_KEPT = pa.list_(pa.struct([("batch_id", pa.string()), ("at", pa.int64())]))


def _admission_fold(interval_ms: int, capacity: int, ttl_ms: int, outcomes: Sequence[str] | None):
    """Admission of each (device, slice) from its entry: the level, and the reserved batch ids that come again.

    With ``outcomes`` (columns to keep) the requests' outcomes, else one exit per slice: its last level, and when it
    last accepted each batch id that comes more than once.
    """
    full = capacity * interval_ms

    def run(batches):
        held, level, since, reserved, kept = None, full, 0, {}, {}
        for batch in batches:
            keep, status, wait, ended = [], [], [], []
            for row, device, part, now, bid, again, entry, given in _lists(
                    batch, "_row", "device_id", "_slice", "_ms", "batch_id", "again", "entry", "reserved"):
                keep.append(row == 1)
                if row == 0:
                    if held is not None:
                        ended.append((*held, level, since, list(kept.items())))
                    held, level, since, kept = (device, part), entry, now, {}
                    reserved = {x["batch_id"]: x["at"] for x in given or ()}
                    continue
                at = reserved.get(bid) if again else None
                if at is not None and now - at < ttl_ms:
                    status.append(200)
                    wait.append(None)
                    continue
                level, since = min(full, level + now - since), now
                if level >= interval_ms:
                    level -= interval_ms
                    if again:
                        reserved[bid] = kept[bid] = now
                    status.append(202)
                    wait.append(None)
                else:
                    reserved.pop(bid, None)
                    status.append(429)
                    wait.append(interval_ms - level)
            if outcomes is None:
                yield _exit_rows(ended)
            else:
                yield _with(batch, keep, outcomes, {"status": pa.array(status, pa.int32()), "retry_after_ms": pa.array(wait, pa.int64())})
        if outcomes is None and held is not None:
            yield _exit_rows([(*held, level, since, list(kept.items()))])
    return run


def _exit_rows(ended: list[tuple]) -> pa.RecordBatch:
    device, part, level, since, kept = zip(*ended, strict=True) if ended else ((),) * 5
    kept = [[{"batch_id": b, "at": t} for b, t in k] for k in kept]
    return pa.RecordBatch.from_arrays(
        [pa.array(device, pa.string()), *(pa.array(x, pa.int64()) for x in (part, level, since)), pa.array(kept, _KEPT)],
        names=["device_id", "_slice", "level", "since", "kept"])


def _next_entries(slices: DataFrame, recurring: DataFrame, levels: DataFrame, accepted: DataFrame, full: int, ttl_ms: int) -> DataFrame:
    """What the exits of earlier slices leave to every slice: ``(device_id, _slice, first_ms, entry, reserved)``."""
    here = ["device_id", "_slice"]
    before = F.lag(F.struct("level", "since")).over(Window.partitionBy("device_id").orderBy("_slice"))
    entry = F.when(F.col("_b").isNull(), F.lit(full)).otherwise(F.least(F.lit(full), F.col("_b.level") + F.col("first_ms") - F.col("_b.since")))
    level = slices.join(levels, here).withColumn("_b", before).select(*here, "first_ms", entry.cast("bigint").alias("entry"))
    earlier = Window.partitionBy("device_id", "batch_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    last = (recurring.join(accepted, [*here, "batch_id"], "left").withColumn("at", F.max("at").over(earlier))
            .join(slices, here).where(F.col("first_ms") - F.col("at") < ttl_ms)
            .groupBy(*here).agg(F.array_sort(F.collect_list(F.struct("batch_id", "at"))).alias("reserved")))
    return level.join(last, here, "left").withColumn("reserved", F.coalesce("reserved", F.expr(f"cast(array() as {_RESERVED})")))


def _settled(rows: DataFrame, interval_ms: int, capacity: int, ttl_ms: int) -> DataFrame:
    """The entries of all slices, each left so by the slices before it: ``(device_id, _slice, first_ms, entry, reserved)``.

    First every batch id is assumed to be accepted on its first arrival, and again after the ttl; the bucket's maps
    give the levels that follow. Then slices are folded, and those whose entry is not what the exits before them say
    are folded again. A state that agrees everywhere is the true one, by induction over a device's slices; every
    round settles at least the earliest slice that was not.
    """
    here = ["device_id", "_slice"]
    full = capacity * interval_ms
    first = F.col("first_copy")
    takes = ~F.col("again") | (F.col("_ms") == first) | (F.col("_ms") - first >= ttl_ms)
    guess = rows.withColumn("_takes", takes)
    used = written(slice_entries(guess, ["device_id"], "request_id", interval_ms, capacity), "admission-levels")
    slices = used.select(*here, "first_ms")
    recurring = written(rows.where("again").groupBy(*here, "batch_id").agg(
        F.max(F.when((F.col("_ms") == first) | (F.col("_ms") - first >= ttl_ms), F.col("_ms"))).alias("at")), "admission-recurring")
    wanted = recurring.select(*here, "batch_id")
    as_guessed = recurring.where("at is not null")
    # the guessed levels are entries already; only the reserved ids are looked up
    no_levels = used.select(*here, F.lit(full).alias("level"), F.lit(0).cast("bigint").alias("since"))
    used = written(used.join(_next_entries(slices, wanted, no_levels, as_guessed, full, ttl_ms).select(*here, "reserved"), here), "admission-entries")
    slim = rows.select(*here, "_ms", "request_id", "batch_id", "again")
    fold = _admission_fold(interval_ms, capacity, ttl_ms, None)
    exits = written(_from_entries(slim, used, "request_id").mapInArrow(fold, _EXITS), "admission-exits")
    while True:
        accepted = exits.select(*here, F.inline("kept"))
        now = written(_next_entries(slices, wanted, exits.select(*here, "level", "since"), accepted, full, ttl_ms), "admission-entries")
        old = used.select(*here, F.struct("entry", "reserved").alias("_old"))
        changed = now.join(old, here).where(F.struct("entry", "reserved") != F.col("_old")).drop("_old")
        changed = written(changed, "admission-changed")
        if changed.isEmpty():
            return now
        again = _from_entries(slim.join(changed.select(*here), here, "left_semi"), changed, "request_id").mapInArrow(fold, _EXITS)
        exits = written(exits.join(changed.select(*here), here, "left_anti").unionByName(again), "admission-exits")
        used = now


def admit_ms(requests: DataFrame, interval_ms: int = K.RATE_INTERVAL_MS, capacity: int = K.RATE_BURST,
          ttl_ms: int = K.IDEMPOTENCY_TTL_MS, carry: Sequence[str] = ()) -> DataFrame:
    """ADM1: outcome of every request ``(request_id, arrival_ms, decode_ok, reason, device_id, batch_id, n)``, with the
    columns of ``ingest.admit``. Requests of a device at one time are told apart by request_id."""
    rejected = F.when(~F.col("decode_ok"), F.lit(K.MSG_INVALID_JSON)).otherwise(F.col("reason"))
    n = F.coalesce(F.size("measurements"), F.lit(0)) if "measurements" in requests.columns else F.col("n")
    tagged = written(requests.select("request_id", "device_id", "batch_id", F.col("arrival_ms").cast("bigint").alias("arrival_ms"),
                                     n.cast("int").alias("n"), rejected.alias("error"), *carry), "admission-requests")
    bad = tagged.filter(F.col("error").isNotNull()).select(
        "request_id", "device_id", "batch_id", "arrival_ms", F.lit(400).alias("status"), "error",
        F.lit(None).cast("bigint").alias("retry_after_s"), F.lit(0).cast("bigint").alias("accepted_measurements"),
        *carry)
    good = tagged.filter(F.col("error").isNull()).drop("error").withColumn("_slice", _slice_of(F.col("arrival_ms"))).withColumnRenamed("arrival_ms", "_ms")
    copies = (good.groupBy("device_id", "batch_id").agg(F.count(F.lit(1)).alias("_n"), F.min("_ms").alias("first_copy")).where("_n > 1")
              .select("device_id", "batch_id", "first_copy"))
    rows = written(good.join(copies, ["device_id", "batch_id"], "left").withColumn("again", F.col("first_copy").isNotNull()), "admission-rows")
    entries = _settled(rows, interval_ms, capacity, ttl_ms)
    types = dict(rows.dtypes)
    names = ["request_id", "device_id", "batch_id", "_ms", "n", *carry]
    folded = _from_entries(rows.select(*names, "_slice", "again"), entries, "request_id").mapInArrow(
        _admission_fold(interval_ms, capacity, ttl_ms, names),
        ", ".join(f"`{c}` {types[c]}" for c in names) + ", status int, retry_after_ms bigint")
    decided = folded.select("request_id", "device_id", "batch_id", F.col("_ms").alias("arrival_ms"), "status",
                            F.lit(None).cast("string").alias("error"),
                            F.when(F.col("status") == 429, retry_after_seconds(F.col("retry_after_ms"))).alias("retry_after_s"),
                            F.when(F.col("status") == 202, F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("accepted_measurements"),
                            *carry)
    return decided.unionByName(bad).withColumn("outcome", outcome_of(F.col("status")))
