"""Admission as a stream: every document is decided when it arrives, with the device's state kept between batches.

Documents are decoded and validated as in a batch; rejected ones (400) need no state. The others are keyed by device:
a value state holds the token bucket (level and time of the last request, in doubles as ``ingest.admit`` folds them),
a map state the reserved batch ids with the time of their reservation. In arrival order, a reserved id answers 200 and
leaves the bucket alone; an empty bucket answers 429 and releases the id; else the id is reserved and the answer is
202. A reservation ends 24 h after it by the arrival times, so a replayed backlog gets the answers of live data. What
nobody asks for again leaves the state by wall clock, later than that (``state_ttl_ms``).

Outcomes go to a file sink, exactly once per checkpoint; accepted documents carry their measurements, from which
``accepted_events`` makes the events to publish. A device's documents of one micro-batch are taken together, so the
source's batch limit bounds what a task holds.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pulsegrid import constants as K
from pulsegrid.operators import ingest
from pulsegrid.session import configure
from pulsegrid.streaming.jobs import EMPTY_BATCHES, STATE_STORE

DECIDED = ("request_id string, device_id string, batch_id string, patient_id string, arrival_ms bigint, status int, error string, "
           "retry_after_s bigint, accepted_measurements bigint, measurements string")
MEASUREMENTS = "array<struct<ts:timestamp,heart_rate:int>>"
DOCUMENTS = "request_id string, arrival_ms bigint, body string"


class Admission(StatefulProcessor):
    """Keyed by device_id. Input columns: request_id, batch_id, patient_id, arrival_ms, n, measurements."""

    def __init__(self, interval_ms: int = K.RATE_INTERVAL_MS, capacity: int = K.RATE_BURST, ttl_ms: int = K.IDEMPOTENCY_TTL_MS,
                 state_ttl_ms: int | None = None):
        self.interval_ms, self.capacity, self.ttl_ms = interval_ms, capacity, ttl_ms
        self.state_ttl_ms = 2 * ttl_ms if state_ttl_ms is None else state_ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bucket = handle.getValueState("bucket", "tokens double, refilled_ms long")
        self.reserved = handle.getMapState("reserved", "batch_id string", "at_ms long", self.state_ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["arrival_ms", "request_id"], kind="mergesort", ignore_index=True)
        held = self.bucket.get()
        tokens, refilled = held if held is not None else (float(self.capacity), None)
        known: dict[str, int | None] = {}  # reservations as of this batch; what changed is put back once
        changed: dict[str, int | None] = {}
        status, retry = np.zeros(len(batch), np.int32), [None] * len(batch)
        for i, (bid, now) in enumerate(zip(batch["batch_id"], batch["arrival_ms"].tolist(), strict=True)):
            if bid not in known:
                found = self.reserved.getValue((bid,))
                known[bid] = None if found is None else int(found[0])
            if known[bid] is not None and now - known[bid] < self.ttl_ms:
                status[i] = 200
                continue
            tokens = float(self.capacity) if refilled is None else min(float(self.capacity), tokens + max(0, now - refilled) / float(self.interval_ms))
            refilled = now
            if tokens >= 1:
                tokens -= 1.0
                status[i] = 202
                known[bid] = changed[bid] = now
            else:
                wait = int(math.ceil((1.0 - tokens) * self.interval_ms))
                status[i], retry[i] = 429, max(1, -(-wait // 1000))
                if known[bid] is not None:
                    known[bid] = changed[bid] = None
        for bid, at in changed.items():
            if at is None:
                self.reserved.removeKey((bid,))
            else:
                self.reserved.updateValue((bid,), (at,))
        if refilled is not None:
            self.bucket.update((tokens, int(refilled)))
        accepted = status == 202
        yield pd.DataFrame({
            "request_id": batch["request_id"], "device_id": key[0], "batch_id": batch["batch_id"], "patient_id": batch["patient_id"],
            "arrival_ms": batch["arrival_ms"], "status": status, "error": pd.Series([None] * len(batch), dtype=object),
            "retry_after_s": pd.array(retry, dtype="Int64"), "accepted_measurements": np.where(accepted, batch["n"], 0).astype(np.int64),
            "measurements": batch["measurements"].where(accepted, None)})

    def close(self) -> None:
        pass


def decide(documents: DataFrame, processor: Admission | None = None) -> DataFrame:
    """The outcome of every document of a stream ``(request_id, arrival_ms, body)``, with the columns of DECIDED and
    ``outcome``; ``measurements`` (JSON) only of accepted ones."""
    checked = ingest.process(documents)
    error = F.when(~F.col("decode_ok"), F.lit(K.MSG_INVALID_JSON)).otherwise(F.col("reason"))
    tagged = checked.withColumn("error", error)
    bad = tagged.where(F.col("error").isNotNull()).select(
        "request_id", "device_id", "batch_id", "patient_id", "arrival_ms", F.lit(400).alias("status"), "error",
        F.lit(None).cast("bigint").alias("retry_after_s"), F.lit(0).cast("bigint").alias("accepted_measurements"),
        F.lit(None).cast("string").alias("measurements"))
    good = tagged.where(F.col("error").isNull()).select(
        "request_id", "device_id", "batch_id", "patient_id", "arrival_ms", F.size("measurements").alias("n"),
        F.to_json(F.transform("measurements", lambda m: F.struct(m["ts"].alias("ts"), m["heart_rate"].cast("int").alias("heart_rate")))).alias("measurements"))
    decided = good.groupBy("device_id").transformWithStateInPandas(processor or Admission(), DECIDED, "Append", "ProcessingTime")
    return decided.unionByName(bad).withColumn("outcome", ingest.outcome_of(F.col("status")))


def start_admission(spark: SparkSession, documents: DataFrame, tables_dir: str, checkpoint: str, trigger: dict | None = None,
                    processor: Admission | None = None) -> StreamingQuery:
    """Decide a stream of documents and append the outcomes to ``<tables_dir>/admission``."""
    configure(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    w = (decide(documents, processor).writeStream.format("parquet").option("path", os.path.join(tables_dir, "admission"))
         .option("checkpointLocation", checkpoint))
    before = spark.conf.get(EMPTY_BATCHES)
    spark.conf.set(EMPTY_BATCHES, "false")  # as in jobs.start_alerts: wall-clock expiry asks for empty batches for ever
    try:
        return w.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        spark.conf.set(EMPTY_BATCHES, before)


def documents_from_files(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """File-stream stand-in for the request log: parquet files of (request_id, arrival_ms, body)."""
    return spark.readStream.schema(DOCUMENTS).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def accepted_events(outcomes: DataFrame) -> DataFrame:
    """PRJ11: the events of accepted documents, as ``ingest.explode`` makes them."""
    accepted = outcomes.where(F.col("status") == 202).withColumn("measurements", F.from_json("measurements", MEASUREMENTS))
    return ingest.explode(accepted)
