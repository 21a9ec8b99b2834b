"""Batch documents: packing, strict decode, validation, explode to events, admission control.

Admission per request, in order: invalid JSON -> 400, invalid batch -> 400, repeated (device, batch) within
24 h -> 200 ``duplicate_ignored``, token bucket empty -> 429 (and the batch key is released, so a retry is not
a duplicate), else 202. Because a 429 releases the key, idempotency and the bucket are one ordered fold per
device; it runs per (device, segment), where a segment starts after a pause long enough to reset both, as one
sorted streaming pass over partitions (``pulsegrid.functions.fold``).
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid import constants as K
from pulsegrid.functions import jsonx as J
from pulsegrid.functions.fold import group_starts, sorted_fold
from pulsegrid.functions.greedy import spaced
from pulsegrid.functions.ids import event_id_of, rfc3339_utc
from pulsegrid.functions.sliced import segment_by_gap

BATCH_SCHEMA = ("struct<device_id:string,patient_id:string,batch_id:string,"
                "measurements:array<struct<timestamp:string,heart_rate:bigint>>>")
TOP_KEYS = ["device_id", "patient_id", "batch_id", "measurements"]
MEASUREMENT_KEYS = ["timestamp", "heart_rate"]
FOLD_SLICE_MS = 86_400_000


# --- packing and documents -------------------------------------------------------------------

def pack_batches(readings: DataFrame, run_id: str, max_per_batch: int = K.MAX_MEASUREMENTS,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """PRJ12: consecutive readings of a device (ordered by ``seq``, 1-based) packed into batches of at most
    ``max_per_batch``; ``batch_id = <device>-<run>-<chunk:09d>``. Groups are (device, chunk): at most
    ``max_per_batch`` rows each. Output: device_id, patient_id, batch_id, chunk, measurements
    (array<struct<seq, ts, heart_rate>> in order)."""
    chunk = F.floor((F.col("seq") - 1) / max_per_batch).cast("bigint")
    grouped = (readings.withColumn("chunk", chunk)
               .groupBy("device_id", "chunk")
               .agg(F.first("patient_id").alias("patient_id"), *[F.first(c).alias(c) for c in carry],
                    F.array_sort(F.collect_list(F.struct("seq", "ts", "heart_rate"))).alias("measurements")))
    return grouped.select("device_id", "patient_id", *carry,
                          F.format_string("%s-%s-%09d", F.col("device_id"), F.lit(run_id), F.col("chunk"))
                          .alias("batch_id"),
                          "chunk", "measurements")


def batch_document(device_id: Column, patient_id: Column, batch_id: Column, measurements: Column) -> Column:
    """JSON text of a batch document (timestamps as RFC 3339 UTC)."""
    ms = F.transform(measurements, lambda m: F.named_struct(F.lit("timestamp"), rfc3339_utc(m["ts"]),
                                                            F.lit("heart_rate"), m["heart_rate"]))
    return F.to_json(F.named_struct(F.lit("device_id"), device_id, F.lit("patient_id"), patient_id,
                                    F.lit("batch_id"), batch_id, F.lit("measurements"), ms))


# --- decode and validate ---------------------------------------------------------------------

def decode_strict(docs: DataFrame, body_col: str = "body") -> DataFrame:
    """PRJ2: strict decode. ``decode_ok`` is false (-> ``invalid JSON body``) for malformed or trailing data,
    a non-object document, an unknown field at either level, or a wrongly typed field. Decoded columns:
    device_id, patient_id, batch_id (''), measurements (array<struct<timestamp string, heart_rate bigint,
    ts timestamp>>)."""
    text = F.col(body_col).cast("string")
    v = F.col("_v")
    elems = F.try_variant_get(v, "$.measurements", "array<variant>")

    def elem_ok(e: Column) -> Column:
        ek = F.schema_of_variant(e)
        tk = F.schema_of_variant(F.try_variant_get(e, "$.timestamp", "variant"))
        hk = F.schema_of_variant(F.try_variant_get(e, "$.heart_rate", "variant"))
        ts_raw = F.try_variant_get(e, "$.timestamp", "string")
        shape = ek.startswith("OBJECT") & J.keys_within(F.to_json(e), MEASUREMENT_KEYS)
        ts_good = J.kind_in(tk, J.NULL_KINDS) | ((tk == "STRING") & J.rfc3339_text_ok(ts_raw))
        return F.coalesce(shape & ts_good & J.kind_in(hk, J.INT_KINDS), F.lit(False)) | (ek == "VOID")

    mk = F.col("_k_measurements")
    ok = (v.isNotNull() & F.col("_single") & J.is_object_or_null(v)
          & F.coalesce(J.keys_within(F.when(F.schema_of_variant(v).startswith("OBJECT"), text), TOP_KEYS),
                       F.lit(True))
          & J.kind_in(F.col("_k_device_id"), J.STRING_KINDS) & J.kind_in(F.col("_k_patient_id"), J.STRING_KINDS)
          & J.kind_in(F.col("_k_batch_id"), J.STRING_KINDS)
          & (J.kind_in(mk, J.NULL_KINDS) | (mk.startswith("ARRAY") & F.forall(elems, elem_ok))))
    parsed = F.from_json(text, BATCH_SCHEMA)
    ms = F.transform(parsed["measurements"],
                     lambda m: F.named_struct(F.lit("timestamp"), m["timestamp"],
                                              F.lit("heart_rate"), F.coalesce(m["heart_rate"], F.lit(0)),
                                              F.lit("ts"), J.parse_timestamp(m["timestamp"])))
    ms = F.coalesce(ms, F.array().cast("array<struct<timestamp:string,heart_rate:bigint,ts:timestamp>>"))

    def keep(c: Column) -> Column:
        return F.when(F.col("decode_ok"), c)

    value, single = J.parse_single(text)
    out = (docs.select("*", value.alias("_v"), single.alias("_single"))
           .select("*", *[J.kind(v, f"$.{f}").alias(f"_k_{f}") for f in TOP_KEYS])
           .withColumn("decode_ok", F.coalesce(ok, F.lit(False))))
    return out.select(*docs.columns, "decode_ok",
                      keep(F.coalesce(parsed["device_id"], F.lit(""))).alias("device_id"),
                      keep(F.coalesce(parsed["patient_id"], F.lit(""))).alias("patient_id"),
                      keep(F.coalesce(parsed["batch_id"], F.lit(""))).alias("batch_id"),
                      keep(ms).alias("measurements"))


def batch_reason(device_id: Column, patient_id: Column, batch_id: Column, measurements: Column) -> Column:
    """PRJ4/WIN4: first failing rule's message, NULL when valid. Measurements are checked in order, each with
    timestamp present, hr >= 20, hr <= 250, timestamp strictly after the previous one."""
    n = F.size(measurements)
    idx = F.sequence(F.lit(0), n - 1)

    def rule(i: Column) -> Column:
        m = F.element_at(measurements, i + 1)
        prev = F.element_at(measurements, F.greatest(i, F.lit(1)))
        return (F.when(J.is_zero_time(m["ts"]), F.lit(K.MSG_MEASUREMENT_TS_REQUIRED))
                .when(m["heart_rate"] < K.MIN_HEART_RATE, F.lit(K.MSG_HR_TOO_LOW))
                .when(m["heart_rate"] > K.MAX_HEART_RATE, F.lit(K.MSG_HR_TOO_HIGH))
                .when((i > 0) & (m["ts"] <= prev["ts"]), F.lit(K.MSG_TS_OUT_OF_ORDER)))

    per_item = F.when(n >= 1, F.try_element_at(F.filter(F.transform(idx, rule), lambda r: r.isNotNull()), F.lit(1)))
    return (F.when(device_id == "", F.lit(K.MSG_DEVICE_ID_REQUIRED))
            .when(patient_id == "", F.lit(K.MSG_PATIENT_ID_REQUIRED))
            .when(batch_id == "", F.lit(K.MSG_BATCH_ID_REQUIRED))
            .when((n < K.MIN_MEASUREMENTS) | (n > K.MAX_MEASUREMENTS), F.lit(K.MSG_MEASUREMENTS_LENGTH))
            .otherwise(per_item))


def validate(decoded: DataFrame) -> DataFrame:
    """Adds ``reason`` for decoded documents (NULL when valid or when decoding failed)."""
    reason = batch_reason(F.col("device_id"), F.col("patient_id"), F.col("batch_id"), F.col("measurements"))
    return decoded.withColumn("reason", F.when(F.col("decode_ok"), reason))


def process(docs: DataFrame, body_col: str = "body") -> DataFrame:
    """decode_strict -> validate in one narrow pass; re-emitted through a one-element ``inline`` so that later
    filters on the outcome stay above the JSON checks instead of being rewritten into them."""
    checked = validate(decode_strict(docs, body_col))
    return checked.select(F.inline(F.array(F.struct(*[F.col(c) for c in checked.columns]))))


def explode(batches: DataFrame) -> DataFrame:
    """PRJ11: one event per measurement, ``event_id = <batch_id>-<index>`` (0-based)."""
    return (batches.select("device_id", "patient_id", "batch_id", F.posexplode("measurements").alias("i", "m"))
            .select(event_id_of(F.col("batch_id"), F.col("i")).alias("event_id"), "device_id", "patient_id",
                    F.col("m.ts").alias("timestamp"), F.col("m.heart_rate").cast("int").alias("heart_rate")))


def first_seen(requests: DataFrame, ttl_ms: int = K.IDEMPOTENCY_TTL_MS) -> DataFrame:
    """DED1 in isolation: a copy of a (device, batch) is first seen when the key is not reserved, that is for the
    first copy in arrival order and for the first one ``ttl`` or more after the copy that reserved it last.
    Copies of one key that arrive together are told apart by request_id (unique), the smallest comes first."""
    cols = ["device_id", "batch_id", "arrival_ms", "request_id"]
    kept = spaced(requests.select(*cols), ["device_id", "batch_id"], "arrival_ms", "request_id", ttl_ms, ttl_ms)
    return (requests.join(kept.withColumn("first_seen", F.lit(True)), cols, "left")
            .select(*requests.columns, F.coalesce("first_seen", F.lit(False)).alias("first_seen")))


# --- ordered folds -----------------------------------------------------------------------------

def _bucket_step(tokens: float, refilled: float | None, now: int, interval_ms: int, capacity: float):
    if refilled is None:
        tokens = float(capacity)
    else:
        tokens = min(float(capacity), tokens + max(0, now - refilled) / float(interval_ms))
    if tokens >= 1:
        return tokens - 1.0, now, True, 0
    return tokens, now, False, int(math.ceil((1.0 - tokens) * interval_ms))


def _bucket_fold(interval_ms: int, capacity: int):
    """Streaming token bucket over partitions sorted by (device_id, segment, arrival_ms, seq)."""
    def run(batches):
        carry, tokens, refilled = None, float(capacity), None
        for pdf in batches:
            dev, seg = pdf["device_id"].to_numpy(), pdf["segment"].to_numpy()
            now_ms = pdf["arrival_ms"].to_numpy()
            starts = group_starts([dev, seg], carry)
            allowed = np.zeros(len(pdf), dtype=bool)
            after = np.zeros(len(pdf))
            retry = np.zeros(len(pdf), dtype=np.int64)
            for i in range(len(pdf)):
                if starts[i]:
                    tokens, refilled = float(capacity), None
                tokens, refilled, ok, wait = _bucket_step(tokens, refilled, int(now_ms[i]), interval_ms, capacity)
                allowed[i], after[i], retry[i] = ok, tokens, wait
            if len(pdf):
                carry = (dev[-1], seg[-1])
            yield pd.DataFrame({"device_id": dev, "seq": pdf["seq"].to_numpy(), "arrival_ms": now_ms,
                                "allowed": allowed, "tokens": after, "retry_after_ms": retry})
    return run


def outcome_of(status: Column) -> Column:
    """The word for a status."""
    return (F.when(status == 202, F.lit("accepted"))
            .when(status == 200, F.lit("duplicate_ignored"))
            .when(status == 429, F.lit("rate_limit_exceeded"))
            .otherwise(F.lit("invalid_batch")))


def retry_after_seconds(ms: Column) -> Column:
    """RTL2: whole seconds rounded up, at least 1."""
    return F.greatest(F.ceil(ms / F.lit(1000)), F.lit(1)).cast("bigint")


def rate_limit(requests: DataFrame, interval_ms: int = K.RATE_INTERVAL_MS, capacity: int = K.RATE_BURST) -> DataFrame:
    """RTL1/RTL2: token bucket per device over ``(device_id, seq, arrival_ms)`` requests in arrival order.
    Starts full; refills ``elapsed / interval`` (negative elapsed counts as 0) up to ``capacity``; a request
    takes one token if at least one is there. A pause of ``capacity x interval`` refills completely, so the
    fold runs per (device, segment). Output adds allowed, tokens (after), retry_after_ms, retry_after_s."""
    base = requests.select("device_id", "seq", "arrival_ms",
                           F.floor(F.col("arrival_ms") / FOLD_SLICE_MS).cast("bigint").alias("_slice"))
    seg = segment_by_gap(base, ["device_id"], ["arrival_ms", "seq"], "_slice", "arrival_ms", capacity * interval_ms)
    out = sorted_fold(seg.select("device_id", "segment", "seq", "arrival_ms"), ["device_id", "segment"],
                      ["arrival_ms", "seq"], _bucket_fold(interval_ms, capacity),
                      "device_id string, seq bigint, arrival_ms bigint, allowed boolean, tokens double, "
                      "retry_after_ms bigint")
    return out.withColumn("retry_after_s", F.when(~F.col("allowed"), retry_after_seconds(F.col("retry_after_ms"))))


def _admission_fold(interval_ms: int, capacity: int, ttl_ms: int, carried: Sequence[str]):
    """Streaming admission over partitions sorted by (device_id, segment, arrival_ms, request_id): state is the
    bucket and the batch keys reserved in this segment."""
    def run(batches):
        carry, tokens, refilled, reserved, expiry = None, float(capacity), None, {}, deque()
        for pdf in batches:
            dev, seg = pdf["device_id"].to_numpy(), pdf["segment"].to_numpy()
            bids, now_ms = pdf["batch_id"].to_numpy(), pdf["arrival_ms"].to_numpy()
            starts = group_starts([dev, seg], carry)
            status = np.zeros(len(pdf), dtype=np.int32)
            retry = np.full(len(pdf), -1, dtype=np.int64)
            for i in range(len(pdf)):
                if starts[i]:
                    tokens, refilled, reserved, expiry = float(capacity), None, {}, deque()
                now, bid = int(now_ms[i]), bids[i]
                while expiry and now - expiry[0][0] >= ttl_ms:  # forget keys past their TTL, oldest first
                    then, old = expiry.popleft()
                    if reserved.get(old) == then:
                        del reserved[old]
                at = reserved.get(bid)
                if at is not None and now - at < ttl_ms:
                    status[i] = 200
                    continue
                tokens, refilled, ok, wait = _bucket_step(tokens, refilled, now, interval_ms, capacity)
                if ok:
                    reserved[bid] = now
                    expiry.append((now, bid))
                    status[i] = 202
                else:
                    reserved.pop(bid, None)
                    status[i] = 429
                    retry[i] = wait
            if len(pdf):
                carry = (dev[-1], seg[-1])
            out = pdf[["request_id", "device_id", "batch_id", "arrival_ms", "n", *carried]].copy()
            out["status"] = status
            out["retry_after_ms"] = np.where(retry >= 0, retry, 0)
            out["limited"] = retry >= 0
            yield out
    return run


def admit(requests: DataFrame, interval_ms: int = K.RATE_INTERVAL_MS, capacity: int = K.RATE_BURST,
          ttl_ms: int = K.IDEMPOTENCY_TTL_MS, carry: Sequence[str] = ()) -> DataFrame:
    """ADM1: outcome of every request ``(request_id, arrival_ms, decode_ok, reason, device_id, batch_id, n)``.

    Rejected documents (400) never touch state and are decided row-wise; the rest are folded per
    (device, segment), a segment starting after a pause of at least the idempotency TTL (which also refills
    the bucket). Output: request_id, device_id, batch_id, arrival_ms, status (202/200/429/400), outcome, error,
    retry_after_s, accepted_measurements, and the columns in ``carry`` as they came (so that nobody has to join the
    outcomes back to the documents).
    """
    rejected = F.when(~F.col("decode_ok"), F.lit(K.MSG_INVALID_JSON)).otherwise(F.col("reason"))
    n = F.coalesce(F.size("measurements"), F.lit(0)) if "measurements" in requests.columns else F.col("n")
    tagged = requests.select("request_id", "device_id", "batch_id", "arrival_ms", n.cast("int").alias("n"),
                             rejected.alias("error"), *carry)
    bad = tagged.filter(F.col("error").isNotNull()).select(
        "request_id", "device_id", "batch_id", "arrival_ms", F.lit(400).alias("status"), "error",
        F.lit(None).cast("bigint").alias("retry_after_s"), F.lit(0).cast("bigint").alias("accepted_measurements"),
        *carry)
    good = tagged.filter(F.col("error").isNull())
    base = good.select("request_id", "device_id", "batch_id", "arrival_ms", "n", *carry,
                       F.floor(F.col("arrival_ms") / FOLD_SLICE_MS).cast("bigint").alias("_slice"))
    seg = segment_by_gap(base, ["device_id"], ["arrival_ms", "request_id"], "_slice", "arrival_ms", ttl_ms)
    types = dict(requests.dtypes)
    folded = sorted_fold(seg.drop("_slice"), ["device_id", "segment"], ["arrival_ms", "request_id"],
                         _admission_fold(interval_ms, capacity, ttl_ms, carry),
                         "request_id string, device_id string, batch_id string, arrival_ms bigint, n int, "
                         "status int, retry_after_ms bigint, limited boolean"
                         + "".join(f", `{c}` {types[c]}" for c in carry))
    decided = (folded
               .select("request_id", "device_id", "batch_id", "arrival_ms", "status",
                       F.lit(None).cast("string").alias("error"),
                       F.when(F.col("limited"), retry_after_seconds(F.col("retry_after_ms"))).alias("retry_after_s"),
                       F.when(F.col("status") == 202, F.col("n")).otherwise(F.lit(0)).cast("bigint")
                       .alias("accepted_measurements"), *carry))
    return decided.unionByName(bad).withColumn("outcome", outcome_of(F.col("status")))
