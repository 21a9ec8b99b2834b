"""Event messages: lenient decode, validation, routing, dead-letter envelopes, lag, and the event sink."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid import constants as K
from pulsegrid.functions import jsonx as J
from pulsegrid.functions.ids import rfc3339_utc

def decode(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """PRJ1: lenient JSON decode of the message value into event columns.

    Adds ``decode_ok`` and event_id, device_id, patient_id (''), ``timestamp_text``, ``timestamp`` (instant),
    heart_rate (bigint, 0 when absent), spo2 (bigint), temperature (double). Fields are NULL when decoding fails.
    A Kafka record time column ``timestamp`` is kept as ``record_timestamp``.
    """
    if "timestamp" in messages.columns:
        messages = messages.withColumnRenamed("timestamp", "record_timestamp")
    text = F.col(value_col).cast("string")
    v = F.col("_v")
    fields = {"event_id": "$.event_id", "device_id": "$.device_id", "patient_id": "$.patient_id",
              "timestamp": "$.timestamp", "heart_rate": "$.heart_rate", "spo2": "$.spo2",
              "temperature": "$.temperature"}
    # one JSON-type lookup per field, kept as columns so the checks below only reference attributes
    kinds = [J.kind(v, path).alias(f"_k_{name}") for name, path in fields.items()]
    k = {name: F.col(f"_k_{name}") for name in fields}
    ts_raw = F.col("_ts_raw")
    ok = (v.isNotNull() & F.col("_single") & J.is_object_or_null(v)
          & J.kind_in(k["event_id"], J.STRING_KINDS) & J.kind_in(k["device_id"], J.STRING_KINDS)
          & J.kind_in(k["patient_id"], J.STRING_KINDS) & J.kind_in(k["heart_rate"], J.INT_KINDS)
          & J.kind_in(k["spo2"], J.INT_KINDS) & J.number_kind(k["temperature"])
          & (J.kind_in(k["timestamp"], J.NULL_KINDS)
             | ((k["timestamp"] == "STRING") & J.rfc3339_text_ok(ts_raw))))
    ts_text = F.when(k["timestamp"] == "STRING", ts_raw)

    def keep(c: Column) -> Column:
        return F.when(F.col("decode_ok"), c)

    parsed, single = J.parse_single(text)
    return (messages.select("*", parsed.alias("_v"), single.alias("_single"))
            .select("*", *kinds,
                    F.try_variant_get(v, "$.timestamp", "string").alias("_ts_raw"))
            .withColumn("decode_ok", F.coalesce(ok, F.lit(False)))
            .select(*messages.columns, "decode_ok",
                    keep(J.string_field(v, "$.event_id")).alias("event_id"),
                    keep(J.string_field(v, "$.device_id")).alias("device_id"),
                    keep(J.string_field(v, "$.patient_id")).alias("patient_id"),
                    keep(ts_text).alias("timestamp_text"),
                    keep(J.parse_timestamp(ts_text)).alias("timestamp"),
                    keep(F.coalesce(F.try_variant_get(v, "$.heart_rate", "bigint"), F.lit(0))).alias("heart_rate"),
                    keep(F.try_variant_get(v, "$.spo2", "bigint")).alias("spo2"),
                    keep(F.try_variant_get(v, "$.temperature", "double")).alias("temperature")))


def validation_reason(event_id: Column, device_id: Column, patient_id: Column, ts_text: Column, ts: Column,
                      heart_rate: Column) -> Column:
    """PRJ3: first failing rule's message, NULL when valid (one CASE chain, rules in order)."""
    return (F.when(event_id == "", F.lit(K.MSG_EVENT_ID_REQUIRED))
            .when(device_id == "", F.lit(K.MSG_DEVICE_ID_REQUIRED))
            .when(patient_id == "", F.lit(K.MSG_PATIENT_ID_REQUIRED))
            .when(J.is_zero_time(ts), F.lit(K.MSG_TIMESTAMP_REQUIRED))
            .when(~J.is_utc_text(ts_text), F.lit(K.MSG_TIMESTAMP_NOT_UTC))
            .when(heart_rate < K.MIN_HEART_RATE, F.lit(K.MSG_HR_TOO_LOW))
            .when(heart_rate > K.MAX_HEART_RATE, F.lit(K.MSG_HR_TOO_HIGH)))


def validate(decoded: DataFrame) -> DataFrame:
    """Adds ``reason`` (validation message, NULL when valid or when decoding already failed).

    After the rules of PRJ3 comes one of the table: an spo2 that its integer column cannot hold. Such a message would
    stop the store query at every retry, so it becomes a dead letter."""
    reason = validation_reason(F.col("event_id"), F.col("device_id"), F.col("patient_id"),
                               F.col("timestamp_text"), F.col("timestamp"), F.col("heart_rate"))
    too_wide = F.col("spo2").isNotNull() & ~F.col("spo2").between(-(1 << 31), (1 << 31) - 1)
    return decoded.withColumn("reason", F.when(F.col("decode_ok"), F.coalesce(reason, F.when(too_wide, F.lit(K.MSG_SPO2_RANGE)))))


def route(validated: DataFrame) -> DataFrame:
    """PRJ5/PRJ6: ``route`` ('store' | 'dlq'), ``dlq_reason`` class ('decode' | 'validation' | NULL) and the
    ``error`` text the dead-letter envelope carries."""
    decode_failed = ~F.col("decode_ok")
    invalid = F.col("reason").isNotNull()
    return validated.select(
        "*",
        F.when(decode_failed | invalid, F.lit("dlq")).otherwise(F.lit("store")).alias("route"),
        F.when(decode_failed, F.lit("decode")).when(invalid, F.lit("validation")).alias("dlq_reason"),
        F.when(decode_failed, F.lit(K.MSG_DECODE + ": invalid JSON"))
        .when(invalid, F.concat(F.lit(K.MSG_INVALID_EVENT + ": validate telemetry event: "), F.col("reason")))
        .alias("error"))


def process(messages: DataFrame) -> DataFrame:
    """decode -> validate -> route, one narrow pass (no shuffle).

    The routed row is re-emitted through a one-element ``inline``: filters on ``route`` (the store / dead-letter
    split) then stay above it instead of being rewritten into the decode expressions, which would evaluate the
    JSON checks a second time inside the predicate and bloat the generated code."""
    routed = route(validate(decode(messages)))
    return routed.select(F.inline(F.array(F.struct(*[F.col(c) for c in routed.columns]))))


def dlq_records(routed: DataFrame, processed_at: dt.datetime | None = None) -> DataFrame:
    """SNK3: dead-letter records: original key, JSON envelope value, four headers.

    Columns: key, value, headers (array<struct<key string, value binary>>), plus the envelope fields.
    """
    at = F.lit(processed_at) if processed_at is not None else F.current_timestamp()
    bad = routed.filter(F.col("route") == "dlq")
    payload = F.base64(F.col("value").cast("binary"))
    env = bad.select(
        "key",
        F.col("error").alias("reason"),
        rfc3339_utc(at).alias("dlq_timestamp"),
        F.col("topic").alias("source_topic"),
        F.col("partition").cast("int").alias("source_partition"),
        F.col("offset").cast("bigint").alias("source_offset"),
        payload.alias("payload_base64"))
    value = F.to_json(F.struct(F.col("reason"), F.col("dlq_timestamp").alias("timestamp"), "source_topic",
                               "source_partition", "source_offset", "payload_base64"))

    def header(k: str, c: Column) -> Column:
        return F.struct(F.lit(k).alias("key"), c.cast("string").cast("binary").alias("value"))

    headers = F.array(header("source_topic", F.col("source_topic")),
                      header("source_partition", F.col("source_partition")),
                      header("source_offset", F.col("source_offset")),
                      header("reason", F.col("reason")))
    return env.select("*", value.alias("value"), headers.alias("headers"))


def consumer_lag(messages: DataFrame) -> DataFrame:
    """AGG10: lag per (topic, partition) from the last fetched message: ``max(hwm - offset - 1, 0)``;
    messages without a high watermark are ignored. Partial aggregate (``max_by``) before the shuffle."""
    lag = F.greatest(F.col("high_watermark") - F.col("offset") - 1, F.lit(0))
    return (messages.filter(F.col("high_watermark") > 0)
            .groupBy("topic", "partition")
            .agg(F.max_by(lag, F.col("offset")).cast("bigint").alias("lag")))


def event_messages(events: DataFrame, topic: str = K.RAW_TOPIC) -> DataFrame:
    """SNK1: Kafka records for events: key = patient_id, value = event JSON (RFC 3339 UTC timestamp),
    ``timestamp`` = event time. Ready for ``write.format("kafka")``."""
    value = F.to_json(F.struct("event_id", "device_id", "patient_id",
                               rfc3339_utc(F.col("timestamp")).alias("timestamp"), "heart_rate"))
    return events.select(F.col("patient_id").alias("key"), value.alias("value"), F.lit(topic).alias("topic"),
                         F.col("timestamp"))
