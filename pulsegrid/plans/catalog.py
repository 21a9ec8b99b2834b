"""The named queries: each takes (spark, sf_dir) and returns a DataFrame over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid import constants as K
from pulsegrid.functions.ids import event_id_of
from pulsegrid.operators import admission, alerts, detect, events, ingest, metrics, reconcile, scraped, store
from pulsegrid.sources import fixtures, readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


# --- detection ---------------------------------------------------------------------------------

def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the detector's window holds: every reading once, as it was delivered last."""
    return detect.latest_readings(fixtures.deliveries(spark, sf_dir))


def _detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.detect_sustained(_readings(spark, sf_dir))


@query
def detect_sustained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _detections(spark, sf_dir)


# --- fixed values: query parameters ------------------------------------------------------------
LIST_TELEMETRY_FILTER = store.ListFilter(from_="2026-07-07T12:01:00Z", to="2026-07-07T12:05:00Z", limit=1000)
LIST_ALERTS_FILTER = store.ListFilter()
RANGE_TELEMETRY_FILTER = store.ListFilter(from_="2026-07-07T12:01:00Z", to="2026-07-07T12:02:00Z")
RANGE_ALERTS_FILTER = store.ListFilter(from_="2026-07-07T12:05:00Z", to="2026-07-07T12:15:00Z")
RETENTION_NOW = dt.datetime(2026, 7, 8, tzinfo=dt.timezone.utc)


def _partial_alerts(det: DataFrame) -> DataFrame:
    """Alerts table of an earlier run whose writes for every 4th bucket were lost."""
    t = alerts.alerts_table(det)
    return t.filter(alerts.alert_bucket(F.col("detected_at")) % 4 != 0)


@query
def alert_dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.with_dedup_key(_detections(spark, sf_dir)).select("event_id", "dedup_key")


@query
def alerts_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.bucketed(_detections(spark, sf_dir))


@query
def alerts_cooldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.cooldown(_detections(spark, sf_dir))


@query
def alerts_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = _detections(spark, sf_dir)
    return alerts.recovered(alerts.cooldown(det), _partial_alerts(det))


@query
def alerts_backfill_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = alerts.alerts_table(_detections(spark, sf_dir))
    legacy = t.withColumn("dedup_key", F.when(alerts.alert_bucket(F.col("detected_at")) % 2 == 1, F.lit(None))
                          .otherwise(F.col("dedup_key")))
    return alerts.backfill_key(legacy)


@query
def alerts_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = _detections(spark, sf_dir)
    incoming = alerts.with_dedup_key(det).select("dedup_key", "patient_id", "alert_type",
                                                 F.col("triggered_at").alias("detected_at"), "event_id")
    return alerts.insert_if_absent(incoming, _partial_alerts(det), "dedup_key", ["detected_at", "event_id"])


@query
def list_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = alerts.list_view(alerts.alerts_table(_detections(spark, sf_dir)))
    return store.list_rows(view, LIST_ALERTS_FILTER, "triggered_at", "dedup_key")


@query
def filter_alerts_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = alerts.list_view(alerts.alerts_table(_detections(spark, sf_dir)))
    return store.filter_range(view, RANGE_ALERTS_FILTER, "triggered_at")


@query
def recent_alert_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    det = _detections(spark, sf_dir)
    return alerts.recent_alert_semi(det, alerts.alerts_table(det))


# --- telemetry table ------------------------------------------------------------------------------

@query
def list_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.list_telemetry(fixtures.telemetry_table(spark, sf_dir), LIST_TELEMETRY_FILTER)


@query
def filter_telemetry_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = fixtures.telemetry_table(spark, sf_dir).select(*store.TELEMETRY_COLUMNS)
    return store.filter_range(t, RANGE_TELEMETRY_FILTER, "timestamp")


@query
def telemetry_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-if-absent of a redelivering stream into a table that already holds each patient's first 20
    readings; redeliveries (``src_event_id % 89 = 0``) arrive 1 s later with a changed reading."""
    t = fixtures.telemetry_table(spark, sf_dir)
    cols = ["event_id", "device_id", "patient_id", "timestamp", "heart_rate"]
    fresh = t.select(*cols, F.unix_millis("timestamp").alias("arrival"))
    again = (t.filter(F.col("src_event_id") % 89 == 0)
             .select("event_id", "device_id", "patient_id", "timestamp", (F.col("heart_rate") + 1).alias("heart_rate"),
                     (F.unix_millis("timestamp") + 1000).alias("arrival")))
    target = t.filter(F.col("seq") <= 20)
    return store.store_telemetry(fresh.unionByName(again), target).drop("arrival")


@query
def retention_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, _ = store.retention_split(fixtures.telemetry_table(spark, sf_dir), RETENTION_NOW)
    return kept.select("event_id", "created_at")


@query
def retention_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, t_drop = store.retention_split(fixtures.telemetry_table(spark, sf_dir), RETENTION_NOW)
    _, a_drop = store.retention_split(alerts.alerts_table(_detections(spark, sf_dir)), RETENTION_NOW)
    counts = (t_drop.select(F.lit("telemetry").alias("table_name"))
              .unionByName(a_drop.select(F.lit("alerts").alias("table_name"))))
    names = spark.createDataFrame([("telemetry",), ("alerts",)], "table_name string")
    return (names.join(counts.groupBy("table_name").agg(F.count(F.lit(1)).alias("dropped")), "table_name", "left")
            .select("table_name", F.coalesce("dropped", F.lit(0)).cast("bigint").alias("dropped")))


# --- event messages: decode / validate / route / dead letters ----------------------------------------
DLQ_PROCESSED_AT = dt.datetime(2026, 7, 8, tzinfo=dt.timezone.utc)


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.process(fixtures.raw_messages(spark, sf_dir))


@query
def decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = events.decode(fixtures.raw_messages(spark, sf_dir))
    return d.select("topic", "partition", "offset", "decode_ok", "event_id", "device_id", "patient_id", "timestamp",
                    "heart_rate")


@query
def validate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.validate(events.decode(fixtures.raw_messages(spark, sf_dir))).select("offset", "decode_ok", "reason")


@query
def route_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_processed(spark, sf_dir).groupBy("route", "dlq_reason")
            .agg(F.count(F.lit(1)).alias("messages")))


@query
def dlq_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = events.dlq_records(_processed(spark, sf_dir), DLQ_PROCESSED_AT)
    return rec.select("key", "reason", "source_topic", "source_partition", "source_offset", "payload_base64", "value")


@query
def dlq_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_processed(spark, sf_dir).filter(F.col("route") == "dlq")
            .groupBy(F.col("dlq_reason").alias("reason")).agg(F.count(F.lit(1)).alias("messages")))


@query
def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.consumer_lag(fixtures.raw_messages(spark, sf_dir))


@query
def snk_event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = fixtures.telemetry(spark, sf_dir).withColumnRenamed("ts", "timestamp")
    return events.event_messages(v).select("key", "value", "topic")


# --- sliding window -------------------------------------------------------------------------------

@query
def window_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = detect.window_stats(_readings(spark, sf_dir))
    return w.select("event_id", "patient_id", "ts", "window_events")


@query
def window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = detect.window_stats(_readings(spark, sf_dir))
    return w.drop("window_first_ts")


@query
def window_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JON1: window index entries whose payload is missing from the store (lost writes: src_event_id % 97 = 0)."""
    t = fixtures.telemetry_table(spark, sf_dir)
    index = fixtures.telemetry(spark, sf_dir).select("patient_id", "event_id")
    payloads = t.filter(F.col("src_event_id") % 97 != 0).select("event_id", F.lit(True).alias("_has"))
    return (index.join(payloads, "event_id", "left")
            .groupBy("patient_id")
            .agg(F.count(F.lit(1)).alias("indexed"), F.count_if(F.col("_has").isNull()).alias("missing")))


# --- ingestion: documents, admission -----------------------------------------------------------------
BATCH_BASE_EPOCH_MS = fixtures.GRID_BASE_EPOCH * 1000


def _checked_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded and validated documents."""
    return ingest.process(fixtures.batch_requests(spark, sf_dir)).drop("body")


def _admitted(spark: SparkSession, sf_dir: str, *carry: str) -> DataFrame:
    """Admission outcomes with columns of the documents carried along; ``sent`` is what the sender packed."""
    return ingest.admit(_checked_docs(spark, sf_dir).withColumnRenamed("n", "sent"), carry=carry)


@query
def pack_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = ingest.pack_batches(fixtures.telemetry(spark, sf_dir), fixtures.BATCH_RUN_ID)
    ms = F.col("measurements")
    return packed.select("batch_id", "device_id", "patient_id", F.size(ms).alias("n_measurements"),
                         F.element_at(ms, 1)["ts"].alias("first_ts"), F.element_at(ms, -1)["ts"].alias("last_ts"),
                         F.array_join(F.transform(ms, lambda m: m["heart_rate"].cast("string")), ",").alias("hr_list"))


@query
def src_batches_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = readers.parse_batches(fixtures.batch_requests(spark, sf_dir))
    ms = F.col("measurements")
    return docs.select("request_id", "device_id", "patient_id", "batch_id", F.size(ms).alias("n_measurements"),
                       F.element_at(ms, 1)["timestamp"].alias("first_ts"),
                       F.element_at(ms, -1)["timestamp"].alias("last_ts"),
                       F.array_join(F.transform(ms, lambda m: m["heart_rate"].cast("string")), ",").alias("hr_list"))


@query
def decode_batches_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = ingest.decode_strict(fixtures.batch_requests(spark, sf_dir))
    return d.select("request_id", "decode_ok",
                    F.when(~F.col("decode_ok"), F.lit(K.MSG_INVALID_JSON)).alias("error"))


@query
def validate_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_docs(spark, sf_dir).select("request_id", "decode_ok", "reason")


@query
def validate_odd_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the strict decode and of the batch validation, one class of documents each."""
    return ingest.process(fixtures.odd_batches(spark, sf_dir)).select("request_id", "decode_ok", "reason", F.size("measurements").alias("n"))


@query
def explode_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of every valid document, of repeated ones as often as they came (a batch id makes the same event ids)."""
    return ingest.explode(_checked_docs(spark, sf_dir).filter(F.col("decode_ok") & F.col("reason").isNull()))


@query
def batch_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _checked_docs(spark, sf_dir).filter(F.col("decode_ok") & F.col("reason").isNull())
    return ingest.first_seen(docs.select("request_id", "device_id", "batch_id", "copy", "arrival_ms"))


@query
def rate_limit_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ingest.rate_limit(fixtures.rate_requests(spark, sf_dir))
    return out.withColumn("tokens", F.round("tokens", 6))


@query
def rate_limit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ingest.rate_limit(fixtures.rate_requests(spark, sf_dir))
    return out.groupBy("device_id").agg(F.count(F.lit(1)).alias("requests"),
                                        F.count_if(F.col("allowed")).alias("allowed"),
                                        F.count_if(~F.col("allowed")).alias("limited"))


@query
def admission_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _admitted(spark, sf_dir)


@query
def admission_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_admitted(spark, sf_dir).groupBy("status", "outcome")
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.sum("accepted_measurements").cast("bigint").alias("accepted_measurements")))


@query
def rate_limit_by_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token bucket in whole milliseconds, composed over hours."""
    out = admission.rate_limit_ms(fixtures.rate_requests(spark, sf_dir))
    return out.withColumn("tokens", F.round("tokens", 6))


@query
def admission_by_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Admission in whole milliseconds, hours folded side by side."""
    return admission.admit_ms(_checked_docs(spark, sf_dir).withColumnRenamed("n", "sent"))


# --- accepted log, reconciliation, run summary ---------------------------------------------------------

@query
def accepted_batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = reconcile.accepted_log(_admitted(spark, sf_dir, "patient_id"), BATCH_BASE_EPOCH_MS)
    return log.withColumn("event_ids", F.to_json("event_ids"))


@query
def reconcile_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted events against stored telemetry. Stored are the events of 202 batches and of 429 batches (published
    before the rejection), minus lost rows (index 3 of chunks % 5 = 0), plus a second copy of index 7 of chunks
    % 6 = 0. Both sides come from one admission, so they are tagged in one pass."""
    adm = _admitted(spark, sf_dir, "sent", "chunk").filter(F.col("status").isin(202, 429))
    ev = adm.select("batch_id", "chunk", (F.col("status") == 202).alias("accepted"),
                    F.explode(F.sequence(F.lit(0), F.col("sent") - 1)).alias("i"))
    copies = (F.when((F.col("i") == 3) & (F.col("chunk") % 5 == 0), 0)
              .when((F.col("i") == 7) & (F.col("chunk") % 6 == 0), 2).otherwise(1))
    return reconcile.compare(ev.select(event_id_of(F.col("batch_id"), F.col("i")).alias("event_id"), "accepted",
                                       copies.cast("bigint").alias("copies")))


@query
def reconcile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (reconcile_events(spark, sf_dir).groupBy("status")
            .agg(F.count(F.lit(1)).alias("events"), F.sum("stored_copies").cast("bigint").alias("stored_rows")))


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.run_summary(_admitted(spark, sf_dir, "sent"))


@query
def latency_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.p95_latency(fixtures.access_log(spark, sf_dir), "event_type")


# --- metrics -------------------------------------------------------------------------------------

@query
def metric_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.counters(fixtures.metric_observations(spark, sf_dir)).select(
        "name", "labels_key", F.round("value", 6).alias("value"))


@query
def metric_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.gauges(fixtures.metric_observations(spark, sf_dir)).select(
        "name", "labels_key", F.round("value", 6).alias("value"))


@query
def metric_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.histogram_long(metrics.histograms(fixtures.metric_observations(spark, sf_dir)))


@query
def metrics_exposition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.exposition(spark, fixtures.metric_observations(spark, sf_dir))


@query
def metric_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = metrics.counter_samples(fixtures.metric_observations(spark, sf_dir), "day")
    return metrics.rate(samples)


@query
def metric_rate_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = metrics.counter_samples(fixtures.metric_observations(spark, sf_dir), "day")
    return metrics.rate(samples, by_labels=True)


@query
def histogram_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.histogram_quantile(fixtures.metric_observations(spark, sf_dir))


@query
def lookback_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sum by (status) (rate(processing_kafka_messages_total[1m]))`` every 30 s."""
    samples = fixtures.scraped_samples(spark, sf_dir).where(F.col("name") == "processing_kafka_messages_total")
    return scraped.rate_by(samples, ["status"]).withColumn("rate", F.round("rate", 6))


@query
def bucket_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``histogram_quantile(0.95, sum by (le, operation) (rate(..._bucket[5m])))`` every minute."""
    out = scraped.bucket_quantile(fixtures.scraped_samples(spark, sf_dir))
    return out.withColumn("rate", F.round("rate", 6)).withColumn("quantile", F.round("quantile", 6))


@query
def service_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.service_up(fixtures.up_samples(spark, sf_dir))


@query
def readiness_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.readiness(fixtures.readiness_checks(spark, sf_dir))


@query
def request_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.request_counters(fixtures.access_log(spark, sf_dir))


@query
def ingestion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingestion service's six metrics from its access log and readiness checks. A request holds seq % 10 + 1
    measurements; 503 answers are publisher failures, 429 ones with seq % 3 = 0 backpressure."""
    status, seq = F.col("status"), F.col("seq")
    access = fixtures.access_log(spark, sf_dir).withColumns({
        "measurements": seq % 10 + 1,
        "reason": F.when(status == 503, F.lit("publisher_unavailable")).when((status == 429) & (seq % 3 == 0), F.lit("publisher_backpressure"))})
    checks = fixtures.access_log(spark, sf_dir).select(
        "ts", "seq", F.element_at(F.array(F.lit("redis"), F.lit("kafka"), F.lit("postgres")), (seq % 3 + 1).cast("int")).alias("dependency"),
        (F.col("event_type") != "error").alias("ok"))
    return metrics.ingestion_metrics(access, checks).withColumn("value", F.round("value", 6))


@query
def processing_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG5: the processing service's counters over the raw topic: messages, commits, dead letters, errors,
    and alerts created from the valid events (one per stored 300 s bucket)."""
    routed = _processed(spark, sf_dir)
    tags = metrics.metric_tags(routed).groupBy("name", "labels_key").agg(F.count(F.lit(1)).alias("value"))
    valid = routed.filter(F.col("route") == "store").select("event_id", "patient_id", F.col("timestamp").alias("ts"),
                                                             F.col("heart_rate").cast("int").alias("heart_rate"), "offset")
    created = alerts.bucketed(detect.detect_sustained(detect.latest_readings(valid, "offset")))
    alert_count = created.groupBy(F.lit("processing_alerts_created_total").alias("name"),
                                  F.concat(F.lit("type="), F.col("alert_type")).alias("labels_key")) \
        .agg(F.count(F.lit(1)).alias("value"))
    return tags.unionByName(alert_count).withColumn("value", F.col("value").cast("bigint"))
