"""Streaming: file source + availableNow, restart from checkpoint, replayed input, stream == batch."""

import os

from pyspark.sql import functions as F

from pulsegrid.operators import alerts, detect, events
from pulsegrid.sources import fixtures
from pulsegrid.streaming import jobs

SF = "/root/testdata/sf0.001"


def test_store_and_alert_streams(spark, scratch):
    raw = fixtures.raw_messages(spark, SF)
    first, second = raw.filter("offset < 500"), raw.filter("offset >= 500")
    inp, tables = os.path.join(scratch, "in"), os.path.join(scratch, "tables")
    first.coalesce(1).write.parquet(os.path.join(inp, "a"))
    msgs = jobs.messages_from_files(spark, os.path.join(inp, "*"), 10)
    jobs.start_store(spark, msgs, tables, os.path.join(scratch, "ck_s")).awaitTermination()
    jobs.start_alerts(spark, msgs, tables, os.path.join(scratch, "ck_a")).awaitTermination()
    # more data arrives; both queries restart from their checkpoints
    second.coalesce(1).write.parquet(os.path.join(inp, "b"))
    jobs.start_store(spark, msgs, tables, os.path.join(scratch, "ck_s")).awaitTermination()
    jobs.start_alerts(spark, msgs, tables, os.path.join(scratch, "ck_a")).awaitTermination()
    # the whole input replayed through a new checkpoint: sinks stay unchanged
    jobs.start_store(spark, msgs, tables, os.path.join(scratch, "ck_s2")).awaitTermination()

    tel = spark.read.parquet(os.path.join(tables, "telemetry"))
    routed = events.process(raw)
    n_valid = routed.filter("route = 'store'").count()
    assert tel.count() == n_valid == tel.select("event_id").distinct().count()
    assert spark.read.json(os.path.join(tables, "dlq")).count() == \
        routed.filter("route = 'dlq'").count()

    valid = routed.filter("route = 'store'").select("event_id", "patient_id", F.col("timestamp").alias("ts"),
                                                   F.col("heart_rate").cast("int").alias("heart_rate"))
    batch = {r.dedup_key for r in alerts.cooldown(detect.detect_sustained(valid)).collect()}
    stream = {r.dedup_key for r in spark.read.parquet(os.path.join(tables, "alerts")).collect()}
    assert stream == batch and len(batch) > 0


def test_append_if_absent_looks_everywhere(spark, scratch):
    """The same id on another date, a table made empty beforehand, and repeats within a batch."""
    import datetime as dt

    from pulsegrid.operators.store import ALERTS_SCHEMA, create_tables

    create_tables(spark, scratch)
    path = os.path.join(scratch, "alerts")

    def batch(key, day):
        when = dt.datetime(2026, 7, day, 12, tzinfo=dt.timezone.utc)
        return spark.createDataFrame([(key, "p", "t", when, when, when.date())] * 2, ALERTS_SCHEMA)

    added = [jobs.append_if_absent(batch(k, d), path, ["dedup_key"], ["detected_at"], "created_date") for k, d in (("a", 7), ("a", 8), ("b", 8))]
    assert added == [1, 0, 1]
    assert spark.read.parquet(path).count() == 2


def test_state_expires_and_late_rows(spark, scratch):
    """A patient that is silent for longer than the window's life starts anew; a late row within it still counts."""
    import json
    import time

    from pulsegrid.streaming.detector import SustainedHighDetector

    def send(name, first, readings):
        rows = [("p", json.dumps({"event_id": e, "device_id": "d", "patient_id": "p",
                                  "timestamp": f"2026-07-07T12:{s // 60:02d}:{s % 60:02d}Z", "heart_rate": h}),
                 "telemetry.raw", 0, first + i) for i, (e, s, h) in enumerate(readings)]
        (spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset bigint")
         .withColumn("high_watermark", F.lit(99).cast("bigint")).withColumn("timestamp", F.current_timestamp())
         .coalesce(1).write.parquet(os.path.join(scratch, "in", name)))

    def alerts_after(ttl):
        tables = os.path.join(scratch, f"tables-{ttl}")
        msgs = jobs.messages_from_files(spark, os.path.join(scratch, "in", "*"), 10)
        query = jobs.start_alerts(spark, msgs, tables, os.path.join(scratch, f"ck-{ttl}"),
                                  processor=SustainedHighDetector(window_ttl_ms=ttl))
        assert query.awaitTermination(120)
        path = os.path.join(tables, "alerts")
        return spark.read.parquet(path).count() if os.path.isdir(path) else 0

    send("a", 0, [("e1", 30, 130), ("e0", 0, 130)])  # e0 comes late
    assert alerts_after(300_000) == alerts_after(1_000) == 0
    time.sleep(2)
    send("b", 2, [("e2", 60, 130)])
    assert alerts_after(300_000) == 1
    assert alerts_after(1_000) == 0


def test_live_metrics_of_one_run(spark, scratch):
    """All ten names come out of the running queries; counts and lag equal the batch operators'."""
    import time

    from pulsegrid import constants as K
    from pulsegrid.streaming.live import LiveMetrics

    raw = fixtures.raw_messages(spark, SF)
    raw.filter("offset < 600").coalesce(1).write.parquet(os.path.join(scratch, "in", "a"))
    raw.filter("offset >= 600").coalesce(1).write.parquet(os.path.join(scratch, "in", "b"))
    live = LiveMetrics()
    spark.streams.addListener(live)
    try:
        msgs = jobs.messages_from_files(spark, os.path.join(scratch, "in", "*"), 1)
        jobs.start_store(spark, msgs, os.path.join(scratch, "t"), os.path.join(scratch, "ck_s"), live=live).awaitTermination()
        jobs.start_alerts(spark, msgs, os.path.join(scratch, "t"), os.path.join(scratch, "ck_a"), live=live).awaitTermination()
        deadline = time.time() + 20  # progress reaches listeners after the query
        while time.time() < deadline and {n for n, _ in live.snapshot()} < {"processing_sliding_window_events_current"}:
            time.sleep(0.2)
        time.sleep(1)
    finally:
        spark.streams.removeListener(live)
    got = live.snapshot()
    routed = events.process(raw)
    n = {r["route"]: r["count"] for r in routed.groupBy("route").count().collect()}
    reasons = {r["dlq_reason"]: r["count"] for r in routed.where("route = 'dlq'").groupBy("dlq_reason").count().collect()}
    assert got["processing_kafka_messages_total", "status=processed"] == n["store"]
    assert got["processing_kafka_messages_total", "status=dlq"] == n["dlq"] == sum(reasons.values())
    assert got["processing_kafka_commits_total", "status=success"] == n["store"] + n["dlq"]
    assert {k: got["processing_dlq_messages_total", f"reason={k}"] for k in reasons} == reasons
    assert got["processing_errors_total", "stage=validate"] == reasons["validation"]
    assert got["processing_alerts_created_total", f"type={K.ALERT_TYPE_HIGH_HR}"] == spark.read.parquet(os.path.join(scratch, "t", "alerts")).count()
    lag = {f"partition={r['partition']},topic={r['topic']}": r["lag"] for r in events.consumer_lag(raw).collect()}
    assert {labels: v for (name, labels), v in got.items() if name == "processing_kafka_consumer_lag"} == lag
    assert got["processing_sliding_window_events_current", ""] >= 1
    assert got["processing_processing_duration_seconds_count", ""] == 2
    names = {name.removesuffix("_count").removesuffix("_sum") for name, _ in got}
    assert names == set(K.METRIC_DEFINITIONS)
    assert any(name.endswith("_bucket") and "le=+Inf" in labels for name, labels, _ in live.samples())
