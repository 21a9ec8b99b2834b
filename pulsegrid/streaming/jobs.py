"""Structured Streaming jobs: the processing service as two checkpointed queries.

* ``start_store`` — raw messages -> decode / validate / route -> per micro-batch: telemetry insert-if-absent
  (parquet table partitioned by the day of storage, so that retention and appends never meet: ``store.expire``) and dead-letter records (JSON envelope files).
* ``start_alerts`` — valid events -> keyed stateful detector -> alerts insert-if-absent on dedup_key.

Delivery is at-least-once from the source and idempotent at the sinks: a micro-batch replayed after a
failure (the checkpoint commits only after ``foreachBatch`` returns) inserts nothing twice, because every
write is an anti-join against what the table already holds. Executor loss only re-runs tasks. The micro-batch
size is bounded by ``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pulsegrid.functions.ids import alert_dedup_key
from pulsegrid.operators import events as ev
from pulsegrid.session import configure
from pulsegrid.streaming.detector import SustainedHighDetector, detect_stream
from pulsegrid.streaming.live import LiveMetrics, observe_alerts, observe_messages, timer

EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def append_if_absent(batch: DataFrame, path: str, key: list[str], order_by: list[str], partition_col: str | None = None,
                     fmt: str = "parquet") -> int:
    """Insert-if-absent into a table of files, partitioned by ``partition_col`` where given.

    First row per key inside the batch (by ``order_by``); keys stored anywhere in the table are skipped: the lookup
    reads the key columns of all stored rows with the batch's own types, so an empty table has nothing to infer.
    Adaptive execution broadcasts the batch's keys where their measured size allows. Returns the rows appended.
    """
    spark = batch.sparkSession
    cols = [c for c in batch.columns if c not in key]
    first = (batch.groupBy(*key).agg(F.min_by(F.struct(*cols), F.struct(*order_by)).alias("_r"))
             .select(*key, *[F.col(f"_r.{c}").alias(c) for c in cols]))
    fresh = first
    if _table_exists(spark, path):
        keys = T.StructType([f for f in first.schema if f.name in key])
        stored = spark.read.format(fmt).schema(keys).load(path)
        fresh = first.join(stored.join(first.select(*key), key, "left_semi"), key, "left_anti")
    fresh = fresh.persist()
    n = fresh.count()
    if n:
        writer = fresh.write.mode("append").format(fmt)
        (writer.partitionBy(partition_col) if partition_col else writer).save(path)
    fresh.unpersist()
    return n


def store_batch(tables_dir: str, processed_at: dt.datetime | None = None, live: LiveMetrics | None = None):
    """``foreachBatch`` body of the store query."""
    timed = timer(live)

    def run(batch: DataFrame, epoch_id: int) -> None:
        routed = batch.persist()
        good = (routed.filter(F.col("route") == "store")
                .select("event_id", "device_id", "patient_id", "timestamp", F.col("heart_rate").cast("int"),
                        F.col("spo2").cast("int"), "temperature",
                        F.current_timestamp().alias("created_at"),
                        F.struct("partition", "offset").alias("arrival"),
                        F.to_date(F.current_timestamp()).alias("created_date")))
        with timed("processing_postgres_write_duration_seconds", "operation=save_telemetry"):
            append_if_absent(good, os.path.join(tables_dir, "telemetry"), ["event_id"], ["arrival"], "created_date")
        # a dead letter is known by where its message stood, so neither replays nor new checkpoints lose or repeat one
        at = ["source_topic", "source_partition", "source_offset"]
        dlq = ev.dlq_records(routed, processed_at).select("key", "value", "headers", "reason", *at)
        append_if_absent(dlq, os.path.join(tables_dir, "dlq"), at, ["reason"], fmt="json")
        routed.unpersist()
    return run


def start_store(spark: SparkSession, messages: DataFrame, tables_dir: str, checkpoint: str,
                trigger: dict | None = None, processed_at: dt.datetime | None = None, live: LiveMetrics | None = None,
                partitions: int = 3) -> StreamingQuery:
    """Start the store query over a streaming DataFrame of Kafka-shaped messages. ``live`` (added to the session's
    listeners by the caller) gets its counts, and the lag of ``partitions`` partitions."""
    configure(spark)
    routed = ev.process(messages)
    if live is not None:
        routed = observe_messages(routed, partitions)
    w = routed.writeStream.foreachBatch(store_batch(tables_dir, processed_at, live)).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def alerts_batch(tables_dir: str, live: LiveMetrics | None = None):
    timed = timer(live)

    def run(batch: DataFrame, epoch_id: int) -> None:
        held = batch.persist()  # one evaluation, so that what is observed counts once
        rows = held.where(F.col("alert_type").isNotNull()).select(
            alert_dedup_key(F.col("patient_id"), F.col("alert_type"), F.col("triggered_at")).alias("dedup_key"),
            "patient_id", "alert_type", F.col("triggered_at").alias("detected_at"),
            F.current_timestamp().alias("created_at"), F.to_date(F.current_timestamp()).alias("created_date"))
        with timed("processing_postgres_write_duration_seconds", "operation=save_alert"):
            append_if_absent(rows, os.path.join(tables_dir, "alerts"), ["dedup_key"], ["detected_at"], "created_date")
        held.unpersist()
    return run


def start_alerts(spark: SparkSession, messages: DataFrame, tables_dir: str, checkpoint: str,
                 trigger: dict | None = None, processor: SustainedHighDetector | None = None,
                 live: LiveMetrics | None = None) -> StreamingQuery:
    """Start the alert query: valid events -> stateful detector (RocksDB state) -> alerts table. With ``live`` the
    detector also reports window sizes."""
    configure(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    routed = ev.process(messages)
    valid = (routed.filter(F.col("route") == "store")
             .select("patient_id", "event_id", "timestamp", F.col("heart_rate").cast("int").alias("heart_rate"),
                     (F.col("partition").cast("bigint") * F.lit(1 << 40) + F.col("offset")).alias("arrival")))
    processor = processor or SustainedHighDetector()
    processor.report_sizes = live is not None
    alerts = detect_stream(valid, processor)
    if live is not None:
        alerts = observe_alerts(alerts)
    w = alerts.writeStream.foreachBatch(alerts_batch(tables_dir, live)).option("checkpointLocation", checkpoint)
    # state that expires by wall clock asks for batches without data for ever; the query takes its settings at its start
    before = spark.conf.get(EMPTY_BATCHES)
    spark.conf.set(EMPTY_BATCHES, "false")
    try:
        return w.trigger(**(trigger or {"availableNow": True})).start()
    finally:
        spark.conf.set(EMPTY_BATCHES, before)


def messages_from_files(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """File-stream stand-in for the Kafka source: parquet files with the Kafka columns."""
    schema = ("key string, value string, topic string, partition int, offset bigint, high_watermark bigint, "
              "timestamp timestamp")
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path))


def kafka_sink(records: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """SNK1/SNK3 to Kafka (needs the connector jar): key, value (and headers when present)."""
    cols = ["key", "value"] + (["headers"] if "headers" in records.columns else [])
    return (records.select(*cols).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())


__all__ = ["start_store", "start_alerts", "append_if_absent", "messages_from_files", "kafka_sink"]
