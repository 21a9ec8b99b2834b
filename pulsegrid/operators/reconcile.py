"""Accepted-batch log, reconciliation against stored telemetry, run summary, latency percentile."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid import constants as K
from pulsegrid.functions.ids import event_id_of


def accepted_log(outcomes: DataFrame, base_epoch_ms: int) -> DataFrame:
    """SNK7: one record per accepted (202) batch: batch_id, device_id, patient_id, event_ids (``<batch>-<i>``),
    measurements, accepted_at (= arrival time). ``outcomes`` come from ``ingest.admit`` with patient_id carried."""
    n = F.col("accepted_measurements")
    ids = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: event_id_of(F.col("batch_id"), i))
    return (outcomes.filter(F.col("status") == 202)
            .select("batch_id", "device_id", "patient_id", ids.alias("event_ids"),
                    n.cast("int").alias("measurements"),
                    F.timestamp_millis(F.lit(base_epoch_ms) + F.col("arrival_ms")).alias("accepted_at")))


def write_accepted_log(log: DataFrame, path: str) -> None:
    """SNK7 writer: JSON lines (Spark's committer writes to a temporary location and renames on commit)."""
    log.write.mode("append").json(path)


def reconcile(log: DataFrame, stored: DataFrame) -> DataFrame:
    """JON4: accepted event ids vs stored telemetry rows, see ``compare``."""
    return compare(log.select(F.explode("event_ids").alias("event_id"), F.lit(True).alias("accepted"),
                              F.lit(0).cast("bigint").alias("copies"))
                   .unionByName(stored.select("event_id", F.lit(False).alias("accepted"), F.lit(1).cast("bigint").alias("copies"))))


def compare(sides: DataFrame) -> DataFrame:
    """JON4 core over rows ``(event_id, accepted boolean, copies bigint)`` of either side, or of both at once.

    status: ok (accepted, stored once), missing (accepted, not stored), duplicated (accepted, stored more than once),
    extra (stored, never accepted). The full outer join of two sides that are grouped by event_id is one grouping
    of their union: partial aggregates, then a single shuffle.
    Output: event_id, status, stored_copies.
    """
    per = sides.groupBy("event_id").agg(F.bool_or("accepted").alias("_accepted"), F.sum("copies").alias("stored_copies"))
    n = F.col("stored_copies")
    status = (F.when(~F.col("_accepted"), F.lit("extra"))
              .when(n == 0, F.lit("missing"))
              .when(n == 1, F.lit("ok"))
              .otherwise(F.lit("duplicated")))
    return per.filter(F.col("_accepted") | (n > 0)).select("event_id", status.alias("status"), n.cast("bigint").alias("stored_copies"))


def run_summary(outcomes: DataFrame) -> DataFrame:
    """AGG7/AGG9/SNK8: one-row run summary of ``ingest.admit`` with ``sent`` (measurements of the request) carried.

    duration_seconds = round(span), at least 1 when the span is positive; throughput = accepted measurements
    per second of span (0 when the span is 0)."""
    s = F.col("status")
    agg = outcomes.agg(F.count(F.lit(1)).alias("sent_batches"),
                F.sum("sent").cast("bigint").alias("sent_measurements"),
                F.count_if(s == 202).alias("accepted_202"),
                F.count_if(s == 200).alias("duplicates_200"),
                F.count_if(s == 429).alias("rate_limited_429"),
                F.count_if(s == 503).alias("unavailable_503"),
                F.count_if(~s.isin(202, 200, 429, 503)).alias("failed_requests"),
                F.sum("accepted_measurements").cast("bigint").alias("accepted_measurements"),
                (F.max("arrival_ms") - F.min("arrival_ms")).alias("_span_ms"))
    span_s = F.col("_span_ms") / F.lit(1000.0)
    duration = F.when(F.col("_span_ms") > 0, F.greatest(F.round(span_s), F.lit(1))).otherwise(F.lit(0))
    throughput = F.when(F.col("_span_ms") > 0, F.col("accepted_measurements") / span_s).otherwise(F.lit(0.0))
    return agg.select("*", duration.cast("bigint").alias("duration_seconds"),
                      F.round(throughput, 6).alias("throughput_measurements_per_sec")).drop("_span_ms")


RESULT_FIELDS = ["run_id", "mode", "devices", "peak_devices", "patients", "duration_seconds", "started_at", "finished_at", "generated_measurements",
                 "sent_batches", "sent_measurements", "accepted_202", "duplicates_200", "rate_limited_429", "unavailable_503", "failed_requests",
                 "accepted_measurements", "buffered_measurements_remaining", "p95_http_latency_ms", "throughput_measurements_per_sec", "event_log"]


def run_result(outcomes: DataFrame, latencies: DataFrame, base_epoch_ms: int, run_id: str, mode: str, peak_devices: int, event_log: str) -> DataFrame:
    """SNK8: the whole run-summary record, one row with RESULT_FIELDS. ``outcomes`` carry ``sent`` and ``patient_id``,
    ``latencies`` are milliseconds (``latency_ms``). Generated is what all batches hold, each once; what no answer has
    accepted of it is still buffered. Devices and patients are those that sent something."""
    per_batch = outcomes.groupBy("device_id", "batch_id").agg(F.max("sent").alias("held"), F.max(F.col("status") == 202).alias("taken"),
                                                              F.max("patient_id").alias("patient_id"))
    held = per_batch.agg(F.count_distinct("device_id").alias("devices"), F.count_distinct(F.nullif("patient_id", F.lit(""))).alias("patients"),
                         F.coalesce(F.sum("held"), F.lit(0)).cast("bigint").alias("generated_measurements"),
                         F.coalesce(F.sum(F.when(~F.col("taken"), F.col("held"))), F.lit(0)).cast("bigint").alias("buffered_measurements_remaining"))
    span = outcomes.agg(*[F.timestamp_millis(F.lit(base_epoch_ms) + f("arrival_ms")).alias(n) for f, n in ((F.min, "started_at"), (F.max, "finished_at"))])
    p95 = p95_latency(latencies.withColumn("_run", F.lit(1)), "_run").select(F.col("p95_ms").alias("p95_http_latency_ms"))
    one = run_summary(outcomes).withColumn("_k", F.lit(1))
    for part in (held, span, p95):  # one row each
        one = one.join(part.withColumn("_k", F.lit(1)), "_k", "left")
    one = one.withColumns({"run_id": F.lit(run_id), "mode": F.lit(mode), "peak_devices": F.lit(peak_devices).cast("bigint"), "event_log": F.lit(event_log),
                           "p95_http_latency_ms": F.coalesce("p95_http_latency_ms", F.lit(0))})
    return one.select(*RESULT_FIELDS)


def write_result(result: DataFrame, path: str) -> None:
    """SNK8 writer: the record as indented JSON in one file, written beside it and renamed into place."""
    row = result.select(F.to_json(F.struct(*RESULT_FIELDS), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSX", "ignoreNullFields": "false"})).first()[0]
    spark = result.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target, side = hadoop.Path(path), hadoop.Path(path + ".tmp")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(side, True)
    out.write(bytearray((json.dumps(json.loads(row), indent=2) + "\n").encode()))
    out.close()
    fs.delete(target, False)
    fs.rename(side, target)


def p95_latency(latencies: DataFrame, group: str, ms_col: str = "latency_ms") -> DataFrame:
    """AGG8: per group, the smallest whole-millisecond latency (clamped to 0..60000) whose cumulative count
    reaches ``ceil(0.95 n)``. Pre-aggregated to (group, ms) counts — at most 60,001 rows per group — before
    the ordered window, so the window never sees raw rows."""
    ms = F.least(F.greatest(F.col(ms_col), F.lit(0)), F.lit(K.MAX_LATENCY_MS)).cast("bigint")
    hist = latencies.groupBy(group, ms.alias("ms")).agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy(group).orderBy("ms").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy(group)
    cum = hist.select(group, "ms", F.sum("c").over(w).alias("cum"), F.sum("c").over(total).alias("n"))
    return (cum.filter(F.col("cum") >= F.ceil(F.col("n") * F.lit(0.95)))
            .groupBy(group).agg(F.first("n").cast("bigint").alias("requests"), F.min("ms").alias("p95_ms")))
