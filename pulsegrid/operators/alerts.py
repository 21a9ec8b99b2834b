"""Alert keys, bucket de-duplication, cool-down, recovery, the alerts table and its scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid import constants as K
from pulsegrid.functions.greedy import spaced
from pulsegrid.functions.ids import alert_bucket, alert_dedup_key, alert_message
from pulsegrid.functions.sliced import US_PER_SECOND

COOLDOWN_SLICE_SECONDS = 3600


def with_dedup_key(detections: DataFrame) -> DataFrame:
    """PRJ14: ``patient:type:floor(unix/300)`` next to each detection."""
    return detections.withColumn(
        "dedup_key", alert_dedup_key(F.col("patient_id"), F.col("alert_type"), F.col("triggered_at")))


def bucketed(detections: DataFrame) -> DataFrame:
    """DED3: one alert per dedup key, the earliest detection wins (ties: smallest event_id).

    ``min_by`` is a partial aggregate, so each task reduces its rows before the shuffle on dedup_key.
    Output: dedup_key, patient_id, alert_type, detected_at, event_id.
    """
    first = (with_dedup_key(detections).groupBy("dedup_key")
             .agg(F.min_by(F.struct("patient_id", "alert_type", "triggered_at", "event_id"),
                           F.struct("triggered_at", "event_id")).alias("a")))
    return first.select("dedup_key",
                        F.col("a.patient_id").alias("patient_id"),
                        F.col("a.alert_type").alias("alert_type"),
                        F.col("a.triggered_at").alias("detected_at"),
                        F.col("a.event_id").alias("event_id"))


def alerts_table(detections: DataFrame, write_delay_seconds: int = 2) -> DataFrame:
    """The alerts table as an insert-if-absent writer leaves it: bucketed alerts plus ``created_at``
    (detection time + a fixed write delay). Columns: patient_id, alert_type, dedup_key, detected_at, created_at."""
    b = bucketed(detections)
    return b.select("patient_id", "alert_type", "dedup_key", "detected_at",
                    (F.col("detected_at") + F.expr(f"INTERVAL {int(write_delay_seconds)} SECONDS")).alias("created_at"))


def cooldown(detections: DataFrame, cooldown_seconds: int = K.ALERT_COOLDOWN_SECONDS,
             slice_seconds: int = COOLDOWN_SLICE_SECONDS) -> DataFrame:
    """DED4: greedy cool-down per (patient, type). The first detection is kept; it reserves the pair for
    ``cooldown`` seconds of event time; the next kept one is the first detection at or after that.
    Suppressed detections do not extend the reservation.

    Detections of one pair at the same time are one (the smallest event_id): two devices of a patient may report
    together. The rule is computed per (patient, slice), see ``pulsegrid.functions.greedy``.
    Output: event_id, patient_id, alert_type, triggered_at, dedup_key.
    """
    us = detections.select("event_id", "patient_id", "alert_type", F.unix_micros("triggered_at").alias("_us"))
    kept = spaced(us, ["patient_id", "alert_type"], "_us", "event_id", cooldown_seconds * US_PER_SECOND,
                  slice_seconds * US_PER_SECOND)
    return with_dedup_key(kept.select("event_id", "patient_id", "alert_type",
                                      F.timestamp_micros("_us").alias("triggered_at")))


def recovered(kept: DataFrame, stored: DataFrame) -> DataFrame:
    """DED5: kept alerts re-derived on an idempotent re-run. An alert whose key is missing from the store (its
    write was lost after the cool-down was reserved) is marked ``recovered`` and would be inserted again.
    Output: dedup_key, patient_id, alert_type, detected_at, recovered."""
    present = stored.select("dedup_key").distinct().withColumn("_present", F.lit(True))
    return (kept.join(present, "dedup_key", "left")
            .select("dedup_key", "patient_id", "alert_type", F.col("triggered_at").alias("detected_at"),
                    F.col("_present").isNull().alias("recovered")))


def backfill_key(table: DataFrame) -> DataFrame:
    """SNK6: fill a missing ``dedup_key`` from (patient, type, 300 s bucket of detected_at)."""
    computed = alert_dedup_key(F.col("patient_id"), F.col("alert_type"), F.col("detected_at"))
    return table.select("patient_id", "alert_type", "detected_at",
                        F.coalesce(F.col("dedup_key"), computed).alias("dedup_key"),
                        F.col("dedup_key").isNull().alias("backfilled"))


def insert_if_absent(incoming: DataFrame, target: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """SNK4/SNK5 core: first incoming row per key (by ``order_by``), minus keys already in ``target``.

    The per-key pick is a partial aggregate (``min_by``), and the anti join reads only the key column of the
    target; AQE broadcasts the smaller side when its measured size allows and shuffles otherwise.
    """
    cols = [c for c in incoming.columns if c != key]
    first = (incoming.groupBy(key)
             .agg(F.min_by(F.struct(*cols), F.struct(*order_by)).alias("_r"))
             .select(key, *[F.col(f"_r.{c}").alias(c) for c in cols]))
    return first.join(target.select(key), key, "left_anti")


def recent_alert_semi(detections: DataFrame, table: DataFrame,
                      window_seconds: int = K.ALERT_COOLDOWN_SECONDS) -> DataFrame:
    """JON2: detections for which a stored alert of the same (patient, type) was created within
    ``[ts - window, ts]``.

    Interval join without a per-patient task: both sides carry a ``window``-wide time bucket; a stored
    alert is offered to its own bucket and the next one (the only buckets whose detections it can serve),
    so the equi-keys are (patient, type, bucket) and the range check runs inside the join.
    Output: event_id, patient_id, alert_type, triggered_at.
    """
    w_us = window_seconds * 1_000_000
    d = detections.select("event_id", "patient_id", "alert_type", "triggered_at",
                          F.floor(F.unix_micros("triggered_at") / w_us).cast("bigint").alias("_b"))
    a = (table.select(F.col("patient_id").alias("_p"), F.col("alert_type").alias("_ty"),
                      F.col("created_at").alias("_c"))
         .withColumn("_cb", F.floor(F.unix_micros("_c") / w_us).cast("bigint"))
         .withColumn("_b2", F.explode(F.array(F.col("_cb"), F.col("_cb") + 1))))
    cond = ((d["patient_id"] == a["_p"]) & (d["alert_type"] == a["_ty"]) & (d["_b"] == a["_b2"])
            & (a["_c"] >= d["triggered_at"] - F.expr(f"INTERVAL {int(window_seconds)} SECONDS"))
            & (a["_c"] <= d["triggered_at"]))
    return d.join(a, cond, "left_semi").drop("_b")


def list_view(table: DataFrame) -> DataFrame:
    """SRC4/PRJ9: the alert listing projection (message derived from the type)."""
    return table.select("patient_id", F.col("alert_type").alias("type"),
                        alert_message(F.col("alert_type")).alias("message"),
                        F.col("detected_at").alias("triggered_at"), "created_at", "dedup_key")


__all__ = ["alert_bucket", "with_dedup_key", "bucketed", "alerts_table", "cooldown", "recovered", "backfill_key",
           "insert_if_absent", "recent_alert_semi", "list_view"]
