"""Per-patient sliding window and the sustained-high-heart-rate detector.

Batch semantics are event-time exact: each event sees every event of its patient with
``ts - window <= t <= ts`` (both ends inclusive, peers with equal ts included). Where events may be delivered again,
``latest_readings`` comes first; the windows take each event_id once. The streaming processor in
``pulsegrid.streaming.detector`` reproduces the arrival-order behaviour instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid import constants as K
from pulsegrid.functions.ids import alert_message
from pulsegrid.functions.sliced import US_PER_SECOND, with_lookback_halo

DEFAULT_SLICE_SECONDS = 3600


def latest_readings(deliveries: DataFrame, arrival: str = "arrival", key: str = "patient_id", ts: str = "ts",
                    hr: str = "heart_rate") -> DataFrame:
    """WIN1 upsert: the reading that arrived last for each (patient, event_id), as a redelivery replaces the entry
    of the window. Equal arrivals: the later, then the higher reading. One partial aggregate, no group is held.
    Output: event_id, patient_id, ts, heart_rate.
    """
    last = deliveries.groupBy(key, "event_id").agg(F.max(F.struct(arrival, ts, hr)).alias("_last"))
    return last.select("event_id", key, F.col(f"_last.{ts}").alias(ts), F.col(f"_last.{hr}").alias(hr))


def window_stats(telemetry: DataFrame, window_seconds: int = K.HIGH_HR_WINDOW_SECONDS,
                 slice_seconds: int = DEFAULT_SLICE_SECONDS, key: str = "patient_id", ts: str = "ts",
                 hr: str = "heart_rate") -> DataFrame:
    """Adds ``window_events, window_min_hr, window_max_hr, window_sum_hr, window_first_ts`` to each row.

    One shuffle on (key, time slice); rows near a slice start are copied into it as look-back halo, so a hot
    patient is spread over its slices instead of one task.
    """
    halo = with_lookback_halo(telemetry, ts, window_seconds, slice_seconds)
    w = (Window.partitionBy(key, "_slice").orderBy("_us")
         .rangeBetween(-window_seconds * US_PER_SECOND, 0))
    return (halo.select("*",
                        F.count(F.lit(1)).over(w).alias("window_events"),
                        F.min(hr).over(w).alias("window_min_hr"),
                        F.max(hr).over(w).alias("window_max_hr"),
                        F.sum(hr).over(w).cast("bigint").alias("window_sum_hr"),
                        F.min(ts).over(w).alias("window_first_ts"))
            .filter(F.col("_own"))
            .drop("_us", "_slice", "_own"))


def detect_sustained(telemetry: DataFrame, threshold: int = K.HIGH_HR_THRESHOLD,
                     window_seconds: int = K.HIGH_HR_WINDOW_SECONDS, min_span_seconds: int | None = None,
                     slice_seconds: int = DEFAULT_SLICE_SECONDS) -> DataFrame:
    """Events that end a sustained high reading: the event's hr is above ``threshold``, every reading of the
    patient in ``[ts - window, ts]`` is above it, and the oldest of them is at least ``min_span`` (default: the
    window) before ``ts``. With the defaults the oldest must sit exactly ``window`` back.

    Rows at or below the threshold are not filtered before the window: they are what suppresses an alert.
    Output: event_id, patient_id, alert_type, message, triggered_at, window_events, window_min_hr.
    """
    span = window_seconds if min_span_seconds is None else min_span_seconds
    stats = window_stats(telemetry.select("event_id", "patient_id", "ts", "heart_rate"), window_seconds,
                         slice_seconds)
    hit = ((F.col("heart_rate") > threshold) & (F.col("window_min_hr") > threshold)
           & (F.unix_micros("ts") - F.unix_micros("window_first_ts") >= F.lit(span * US_PER_SECOND)))
    return stats.filter(hit).select(
        "event_id", "patient_id",
        F.lit(K.ALERT_TYPE_HIGH_HR).alias("alert_type"),
        alert_message(F.lit(K.ALERT_TYPE_HIGH_HR)).alias("message"),
        F.col("ts").alias("triggered_at"),
        F.col("window_events").cast("bigint").alias("window_events"),
        F.col("window_min_hr").cast("int").alias("window_min_hr"),
    )
