"""Live metrics of the running queries, without a second pass over the data.

Counts, lag and window size are aggregates observed on the micro-batch as it is processed (``observe``); durations come
from the queries' progress and from the time that the sinks' writes take. A listener adds them to one registry in the
driver, whose size follows the names and labels, never the data. The ten names are those of the batch operators.

What a progress report cannot say per message it says per micro-batch: a processing duration is that of the batch, a
state duration that of the batch's updates.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from pulsegrid import constants as K

OBSERVED_STORE, OBSERVED_ALERTS = "pulsegrid_store", "pulsegrid_alerts"


def observe_messages(routed: DataFrame, partitions: int) -> DataFrame:
    """Counts by route and reason, errors, and the lag of the last message of every partition."""
    dlq, reason = F.col("route") == "dlq", F.col("dlq_reason")
    counts = [F.count_if(~dlq).alias("processed"), F.count_if(dlq).alias("dlq"), F.count_if(reason == "decode").alias("decode"),
              F.count_if(reason == "validation").alias("validation")]
    lag = F.greatest(F.col("high_watermark") - F.col("offset") - 1, F.lit(0))
    lags = []
    for p in range(partitions):
        here = (F.col("partition") == p) & (F.col("high_watermark") > 0)
        lags.append(F.max_by(F.when(here, lag), F.when(here, F.col("offset"))).alias(f"lag_{p}"))
    return routed.observe(OBSERVED_STORE, *counts, *lags)


def observe_alerts(detected: DataFrame) -> DataFrame:
    """Alerts, and the window size after the latest event (rows without a type report sizes)."""
    size = F.col("alert_type").isNull()
    return detected.observe(OBSERVED_ALERTS, F.count_if(~size).alias("alerts"),
                            F.max_by(F.when(size, F.col("window_events")), F.when(size, F.col("triggered_at"))).alias("window"))


class LiveMetrics(StreamingQueryListener):
    """The registry: counters, gauges and histograms by (name, labels)."""

    def __init__(self, topic: str = K.RAW_TOPIC):
        self.topic = topic
        self._lock = threading.Lock()
        self._values: dict[tuple[str, str], float] = {}
        self._histograms: dict[tuple[str, str], list[float]] = {}  # bucket counts, then sum and count
        self._seen: set[tuple[str, int]] = set()

    def add(self, name: str, labels: str, value: float) -> None:
        if value > 0:
            with self._lock:
                self._values[name, labels] = self._values.get((name, labels), 0.0) + value

    def set(self, name: str, labels: str, value: float) -> None:
        with self._lock:
            self._values[name, labels] = float(value)

    def observe(self, name: str, labels: str, seconds: float) -> None:
        with self._lock:
            h = self._histograms.setdefault((name, labels), [0.0] * (len(K.HISTOGRAM_BOUNDS) + 2))
            for i, bound in enumerate(K.HISTOGRAM_BOUNDS):
                h[i] += seconds <= bound
            h[-2] += seconds
            h[-1] += 1

    @contextmanager
    def timed(self, name: str, labels: str):
        start = time.perf_counter()
        yield
        self.observe(name, labels, time.perf_counter() - start)

    def snapshot(self) -> dict[tuple[str, str], float]:
        """All values; of a histogram its count and sum (``<name>_count``, ``<name>_sum``)."""
        with self._lock:
            out = dict(self._values)
            for (name, labels), h in self._histograms.items():
                out[f"{name}_sum", labels], out[f"{name}_count", labels] = h[-2], h[-1]
            return out

    def samples(self) -> list[tuple[str, str, float]]:
        """As a scrape would see them, sorted: (name, labels, value), histograms as cumulative ``_bucket`` series."""
        rows = [(name, labels, value) for (name, labels), value in self.snapshot().items()]
        with self._lock:
            for (name, labels), h in self._histograms.items():
                les = [*(f"{b:g}" for b in K.HISTOGRAM_BOUNDS), "+Inf"]
                rows += [(f"{name}_bucket", ",".join(filter(None, [labels, f"le={le}"])), n) for le, n in zip(les, [*h[:-2], h[-1]], strict=True)]
        return sorted(rows)

    # --- the listener ---------------------------------------------------------------------------------

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        batch = (str(p.runId), p.batchId)
        if batch in self._seen or not p.numInputRows:
            return
        self._seen.add(batch)
        seen = p.observedMetrics
        if OBSERVED_STORE in seen:
            self._messages(seen[OBSERVED_STORE].asDict())
            self.observe("processing_processing_duration_seconds", "", p.durationMs["triggerExecution"] / 1000)
        if OBSERVED_ALERTS in seen:
            m = seen[OBSERVED_ALERTS].asDict()
            self.add("processing_alerts_created_total", f"type={K.ALERT_TYPE_HIGH_HR}", m["alerts"])
            if m["window"] is not None:
                self.set("processing_sliding_window_events_current", "", m["window"])
            for op in p.stateOperators:
                self.observe("processing_redis_duration_seconds", "operation=sliding_window_add", op.allUpdatesTimeMs / 1000)

    def _messages(self, m: dict) -> None:
        self.add("processing_kafka_messages_total", "status=processed", m["processed"])
        self.add("processing_kafka_messages_total", "status=dlq", m["dlq"])
        self.add("processing_kafka_commits_total", "status=success", m["processed"] + m["dlq"])
        for reason in ("decode", "validation"):
            self.add("processing_dlq_messages_total", f"reason={reason}", m[reason])
        self.add("processing_errors_total", "stage=validate", m["validation"])
        for name, lag in m.items():
            if name.startswith("lag_") and lag is not None:
                self.set("processing_kafka_consumer_lag", f"partition={name[4:]},topic={self.topic}", lag)


def timer(live: LiveMetrics | None) -> Callable:
    """``live.timed``, or something that does nothing."""
    @contextmanager
    def idle(name: str, labels: str):
        yield

    return live.timed if live is not None else idle
