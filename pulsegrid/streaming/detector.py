"""Streaming sliding window + sustained-high detector + cool-down, as keyed state per patient.

Range windows are not available on streaming DataFrames, so the per-patient window lives in state
(``transformWithStateInPandas``). Per arriving event, in arrival order:

1. upsert the event into the patient's window (a repeated event_id replaces the earlier entry),
2. drop entries whose whole second is before ``floor(ts - 60 s)``,
3. the events with ``ts - 60 s <= t <= ts`` must all be above the threshold, the arriving one too, and the
   oldest of them at least ``min_span`` before ``ts`` -> detection,
4. a detection becomes an alert unless an alert of the patient was kept less than the cool-down before it.

The cool-down is measured in event time (a replayed backlog yields the same alerts as live data); the window
sees only what has arrived so far (late rows still get stored, but can miss detections) — both as documented
in README.md. Per patient the state is at most 60 s of readings plus the last alert time. Both expire by wall clock
when the patient has sent nothing for a while: the window after 5 minutes, the last alert after a day, which is longer
so that the cool-down is not cut short. Every batch that holds a row of the patient renews both. Expired state is
removed by the next batches that hold any data (``jobs.start_alerts`` starts the query without empty batches, which
would never let an ``availableNow`` run end).
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pulsegrid import constants as K

US = 1_000_000
ALERT_TTL_MS = 24 * 3_600_000
OUTPUT_SCHEMA = ("patient_id string, alert_type string, message string, triggered_at timestamp, "
                 "event_id string, window_events bigint")
INPUT_COLUMNS = ["patient_id", "event_id", "timestamp", "heart_rate", "arrival"]


class Window:
    """A patient's readings in order of time, and those of them that are not above the threshold.

    Adding, replacing and checking cost a search each, dropping the oldest no more than adding them did: a batch takes
    time in proportion to its events, however many of them share a window.
    """

    def __init__(self, threshold: int, readings: Iterable[tuple[str, int, int]] = ()):
        self.threshold = threshold
        self.of: dict[str, tuple[int, int]] = {}
        self.times: list[tuple[int, str]] = []
        self.low: list[tuple[int, str]] = []
        for event_id, t, hr in readings:
            self.add(event_id, t, hr)

    def __len__(self) -> int:
        return len(self.times)

    def add(self, event_id: str, t: int, hr: int) -> None:
        """A repeated event_id replaces the earlier reading."""
        was = self.of.get(event_id)
        if was is not None:
            old = (was[0], event_id)
            del self.times[bisect_left(self.times, old)]
            if was[1] <= self.threshold:
                del self.low[bisect_left(self.low, old)]
        self.of[event_id] = (t, hr)
        insort(self.times, (t, event_id))
        if hr <= self.threshold:
            insort(self.low, (t, event_id))

    def drop_before(self, t: int) -> None:
        """Forget readings before ``t``."""
        k = bisect_left(self.times, (t, ""))
        for _, event_id in self.times[:k]:
            del self.of[event_id]
        del self.times[:k]
        del self.low[:bisect_left(self.low, (t, ""))]

    def span(self, since: int, until: int) -> tuple[int, int] | None:
        """Oldest time and number of readings in [since, until]; None if one of them is not above the threshold."""
        a, b = bisect_left(self.times, (since, "")), bisect_left(self.times, (until + 1, ""))
        if a == b or bisect_left(self.low, (since, "")) < bisect_left(self.low, (until + 1, "")):
            return None
        return self.times[a][0], b - a


class SustainedHighDetector(StatefulProcessor):
    """Keyed by patient_id. Input columns: event_id, timestamp, heart_rate, arrival (ordering within a batch)."""

    def __init__(self, threshold: int = K.HIGH_HR_THRESHOLD, window_seconds: int = K.HIGH_HR_WINDOW_SECONDS,
                 min_span_seconds: int | None = None, cooldown_seconds: int = K.ALERT_COOLDOWN_SECONDS,
                 window_ttl_ms: int | None = K.SLIDING_WINDOW_TTL_SECONDS * 1000, alert_ttl_ms: int | None = ALERT_TTL_MS):
        self.threshold = threshold
        self.window_us = window_seconds * US
        self.span_us = (window_seconds if min_span_seconds is None else min_span_seconds) * US
        self.cooldown_us = cooldown_seconds * US
        self.window_ttl_ms = window_ttl_ms
        self.alert_ttl_ms = alert_ttl_ms
        self.report_sizes = False  # one more row per patient and batch, without a type: the window after its last event

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.window = handle.getListState("window", "event_id string, ts_us long, hr int", self.window_ttl_ms)
        self.last_alert = handle.getValueState("last_alert", "ts_us long", self.alert_ttl_ms)

    @property
    def time_mode(self) -> str:
        """State expires by wall clock, which Spark offers in this mode only."""
        return "ProcessingTime" if self.window_ttl_ms or self.alert_ttl_ms else "None"

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        patient = key[0]
        batch = pd.concat(list(rows), ignore_index=True).sort_values("arrival", kind="mergesort")
        window = Window(self.threshold, ((eid, int(t), int(h)) for eid, t, h in self.window.get()))
        last = self.last_alert.get()
        last_us = None if last is None else int(last[0])
        out = []
        times = batch["timestamp"].to_numpy("datetime64[us]").astype(np.int64).tolist()
        for eid, t_us, hr in zip(batch["event_id"].tolist(), times, batch["heart_rate"].tolist(), strict=True):
            window.add(eid, t_us, int(hr))
            window.drop_before((t_us - self.window_us) // US * US)
            if hr <= self.threshold or (last_us is not None and t_us - last_us < self.cooldown_us):
                continue
            found = window.span(t_us - self.window_us, t_us)
            if found is None or t_us - found[0] < self.span_us:
                continue
            last_us = t_us
            out.append((patient, K.ALERT_TYPE_HIGH_HR, K.ALERT_MESSAGE_HIGH_HR, pd.Timestamp(t_us, unit="us"), eid, found[1]))
        self.window.put([(eid, t, window.of[eid][1]) for t, eid in window.times])
        if last_us is not None:
            self.last_alert.update((last_us,))
        if self.report_sizes:
            out.append((patient, None, None, pd.Timestamp(batch["timestamp"].iloc[-1]), batch["event_id"].iloc[-1], len(window)))
        yield pd.DataFrame(out, columns=["patient_id", "alert_type", "message", "triggered_at", "event_id",
                                         "window_events"])

    def close(self) -> None:
        pass


def detect_stream(valid_events, processor: SustainedHighDetector | None = None):
    """Apply the detector to a streaming DataFrame of valid events (columns INPUT_COLUMNS)."""
    processor = processor or SustainedHighDetector()
    return (valid_events.select(*INPUT_COLUMNS).groupBy("patient_id")
            .transformWithStateInPandas(processor, OUTPUT_SCHEMA, "Append", processor.time_mode))
