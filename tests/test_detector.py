"""Detector windows (the original detector/window tests plus edge cases) and the cool-down against a
plain Python model (property test)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.functions.greedy import spaced
from pulsegrid.operators import alerts, detect

BASE = dt.datetime(2026, 7, 7, 12, 0, 0)

# (rows as (offset seconds, hr), expected trigger offsets)
WINDOWS = [
    ([(0, 78)], []),
    ([(0, 121)], []),
    ([(0, 120), (60, 120)], []),
    ([(0, 121), (30, 80), (60, 121)], []),
    ([(0, 121), (30, 122), (60, 121)], [60]),
    ([(0, 121), (59, 121)], []),
    ([(0, 121), (61, 121)], []),
    ([(600, 130), (660, 130)], [660]),
    ([(600, 130), (660, 130), (720, 130), (780, 130), (781, 80)], [660, 720, 780]),
]


def _frame(spark, cases):
    rows = []
    for c, (events, _) in enumerate(cases):
        for i, (off, hr) in enumerate(events):
            rows.append((f"e{c}-{i}", f"patient-{c:03d}", BASE + dt.timedelta(seconds=off), hr))
    return spark.createDataFrame(rows, "event_id string, patient_id string, ts timestamp, heart_rate int")


def test_detector_windows(spark):
    got = {}
    for r in detect.detect_sustained(_frame(spark, WINDOWS)).collect():
        got.setdefault(r.patient_id, []).append(int((r.triggered_at - BASE).total_seconds()))
    for c, (_, expected) in enumerate(WINDOWS):
        assert sorted(got.get(f"patient-{c:03d}", [])) == expected, WINDOWS[c]


def test_window_size_counts_both_ends(spark):
    df = _frame(spark, [([(0, 70), (30, 70), (60, 70), (61, 70)], [])])
    sizes = {r.event_id: r.window_events for r in detect.window_stats(df).collect()}
    assert sizes == {"e0-0": 1, "e0-1": 2, "e0-2": 3, "e0-3": 3}


def test_window_across_slice_boundary(spark):
    # slice 3600 s: readings around the hour boundary must still see their look-back
    rows = [(3540 + 5 * i, 130) for i in range(25)]
    df = _frame(spark, [(rows, [])])
    got = sorted(int((r.triggered_at - BASE).total_seconds()) for r in detect.detect_sustained(df).collect())
    assert got == [o for o, _ in rows if o >= 3600]


def _greedy(times, gap):
    kept, last = [], None
    for t in sorted(times):
        if last is None or t >= last + gap:
            kept.append(t)
            last = t
    return kept


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5000), min_size=1, max_size=40), min_size=1, max_size=4))
def test_cooldown_matches_greedy_model(spark, patients):
    rows = []
    for p, offs in enumerate(patients):
        for i, off in enumerate(offs):  # in any order, equal times included
            rows.append((f"e{p}-{i:02d}", f"p{p}", "HIGH_HEART_RATE", BASE + dt.timedelta(seconds=off)))
    det = spark.createDataFrame(rows, "event_id string, patient_id string, alert_type string, triggered_at timestamp")
    got = {}
    for r in alerts.cooldown(det).collect():
        got.setdefault(r.patient_id, []).append((int((r.triggered_at - BASE).total_seconds()), r.event_id))
    for p, offs in enumerate(patients):
        first = {t: min(f"e{p}-{i:02d}" for i, o in enumerate(offs) if o == t) for t in offs}
        assert sorted(got.get(f"p{p}", [])) == [(t, first[t]) for t in _greedy(offs, 300)]


def test_cooldown_equal_times(spark):
    rows = [(e, "p", "HIGH_HEART_RATE", BASE + dt.timedelta(seconds=s)) for e, s in (("b", 60), ("a", 60), ("c", 400))]
    det = spark.createDataFrame(rows, "event_id string, patient_id string, alert_type string, triggered_at timestamp")
    assert sorted(r.event_id for r in alerts.cooldown(det).collect()) == ["a", "c"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), st.integers(-500, 900)), min_size=1, max_size=80),
       st.integers(1, 60), st.integers(0, 70))
def test_spacing_over_batches_and_slices(spark, rows, gap, wider):
    """Slices as narrow as the gap and Arrow batches of a few rows: every state crosses both borders."""
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "k string, t long, i long")
        got = sorted((r.k, r.t) for r in spaced(df, ["k"], "t", "i", gap, gap + wider).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == [(k, t) for k in "xyz" for t in _greedy([u for j, u in rows if j == k], gap)]


def test_redelivered_and_corrected_readings(spark):
    at = [BASE + dt.timedelta(seconds=s) for s in (0, 30, 60)]
    rows = [("e0", "p", at[0], 130, 1), ("e1", "p", at[1], 80, 2), ("e2", "p", at[2], 130, 3), ("e2", "p", at[2], 130, 4)]
    schema = "event_id string, patient_id string, ts timestamp, heart_rate int, arrival long"
    seen = detect.latest_readings(spark.createDataFrame(rows, schema))
    assert {r.event_id: r.window_events for r in detect.window_stats(seen).collect()} == {"e0": 1, "e1": 2, "e2": 3}
    assert detect.detect_sustained(seen).count() == 0
    # the low reading is corrected: nothing suppresses the alert any more
    fixed = detect.latest_readings(spark.createDataFrame([*rows, ("e1", "p", at[1], 131, 5)], schema))
    assert [r.event_id for r in detect.detect_sustained(fixed).collect()] == ["e2"]


def test_bucketed_first_wins_and_key(spark):
    rows = [("a", "p1", "HIGH_HEART_RATE", BASE + dt.timedelta(seconds=s)) for s in (0,)] + \
           [("b", "p1", "HIGH_HEART_RATE", BASE + dt.timedelta(seconds=120)),
            ("c", "p1", "HIGH_HEART_RATE", BASE + dt.timedelta(seconds=300))]
    det = spark.createDataFrame(rows, "event_id string, patient_id string, alert_type string, triggered_at timestamp")
    out = {r.dedup_key: r.event_id for r in alerts.bucketed(det).collect()}
    b0 = int(BASE.replace(tzinfo=dt.timezone.utc).timestamp()) // 300
    assert out == {f"p1:HIGH_HEART_RATE:{b0}": "a", f"p1:HIGH_HEART_RATE:{b0 + 1}": "c"}


def test_cooldown_hot_patient_many_slices(spark):
    # one patient alerting every 7 s for 6 hours (no pause, one long run) next to a sparse one
    offs = list(range(0, 6 * 3600, 7))
    rows = [(f"h{i}", "hot", "HIGH_HEART_RATE", BASE + dt.timedelta(seconds=o)) for i, o in enumerate(offs)]
    rows += [("s0", "cold", "HIGH_HEART_RATE", BASE), ("s1", "cold", "HIGH_HEART_RATE", BASE + dt.timedelta(seconds=299))]
    det = spark.createDataFrame(rows, "event_id string, patient_id string, alert_type string, triggered_at timestamp")
    got = {}
    for r in alerts.cooldown(det).collect():
        got.setdefault(r.patient_id, []).append(int((r.triggered_at - BASE).total_seconds()))
    assert sorted(got["hot"]) == _greedy(offs, 300)
    assert got["cold"] == [0]


class _Held:
    """A value or list state in memory."""

    def __init__(self, value=None):
        self.value = value

    def get(self):
        return self.value

    def put(self, rows):
        self.value = list(rows)

    update = put


def _detector():
    from pulsegrid.streaming.detector import SustainedHighDetector

    d = SustainedHighDetector()
    d.window, d.last_alert = _Held([]), _Held()
    d.last_alert.update = lambda row: setattr(d.last_alert, "value", row)
    return d


def _batch(rows):
    import pandas as pd

    return pd.DataFrame({"event_id": [r[0] for r in rows], "timestamp": pd.to_datetime([r[1] for r in rows], unit="us"),
                         "heart_rate": [r[2] for r in rows], "arrival": range(len(rows))})


def _plain(batches):
    """The rules one by one over plain dictionaries."""
    entries, last, out = {}, None, []
    for eid, t, hr in (r for b in batches for r in b):
        entries.pop(eid, None)
        entries[eid] = (t, hr)
        entries = {k: v for k, v in entries.items() if v[0] // 1_000_000 >= (t - 60_000_000) // 1_000_000}
        inside = [v for v in entries.values() if t - 60_000_000 <= v[0] <= t]
        if hr <= 120 or min(v[0] for v in inside) > t - 60_000_000 or any(v[1] <= 120 for v in inside):
            continue
        if last is not None and t - last < 300_000_000:
            continue
        last = t
        out.append((eid, len(inside)))
    return out


def test_detector_window_equals_the_plain_rules():
    import random

    rng = random.Random(5)
    for _ in range(30):
        t, batches = 10**15, []
        for _ in range(6):
            rows = []
            for _ in range(60):
                t += rng.choice([0, 1, 500_000, 5_000_000, 5_000_000, 60_000_000])
                late = t - rng.choice([0, 0, 0, 3_000_000, 59_000_000, 200_000_000])
                rows.append((f"e{rng.randrange(40)}" if rng.random() < 0.2 else f"u{t}-{len(rows)}", late, rng.choice([130, 140, 150, 121] * 8 + [120, 90])))
            batches.append(rows)
        d, got = _detector(), []
        for rows in batches:
            for frame in d.handleInputRows(("p",), iter([_batch(rows)]), None):
                got += list(zip(frame["event_id"], frame["window_events"], strict=True))
        assert got == _plain(batches)


def test_detector_time_follows_the_events():
    """100,000 readings of one patient within a window, in one batch."""
    import time

    def run(n):
        rows = [(f"e{i}", 10**15 + i * 500, 130) for i in range(n)]
        start = time.process_time()
        list(_detector().handleInputRows(("p",), iter([_batch(rows)]), None))
        return time.process_time() - start

    run(1_000)
    assert run(100_000) < 30 * max(run(10_000), 0.02)
