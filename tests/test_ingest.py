"""Batch documents: strict decode, validation, explode, admission (idempotency + token bucket)."""

import json
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid import constants as K
from pulsegrid.operators import ingest


def _doc(n=1, **over):
    d = {"device_id": "device-1", "patient_id": "patient-1", "batch_id": "b1",
         "measurements": [{"timestamp": f"2026-07-07T12:00:{i:02d}Z", "heart_rate": 70 + i} for i in range(n)]}
    d.update(over)
    return json.dumps(d, separators=(",", ":"))


def _check(spark, bodies):
    df = spark.createDataFrame([(f"r{i}", b) for i, b in enumerate(bodies)], "request_id string, body string")
    return {r.request_id: r for r in ingest.validate(ingest.decode_strict(df))
            .select("request_id", "decode_ok", "reason").collect()}


def test_strict_decode(spark):
    bad = ["", '{"device_id":"d"', _doc(1) + "{}", _doc(1, note="x"),
           _doc(1).replace('"heart_rate":70', '"heart_rate":70,"x":1'), _doc(1).replace("70", '"70"'), "[]"]
    good = [_doc(1), _doc(10)]
    out = _check(spark, bad + good)
    for i in range(len(bad)):
        assert not out[f"r{i}"].decode_ok, bad[i]
    for j in range(len(good)):
        assert out[f"r{len(bad) + j}"].decode_ok


def test_batch_validation_rules(spark):
    ms = json.loads(_doc(3))["measurements"]
    cases = [
        (_doc(1), None),
        (_doc(0), K.MSG_MEASUREMENTS_LENGTH),
        (_doc(11), K.MSG_MEASUREMENTS_LENGTH),
        (_doc(1, device_id=""), K.MSG_DEVICE_ID_REQUIRED),
        (_doc(1, patient_id=""), K.MSG_PATIENT_ID_REQUIRED),
        (_doc(1, batch_id=""), K.MSG_BATCH_ID_REQUIRED),
        (_doc(1, measurements=[{"timestamp": "2026-07-07T12:00:00Z", "heart_rate": 19}]), K.MSG_HR_TOO_LOW),
        (_doc(1, measurements=[{"timestamp": "2026-07-07T12:00:00Z", "heart_rate": 251}]), K.MSG_HR_TOO_HIGH),
        (_doc(1, measurements=[{"heart_rate": 80}]), K.MSG_MEASUREMENT_TS_REQUIRED),
        (_doc(3, measurements=[ms[1], ms[0], ms[2]]), K.MSG_TS_OUT_OF_ORDER),
        (_doc(2, measurements=[ms[0], ms[0]]), K.MSG_TS_OUT_OF_ORDER),
        (_doc(2, measurements=[ms[0], {"timestamp": ms[1]["timestamp"], "heart_rate": 300}]), K.MSG_HR_TOO_HIGH),
    ]
    out = _check(spark, [b for b, _ in cases])
    for i, (body, reason) in enumerate(cases):
        assert out[f"r{i}"].decode_ok
        assert out[f"r{i}"].reason == reason, body


def test_explode_ids(spark):
    df = spark.createDataFrame([("r0", _doc(3))], "request_id string, body string")
    rows = ingest.explode(ingest.process(df)).orderBy("event_id").collect()
    assert [r.event_id for r in rows] == ["b1-0", "b1-1", "b1-2"]
    assert [r.heart_rate for r in rows] == [70, 71, 72]


def _requests(spark, rows):
    """rows: (request_id, device_id, batch_id, arrival_ms)"""
    return spark.createDataFrame([(r, d, b, t, True, None, 1) for r, d, b, t in rows],
                                 "request_id string, device_id string, batch_id string, arrival_ms long, "
                                 "decode_ok boolean, reason string, n int")


def test_burst_of_two_then_429_and_release(spark):
    reqs = _requests(spark, [("a", "d1", "b1", 0), ("b", "d1", "b2", 1), ("c", "d1", "b3", 2),
                             ("d", "d1", "b3", 5002), ("e", "d1", "b1", 5003)])
    out = {r.request_id: r for r in ingest.admit(reqs).collect()}
    assert [out[k].status for k in "abc"] == [202, 202, 429]
    assert out["c"].retry_after_s == 5 and out["c"].outcome == "rate_limit_exceeded"
    assert out["d"].status == 202   # the rejected batch's key was released: its retry is not a duplicate
    assert out["e"].status == 200 and out["e"].outcome == "duplicate_ignored"


def test_first_seen_forgets_after_24_hours(spark):
    h = 3_600_000
    copies = [("a", 0), ("b", 1), ("c", 25 * h), ("d", 26 * h), ("e", 49 * h), ("f", 49 * h)]
    df = spark.createDataFrame([(r, "d1", "b1", t) for r, t in copies] + [("z", "d2", "b1", 5)],
                               "request_id string, device_id string, batch_id string, arrival_ms long")
    got = {r.request_id: r.first_seen for r in ingest.first_seen(df).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": False, "e": True, "f": False, "z": True}


def _bucket_model(times, interval=5000, cap=2):
    tokens, last, out = float(cap), None, []
    for now in times:
        tokens = float(cap) if last is None else min(float(cap), tokens + max(0, now - last) / interval)
        last = now
        if tokens >= 1:
            tokens -= 1
            out.append((True, 0))
        else:
            out.append((False, int(math.ceil((1 - tokens) * interval))))
    return out


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 12000), min_size=1, max_size=30))
def test_token_bucket_matches_model(spark, gaps):
    times, t = [], 0
    for g in gaps:
        t += g
        times.append(t)
    df = spark.createDataFrame([("d1", i + 1, t) for i, t in enumerate(times)],
                               "device_id string, seq long, arrival_ms long")
    got = [(r.allowed, r.retry_after_ms) for r in ingest.rate_limit(df).orderBy("seq").collect()]
    assert got == _bucket_model(times)


def test_accepted_log_round_trip_and_reconcile(spark, scratch):
    import os

    from pulsegrid.operators import reconcile
    from pulsegrid.sources import readers
    docs = spark.createDataFrame([("r0", _doc(3)), ("r1", _doc(2, batch_id="b2"))], "request_id string, body string")
    checked = ingest.process(docs).withColumn("arrival_ms", ingest.F.lit(0).cast("long"))
    adm = ingest.admit(checked, carry=["patient_id"])
    log = reconcile.accepted_log(adm, 1783425600000)
    path = os.path.join(scratch, "accepted")
    reconcile.write_accepted_log(log, path)
    back = readers.read_accepted_log(spark, path)
    assert sorted(back.columns) == sorted(log.columns)
    stored = spark.createDataFrame([("b1-0",), ("b1-1",), ("b1-1",), ("zz-9",)], "event_id string")
    got = {r.event_id: r.status for r in reconcile.reconcile(back, stored).collect()}
    assert got == {"b1-0": "ok", "b1-1": "duplicated", "b1-2": "missing", "b2-0": "missing", "b2-1": "missing",
                   "zz-9": "extra"}


def test_run_result_record(spark, scratch):
    import os

    from pulsegrid.operators import reconcile
    rows = [("a", "d1", "b1", "p1", 0, 202, 10, 10), ("b", "d1", "b1", "p1", 500, 200, 10, 0), ("c", "d1", "b2", "p1", 900, 429, 7, 0),
            ("d", "d2", "b3", "p2", 2_600, 202, 4, 4), ("e", "d2", "b4", "p2", 2_700, 400, 3, 0)]
    out = spark.createDataFrame(rows, "request_id string, device_id string, batch_id string, patient_id string, arrival_ms long, status int, sent long, "
                                      "accepted_measurements long")
    latencies = spark.createDataFrame([(k,) for k in range(1, 101)], "latency_ms long")
    path = os.path.join(scratch, "result.json")
    for _ in range(2):  # a second run replaces the file
        reconcile.write_result(reconcile.run_result(out, latencies, 1783425600000, "run1", "steady", 2, "events.jsonl"), path)
    got = json.load(open(path))
    assert list(got) == reconcile.RESULT_FIELDS
    assert got == {"run_id": "run1", "mode": "steady", "devices": 2, "peak_devices": 2, "patients": 2, "duration_seconds": 3,
                   "started_at": "2026-07-07T12:00:00.000Z", "finished_at": "2026-07-07T12:00:02.700Z", "generated_measurements": 24, "sent_batches": 5,
                   "sent_measurements": 34, "accepted_202": 2, "duplicates_200": 1, "rate_limited_429": 1, "unavailable_503": 0, "failed_requests": 1,
                   "accepted_measurements": 14, "buffered_measurements_remaining": 10, "p95_http_latency_ms": 95,
                   "throughput_measurements_per_sec": round(14 / 2.7, 6), "event_log": "events.jsonl"}
