"""Admission as a stream: equal to the batch over restarts, and the reference's answers to bursts and retries."""

import json
import os

from pyspark.sql import functions as F

from pulsegrid.operators import ingest
from pulsegrid.sources import fixtures
from pulsegrid.streaming import admission

SF = "/root/testdata/sf0.001"
KEPT = ["request_id", "device_id", "batch_id", "arrival_ms", "status", "outcome", "error", "retry_after_s", "accepted_measurements"]


def drain(spark, scratch, limit=1):
    docs = admission.documents_from_files(spark, os.path.join(scratch, "in", "*"), limit)
    query = admission.start_admission(spark, docs, os.path.join(scratch, "tables"), os.path.join(scratch, "ck"))
    assert query.awaitTermination(150)
    return spark.read.parquet(os.path.join(scratch, "tables", "admission"))


def rows(df):
    return sorted(tuple(r[c] for c in KEPT) for r in df.collect())


def test_stream_equals_batch_over_restarts(spark, scratch):
    docs = fixtures.batch_requests(spark, SF).select("request_id", "arrival_ms", "body").persist()
    cuts = docs.approxQuantile("arrival_ms", [0.4, 0.8], 0)
    for k, (low, high) in enumerate(zip([-1, *cuts], [*cuts, 1 << 60], strict=True)):
        part = docs.where((F.col("arrival_ms") > low) & (F.col("arrival_ms") <= high))
        part.coalesce(1).write.parquet(os.path.join(scratch, "in", f"p{k}"))
        out = drain(spark, scratch)  # each time a new query from the same checkpoint
    checked = ingest.process(docs)
    want = ingest.admit(checked, carry=["patient_id"])
    got = rows(out)
    assert got == rows(want) and {r[4] for r in got} == {200, 202, 400, 429}
    accepted = want.where("status = 202").select("request_id")
    events = ingest.explode(checked.join(accepted, "request_id"))
    columns = ["event_id", "device_id", "patient_id", "timestamp", "heart_rate"]
    assert sorted(map(tuple, admission.accepted_events(out).select(*columns).collect())) == sorted(map(tuple, events.select(*columns).collect()))


def body(batch, device="d1"):
    return json.dumps({"device_id": device, "patient_id": "p", "batch_id": batch, "measurements": [{"timestamp": "2026-07-07T12:00:00Z", "heart_rate": 70}]})


def test_release_on_429_and_reservation_across_batches(spark, scratch):
    """Burst of two, the third is told to wait and may come again; a copy is ignored for 24 h, then taken anew."""
    day = 86_400_000
    sent = [[("a", 0, "b1"), ("b", 1, "b2"), ("c", 2, "b3")], [("d", 5_002, "b3"), ("e", 5_003, "b1")], [("f", day - 1, "b2"), ("g", day + 1, "b2"), ("h", day + 2, "b2")]]
    for k, part in enumerate(sent):
        spark.createDataFrame([(r, t, body(b)) for r, t, b in part], admission.DOCUMENTS).coalesce(1).write.parquet(os.path.join(scratch, "in", f"p{k}"))
        out = drain(spark, scratch)
    got = {r.request_id: (r.status, r.retry_after_s) for r in out.collect()}
    assert got == {"a": (202, None), "b": (202, None), "c": (429, 5), "d": (202, None), "e": (200, None), "f": (200, None), "g": (202, None), "h": (200, None)}
    assert admission.accepted_events(out).count() == 4
