"""Whole-millisecond bucket and admission: composed maps and hour slices equal plain ordered folds."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.functions.bucket import LevelMap, applied
from pulsegrid.operators import admission

FULL, TOKEN = 10_000, 5_000


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 4), st.integers(1, 40), st.lists(st.tuples(st.integers(0, 60), st.booleans()), max_size=40))
def test_level_map_is_the_fold(capacity, interval, steps):
    m, levels = LevelMap(interval, capacity), list(range(capacity * interval + 1))
    for elapsed, takes in steps:
        m.refill(elapsed)
        levels = [min(capacity * interval, x + elapsed) for x in levels]
        if takes:
            m.take()
            levels = [x - interval if x >= interval else x for x in levels]
    parts = list(zip(*m.pieces, strict=True))
    assert [applied(*parts, x) for x in range(capacity * interval + 1)] == levels
    assert len(m.pieces) <= 4 * capacity + 4  # however many requests


def plain_bucket(times):
    level, since, out = FULL, None, []
    for now in times:
        level = min(FULL, level + (now - since if since is not None else 0))
        since = now
        out.append((level >= TOKEN, max(0, TOKEN - level)))
        level -= TOKEN if level >= TOKEN else 0
    return out


def plain_admission(requests):
    """requests of one device, (request_id, batch_id, ms), in order."""
    level, since, reserved, out = FULL, None, {}, {}
    for rid, bid, now in requests:
        if bid in reserved and now - reserved[bid] < 86_400_000:
            out[rid] = (200, None)
            continue
        level = min(FULL, level + (now - since if since is not None else 0))
        since = now
        if level >= TOKEN:
            level, reserved[bid] = level - TOKEN, now
            out[rid] = (202, None)
        else:
            reserved.pop(bid, None)
            out[rid] = (429, max(1, -(-(TOKEN - level) // 1000)))
    return out


@settings(max_examples=6, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 999, 2000, 2500, 4999, 5000, 10_000, 1_200_000, 3_600_000, 40_000_000]), min_size=1, max_size=60), st.integers(0, 2000))
def test_rate_limit_equals_the_fold(spark, gaps, start):
    times = [start + sum(gaps[:k + 1]) for k in range(len(gaps))]
    df = spark.createDataFrame([("d1", k, t) for k, t in enumerate(times)] + [("d2", k, 7) for k in range(4)], "device_id string, seq long, arrival_ms long")
    got = {(r.device_id, r.seq): (r.allowed, r.retry_after_ms) for r in admission.rate_limit_ms(df).collect()}
    want = {("d1", k): x for k, x in enumerate(plain_bucket(times))} | {("d2", k): x for k, x in enumerate(plain_bucket([7] * 4))}
    assert got == want


def test_a_device_that_never_pauses_is_spread_over_slices(spark):
    """A third of the requests from one device, never idle for long: every hour its own group, and the same answers."""
    rng = random.Random(4)
    times = [0]
    while times[-1] < 20 * 3_600_000:
        times.append(times[-1] + rng.randrange(500, 9_000))
    df = spark.createDataFrame([("hot", k, t) for k, t in enumerate(times)], "device_id string, seq long, arrival_ms long")
    got = [(r.allowed, r.retry_after_ms) for r in admission.rate_limit_ms(df).orderBy("seq").collect()]
    assert got == plain_bucket(times)
    assert df.groupBy(admission._slice_of(F.col("arrival_ms"))).count().count() >= 20


def outcomes(spark, requests):
    df = spark.createDataFrame([(r, "d", b, t, True, None, 1) for r, b, t in requests],
                               "request_id string, device_id string, batch_id string, arrival_ms long, decode_ok boolean, reason string, n int")
    return {r.request_id: (r.status, r.retry_after_s) for r in admission.admit_ms(df).collect()}


def test_admission_equals_the_fold(spark):
    """Copies within and past 24 h, retries of rejected batches, bursts over hour borders, days without a long pause."""
    rng = random.Random(11)
    requests, now = [], 0
    for k in range(900):
        now += rng.choice([0, 1, 400, 2_000, 4_000, 5_000, 9_000, 9_000, 60_000, 900_000, 3_000_000])
        bid = f"b{rng.randrange(max(1, k - 12), k + 1)}" if rng.random() < 0.5 else f"b{rng.randrange(60)}"
        requests.append((f"r{k:04d}", bid, now))
    want = plain_admission(requests)
    assert outcomes(spark, requests) == want
    assert {s for s, _ in want.values()} == {200, 202, 429}


def test_a_wrong_guess_travels_over_slices(spark):
    """Rejected first copies: every hour's guess depends on how the hour before really ended."""
    requests = []
    for h in range(6):
        end = (h + 1) * 3_600_000
        # three at once: the third is rejected, and comes again in the next hour as if it were a copy
        requests += [(f"x{h}", f"x{h}", end - 3), (f"y{h}", f"y{h}", end - 2), (f"z{h}", f"z{h}", end - 1), (f"z{h}+", f"z{h}", end + 1), (f"z{h}++", f"z{h}", end + 5_000)]
    requests.sort(key=lambda r: (r[2], r[0]))
    assert outcomes(spark, requests) == plain_admission(requests)


def test_rejected_documents_and_no_requests(spark):
    schema = "request_id string, device_id string, batch_id string, arrival_ms long, decode_ok boolean, reason string, n int, extra string"
    df = spark.createDataFrame([("a", None, None, 5, False, None, 0, "p"), ("b", "d", "x", 6, True, "no", 1, None), ("c", "d", "x", 6, True, None, 3, "q")], schema)
    got = {r.request_id: (r.status, r.outcome, r.error, r.accepted_measurements, r.extra) for r in admission.admit_ms(df, carry=["extra"]).collect()}
    assert got == {"a": (400, "invalid_batch", "invalid JSON body", 0, "p"), "b": (400, "invalid_batch", "no", 0, None), "c": (202, "accepted", None, 3, "q")}
    assert admission.admit_ms(df.limit(0)).count() == 0
