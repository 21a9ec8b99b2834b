"""Look-back rates and bucket quantiles over scraped samples against plain loops."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.sliced import chained
from pulsegrid.operators import scraped

BASE = dt.datetime(2026, 7, 7, 23, 50, tzinfo=dt.timezone.utc)
SCHEMA = "ts timestamp, job string, name string, labels map<string,string>, value double"


def frame(spark, rows):
    return spark.createDataFrame([(BASE + dt.timedelta(seconds=s), "j", name, labels, float(v)) for s, name, labels, v in rows], SCHEMA)


def plain_rate(points, at, width):
    """points: (seconds, value) of one series, ascending."""
    inside = [p for p in points if at - width < p[0] <= at]
    if len(inside) < 2:
        return None
    inc = sum(b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:]))
    sampled = inside[-1][0] - inside[0][0]
    step = sampled / (len(inside) - 1)
    start, end = inside[0][0] - (at - width), at - inside[-1][0]
    if inc > 0 and inside[0][1] >= 0:
        start = min(start, sampled * inside[0][1] / inc)
    return inc * (sampled + (start if start < 1.1 * step else step / 2) + (end if end < 1.1 * step else step / 2)) / sampled / width


@pytest.mark.parametrize("seed", [1, 2])
def test_rate_equals_plain_windows(spark, seed):
    """Resets, gaps longer than the look-back, samples on window borders, an hour border, one sample alone."""
    rng = random.Random(seed)
    series, rows = {}, []
    for k in range(4):
        t, v, points = rng.randrange(60), rng.randrange(5), []
        for _ in range(80):
            points.append((t, v))
            t += rng.choice([1, 5, 10, 15, 15, 15, 30, 60, 61, 400])
            v = rng.randrange(3) if rng.random() < 0.1 else v + rng.randrange(20)
        series[f"i={k}"] = points
        rows += [(t, "c", {"i": str(k)}, v) for t, v in points]
    rows += [(5, "c", {"i": "alone"}, 3), (rows[0][0], "c", {"i": "0"}, -1)]  # a second value at one time: the larger counts
    got = {(r.labels_key, round(r.eval_ts.timestamp() - BASE.timestamp())): r.rate for r in scraped.rate(frame(spark, rows), 60, 15).collect()}
    want = {}
    for key, points in series.items():
        for at in range(0, points[-1][0] + 120, 15):
            r = plain_rate(points, at, 60)
            if r is not None:
                want[key, at] = r
    assert got.keys() == want.keys() and len(want) > 200
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-12) for k in want)


def test_chained_equals_one_pass(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(5)}", p, rng.randrange(100)) for p in rng.sample(range(100_000), 1500)]
    df = spark.createDataFrame(rows, "k string, p long, v long").withColumn("v", F.col("v").cast("double"))
    got = {(r.k, r.p): (r.prev_p, r.next_p, r.seq, r.total) for r in chained(df.withColumn("s", F.floor(F.col("p") / 700)), ["k"], "p", "v", "s").collect()}
    want = {}
    for key in {r[0] for r in rows}:
        mine, total = sorted((p, v) for k, p, v in rows if k == key), 0.0
        for i, (p, v) in enumerate(mine):
            if i:
                total += v - mine[i - 1][1] if v >= mine[i - 1][1] else v
            want[key, p] = (mine[i - 1][0] if i else None, mine[i + 1][0] if i + 1 < len(mine) else None, i + 1, total)
    assert got == want


def test_quantile_search(spark):
    inf = math.inf
    cases = [([1.0, 2.0, inf], [5.0, 10.0, 10.0], 0.5, 1.0), ([1.0, 2.0, inf], [5.0, 10.0, 10.0], 0.75, 1.5), ([1.0, 2.0, inf], [2.0, 1.0, 4.0], 0.9, 2.0),
             ([1.0, 2.0, inf], [0.0, 0.0, 0.0], 0.9, None), ([1.0, 2.0], [1.0, 2.0], 0.9, None), ([inf], [4.0], 0.9, None),
             ([-1.0, 2.0, inf], [4.0, 4.0, 4.0], 0.5, -1.0), ([1.0, 2.0, inf], [3.0, 2.0, 6.0], 0.5, 1.0)]  # a dip is raised to the bucket below
    for les, counts, q, want in cases:
        df = spark.createDataFrame([(les, counts)], "les array<double>, counts array<double>")
        assert df.select(scraped.quantile_of_buckets(q, F.col("les"), F.col("counts")).alias("x")).first().x == want, (les, counts, q)


def test_bucket_quantile_sums_instances_and_skips_other_series(spark):
    rows = []
    for inst in "ab":
        for s in range(0, 301, 30):
            n = s // 30 + 1
            rows += [(s, "h_bucket", {"operation": "x", "instance": inst, "le": le}, n * c) for le, c in (("0.1", 2), ("0.5", 3), ("+Inf", 4))]
            rows.append((s, "h_count", {"operation": "x", "instance": inst}, 4 * n))
    got = [r for r in scraped.bucket_quantile(frame(spark, rows), 0.5, lookback=120, step=60).collect() if round(r.eval_ts.timestamp() - BASE.timestamp()) == 240]
    assert len(got) == 1 and got[0].operation == "x" and math.isclose(got[0].quantile, 0.1) and math.isclose(got[0].rate, 2 * 4 / 30)
    assert scraped.bucket_quantile(frame(spark, rows).limit(0)).count() == 0


def test_rate_sorts_its_samples_once_and_never_hashes_them(spark):
    rows = [(s, "m", {"le": str(s % 3)}, float(s)) for s in range(0, 600, 5)]
    rows += [(300, "m", {"le": "0"}, 1.0), (300, "m", {"le": "0"}, 1e9)]  # of samples at one time the largest counts
    samples = frame(spark, rows)
    got = scraped.rate(samples, lookback=120, step=60)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "BroadcastHashJoin" not in plan
    top = {(r.labels["le"], r.eval_ts): r.rate for r in got.collect()}
    without = scraped.rate(samples.where("value not in (1.0, 300.0)"), lookback=120, step=60)
    assert top == {(r.labels["le"], r.eval_ts): r.rate for r in without.collect()} and len(top) > 20
    assert max(top.values()) > 1e6
