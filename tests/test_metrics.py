"""Metric aggregation and exposition (the original registry/consumer test cases) + number formatting."""

import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.operators import metrics

T0 = dt.datetime(2026, 7, 7, 12, 0, 0)


def _obs(spark, rows):
    return spark.createDataFrame([(i, T0 + dt.timedelta(seconds=i), k, n, l, float(v))
                                  for i, (k, n, l, v) in enumerate(rows)],
                                 "seq long, ts timestamp, kind string, name string, labels map<string,string>, value double")


def test_registry_text(spark):
    obs = _obs(spark, [
        ("counter", "processing_kafka_messages_total", {"status": "processed"}, 1),
        ("counter", "processing_kafka_messages_total", {"status": "processed"}, -5),
        ("gauge", "processing_kafka_consumer_lag", {"topic": "telemetry.raw", "partition": "0"}, 7),
        ("gauge", "processing_kafka_consumer_lag", {"topic": "telemetry.raw", "partition": "0"}, 42),
        ("histogram", "processing_processing_duration_seconds", {}, 0.12),
    ])
    lines = [r.line for r in metrics.exposition(spark, obs).orderBy("name", "section", "labels_key", "ord").collect()]
    assert 'processing_kafka_messages_total{status="processed"} 1' in lines
    assert 'processing_kafka_consumer_lag{partition="0",topic="telemetry.raw"} 42' in lines
    assert 'processing_processing_duration_seconds_bucket{le="0.1"} 0' in lines
    assert 'processing_processing_duration_seconds_bucket{le="0.25"} 1' in lines
    assert 'processing_processing_duration_seconds_bucket{le="+Inf"} 1' in lines
    assert "processing_processing_duration_seconds_sum 0.12" in lines
    assert "processing_processing_duration_seconds_count 1" in lines
    assert lines[0].startswith("# HELP processing_alerts_created_total")
    assert sum(1 for x in lines if x.startswith("# TYPE")) == 10


def test_label_escaping(spark):
    df = spark.createDataFrame([({"b": 'x"y', "a": "l\\n"},)], "labels map<string,string>")
    r = df.select(metrics.render_labels(F.col("labels")).alias("t"), metrics.labels_key(F.col("labels")).alias("k")).first()
    assert r.t == '{a="l\\\\n",b="x\\"y"}'
    assert r.k == 'a=l\\n,b=x"y'


def test_float_text(spark):
    vals = [0.0, 1.0, 42.0, 0.12, 1234567.5, 1e6, 0.0001, 0.00001234, -2.5, float("nan"), float("inf"),
            1e-20, 3e-19, 1e20, 1.234567890123e-05, -1e100, 100000.0, 123456.75, 0.00123, 1.5e300, 1000.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.t for r in df.select(metrics.go_float_text(F.col("v")).alias("t")).collect()]
    assert got == ["0", "1", "42", "0.12", "1.2345675e+06", "1e+06", "0.0001", "1.234e-05", "-2.5", "0", "0",
                   "1e-20", "3e-19", "1e+20", "1.234567890123e-05", "-1e+100", "100000", "123456.75", "0.00123",
                   "1.5e+300", "1000"]


def test_quantile_interpolation(spark):
    df = spark.createDataFrame([([0, 0, 0, 0, 0, 0, 10, 10, 10, 10, 10, 10], 10), ([0] * 12, 4)],
                               "buckets array<long>, count long")
    got = [r.q for r in df.select(metrics.quantile_from_buckets(0.95, F.col("buckets"), F.col("count")).alias("q")).collect()]
    assert abs(got[0] - (0.1 + 0.15 * 9.5 / 10)) < 1e-12
    assert got[1] == 10.0


def test_rate_reset_aware(spark):
    s = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), i, "c", "", float(v))
                               for i, (s, v) in enumerate([(0, 5), (10, 8), (20, 2), (30, 4)])],
                              "ts timestamp, seq long, name string, labels_key string, value double")
    r = metrics.rate(s).collect()
    assert len(r) == 1 and abs(r[0].rate - (5 + 3 + 2 + 2) / 60) < 1e-6


def test_write_exposition_in_order(spark, scratch):
    import glob
    import os
    obs = _obs(spark, [
        ("counter", "processing_errors_total", {"stage": "redis"}, 2),
        ("counter", "processing_errors_total", {"stage": "postgres"}, 1),
        ("gauge", "processing_kafka_consumer_lag", {"topic": "t", "partition": "1"}, 3),
    ])
    path = os.path.join(scratch, "metrics")
    metrics.write_exposition(metrics.exposition(spark, obs), path)
    lines = []
    for f in sorted(glob.glob(os.path.join(path, "part-*"))):
        lines += open(f).read().splitlines()
    names = [ln.split()[2] if ln.startswith("#") else ln.split("{")[0].split(" ")[0] for ln in lines]
    assert names == sorted(names)
    i = lines.index("# TYPE processing_errors_total counter")
    assert lines[i + 1:i + 3] == ['processing_errors_total{stage="postgres"} 1', 'processing_errors_total{stage="redis"} 2']
