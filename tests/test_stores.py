"""Stores, list queries, retention (the original repository integration cases on DataFrames)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import alerts, store

BASE = dt.datetime(2026, 7, 7, 12, 0, 0)


def _telemetry(spark):
    rows = [("e1", "d1", "p1", BASE - dt.timedelta(seconds=1), 70, None, None, BASE),
            ("e2", "d1", "p1", BASE, 71, 98, 36.6, BASE),
            ("e3", "d1", "p1", BASE + dt.timedelta(seconds=1), 72, None, None, BASE),
            ("e4", "d1", "p1", BASE + dt.timedelta(seconds=2), 73, None, None, BASE),
            ("e5", "d2", "p2", BASE, 74, None, None, BASE)]
    return spark.createDataFrame(rows, "event_id string, device_id string, patient_id string, timestamp timestamp, "
                                       "heart_rate int, spo2 int, temperature double, created_at timestamp")


def test_inclusive_range_and_patient(spark):
    flt = store.ListFilter(patient_id="p1", from_="2026-07-07T11:59:59Z", to="2026-07-07T12:00:01Z")
    got = sorted(r.event_id for r in store.filter_range(_telemetry(spark), flt, "timestamp").collect())
    assert got == ["e1", "e2", "e3"]


def test_list_newest_first_with_limit_and_nullable(spark):
    rows = store.list_telemetry(_telemetry(spark), store.ListFilter(patient_id="p1", limit=2)).collect()
    assert [r.event_id for r in rows] == ["e4", "e3"]
    full = {r.event_id: r for r in store.list_telemetry(_telemetry(spark), store.ListFilter()).collect()}
    assert full["e2"].spo2 == 98 and full["e1"].spo2 is None


def test_limit_normalisation_and_parse_errors():
    assert store.normalize_limit(0) == 100 and store.normalize_limit(-1) == 100
    assert store.normalize_limit(5000) == 1000 and store.normalize_limit(7) == 7
    assert store.ListFilter.parse({"patient_id": "q"}, "p").patient_id == "p"
    for bad in ({"limit": "-1"}, {"limit": "x"}, {"from": "yesterday"}, {"to": "2026-07-07"}):
        with pytest.raises(ValueError, match="invalid_query"):
            store.ListFilter.parse(bad)


def test_insert_if_absent_first_wins(spark):
    incoming = spark.createDataFrame([("e1", 1, 70), ("e1", 2, 99), ("e9", 1, 80)],
                                     "event_id string, arrival int, heart_rate int")
    target = spark.createDataFrame([("e9",)], "event_id string")
    rows = alerts.insert_if_absent(incoming, target, "event_id", ["arrival"]).collect()
    assert [(r.event_id, r.heart_rate) for r in rows] == [("e1", 70)]


def test_retention_31_vs_30_days(spark):
    now = dt.datetime(2026, 7, 8, tzinfo=dt.timezone.utc)
    df = spark.createDataFrame([("old", dt.datetime(2026, 6, 7)), ("new", dt.datetime(2026, 6, 9))],
                               "event_id string, created_at timestamp")
    kept, dropped = store.retention_split(df, now)
    assert [r.event_id for r in kept.collect()] == ["new"]
    assert [r.event_id for r in dropped.collect()] == ["old"]


def test_recent_alert_semi_interval(spark):
    det = spark.createDataFrame(
        [("d1", "p1", "HIGH_HEART_RATE", BASE), ("d2", "p1", "HIGH_HEART_RATE", BASE + dt.timedelta(seconds=400)),
         ("d3", "p2", "HIGH_HEART_RATE", BASE)],
        "event_id string, patient_id string, alert_type string, triggered_at timestamp")
    table = spark.createDataFrame([("p1", "HIGH_HEART_RATE", BASE - dt.timedelta(seconds=299))],
                                  "patient_id string, alert_type string, created_at timestamp")
    got = [r.event_id for r in alerts.recent_alert_semi(det, table).collect()]
    assert got == ["d1"]
    assert F is not None


def test_apply_retention_on_partitioned_table(spark, scratch):
    import os
    path = os.path.join(scratch, "telemetry")
    rows = [("a", dt.datetime(2026, 6, 1), dt.date(2026, 6, 1)), ("b", dt.datetime(2026, 6, 8, 23), dt.date(2026, 6, 8)),
            ("c", dt.datetime(2026, 6, 8, 1), dt.date(2026, 6, 8)), ("d", dt.datetime(2026, 7, 1), dt.date(2026, 7, 1))]
    spark.createDataFrame(rows, "event_id string, created_at timestamp, event_date date") \
        .write.partitionBy("event_date").parquet(path)
    removed = store.apply_retention(spark, path, dt.datetime(2026, 7, 8, 12, tzinfo=dt.timezone.utc), "event_date")
    assert removed == 2
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == ["b", "d"]


def test_tables_and_additive_dedup_key(spark, scratch):
    import os
    store.create_tables(spark, scratch)
    assert store.read_declared(spark, os.path.join(scratch, "telemetry"), store.TELEMETRY_SCHEMA).count() == 0
    path = os.path.join(scratch, "alerts_old")
    old = spark.createDataFrame([("p1", "HIGH_HEART_RATE", BASE, BASE)],
                                "patient_id string, alert_type string, detected_at timestamp, created_at timestamp")
    old.write.parquet(os.path.join(path, "part=old"))
    new = spark.createDataFrame([("p2:HIGH_HEART_RATE:7", "p2", "HIGH_HEART_RATE", BASE, BASE)],
                                "dedup_key string, patient_id string, alert_type string, detected_at timestamp, "
                                "created_at timestamp")
    new.write.parquet(os.path.join(path, "part=new"))
    rows = {r.patient_id: (r.dedup_key, r.backfilled) for r in store.read_alerts(spark, path).collect()}
    b = int(BASE.replace(tzinfo=dt.timezone.utc).timestamp()) // 300
    assert rows == {"p1": (f"p1:HIGH_HEART_RATE:{b}", True), "p2": ("p2:HIGH_HEART_RATE:7", False)}


def _stored(spark, path, rows):
    """rows: (event_id, created_at)"""
    spark.createDataFrame([(e, t, t.date()) for e, t in rows], "event_id string, created_at timestamp, created_date date") \
        .write.mode("append").partitionBy("created_date").parquet(path)


SMALL = "event_id string, created_at timestamp, created_date date"
NOW = dt.datetime(2026, 7, 8, 12, tzinfo=dt.timezone.utc)  # the cutoff is 2026-06-08 12:00


def test_expire_beside_a_writer(spark, scratch, monkeypatch):
    """A row stored while retention has read the old days, and before it puts them back, is kept; so is its late repeat."""
    import os
    path = os.path.join(scratch, "telemetry")
    _stored(spark, path, [("a", dt.datetime(2026, 6, 1)), ("b", dt.datetime(2026, 6, 8, 11, 59, 59)), ("c", dt.datetime(2026, 6, 8, 12)),
                          ("d", dt.datetime(2026, 6, 9)), ("e", dt.datetime(2026, 7, 8))])
    replace = store._replace_day

    def between(survivors, where):
        _stored(spark, path, [("f", dt.datetime(2026, 7, 8, 12))])
        replace(survivors, where)

    monkeypatch.setattr(store, "_replace_day", between)
    assert store.expire(spark, path, SMALL, NOW) == 2
    monkeypatch.undo()
    assert sorted(r.event_id for r in spark.read.schema(SMALL).parquet(path).collect()) == ["c", "d", "e", "f"]
    assert store.expire(spark, path, SMALL, NOW) == 0


def test_expire_empty_and_whole_days(spark, scratch):
    import os
    store.create_tables(spark, scratch)
    for name, schema in (("telemetry", store.TELEMETRY_SCHEMA), ("alerts", store.ALERTS_SCHEMA)):
        assert store.expire(spark, os.path.join(scratch, name), schema, NOW) == 0
        assert store.apply_retention(spark, os.path.join(scratch, name), NOW, "created_date") == 0
    assert store.expire(spark, os.path.join(scratch, "nowhere"), SMALL, NOW) == 0
    assert store.read_alerts(spark, os.path.join(scratch, "alerts")).count() == 0
    path = os.path.join(scratch, "t")
    _stored(spark, path, [("a", dt.datetime(2026, 6, 8, 1)), ("b", dt.datetime(2026, 5, 1)), ("c", dt.datetime(2026, 7, 1))])
    assert store.expire(spark, path, SMALL, NOW) == 2
    assert [r.event_id for r in spark.read.schema(SMALL).parquet(path).collect()] == ["c"]
