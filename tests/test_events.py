"""Event decode + validation: the table-driven cases of the original validator/handler tests, plus JSON edge
cases of the lenient decoder."""

from pyspark.sql import functions as F

from pulsegrid import constants as K
from pulsegrid.operators import events

BASE = {"event_id": "evt-1", "device_id": "device-1", "patient_id": "patient-001",
        "timestamp": "2026-07-07T12:00:00Z", "heart_rate": 78}


def _json(d):
    import json
    return json.dumps(d, separators=(",", ":"))


def _run(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "offset long, value string")
    out = (events.route(events.validate(events.decode(df)))
           .select("offset", "decode_ok", "reason", "route", "dlq_reason", "error", "event_id")
           .orderBy("offset").collect())
    return out


CASES = [
    (BASE, None),
    ({**BASE, "event_id": ""}, K.MSG_EVENT_ID_REQUIRED),
    ({k: v for k, v in BASE.items() if k != "event_id"}, K.MSG_EVENT_ID_REQUIRED),
    ({**BASE, "device_id": ""}, K.MSG_DEVICE_ID_REQUIRED),
    ({**BASE, "patient_id": ""}, K.MSG_PATIENT_ID_REQUIRED),
    ({**BASE, "timestamp": "0001-01-01T00:00:00Z"}, K.MSG_TIMESTAMP_REQUIRED),
    ({k: v for k, v in BASE.items() if k != "timestamp"}, K.MSG_TIMESTAMP_REQUIRED),
    ({**BASE, "timestamp": "2026-07-07T15:00:00+03:00"}, K.MSG_TIMESTAMP_NOT_UTC),
    ({**BASE, "timestamp": "2026-07-07T12:00:00+00:00"}, None),
    ({**BASE, "heart_rate": 19}, K.MSG_HR_TOO_LOW),
    ({**BASE, "heart_rate": 20}, None),
    ({**BASE, "heart_rate": 250}, None),
    ({**BASE, "heart_rate": 251}, K.MSG_HR_TOO_HIGH),
    ({**BASE, "spo2": 98, "temperature": 36.6, "extra": {"x": [1]}}, None),
    ({**BASE, "event_id": "", "heart_rate": 300}, K.MSG_EVENT_ID_REQUIRED),  # first failing rule wins
]


def test_validation_rules(spark):
    rows = _run(spark, [_json(doc) for doc, _ in CASES])
    for row, (doc, reason) in zip(rows, CASES):
        assert row.decode_ok, doc
        assert row.reason == reason, doc
        assert row.route == ("store" if reason is None else "dlq")


def test_spo2_that_no_column_holds_is_a_dead_letter(spark):
    import json
    texts = [json.dumps({**BASE, "spo2": v}) for v in (98, (1 << 31) - 1, 1 << 31, 3_000_000_000)]
    rows = _run(spark, texts)
    assert [r.route for r in rows] == ["store", "store", "dlq", "dlq"]
    assert [r.reason for r in rows] == [None, None, K.MSG_SPO2_RANGE, K.MSG_SPO2_RANGE]


DECODE_ERRORS = [
    '{"invalid"', '{"event_id":"e"}{}', '[1]', '"text"', "12",
    '{"heart_rate":"78"}', '{"heart_rate":78.5}', '{"heart_rate":78.0}', '{"heart_rate":1e2}',
    '{"event_id":5}', '{"timestamp":"2026-07-07 12:00:00"}', '{"timestamp":"2026-07-07"}',
    '{"timestamp":12}', '{"spo2":"98"}', '{"temperature":"x"}', '', '{"heart_rate":123456789012345678901}',
]


def test_decode_errors(spark):
    for row, text in zip(_run(spark, DECODE_ERRORS), DECODE_ERRORS):
        assert not row.decode_ok, text
        assert row.dlq_reason == "decode"
        assert row.error.startswith(K.MSG_DECODE)


def test_null_document_is_zero_event(spark):
    row = _run(spark, ["null"])[0]
    assert row.decode_ok and row.reason == K.MSG_EVENT_ID_REQUIRED


def test_duplicate_keys_last_wins(spark):
    row = _run(spark, ['{"event_id":"a","event_id":"b","device_id":"d","patient_id":"p",'
                       '"timestamp":"2026-07-07T12:00:00Z","heart_rate":80}'])[0]
    assert row.decode_ok and row.event_id == "b" and row.reason is None


def test_dlq_envelope_and_headers(spark):
    import base64
    import datetime as dt
    import json
    df = spark.createDataFrame([("patient-1", '{"invalid"', "telemetry.raw", 2, 41)],
                               "key string, value string, topic string, partition int, offset long")
    rec = events.dlq_records(events.process(df), dt.datetime(2026, 7, 8, tzinfo=dt.timezone.utc)).collect()[0]
    env = json.loads(rec.value)
    assert list(env) == ["reason", "timestamp", "source_topic", "source_partition", "source_offset", "payload_base64"]
    assert env["source_partition"] == 2 and env["source_offset"] == 41 and env["timestamp"] == "2026-07-08T00:00:00Z"
    assert base64.b64decode(env["payload_base64"]).decode() == '{"invalid"'
    assert rec.key == "patient-1"
    hdr = {h.key: bytes(h.value).decode() for h in rec.headers}
    assert hdr == {"source_topic": "telemetry.raw", "source_partition": "2", "source_offset": "41",
                   "reason": env["reason"]}


def test_base64_is_not_chunked(spark):
    long_value = '{"event_id":"' + "x" * 300 + '"'
    df = spark.createDataFrame([("k", long_value, "t", 0, 1)],
                               "key string, value string, topic string, partition int, offset long")
    rec = events.dlq_records(events.process(df)).collect()[0]
    assert "\n" not in rec.payload_base64 and "\r" not in rec.payload_base64


def test_consumer_lag(spark):
    df = spark.createDataFrame([("t", 0, 40, 45), ("t", 0, 42, 45), ("t", 1, 7, 0)],
                               "topic string, partition int, offset long, high_watermark long")
    rows = {r.partition: r.lag for r in events.consumer_lag(df).collect()}
    assert rows == {0: 2}


def test_event_message_json(spark):
    import datetime as dt
    df = spark.createDataFrame([("e1", "d1", "p1", dt.datetime(2026, 7, 7, 12, 0, 5), 78)],
                               "event_id string, device_id string, patient_id string, timestamp timestamp, heart_rate int")
    rec = events.event_messages(df).collect()[0]
    assert rec.key == "p1"
    assert rec.value == ('{"event_id":"e1","device_id":"d1","patient_id":"p1",'
                         '"timestamp":"2026-07-07T12:00:05Z","heart_rate":78}')
    assert F is not None
