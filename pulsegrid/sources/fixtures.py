"""Telemetry-shaped views derived from the driver's ``events`` table.

The driver's tables are not telemetry; these views turn ``events`` into the inputs the operators expect, by
fixed rules, so that every query's work grows with the tables (see FIXTURES.md part B). Every rule here has a
SQL twin in ``pulsegrid.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid import constants as K
from pulsegrid.functions.ids import rfc3339_utc
from pulsegrid.functions.sliced import position_in_group, time_slice
from pulsegrid.sources.tables import events

_MEMO: dict[tuple, DataFrame] = {}


def _memo(fn):
    """Reuse a view's lazy DataFrame definition per (application, table folder): building it again only
    repeats analysis; Spark still computes it from the tables on every action."""
    import functools

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (fn.__name__, spark.sparkContext.applicationId, id(spark), sf_dir)
        if key not in _MEMO:
            _MEMO[key] = fn(spark, sf_dir)
        return _MEMO[key]
    return wrapper


# --- fixed values: fixture rules ------------------------------------------------------------
GRID_BASE_EPOCH = 1783425600  # 2026-07-07T12:00:00Z
GRID_STEP_SECONDS = 5
SEQ_SLICE_SECONDS = 86400  # slices used to number each user's events without a per-user task
MEASURE_STEP_MS = 2000  # request cadence for the token-bucket view


@_memo
def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View ``v``: each user's events renumbered (``seq`` from 1 by ts, event_id) onto a 5 s grid.

    Columns: src_event_id, user_id, event_id, device_id, patient_id, seq, ts, heart_rate.
    Readings of users ``%6 = 0`` are always above the threshold, those of users ``%6 = 3`` for 30 of every 48 readings,
    the rest stay below it.
    """
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id")
    ev = ev.withColumn("_slice", time_slice(F.col("ts"), SEQ_SLICE_SECONDS))
    numbered = position_in_group(ev, ["user_id"], ["ts", "event_id"], "_slice", out="seq").drop("_slice")
    seq, uid = F.col("seq"), F.col("user_id")
    phase = (seq * 3 + uid * 5) % 37
    is_high = (uid % 6 == 0) | ((uid % 6 == 3) & ((seq + uid) % 48 < 30))
    heart_rate = F.when(is_high, F.lit(124) + phase % 19).otherwise(F.lit(56) + (phase * 2 + uid) % 61)
    return numbered.select(
        F.col("event_id").alias("src_event_id"),
        uid,
        F.concat(F.lit("evt-"), F.col("event_id").cast("string")).alias("event_id"),
        F.concat(F.lit("device-"), uid.cast("string")).alias("device_id"),
        F.format_string("patient-%06d", uid).alias("patient_id"),
        seq,
        F.timestamp_seconds(F.lit(GRID_BASE_EPOCH) + seq * GRID_STEP_SECONDS).alias("ts"),
        heart_rate.cast("int").alias("heart_rate"),
    )


@_memo
def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as they arrive at the detector, some more than once: ``v`` (arrival 1); the same reading again
    (``src_event_id % 31 = 0``, arrival 2); a corrected one, 30 lower (``src_event_id % 97 = 0``, arrival 3); and a
    second device of users ``%12 = 0`` that reports every fourth reading at the same time under an own event id.
    Columns: event_id, patient_id, ts, heart_rate, arrival.
    """
    hr, src = F.col("heart_rate"), F.col("src_event_id")

    def row(event_id: Column, heart_rate: Column, arrival: int) -> Column:
        return F.struct(event_id.alias("event_id"), "patient_id", "ts", heart_rate.cast("int").alias("heart_rate"),
                        F.lit(arrival).cast("bigint").alias("arrival"))

    same = F.col("event_id")
    rows = F.array(row(same, hr, 1), F.when(src % 31 == 0, row(same, hr, 2)), F.when(src % 97 == 0, row(same, hr - 30, 3)),
                   F.when((F.col("user_id") % 12 == 0) & (F.col("seq") % 4 == 0),
                          row(F.concat(same, F.lit("-b")), hr, 1)))
    return telemetry(spark, sf_dir).select(F.inline(F.filter(rows, lambda r: r.isNotNull())))


@_memo
def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View ``raw``: Kafka-shaped messages (key, value, topic, partition, offset, high_watermark, timestamp)
    carrying the event JSON, corrupted by ``src_event_id % 50``:
    0 malformed, 1 hr 251, 2 patient_id missing, 3 zone +03:00, 4 hr as string, 5 hr 19, 6 trailing data.
    """
    v = telemetry(spark, sf_dir)
    cls = F.col("src_event_id") % 50
    hr = F.col("heart_rate").cast("string")
    hr_text = (F.when(cls == 1, F.lit("251")).when(cls == 5, F.lit("19"))
               .when(cls == 4, F.concat(F.lit('"'), hr, F.lit('"'))).otherwise(hr))
    ts_text = F.when(cls == 3, F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 3 HOURS"),
                                                      "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00"))
                     ).otherwise(rfc3339_utc(F.col("ts")))
    patient = F.when(cls == 2, F.lit("")).otherwise(
        F.concat(F.lit('"patient_id":"'), F.col("patient_id"), F.lit('",')))
    body = F.concat(F.lit('{"event_id":"'), F.col("event_id"), F.lit('","device_id":"'), F.col("device_id"),
                    F.lit('",'), patient, F.lit('"timestamp":"'), ts_text, F.lit('","heart_rate":'), hr_text,
                    F.lit("}"))
    value = (F.when(cls == 0, F.lit('{"invalid"'))
             .when(cls == 6, F.concat(body, F.lit("{}")))
             .otherwise(body))
    off = F.col("src_event_id")
    return v.select(
        F.col("patient_id").alias("key"),
        value.alias("value"),
        F.lit(K.RAW_TOPIC).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        off.alias("offset"),
        (off + 1 + off % 7).alias("high_watermark"),
        F.col("ts").alias("timestamp"),
    )


@_memo
def telemetry_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The telemetry table as stored: ``v`` plus nullable spo2 (every 10th reading) and temperature (every 15th),
    and ``created_at`` = reading time moved back ``src_event_id % 60`` days (spreads rows over retention).
    Columns: event_id, device_id, patient_id, timestamp, heart_rate, spo2, temperature, created_at, seq,
    src_event_id."""
    v = telemetry(spark, sf_dir)
    seq = F.col("seq")
    return v.select(
        "event_id", "device_id", "patient_id", F.col("ts").alias("timestamp"), "heart_rate",
        F.when(seq % 10 == 0, (F.lit(95) + seq % 5).cast("int")).alias("spo2"),
        F.when(seq % 15 == 0, (F.lit(365) + seq % 5).cast("double") / 10).alias("temperature"),
        F.timestamp_micros(F.unix_micros("ts") - (F.col("src_event_id") % 60) * F.lit(86_400_000_000))
        .alias("created_at"),
        "seq", "src_event_id")


BATCH_RUN_ID = "run1"
LATE_COPY_MS = 25 * 3_600_000  # past the 24 h for which a batch key is reserved


@_memo
def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View ``batches``: each device's readings packed 10 per batch and sent as JSON documents.

    ``arrival_ms = chunk * (1000 + 500 * (user_id % 9))``; chunks with ``chunk % 7 = 3`` are sent twice (second
    copy 1 ms later), those with ``chunk % 14 = 3`` a third time 25 h later; ``chunk % 11 = 5`` carries an unknown top-level field; ``chunk % 13 = 6`` has its first
    two measurements swapped. Columns: request_id, sender, copy, arrival_ms, body, user_id, chunk, n.
    """
    from pulsegrid.operators.ingest import batch_document, pack_batches

    v = telemetry(spark, sf_dir)
    packed = pack_batches(v, BATCH_RUN_ID, carry=("user_id",))
    ms = F.col("measurements")
    n = F.size(ms)
    swapped = F.when((F.col("chunk") % 13 == 6) & (n >= 2),
                     F.concat(F.array(F.element_at(ms, 2), F.element_at(ms, 1)), F.slice(ms, 3, 10))).otherwise(ms)
    body = batch_document(F.col("device_id"), F.col("patient_id"), F.col("batch_id"), swapped)
    body = F.when(F.col("chunk") % 11 == 5, F.regexp_replace(body, "^[{]", '{"note":"x",')).otherwise(body)
    copies = (F.when(F.col("chunk") % 14 == 3, F.array(F.lit(0), F.lit(1), F.lit(2)))
              .when(F.col("chunk") % 7 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    delay = F.when(F.col("copy") == 2, F.lit(LATE_COPY_MS)).otherwise(F.col("copy"))
    return (packed.select(F.col("device_id").alias("sender"), "batch_id", "user_id", "chunk", n.alias("n"),
                          body.alias("body"), F.explode(copies).alias("copy"))
            .select(F.concat(F.col("batch_id"), F.lit("#"), F.col("copy").cast("string")).alias("request_id"),
                    "sender", F.col("copy").cast("int").alias("copy"),
                    (F.col("chunk") * (F.lit(1000) + (F.col("user_id") % 9) * 500) + delay).alias("arrival_ms"),
                    "body", "user_id", "chunk", "n"))


@_memo
def odd_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View ``odd``: one document per event, ``(request_id, body)``, broken by ``event_id % 20``: 0 malformed, 1 trailing
    data, 2 unknown top-level field, 3 unknown field of a measurement, 4 reading as text, 5 an array, 6 no device_id,
    7 empty patient_id, 8 empty batch_id, 9 no measurements, 10 eleven measurements, 11 no timestamp, 12 reading 19,
    13 reading 251, 14 equal times, 15 times running back, 16 a wrong reading behind a wrong order, 17 a null document,
    18 fractions of a second in order, 19 right.
    """
    ev = _ev(spark, sf_dir)
    cls = (F.col("seq") % 20).cast("int")
    hr = (F.col("seq") % 100 + 60).cast("string")

    def m(ts: str, value: Column | str, more: str = "") -> Column:
        value = F.lit(value) if isinstance(value, str) else value
        return F.concat(F.lit('{"timestamp":"2026-07-07T12:00:' + ts + 'Z","heart_rate":'), value, F.lit(more + "}"))

    def several(*ms: Column) -> Column:
        return F.concat_ws(",", *ms)

    ok = m("00", hr)
    ms = (F.when(cls == 3, m("00", hr, ',"x":1')).when(cls == 4, m("00", '"70"')).when(cls == 9, F.lit(""))
          .when(cls == 10, several(*(m(f"{k:02d}", hr) for k in range(11))))
          .when(cls == 11, F.concat(F.lit('{"heart_rate":'), hr, F.lit("}"))).when(cls == 12, m("00", "19")).when(cls == 13, m("00", "251"))
          .when(cls == 14, several(ok, m("00", hr))).when(cls == 15, several(m("05", hr), m("04", hr)))
          .when(cls == 16, several(m("05", hr), m("04", "300"))).when(cls == 18, several(m("00.25", hr), m("00.5", hr), m("00.500001", hr)))
          .otherwise(several(ok, m("05", hr))))
    device = F.when(cls == 6, F.lit("")).otherwise(F.lit('"device_id":"d1",'))
    patient = F.when(cls == 7, F.lit("")).otherwise(F.lit("p1"))
    batch = F.when(cls == 8, F.lit("")).otherwise(F.concat(F.lit("b"), F.col("seq").cast("string")))
    body = F.concat(F.when(cls == 2, F.lit('{"note":"x",')).otherwise(F.lit("{")), device, F.lit('"patient_id":"'), patient,
                    F.lit('","batch_id":"'), batch, F.lit('","measurements":['), ms, F.lit("]}"))
    body = (F.when(cls == 0, F.lit('{"device_id":"d1"')).when(cls == 1, F.concat(body, F.lit("{}")))
            .when(cls == 5, F.concat(F.lit("["), body, F.lit("]"))).when(cls == 17, F.lit("null")).otherwise(body))
    return ev.select(F.concat(F.lit("r"), F.col("seq").cast("string")).alias("request_id"), body.alias("body"))


@_memo
def rate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for the token bucket: every reading of ``v`` is one request of its device, 2 s apart."""
    v = telemetry(spark, sf_dir)
    return v.select("device_id", "seq", ((F.col("seq") - 1) * MEASURE_STEP_MS).alias("arrival_ms"))


# --- metric inputs (values chosen exact in binary so sums do not depend on addition order) --------------

def _ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"),
                                        "user_id", "event_type", "value")


def _pick(options: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


@_memo
def metric_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric observations ``(seq, ts, kind, name, labels, value)``, one per event, by event_type:
    view -> messages counter {status}, click -> commits counter {status}, error -> errors counter {stage} adding
    ``floor(value) - 10`` (negative adds are ignored), signup -> consumer-lag gauge {partition, topic} set to
    ``floor(value)``, purchase -> redis duration histogram {operation} observing ``floor(value * 16) / 1024`` s.
    """
    ev = _ev(spark, sf_dir)
    et, uid, val = F.col("event_type"), F.col("user_id"), F.col("value")
    kind = (F.when(et.isin("view", "click", "error"), F.lit("counter"))
            .when(et == "signup", F.lit("gauge")).otherwise(F.lit("histogram")))
    name = (F.when(et == "view", F.lit("processing_kafka_messages_total"))
            .when(et == "click", F.lit("processing_kafka_commits_total"))
            .when(et == "error", F.lit("processing_errors_total"))
            .when(et == "signup", F.lit("processing_kafka_consumer_lag"))
            .otherwise(F.lit("processing_redis_duration_seconds")))
    labels = (F.when(et == "view", F.create_map(F.lit("status"), _pick(["processed", "dlq", "error"], uid % 3)))
              .when(et == "click", F.create_map(F.lit("status"), _pick(["success", "error"], uid % 2)))
              .when(et == "error", F.create_map(F.lit("stage"),
                                                _pick(["validate", "postgres", "redis", "commit"], uid % 4)))
              .when(et == "signup", F.create_map(F.lit("partition"), (uid % 3).cast("string"),
                                                 F.lit("topic"), F.lit(K.RAW_TOPIC)))
              .otherwise(F.create_map(F.lit("operation"),
                                      _pick(["sliding_window_add", "alert_dedup_reserve"], uid % 2))))
    value = (F.when(et.isin("view", "click"), F.lit(1.0))
             .when(et == "error", F.floor(val) - 10)
             .when(et == "signup", F.floor(val))
             .otherwise(F.floor(val * 16) / 1024)).cast("double")
    return ev.select("seq", "ts", kind.alias("kind"), name.alias("name"), labels.alias("labels"),
                     value.alias("value"), F.to_date("ts").alias("day"))


@_memo
def scraped_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped samples ``(ts, job, name, labels, value)``, event i scraped 2 i seconds after the start.

    ``event_id % 3 > 0``: one sample of processing_kafka_messages_total {instance = user_id % 2, status by user_id % 3};
    the n-th sample of a series is ``((n - 1) % 50 + 1) * (2 + user_id % 3)`` (a restart every 50), and instance 1 is not
    scraped while ``event_id / 400 % 5 = 4``. The others: the 13 buckets of processing_redis_duration_seconds {instance
    = user_id / 2 % 2, operation by user_id % 2}; with m = ``(n - 1) % 40 + 1`` bucket j holds ``2 m (j + 1)`` for the
    first operation and ``m (j + 1)^2`` for the second, and lines with ``(n + j) % 11 = 0`` are missing but for +Inf.
    """
    uid, eid = F.col("user_id"), F.col("seq")
    ev = _ev(spark, sf_dir).select("seq", "user_id", F.floor(eid / 1800).alias("_slice"),
                                   F.timestamp_seconds(F.lit(GRID_BASE_EPOCH) + eid * 2).alias("ts"),
                                   F.when(eid % 3 > 0, F.concat_ws("/", F.lit("c"), (uid % 2).cast("string"), (uid % 3).cast("string")))
                                   .otherwise(F.concat_ws("/", F.lit("h"), (F.floor(uid / 2) % 2).cast("string"), (uid % 2).cast("string"))).alias("_series"))
    ev = ev.where((eid % 3 == 0) | (uid % 2 == 0) | (F.floor(eid / 400) % 5 != 4))
    ev = position_in_group(ev, ["_series"], ["seq"], "_slice", "n")
    instance = F.concat(F.lit("p"), F.split("_series", "/")[1])
    counter = F.struct(F.lit("processing_kafka_messages_total").alias("name"),
                       F.create_map(F.lit("instance"), instance, F.lit("status"), _pick(["processed", "dlq", "error"], uid % 3)).alias("labels"),
                       (((F.col("n") - 1) % 50 + 1) * (uid % 3 + 2)).cast("double").alias("value"))
    m = (F.col("n") - 1) % 40 + 1

    def bucket(j: int, le: str) -> Column:
        row = F.struct(F.lit("processing_redis_duration_seconds_bucket").alias("name"),
                       F.create_map(F.lit("instance"), instance, F.lit("le"), F.lit(le),
                                    F.lit("operation"), _pick(["sliding_window_add", "alert_dedup_reserve"], uid % 2)).alias("labels"),
                       F.when(uid % 2 == 0, m * 2 * (j + 1)).otherwise(m * (j + 1) * (j + 1)).cast("double").alias("value"))
        return row if le == "+Inf" else F.when((F.col("n") + j) % 11 != 0, row)

    les = [*(f"{b:g}" for b in K.HISTOGRAM_BOUNDS), "+Inf"]
    rows = F.when(eid % 3 > 0, F.array(counter)).otherwise(F.filter(F.array(*(bucket(j, le) for j, le in enumerate(les))), lambda r: r.isNotNull()))
    return ev.select("ts", F.lit("processing").alias("job"), F.inline(rows))


@_memo
def up_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``up`` samples per job: view/click events are ingestion scrapes, the rest processing; error means down."""
    ev = _ev(spark, sf_dir)
    return ev.select("seq", "ts",
                     F.when(F.col("event_type").isin("view", "click"), F.lit("ingestion"))
                     .otherwise(F.lit("processing")).alias("job"),
                     F.when(F.col("event_type") == "error", F.lit(0)).otherwise(F.lit(1)).alias("up"))


@_memo
def readiness_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dependency checks: dependency by ``user_id % 3``, failed when the event is an error."""
    ev = _ev(spark, sf_dir)
    return ev.select("ts", _pick(["redis", "kafka", "postgres"], F.col("user_id") % 3).alias("dependency"),
                     (F.col("event_type") != "error").alias("ok"))


@_memo
def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion access log: path by event_type (error -> an unknown path), status by ``seq % 5``."""
    ev = _ev(spark, sf_dir)
    et = F.col("event_type")
    path = (F.when(et == "view", F.lit("/api/v1/telemetry")).when(et == "click", F.lit("/health"))
            .when(et == "signup", F.lit("/ready")).when(et == "purchase", F.lit("/metrics"))
            .otherwise(F.lit("/api/v2/telemetry")))
    method = F.when(et.isin("view", "error"), F.lit("POST")).otherwise(F.lit("GET"))
    status = F.element_at(F.array(*[F.lit(s) for s in (202, 200, 429, 503, 500)]), (F.col("seq") % 5 + 1).cast("int"))
    return ev.select("seq", "ts", method.alias("method"), path.alias("path"), status.alias("status"),
                     F.floor(F.col("value") * 10).cast("bigint").alias("latency_ms"), "event_type")
