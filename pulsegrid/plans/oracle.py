"""DuckDB SQL twins of the fixture views and queries (the correctness oracle).

Each query's SQL is self-contained: the views it needs are inlined as CTEs over the driver's base tables.
"""

from __future__ import annotations

from pulsegrid import constants as K

HR_T = K.HIGH_HR_THRESHOLD
MSG = K.ALERT_MESSAGE_HIGH_HR
TYPE = K.ALERT_TYPE_HIGH_HR

# --- views ------------------------------------------------------------------------------------

V = """
v AS (
  SELECT event_id AS src_event_id, user_id,
         'evt-' || CAST(event_id AS VARCHAR) AS event_id,
         'device-' || CAST(user_id AS VARCHAR) AS device_id,
         printf('patient-%06d', user_id) AS patient_id,
         seq,
         TIMESTAMP '2026-07-07 12:00:00' + to_seconds(seq * 5) AS ts,
         CAST(CASE WHEN user_id % 6 = 0 OR (user_id % 6 = 3 AND (seq + user_id) % 48 < 30)
                   THEN 124 + (seq * 3 + user_id * 5) % 37 % 19
                   ELSE 56 + ((seq * 3 + user_id * 5) % 37 * 2 + user_id) % 61 END AS INTEGER) AS heart_rate
  FROM (SELECT event_id, ts, user_id,
               CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS seq
        FROM events) e
)"""

WSTATS = """
deliv AS (
  SELECT event_id, patient_id, ts, heart_rate, 1 AS arrival FROM v
  UNION ALL SELECT event_id, patient_id, ts, heart_rate, 2 FROM v WHERE src_event_id % 31 = 0
  UNION ALL SELECT event_id, patient_id, ts, heart_rate - 30, 3 FROM v WHERE src_event_id % 97 = 0
  UNION ALL SELECT event_id || '-b', patient_id, ts, heart_rate, 1 FROM v WHERE user_id % 12 = 0 AND seq % 4 = 0
),
latest AS (
  SELECT event_id, patient_id, ts, heart_rate
  FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, event_id ORDER BY arrival DESC) AS rn FROM deliv) d
  WHERE rn = 1
),
wstats AS (
  SELECT *,
         CAST(count(*) OVER w AS BIGINT) AS window_events,
         min(heart_rate) OVER w AS window_min_hr,
         max(heart_rate) OVER w AS window_max_hr,
         CAST(sum(heart_rate) OVER w AS BIGINT) AS window_sum_hr,
         min(ts) OVER w AS window_first_ts
  FROM latest
  WINDOW w AS (PARTITION BY patient_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW)
)"""

DET = f"""
det AS (
  SELECT event_id, patient_id, '{TYPE}' AS alert_type, '{MSG}' AS message, ts AS triggered_at,
         window_events, CAST(window_min_hr AS INTEGER) AS window_min_hr
  FROM wstats
  WHERE heart_rate > {HR_T} AND window_min_hr > {HR_T} AND ts - window_first_ts >= INTERVAL 60 SECONDS
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def sql_dedup_key(patient: str, typ: str, ts: str) -> str:
    return f"{patient} || ':' || {typ} || ':' || CAST(CAST(floor(epoch({ts}) / 300) AS BIGINT) AS VARCHAR)"


ORACLES: dict[str, str] = {}

ORACLES["detect_sustained"] = with_(V, WSTATS, DET) + "SELECT * FROM det"


def with_recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",".join(ctes) + "\n"


KEYED = f"""
keyed AS (SELECT *, {sql_dedup_key('patient_id', 'alert_type', 'triggered_at')} AS dedup_key FROM det)"""

BKT = """
bkt AS (
  SELECT dedup_key, patient_id, alert_type, triggered_at AS detected_at, event_id
  FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY triggered_at, event_id) AS rn FROM keyed) k
  WHERE rn = 1
)"""

ATAB = """
atab AS (SELECT patient_id, alert_type, dedup_key, detected_at, detected_at + INTERVAL 2 SECONDS AS created_at FROM bkt)"""

PARTIAL = """
partial AS (SELECT * FROM atab WHERE CAST(floor(epoch(detected_at) / 300) AS BIGINT) % 4 <> 0)"""

COOLDOWN = """
cd_e AS (
  SELECT patient_id, alert_type, event_id, triggered_at,
         min(triggered_at) OVER (PARTITION BY patient_id, alert_type ORDER BY triggered_at
                                 RANGE BETWEEN INTERVAL 300 SECONDS FOLLOWING AND UNBOUNDED FOLLOWING) AS nx,
         row_number() OVER (PARTITION BY patient_id, alert_type ORDER BY triggered_at) AS rn
  FROM (SELECT patient_id, alert_type, triggered_at, min(event_id) AS event_id FROM det
        GROUP BY patient_id, alert_type, triggered_at) d
),
cd AS (
  SELECT patient_id, alert_type, event_id, triggered_at, nx FROM cd_e WHERE rn = 1
  UNION ALL
  SELECT e.patient_id, e.alert_type, e.event_id, e.triggered_at, e.nx
  FROM cd c JOIN cd_e e ON e.patient_id = c.patient_id AND e.alert_type = c.alert_type AND e.triggered_at = c.nx
)"""

ALERT_VIEW = f"""
aview AS (
  SELECT patient_id, alert_type AS type,
         CASE WHEN alert_type = '{TYPE}' THEN '{MSG}' ELSE '' END AS message,
         detected_at AS triggered_at, created_at, dedup_key
  FROM atab
)"""

T = """
t AS (
  SELECT event_id, device_id, patient_id, ts AS "timestamp", heart_rate,
         CASE WHEN seq % 10 = 0 THEN CAST(95 + seq % 5 AS INTEGER) END AS spo2,
         CASE WHEN seq % 15 = 0 THEN CAST(365 + seq % 5 AS DOUBLE) / 10 END AS temperature,
         ts - to_days(CAST(src_event_id % 60 AS INTEGER)) AS created_at,
         seq, src_event_id
  FROM v
)"""

TCOLS = 'event_id, device_id, patient_id, "timestamp", heart_rate, spo2, temperature, created_at'
ALERT_BASE = (V, WSTATS, DET, KEYED, BKT, ATAB)

ORACLES["alert_dedup_key"] = with_(V, WSTATS, DET, KEYED) + "SELECT event_id, dedup_key FROM keyed"
ORACLES["alerts_bucketed"] = with_(V, WSTATS, DET, KEYED, BKT) + "SELECT * FROM bkt"
ORACLES["alerts_cooldown"] = with_recursive(V, WSTATS, DET, COOLDOWN) + f"""
SELECT event_id, patient_id, alert_type, triggered_at,
       {sql_dedup_key('patient_id', 'alert_type', 'triggered_at')} AS dedup_key
FROM cd"""
ORACLES["alerts_recovered"] = with_recursive(*ALERT_BASE, PARTIAL, COOLDOWN) + f"""
SELECT k.dedup_key, k.patient_id, k.alert_type, k.triggered_at AS detected_at,
       k.dedup_key NOT IN (SELECT dedup_key FROM partial) AS recovered
FROM (SELECT *, {sql_dedup_key('patient_id', 'alert_type', 'triggered_at')} AS dedup_key FROM cd) k"""
ORACLES["alerts_backfill_key"] = with_(*ALERT_BASE) + f"""
SELECT patient_id, alert_type, detected_at,
       coalesce(CASE WHEN CAST(floor(epoch(detected_at) / 300) AS BIGINT) % 2 = 1 THEN NULL ELSE dedup_key END,
                {sql_dedup_key('patient_id', 'alert_type', 'detected_at')}) AS dedup_key,
       CAST(floor(epoch(detected_at) / 300) AS BIGINT) % 2 = 1 AS backfilled
FROM atab"""
ORACLES["alerts_store"] = with_(*ALERT_BASE, PARTIAL) + """
SELECT dedup_key, patient_id, alert_type, detected_at, event_id FROM bkt
WHERE dedup_key NOT IN (SELECT dedup_key FROM partial)"""
ORACLES["list_alerts"] = with_(*ALERT_BASE, ALERT_VIEW) + """
SELECT * FROM aview ORDER BY triggered_at DESC, dedup_key LIMIT 100"""
ORACLES["filter_alerts_range"] = with_(*ALERT_BASE, ALERT_VIEW) + """
SELECT * FROM aview
WHERE triggered_at >= TIMESTAMP '2026-07-07 12:05:00' AND triggered_at <= TIMESTAMP '2026-07-07 12:15:00'"""
ORACLES["recent_alert_semi"] = with_(*ALERT_BASE) + """
SELECT d.event_id, d.patient_id, d.alert_type, d.triggered_at FROM det d
WHERE EXISTS (SELECT 1 FROM atab a WHERE a.patient_id = d.patient_id AND a.alert_type = d.alert_type
              AND a.created_at >= d.triggered_at - INTERVAL 300 SECONDS AND a.created_at <= d.triggered_at)"""
ORACLES["list_telemetry"] = with_(V, T) + f"""
SELECT {TCOLS} FROM t
WHERE "timestamp" >= TIMESTAMP '2026-07-07 12:01:00' AND "timestamp" <= TIMESTAMP '2026-07-07 12:05:00'
ORDER BY "timestamp" DESC, event_id LIMIT 1000"""
ORACLES["filter_telemetry_range"] = with_(V, T) + f"""
SELECT {TCOLS} FROM t
WHERE "timestamp" >= TIMESTAMP '2026-07-07 12:01:00' AND "timestamp" <= TIMESTAMP '2026-07-07 12:02:00'"""
ORACLES["telemetry_store"] = with_(V, T) + """
, inc AS (
  SELECT event_id, device_id, patient_id, "timestamp", heart_rate, epoch_ms("timestamp") AS arrival FROM t
  UNION ALL
  SELECT event_id, device_id, patient_id, "timestamp", heart_rate + 1, epoch_ms("timestamp") + 1000 FROM t
  WHERE src_event_id % 89 = 0
)
SELECT event_id, device_id, patient_id, "timestamp", heart_rate
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival, event_id) AS rn FROM inc) i
WHERE rn = 1 AND event_id NOT IN (SELECT event_id FROM t WHERE seq <= 20)"""
ORACLES["retention_keep"] = with_(V, T) + """
SELECT event_id, created_at FROM t WHERE created_at >= TIMESTAMP '2026-07-08 00:00:00' - INTERVAL 30 DAYS"""
ORACLES["retention_dropped"] = with_(*ALERT_BASE, T) + """
SELECT 'telemetry' AS table_name,
       CAST(count(*) FILTER (WHERE created_at < TIMESTAMP '2026-07-08 00:00:00' - INTERVAL 30 DAYS) AS BIGINT) AS dropped
FROM t
UNION ALL
SELECT 'alerts', CAST(count(*) FILTER (WHERE created_at < TIMESTAMP '2026-07-08 00:00:00' - INTERVAL 30 DAYS) AS BIGINT)
FROM atab"""

RAW = """
raw AS (
  SELECT patient_id AS key,
         CASE WHEN cls = 0 THEN '{"invalid"' WHEN cls = 6 THEN body || '{}' ELSE body END AS value,
         'telemetry.raw' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", src_event_id AS "offset",
         src_event_id + 1 + src_event_id % 7 AS high_watermark, ts AS "timestamp",
         cls, event_id, device_id, patient_id, ts, heart_rate
  FROM (
    SELECT *,
           '{"event_id":"' || event_id || '","device_id":"' || device_id || '",'
           || CASE WHEN cls = 2 THEN '' ELSE '"patient_id":"' || patient_id || '",' END
           || '"timestamp":"'
           || CASE WHEN cls = 3 THEN strftime(ts + INTERVAL 3 HOURS, '%Y-%m-%dT%H:%M:%S') || '+03:00'
                   ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' END
           || '","heart_rate":'
           || CASE cls WHEN 1 THEN '251' WHEN 5 THEN '19' WHEN 4 THEN '"' || CAST(heart_rate AS VARCHAR) || '"'
                       ELSE CAST(heart_rate AS VARCHAR) END
           || '}' AS body
    FROM (SELECT *, src_event_id % 50 AS cls FROM v) c
  ) b
)"""

ROUTED = f"""
routed AS (
  SELECT *, cls NOT IN (0, 4, 6) AS decode_ok,
         CASE cls WHEN 1 THEN '{K.MSG_HR_TOO_HIGH}' WHEN 2 THEN '{K.MSG_PATIENT_ID_REQUIRED}'
                  WHEN 3 THEN '{K.MSG_TIMESTAMP_NOT_UTC}' WHEN 5 THEN '{K.MSG_HR_TOO_LOW}' END AS reason,
         CASE WHEN cls IN (0, 1, 2, 3, 4, 5, 6) THEN 'dlq' ELSE 'store' END AS route,
         CASE WHEN cls IN (0, 4, 6) THEN 'decode' WHEN cls IN (1, 2, 3, 5) THEN 'validation' END AS dlq_reason
  FROM raw
)"""

ORACLES["decode_events"] = with_(V, RAW) + """
SELECT topic, "partition" AS "partition", "offset" AS "offset", cls NOT IN (0, 4, 6) AS decode_ok,
       CASE WHEN cls NOT IN (0, 4, 6) THEN event_id END AS event_id,
       CASE WHEN cls NOT IN (0, 4, 6) THEN device_id END AS device_id,
       CASE WHEN cls IN (0, 4, 6) THEN NULL WHEN cls = 2 THEN '' ELSE patient_id END AS patient_id,
       CASE WHEN cls NOT IN (0, 4, 6) THEN ts END AS "timestamp",
       CASE WHEN cls NOT IN (0, 4, 6) THEN CAST(CASE cls WHEN 1 THEN 251 WHEN 5 THEN 19 ELSE heart_rate END AS BIGINT)
       END AS heart_rate
FROM raw"""
ORACLES["validate_events"] = with_(V, RAW, ROUTED) + """SELECT "offset" AS "offset", decode_ok, reason FROM routed"""
ORACLES["route_split"] = with_(V, RAW, ROUTED) + """
SELECT route, dlq_reason, CAST(count(*) AS BIGINT) AS messages FROM routed GROUP BY route, dlq_reason"""
ORACLES["dlq_envelope"] = with_(V, RAW, ROUTED) + f"""
, env AS (
  SELECT key,
         CASE WHEN dlq_reason = 'decode' THEN '{K.MSG_DECODE}: invalid JSON'
              ELSE '{K.MSG_INVALID_EVENT}: validate telemetry event: ' || reason END AS reason,
         topic AS source_topic, "partition" AS source_partition, "offset" AS source_offset,
         to_base64(encode(value)) AS payload_base64
  FROM routed WHERE route = 'dlq'
)
SELECT *, json_object('reason', reason, 'timestamp', '2026-07-08T00:00:00Z', 'source_topic', source_topic,
                      'source_partition', source_partition, 'source_offset', source_offset,
                      'payload_base64', payload_base64)::VARCHAR AS value
FROM env"""
ORACLES["dlq_reason_counts"] = with_(V, RAW, ROUTED) + """
SELECT dlq_reason AS reason, CAST(count(*) AS BIGINT) AS messages FROM routed WHERE route = 'dlq' GROUP BY dlq_reason"""
ORACLES["consumer_lag"] = with_(V, RAW) + """
SELECT topic, "partition" AS "partition",
       CAST(arg_max(greatest(high_watermark - "offset" - 1, 0), "offset") AS BIGINT) AS lag
FROM raw WHERE high_watermark > 0 GROUP BY topic, "partition" """
ORACLES["snk_event_messages"] = with_(V) + """
SELECT patient_id AS key,
       json_object('event_id', event_id, 'device_id', device_id, 'patient_id', patient_id,
                   'timestamp', strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z', 'heart_rate', heart_rate)::VARCHAR AS value,
       'telemetry.raw' AS topic
FROM v"""
ORACLES["window_size"] = with_(V, WSTATS) + "SELECT event_id, patient_id, ts, window_events FROM wstats"
ORACLES["window_stats"] = with_(V, WSTATS) + """
SELECT event_id, patient_id, ts, heart_rate, window_events, window_min_hr, window_max_hr, window_sum_hr FROM wstats"""
ORACLES["window_integrity"] = with_(V) + """
SELECT patient_id, CAST(count(*) AS BIGINT) AS indexed,
       CAST(count(*) FILTER (WHERE src_event_id % 97 = 0) AS BIGINT) AS missing
FROM v GROUP BY patient_id"""

# --- ingestion ----------------------------------------------------------------------------------

BDOCS = """
bdocs AS (
  SELECT user_id, device_id, patient_id, chunk, printf('%s-%s-%09d', device_id, 'run1', chunk) AS batch_id,
         CAST(count(*) AS INTEGER) AS n, list(heart_rate ORDER BY seq) AS hrs, list(ts ORDER BY seq) AS tss
  FROM (SELECT *, CAST(floor((seq - 1) / 10) AS BIGINT) AS chunk FROM v) x
  GROUP BY user_id, device_id, patient_id, chunk
)"""

BREQ = """
breq AS (
  SELECT d.*, c.copy, d.batch_id || '#' || CAST(c.copy AS VARCHAR) AS request_id,
         d.chunk * (1000 + (d.user_id % 9) * 500) + CASE WHEN c.copy = 2 THEN 90000000 ELSE c.copy END AS arrival_ms,
         d.chunk % 11 = 5 AS bad_json, (d.chunk % 13 = 6 AND d.n >= 2) AS bad_order,
         CASE WHEN d.chunk % 13 = 6 AND d.n >= 2 THEN [d.hrs[2], d.hrs[1]] || d.hrs[3:] ELSE d.hrs END AS doc_hrs,
         CASE WHEN d.chunk % 13 = 6 AND d.n >= 2 THEN [d.tss[2], d.tss[1]] || d.tss[3:] ELSE d.tss END AS doc_tss
  FROM bdocs d, (SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS copy) c
  WHERE c.copy = 0 OR (c.copy = 1 AND d.chunk % 7 = 3) OR (c.copy = 2 AND d.chunk % 14 = 3)
)"""

GOOD = """
good AS (SELECT * FROM breq WHERE NOT bad_json AND NOT bad_order)"""

ADM = """
adm_req AS (
  SELECT device_id, batch_id, request_id, arrival_ms,
         row_number() OVER (PARTITION BY device_id ORDER BY arrival_ms, request_id) AS rn
  FROM good
),
adm AS (
  SELECT device_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS request_id, CAST(NULL AS INTEGER) AS status,
         CAST(NULL AS BIGINT) AS retry_ms, CAST(2.0 AS DOUBLE) AS tokens, CAST(NULL AS BIGINT) AS refilled,
         CAST([] AS STRUCT(id VARCHAR, t0 BIGINT)[]) AS reserved
  FROM (SELECT DISTINCT device_id FROM adm_req) s
  UNION ALL
  SELECT device_id, rn, request_id,
         CASE WHEN dup THEN 200 WHEN tk >= 1 THEN 202 ELSE 429 END,
         CASE WHEN NOT dup AND tk < 1 THEN CAST(ceil((1 - tk) * 5000) AS BIGINT) END,
         CASE WHEN dup THEN tokens WHEN tk >= 1 THEN tk - 1 ELSE tk END,
         CASE WHEN dup THEN refilled ELSE arrival_ms END,
         CASE WHEN NOT dup AND tk >= 1
              THEN list_append(list_filter(reserved, lambda x: x.id <> batch_id), {'id': batch_id, 't0': arrival_ms})
              ELSE reserved END
  FROM (
    SELECT r.device_id, r.rn, r.request_id, r.batch_id, r.arrival_ms, a.tokens, a.refilled, a.reserved,
           len(list_filter(a.reserved, lambda x: x.id = r.batch_id AND r.arrival_ms - x.t0 < 86400000)) > 0 AS dup,
           CASE WHEN a.refilled IS NULL THEN CAST(2.0 AS DOUBLE)
                ELSE least(CAST(2.0 AS DOUBLE),
                           a.tokens + CAST(greatest(0, r.arrival_ms - a.refilled) AS DOUBLE) / CAST(5000 AS DOUBLE))
           END AS tk
    FROM adm a JOIN adm_req r ON r.device_id = a.device_id AND r.rn = a.rn + 1
  ) step
),
outcomes AS (
  SELECT g.request_id, g.device_id, g.batch_id, g.arrival_ms, a.status, CAST(NULL AS VARCHAR) AS error,
         CASE WHEN a.status = 429 THEN CAST(greatest(ceil(a.retry_ms / 1000), 1) AS BIGINT) END AS retry_after_s,
         CAST(CASE WHEN a.status = 202 THEN g.n ELSE 0 END AS BIGINT) AS accepted_measurements
  FROM good g JOIN adm a ON a.request_id = g.request_id
  UNION ALL
  SELECT request_id, CASE WHEN bad_json THEN NULL ELSE device_id END, CASE WHEN bad_json THEN NULL ELSE batch_id END,
         arrival_ms, 400,
         CASE WHEN bad_json THEN 'invalid JSON body' ELSE 'measurement timestamps must be strictly increasing' END,
         CAST(NULL AS BIGINT), CAST(0 AS BIGINT)
  FROM breq WHERE bad_json OR bad_order
),
adm_out AS (
  SELECT *, CASE status WHEN 202 THEN 'accepted' WHEN 200 THEN 'duplicate_ignored'
                        WHEN 429 THEN 'rate_limit_exceeded' ELSE 'invalid_batch' END AS outcome
  FROM outcomes
)"""

RATE = """
rreq AS (SELECT device_id, seq, (seq - 1) * 2000 AS arrival_ms FROM v),
rb AS (
  SELECT device_id, CAST(0 AS BIGINT) AS seq, CAST(NULL AS BIGINT) AS arrival_ms, CAST(NULL AS BOOLEAN) AS allowed,
         CAST(2.0 AS DOUBLE) AS tokens, CAST(NULL AS BIGINT) AS refilled, CAST(NULL AS BIGINT) AS retry_ms
  FROM (SELECT DISTINCT device_id FROM rreq) s
  UNION ALL
  SELECT device_id, seq, arrival_ms, tk >= 1, CASE WHEN tk >= 1 THEN tk - 1 ELSE tk END, arrival_ms,
         CASE WHEN tk >= 1 THEN 0 ELSE CAST(ceil((1 - tk) * 5000) AS BIGINT) END
  FROM (
    SELECT r.device_id, r.seq, r.arrival_ms,
           CASE WHEN b.refilled IS NULL THEN CAST(2.0 AS DOUBLE)
                ELSE least(CAST(2.0 AS DOUBLE),
                           b.tokens + CAST(greatest(0, r.arrival_ms - b.refilled) AS DOUBLE) / CAST(5000 AS DOUBLE))
           END AS tk
    FROM rb b JOIN rreq r ON r.device_id = b.device_id AND r.seq = b.seq + 1
  ) step
),
rdec AS (
  SELECT device_id, seq, arrival_ms, allowed, round(tokens, 6) AS tokens, retry_ms AS retry_after_ms,
         CASE WHEN NOT allowed THEN CAST(greatest(ceil(retry_ms / 1000), 1) AS BIGINT) END AS retry_after_s
  FROM rb WHERE seq > 0
)"""

ORACLES["pack_batches"] = with_(V, BDOCS) + """
SELECT batch_id, device_id, patient_id, n AS n_measurements, tss[1] AS first_ts, tss[-1] AS last_ts,
       array_to_string(hrs, ',') AS hr_list
FROM bdocs"""
ORACLES["src_batches_decoded"] = with_(V, BDOCS, BREQ) + """
SELECT request_id, device_id, patient_id, batch_id, n AS n_measurements, doc_tss[1] AS first_ts,
       doc_tss[-1] AS last_ts, array_to_string(doc_hrs, ',') AS hr_list
FROM breq"""
ORACLES["decode_batches_strict"] = with_(V, BDOCS, BREQ) + """
SELECT request_id, NOT bad_json AS decode_ok, CASE WHEN bad_json THEN 'invalid JSON body' END AS error FROM breq"""
ORACLES["validate_batches"] = with_(V, BDOCS, BREQ) + """
SELECT request_id, NOT bad_json AS decode_ok,
       CASE WHEN NOT bad_json AND bad_order THEN 'measurement timestamps must be strictly increasing' END AS reason
FROM breq"""
ORACLES["explode_batches"] = with_(V, BDOCS, BREQ, GOOD) + """
SELECT g.batch_id || '-' || CAST(CAST((x.seq - 1) % 10 AS BIGINT) AS VARCHAR) AS event_id, g.device_id, g.patient_id,
       x.ts AS "timestamp", x.heart_rate
FROM good g JOIN v x ON x.device_id = g.device_id AND CAST(floor((x.seq - 1) / 10) AS BIGINT) = g.chunk"""
ORACLES["batch_first_seen"] = with_recursive(V, BDOCS, BREQ, GOOD) + """
, copies AS (
  SELECT *, row_number() OVER (PARTITION BY device_id, batch_id ORDER BY arrival_ms, request_id) AS rn FROM good
),
seen AS (
  SELECT request_id, device_id, batch_id, arrival_ms, rn, arrival_ms AS held, true AS first_seen FROM copies WHERE rn = 1
  UNION ALL
  SELECT c.request_id, c.device_id, c.batch_id, c.arrival_ms, c.rn,
         CASE WHEN c.arrival_ms - s.held >= 86400000 THEN c.arrival_ms ELSE s.held END, c.arrival_ms - s.held >= 86400000
  FROM seen s JOIN copies c ON c.device_id = s.device_id AND c.batch_id = s.batch_id AND c.rn = s.rn + 1
)
SELECT g.request_id, g.device_id, g.batch_id, g.copy, g.arrival_ms, s.first_seen
FROM good g JOIN seen s ON s.request_id = g.request_id"""
ORACLES["rate_limit_decisions"] = with_recursive(V, RATE) + "SELECT * FROM rdec"
ORACLES["rate_limit_summary"] = with_recursive(V, RATE) + """
SELECT device_id, CAST(count(*) AS BIGINT) AS requests, CAST(count(*) FILTER (WHERE allowed) AS BIGINT) AS allowed,
       CAST(count(*) FILTER (WHERE NOT allowed) AS BIGINT) AS limited
FROM rdec GROUP BY device_id"""
ORACLES["admission_outcomes"] = with_recursive(V, BDOCS, BREQ, GOOD, ADM) + "SELECT * FROM adm_out"
ORACLES["admission_counts"] = with_recursive(V, BDOCS, BREQ, GOOD, ADM) + """
SELECT status, outcome, CAST(count(*) AS BIGINT) AS requests,
       CAST(sum(accepted_measurements) AS BIGINT) AS accepted_measurements
FROM adm_out GROUP BY status, outcome"""

# the bucket in whole milliseconds of refill: a token is 5000, full is 10000
RATE_MS = """
rreq AS (SELECT device_id, seq, (seq - 1) * 2000 AS arrival_ms FROM v),
rb AS (
  SELECT device_id, CAST(0 AS BIGINT) AS seq, CAST(NULL AS BIGINT) AS arrival_ms, CAST(NULL AS BOOLEAN) AS allowed,
         CAST(10000 AS BIGINT) AS level, CAST(NULL AS BIGINT) AS refilled, CAST(NULL AS BIGINT) AS retry_ms
  FROM (SELECT DISTINCT device_id FROM rreq) s
  UNION ALL
  SELECT device_id, seq, arrival_ms, lv >= 5000, CASE WHEN lv >= 5000 THEN lv - 5000 ELSE lv END, arrival_ms, greatest(5000 - lv, 0)
  FROM (
    SELECT r.device_id, r.seq, r.arrival_ms, least(10000, b.level + coalesce(r.arrival_ms - b.refilled, 0)) AS lv
    FROM rb b JOIN rreq r ON r.device_id = b.device_id AND r.seq = b.seq + 1
  ) step
)"""

ADM_MS = """
adm_req AS (
  SELECT device_id, batch_id, request_id, arrival_ms,
         row_number() OVER (PARTITION BY device_id ORDER BY arrival_ms, request_id) AS rn
  FROM good
),
adm AS (
  SELECT device_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS VARCHAR) AS request_id, CAST(NULL AS INTEGER) AS status,
         CAST(NULL AS BIGINT) AS retry_ms, CAST(10000 AS BIGINT) AS level, CAST(NULL AS BIGINT) AS refilled,
         CAST([] AS STRUCT(id VARCHAR, t0 BIGINT)[]) AS reserved
  FROM (SELECT DISTINCT device_id FROM adm_req) s
  UNION ALL
  SELECT device_id, rn, request_id, CASE WHEN dup THEN 200 WHEN lv >= 5000 THEN 202 ELSE 429 END,
         CASE WHEN NOT dup AND lv < 5000 THEN 5000 - lv END,
         CASE WHEN dup THEN level WHEN lv >= 5000 THEN lv - 5000 ELSE lv END,
         CASE WHEN dup THEN refilled ELSE arrival_ms END,
         CASE WHEN NOT dup AND lv >= 5000
              THEN list_append(list_filter(reserved, lambda x: x.id <> batch_id), {'id': batch_id, 't0': arrival_ms})
              ELSE reserved END
  FROM (
    SELECT r.device_id, r.rn, r.request_id, r.batch_id, r.arrival_ms, a.level, a.refilled, a.reserved,
           len(list_filter(a.reserved, lambda x: x.id = r.batch_id AND r.arrival_ms - x.t0 < 86400000)) > 0 AS dup,
           least(10000, a.level + coalesce(r.arrival_ms - a.refilled, 0)) AS lv
    FROM adm a JOIN adm_req r ON r.device_id = a.device_id AND r.rn = a.rn + 1
  ) step
)""" + ADM[ADM.index(",\noutcomes AS"):]

ORACLES["rate_limit_by_maps"] = with_recursive(V, RATE_MS) + """
SELECT device_id, seq, arrival_ms, allowed, round(level / 5000, 6) AS tokens, retry_ms AS retry_after_ms,
       CASE WHEN NOT allowed THEN CAST(greatest(ceil(retry_ms / 1000), 1) AS BIGINT) END AS retry_after_s
FROM rb WHERE seq > 0"""
ORACLES["admission_by_slices"] = with_recursive(V, BDOCS, BREQ, GOOD, ADM_MS) + "SELECT * FROM adm_out"

# --- reconciliation / summary ----------------------------------------------------------------------

ACC_LOG = """
acc AS (
  SELECT g.batch_id, g.device_id, g.patient_id, g.n, g.arrival_ms, g.chunk
  FROM good g JOIN adm_out o ON o.request_id = g.request_id WHERE o.status = 202
)"""

STORED_R = """
pub AS (
  SELECT g.batch_id, g.chunk, g.n FROM good g JOIN adm_out o ON o.request_id = g.request_id
  WHERE o.status IN (202, 429)
),
pub_ev AS (SELECT batch_id || '-' || CAST(i AS VARCHAR) AS event_id, i, chunk
           FROM pub, range(0, 10) r(i) WHERE i < n),
stored_r AS (
  SELECT event_id FROM pub_ev WHERE NOT (i = 3 AND chunk % 5 = 0)
  UNION ALL SELECT event_id FROM pub_ev WHERE i = 7 AND chunk % 6 = 0
),
exp_ev AS (SELECT batch_id || '-' || CAST(i AS VARCHAR) AS event_id FROM acc, range(0, 10) r(i) WHERE i < n),
rec AS (
  SELECT coalesce(e.event_id, s.event_id) AS event_id,
         CASE WHEN e.event_id IS NULL THEN 'extra' WHEN coalesce(s.c, 0) = 0 THEN 'missing'
              WHEN s.c = 1 THEN 'ok' ELSE 'duplicated' END AS status,
         CAST(coalesce(s.c, 0) AS BIGINT) AS stored_copies
  FROM (SELECT DISTINCT event_id FROM exp_ev) e
  FULL OUTER JOIN (SELECT event_id, count(*) AS c FROM stored_r GROUP BY event_id) s ON s.event_id = e.event_id
)"""

ING = (V, BDOCS, BREQ, GOOD, ADM)

ORACLES["accepted_batch_log"] = with_recursive(*ING, ACC_LOG) + """
SELECT batch_id, device_id, patient_id,
       to_json(list_transform(range(0, n), lambda i: batch_id || '-' || CAST(i AS VARCHAR)))::VARCHAR AS event_ids,
       n AS measurements, TIMESTAMP '2026-07-07 12:00:00' + to_milliseconds(arrival_ms) AS accepted_at
FROM acc"""
ORACLES["reconcile_events"] = with_recursive(*ING, ACC_LOG, STORED_R) + "SELECT * FROM rec"
ORACLES["reconcile_summary"] = with_recursive(*ING, ACC_LOG, STORED_R) + """
SELECT status, CAST(count(*) AS BIGINT) AS events, CAST(sum(stored_copies) AS BIGINT) AS stored_rows
FROM rec GROUP BY status"""
ORACLES["run_summary"] = with_recursive(*ING) + """
, j AS (SELECT o.*, b.n FROM adm_out o JOIN breq b ON b.request_id = o.request_id)
SELECT CAST(count(*) AS BIGINT) AS sent_batches, CAST(sum(n) AS BIGINT) AS sent_measurements,
       CAST(count(*) FILTER (WHERE status = 202) AS BIGINT) AS accepted_202,
       CAST(count(*) FILTER (WHERE status = 200) AS BIGINT) AS duplicates_200,
       CAST(count(*) FILTER (WHERE status = 429) AS BIGINT) AS rate_limited_429,
       CAST(count(*) FILTER (WHERE status = 503) AS BIGINT) AS unavailable_503,
       CAST(count(*) FILTER (WHERE status NOT IN (202, 200, 429, 503)) AS BIGINT) AS failed_requests,
       CAST(sum(accepted_measurements) AS BIGINT) AS accepted_measurements,
       CAST(CASE WHEN max(arrival_ms) > min(arrival_ms)
                 THEN greatest(round((max(arrival_ms) - min(arrival_ms)) / 1000.0), 1) ELSE 0 END AS BIGINT)
         AS duration_seconds,
       round(CASE WHEN max(arrival_ms) > min(arrival_ms)
                  THEN sum(accepted_measurements) / ((max(arrival_ms) - min(arrival_ms)) / 1000.0) ELSE 0 END, 6)
         AS throughput_measurements_per_sec
FROM j"""

# --- metrics ------------------------------------------------------------------------------------

EV = """
ev AS (SELECT event_id AS seq, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value FROM events)"""

OBS = """
obs AS (
  SELECT seq, ts, CAST(ts AS DATE) AS day,
         CASE WHEN event_type IN ('view', 'click', 'error') THEN 'counter' WHEN event_type = 'signup' THEN 'gauge'
              ELSE 'histogram' END AS kind,
         CASE event_type WHEN 'view' THEN 'processing_kafka_messages_total'
                         WHEN 'click' THEN 'processing_kafka_commits_total'
                         WHEN 'error' THEN 'processing_errors_total'
                         WHEN 'signup' THEN 'processing_kafka_consumer_lag'
                         ELSE 'processing_redis_duration_seconds' END AS name,
         CASE event_type WHEN 'view' THEN 'status=' || ['processed', 'dlq', 'error'][user_id % 3 + 1]
                         WHEN 'click' THEN 'status=' || ['success', 'error'][user_id % 2 + 1]
                         WHEN 'error' THEN 'stage=' || ['validate', 'postgres', 'redis', 'commit'][user_id % 4 + 1]
                         WHEN 'signup' THEN 'partition=' || CAST(user_id % 3 AS VARCHAR) || ',topic=telemetry.raw'
                         ELSE 'operation=' || ['sliding_window_add', 'alert_dedup_reserve'][user_id % 2 + 1]
         END AS labels_key,
         CASE event_type WHEN 'view' THEN 'status="' || ['processed', 'dlq', 'error'][user_id % 3 + 1] || '"'
                         WHEN 'click' THEN 'status="' || ['success', 'error'][user_id % 2 + 1] || '"'
                         WHEN 'error' THEN 'stage="' || ['validate', 'postgres', 'redis', 'commit'][user_id % 4 + 1] || '"'
                         WHEN 'signup' THEN 'partition="' || CAST(user_id % 3 AS VARCHAR) || '",topic="telemetry.raw"'
                         ELSE 'operation="' || ['sliding_window_add', 'alert_dedup_reserve'][user_id % 2 + 1] || '"'
         END AS labels_text,
         CAST(CASE WHEN event_type IN ('view', 'click') THEN 1.0
                   WHEN event_type = 'error' THEN floor(value) - 10
                   WHEN event_type = 'signup' THEN floor(value)
                   ELSE floor(value * 16) / 1024 END AS DOUBLE) AS value
  FROM ev
)"""

BOUNDS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10]
BOUND_TEXT = ["0.001", "0.005", "0.01", "0.025", "0.05", "0.1", "0.25", "0.5", "1", "2.5", "5", "10"]
HIST = ("""
hist AS (
  SELECT name, labels_key, any_value(labels_text) AS labels_text, """
        + ", ".join(f"CAST(count(*) FILTER (WHERE value <= {b}) AS BIGINT) AS b{i}" for i, b in enumerate(BOUNDS))
        + """, CAST(count(*) AS BIGINT) AS cnt, sum(value) AS total
  FROM obs WHERE kind = 'histogram' GROUP BY name, labels_key
)""")


def go_float_sql(x: str) -> str:
    """DuckDB twin of the exposition number format (exact-binary values: integers and k/1024 fractions)."""
    return (f"CASE WHEN isnan({x}) OR isinf({x}) THEN '0' "
            f"WHEN {x} = floor({x}) AND abs({x}) < 1e6 THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) "
            f"ELSE CAST({x} AS VARCHAR) END")


ORACLES["metric_counters"] = with_(EV, OBS) + """
SELECT name, labels_key, round(sum(value), 6) AS value FROM obs WHERE kind = 'counter' AND value >= 0
GROUP BY name, labels_key"""
ORACLES["metric_gauges"] = with_(EV, OBS) + """
SELECT name, labels_key, round(arg_max(value, seq), 6) AS value FROM obs WHERE kind = 'gauge'
GROUP BY name, labels_key"""
ORACLES["metric_histogram"] = with_(EV, OBS, HIST) + "\nUNION ALL\n".join(
    [f"SELECT name, labels_key, '{t}' AS le, b{i} AS cum_count FROM hist" for i, t in enumerate(BOUND_TEXT)]
    + ["SELECT name, labels_key, '+Inf' AS le, cnt AS cum_count FROM hist"])

_DEF_ROWS = ", ".join(f"('{n}', '{k}', '{h}')" for n, (k, h) in sorted(K.METRIC_DEFINITIONS.items()))
_HIST_LINES = "\nUNION ALL\n".join(
    [f"SELECT name, 1, labels_key, {i}, name || '_bucket{{le=\"{t}\",' || labels_text || '}} ' || CAST(b{i} AS VARCHAR) "
     f"FROM hist WHERE name IN (SELECT name FROM defs WHERE kind = 'histogram')" for i, t in enumerate(BOUND_TEXT)]
    + [f"SELECT name, 1, labels_key, 12, name || '_bucket{{le=\"+Inf\",' || labels_text || '}} ' || CAST(cnt AS VARCHAR) "
       f"FROM hist WHERE name IN (SELECT name FROM defs WHERE kind = 'histogram')",
       f"SELECT name, 1, labels_key, 13, name || '_sum{{' || labels_text || '}} ' || ({go_float_sql('total')}) "
       f"FROM hist WHERE name IN (SELECT name FROM defs WHERE kind = 'histogram')",
       "SELECT name, 1, labels_key, 14, name || '_count{' || labels_text || '} ' || CAST(cnt AS VARCHAR) "
       "FROM hist WHERE name IN (SELECT name FROM defs WHERE kind = 'histogram')"])
ORACLES["metrics_exposition"] = with_(EV, OBS, HIST) + f"""
, defs AS (SELECT * FROM (VALUES {_DEF_ROWS}) d(name, kind, help)),
scal AS (
  SELECT name, labels_key, any_value(labels_text) AS labels_text, sum(value) AS v FROM obs
  WHERE kind = 'counter' AND value >= 0 GROUP BY name, labels_key
  UNION ALL
  SELECT name, labels_key, any_value(labels_text), arg_max(value, seq) FROM obs WHERE kind = 'gauge'
  GROUP BY name, labels_key
)
SELECT name, CAST(0 AS INTEGER) AS section, '' AS labels_key, CAST(0 AS INTEGER) AS ord,
       '# HELP ' || name || ' ' || help AS line FROM defs
UNION ALL SELECT name, 0, '', 1, '# TYPE ' || name || ' ' || kind FROM defs
UNION ALL
SELECT name, 1, labels_key, 0, name || '{{' || labels_text || '}} ' || ({go_float_sql('v')}) FROM scal
WHERE name IN (SELECT name FROM defs WHERE kind <> 'histogram')
UNION ALL
{_HIST_LINES}"""

SAMPLES = """
samples AS (
  SELECT ts, seq, name, labels_key,
         CAST(row_number() OVER (PARTITION BY name, labels_key, day ORDER BY ts, seq) AS DOUBLE) AS value
  FROM obs WHERE kind = 'counter'
),
incs AS (
  SELECT ts, name, labels_key,
         CASE WHEN lag(value) OVER w IS NULL THEN value WHEN value >= lag(value) OVER w THEN value - lag(value) OVER w
              ELSE value END AS increase
  FROM samples WINDOW w AS (PARTITION BY name, labels_key ORDER BY ts, seq)
)"""

ORACLES["metric_rate"] = with_(EV, OBS, SAMPLES) + """
SELECT name, time_bucket(INTERVAL 60 SECONDS, ts) AS window_start, round(sum(increase) / 60.0, 6) AS rate
FROM incs GROUP BY name, time_bucket(INTERVAL 60 SECONDS, ts)"""
ORACLES["metric_rate_by_label"] = with_(EV, OBS, SAMPLES) + """
SELECT name, labels_key, time_bucket(INTERVAL 60 SECONDS, ts) AS window_start, round(sum(increase) / 60.0, 6) AS rate
FROM incs GROUP BY name, labels_key, time_bucket(INTERVAL 60 SECONDS, ts)"""

_QB = ", ".join(f"CAST(count(*) FILTER (WHERE value <= {b}) AS DOUBLE)" for b in BOUNDS)
_BL = "[" + ", ".join(str(float(b)) for b in BOUNDS) + "]"
ORACLES["histogram_quantile"] = with_(EV, OBS) + f"""
, per AS (
  SELECT name, labels_key, time_bucket(INTERVAL 300 SECONDS, ts) AS window_start, CAST(count(*) AS BIGINT) AS count,
         [{_QB}] || [CAST(count(*) AS DOUBLE)] AS cum
  FROM obs WHERE kind = 'histogram' GROUP BY name, labels_key, time_bucket(INTERVAL 300 SECONDS, ts)
),
pos AS (SELECT *, 0.95 * count AS rnk,
               list_position(list_transform(cum, lambda c: c >= 0.95 * count), true) AS idx,
               CAST({_BL} AS DOUBLE[]) AS bounds FROM per)
SELECT name, labels_key, window_start, count,
       round(CASE WHEN count = 0 THEN NULL WHEN idx = 13 THEN 10.0
                  ELSE (CASE WHEN idx > 1 THEN bounds[idx - 1] ELSE 0.0 END)
                       + (bounds[idx] - (CASE WHEN idx > 1 THEN bounds[idx - 1] ELSE 0.0 END))
                         * (rnk - (CASE WHEN idx > 1 THEN cum[idx - 1] ELSE 0.0 END))
                         / (cum[idx] - (CASE WHEN idx > 1 THEN cum[idx - 1] ELSE 0.0 END)) END, 6) AS quantile
FROM pos"""
ORACLES["service_up"] = with_(EV) + """
SELECT job, CAST(arg_max(up, (ts, seq)) AS INTEGER) AS up, max(ts) AS last_seen
FROM (SELECT seq, ts, CASE WHEN event_type IN ('view', 'click') THEN 'ingestion' ELSE 'processing' END AS job,
             CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS up FROM ev) s
GROUP BY job"""
ORACLES["readiness_rollup"] = with_(EV) + """
SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS period_start,
       CASE WHEN bool_and(event_type <> 'error') THEN 'ready' ELSE 'not_ready' END AS status,
       CAST(count(*) AS BIGINT) AS checks, CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS failed_checks
FROM ev GROUP BY time_bucket(INTERVAL 1 MINUTE, ts)"""
ACCESS = """
access AS (
  SELECT seq, event_type, CASE WHEN event_type IN ('view', 'error') THEN 'POST' ELSE 'GET' END AS method,
         CASE event_type WHEN 'view' THEN '/api/v1/telemetry' WHEN 'click' THEN '/health' WHEN 'signup' THEN '/ready'
                         WHEN 'purchase' THEN '/metrics' ELSE '/api/v2/telemetry' END AS path,
         [202, 200, 429, 503, 500][seq % 5 + 1] AS status, CAST(floor(value * 10) AS BIGINT) AS latency_ms
  FROM ev
)"""
ORACLES["request_counters"] = with_(EV, ACCESS) + """
SELECT method,
       CASE WHEN path IN ('/api/v1/telemetry', '/health', '/ready', '/metrics') THEN method || ' ' || path
            ELSE 'unmatched' END AS route,
       CAST(status AS VARCHAR) AS status, CAST(count(*) AS BIGINT) AS requests
FROM access GROUP BY ALL"""
ORACLES["latency_p95"] = with_(EV, ACCESS) + """
, h AS (SELECT event_type, least(greatest(latency_ms, 0), 60000) AS ms, count(*) AS c FROM access GROUP BY ALL),
cum AS (SELECT event_type, ms, sum(c) OVER (PARTITION BY event_type ORDER BY ms) AS cum,
               sum(c) OVER (PARTITION BY event_type) AS n FROM h)
SELECT event_type, CAST(any_value(n) AS BIGINT) AS requests, min(ms) AS p95_ms FROM cum
WHERE cum >= ceil(n * 0.95) GROUP BY event_type"""
ORACLES["processing_counters"] = with_(V, RAW, ROUTED) + f"""
, good_ev AS (SELECT event_id, patient_id, ts, heart_rate FROM routed WHERE route = 'store'),
gw AS (
  SELECT *, min(heart_rate) OVER w AS mn, min(ts) OVER w AS f FROM good_ev
  WINDOW w AS (PARTITION BY patient_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW)
),
gd AS (SELECT DISTINCT {sql_dedup_key('patient_id', "'HIGH_HEART_RATE'", 'ts')} AS k FROM gw
       WHERE heart_rate > 120 AND mn > 120 AND ts - f >= INTERVAL 60 SECONDS)
SELECT 'processing_kafka_messages_total' AS name,
       'status=' || CASE WHEN route = 'dlq' THEN 'dlq' ELSE 'processed' END AS labels_key,
       CAST(count(*) AS BIGINT) AS value FROM routed GROUP BY ALL
UNION ALL SELECT 'processing_kafka_commits_total', 'status=success', count(*) FROM routed
UNION ALL SELECT 'processing_dlq_messages_total', 'reason=' || dlq_reason, count(*) FROM routed WHERE route = 'dlq'
          GROUP BY dlq_reason
UNION ALL SELECT 'processing_errors_total', 'stage=validate', count(*) FROM routed WHERE dlq_reason = 'validation'
UNION ALL SELECT 'processing_alerts_created_total', 'type=HIGH_HEART_RATE', count(*) FROM gd HAVING count(*) > 0"""

# --- scraped samples: every look-back window joined to its samples ------------------------------------

SCRAPED = f"""
scr AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY event_id) AS n
  FROM (SELECT event_id, user_id, epoch_us(TIMESTAMP '2026-07-07 12:00:00' + to_seconds(event_id * 2)) AS us,
               CASE WHEN event_id % 3 > 0 THEN 'c/' || (user_id % 2) || '/' || (user_id % 3)
                    ELSE 'h/' || (user_id // 2 % 2) || '/' || (user_id % 2) END AS series
        FROM events WHERE event_id % 3 = 0 OR user_id % 2 = 0 OR event_id // 400 % 5 <> 4) e
),
samples AS (
  SELECT series AS sid, 'processing_kafka_messages_total' AS name, (['processed', 'dlq', 'error'])[user_id % 3 + 1] AS grp, CAST(NULL AS DOUBLE) AS le, us,
         CAST(((n - 1) % 50 + 1) * (user_id % 3 + 2) AS DOUBLE) AS value
  FROM scr WHERE event_id % 3 > 0
  UNION ALL
  SELECT series || '/' || j, 'processing_redis_duration_seconds_bucket', (['sliding_window_add', 'alert_dedup_reserve'])[user_id % 2 + 1],
         CASE WHEN j = 12 THEN 'infinity'::DOUBLE ELSE (CAST({K.HISTOGRAM_BOUNDS} AS DOUBLE[]))[j + 1] END, us,
         CAST(((n - 1) % 40 + 1) * CASE WHEN user_id % 2 = 0 THEN 2 * (j + 1) ELSE (j + 1) * (j + 1) END AS DOUBLE)
  FROM scr, (SELECT CAST(unnest(range(13)) AS BIGINT) AS j) b WHERE event_id % 3 = 0 AND (j = 12 OR (n + j) % 11 <> 0)
),
tot AS (
  SELECT *, sum(inc) OVER (PARTITION BY sid ORDER BY us) AS total
  FROM (SELECT *, coalesce(CASE WHEN value >= lag(value) OVER o THEN value - lag(value) OVER o WHEN lag(value) OVER o IS NULL THEN 0 ELSE value END, 0) AS inc
        FROM samples WINDOW o AS (PARTITION BY sid ORDER BY us)) x
)"""


def _rates(lookback: int, step: int) -> str:
    w, s = lookback * 1_000_000, step * 1_000_000
    return f"""
grid AS (SELECT sid, unnest(generate_series(min(us) // {s} * {s}, max(us) + {w}, {s})) AS tick FROM tot GROUP BY sid),
win AS (
  SELECT t.sid, t.name, t.grp, t.le, g.tick, count(*) - 1 AS steps, min(us) AS us1, max(us) AS us2, arg_min(value, us) AS v1,
         arg_max(total, us) - arg_min(total, us) AS inc
  FROM grid g JOIN tot t ON t.sid = g.sid AND t.us > g.tick - {w} AND t.us <= g.tick
  GROUP BY t.sid, t.name, t.grp, t.le, g.tick HAVING count(*) >= 2
),
ext AS (
  SELECT *, (us2 - us1) / 1e6 AS sampled, (us2 - us1) / 1e6 / steps AS avg_step, (tick - us2) / 1e6 AS to_end,
         CASE WHEN inc > 0 THEN least((us1 - tick + {w}) / 1e6, (us2 - us1) / 1e6 * (v1 / inc)) ELSE (us1 - tick + {w}) / 1e6 END AS to_start
  FROM win
),
rates AS (
  SELECT *, inc * ((sampled + CASE WHEN to_start < avg_step * 1.1 THEN to_start ELSE avg_step / 2 END
                            + CASE WHEN to_end < avg_step * 1.1 THEN to_end ELSE avg_step / 2 END) / sampled) / {float(lookback)} AS rate
  FROM ext
)"""


ORACLES["lookback_rate"] = with_(SCRAPED, _rates(60, 30)) + """
SELECT name, grp AS status, make_timestamp(tick) AS eval_ts, round(sum(rate), 6) AS rate, CAST(count(*) AS BIGINT) AS series
FROM rates WHERE le IS NULL GROUP BY name, grp, tick"""
ORACLES["bucket_quantile"] = with_(SCRAPED, _rates(300, 60)) + """
, per AS (SELECT name, grp, tick, le, sum(rate) AS r FROM rates WHERE le IS NOT NULL GROUP BY name, grp, tick, le),
mono AS (
  SELECT *, max(r) OVER (PARTITION BY name, grp, tick ORDER BY le) AS cum, max(r) OVER (PARTITION BY name, grp, tick) AS total,
         max(le) OVER (PARTITION BY name, grp, tick) AS top, count(*) OVER (PARTITION BY name, grp, tick) AS n
  FROM per
),
low AS (
  SELECT *, coalesce(lag(cum) OVER (PARTITION BY name, grp, tick ORDER BY le), 0) AS below, coalesce(lag(le) OVER (PARTITION BY name, grp, tick ORDER BY le), 0) AS lo
  FROM mono
)
SELECT name, grp AS operation, make_timestamp(tick) AS eval_ts, round(max(total), 6) AS rate,
       round(CASE WHEN max(n) >= 2 AND isinf(max(top)) AND max(total) > 0
                  THEN coalesce(arg_min(lo + (le - lo) * ((0.95 * total - below) / (cum - below)), le) FILTER (WHERE cum >= 0.95 * total AND NOT isinf(le)),
                                max(le) FILTER (WHERE NOT isinf(le))) END, 6) AS quantile
FROM low GROUP BY name, grp, tick"""

# --- the ingestion service's metrics -------------------------------------------------------------------

ORACLES["ingestion_metrics"] = with_(EV, f"""
acc AS (
  SELECT seq, ts, event_type, CASE WHEN event_type IN ('view', 'error') THEN 'POST' ELSE 'GET' END AS method,
         CASE event_type WHEN 'view' THEN 'POST /api/v1/telemetry' WHEN 'click' THEN 'GET /health' WHEN 'signup' THEN 'GET /ready'
                         WHEN 'purchase' THEN 'GET /metrics' ELSE 'unmatched' END AS route,
         ([202, 200, 429, 503, 500])[seq % 5 + 1] AS status, CAST(floor(value * 10) AS BIGINT) / 1000.0 AS seconds
  FROM ev
)""") + f"""
SELECT 'ingestion_http_requests_total' AS name, 'method=' || method || ',route=' || route || ',status=' || status AS labels_key, CAST(count(*) AS DOUBLE) AS value
FROM acc GROUP BY method, route, status
UNION ALL
SELECT 'ingestion_http_request_duration_seconds_bucket', 'le=' || le || ',method=' || method || ',route=' || route,
       CAST(count(*) FILTER (WHERE le = '+Inf' OR seconds <= TRY_CAST(le AS DOUBLE)) AS DOUBLE)
FROM acc, (SELECT unnest({[f"{b:g}" for b in K.INGESTION_DURATION_BOUNDS] + ["+Inf"]}) AS le) b GROUP BY method, route, le
UNION ALL
SELECT 'ingestion_http_request_duration_seconds_sum', 'method=' || method || ',route=' || route, round(sum(seconds), 6) FROM acc GROUP BY method, route
UNION ALL
SELECT 'ingestion_http_request_duration_seconds_count', 'method=' || method || ',route=' || route, CAST(count(*) AS DOUBLE) FROM acc GROUP BY method, route
UNION ALL
SELECT 'ingestion_telemetry_events_published_total', '', CAST(coalesce(sum(seq % 10 + 1) FILTER (WHERE status = 202), 0) AS DOUBLE) FROM acc
UNION ALL
SELECT 'ingestion_telemetry_publish_errors_total', '', CAST(count(*) FILTER (WHERE status = 503) AS DOUBLE) FROM acc
UNION ALL
SELECT 'ingestion_publisher_backpressure_total', '', CAST(count(*) FILTER (WHERE status = 429 AND seq % 3 = 0) AS DOUBLE) FROM acc
UNION ALL
SELECT 'ingestion_readiness_check_up', 'dependency=' || (['redis', 'kafka', 'postgres'])[seq % 3 + 1],
       CAST(arg_max(CAST(event_type <> 'error' AS INTEGER), struct_pack(ts := ts, seq := seq)) AS DOUBLE)
FROM acc GROUP BY seq % 3"""

# what each class of odd documents must give, read off the class
ORACLES["validate_odd_batches"] = f"""WITH c AS (SELECT 'r' || event_id AS request_id, event_id % 20 AS cls FROM events)
SELECT request_id, cls NOT IN (0, 1, 2, 3, 4, 5) AS decode_ok,
       CASE cls WHEN 6 THEN '{K.MSG_DEVICE_ID_REQUIRED}' WHEN 17 THEN '{K.MSG_DEVICE_ID_REQUIRED}' WHEN 7 THEN '{K.MSG_PATIENT_ID_REQUIRED}'
                WHEN 8 THEN '{K.MSG_BATCH_ID_REQUIRED}' WHEN 9 THEN '{K.MSG_MEASUREMENTS_LENGTH}' WHEN 10 THEN '{K.MSG_MEASUREMENTS_LENGTH}'
                WHEN 11 THEN '{K.MSG_MEASUREMENT_TS_REQUIRED}' WHEN 12 THEN '{K.MSG_HR_TOO_LOW}' WHEN 13 THEN '{K.MSG_HR_TOO_HIGH}'
                WHEN 14 THEN '{K.MSG_TS_OUT_OF_ORDER}' WHEN 15 THEN '{K.MSG_TS_OUT_OF_ORDER}' WHEN 16 THEN '{K.MSG_HR_TOO_HIGH}' END AS reason,
       CAST(CASE WHEN cls < 6 THEN NULL WHEN cls IN (9, 17) THEN 0 WHEN cls = 10 THEN 11 WHEN cls IN (11, 12, 13) THEN 1 WHEN cls = 18 THEN 3 ELSE 2 END AS INTEGER) AS n
FROM c"""
