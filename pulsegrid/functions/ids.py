"""Identifier, key and timestamp-text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid import constants as K


def rfc3339_utc(ts: Column) -> Column:
    """RFC 3339 text in UTC as Go's ``time.Time`` JSON encoding writes it: seconds, then a fraction with
    trailing zeros removed (omitted when zero), then ``Z``."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    frac = F.regexp_replace(F.format_string("%06d", micros), "0+$", "")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(micros == 0, F.lit("")).otherwise(F.concat(F.lit("."), frac)),
                    F.lit("Z"))


def event_id_of(batch_id: Column, index: Column) -> Column:
    """Event id of the ``index``-th (0-based) measurement of a batch: ``<batch_id>-<index>``."""
    return F.concat(batch_id, F.lit("-"), index.cast("string"))


def alert_bucket(ts: Column, bucket_seconds: int = K.ALERT_BUCKET_SECONDS) -> Column:
    """Fixed event-time bucket of an alert (floor, so also right before 1970)."""
    return F.floor(F.unix_seconds(ts) / F.lit(bucket_seconds)).cast("bigint")


def alert_dedup_key(patient_id: Column, alert_type: Column, ts: Column,
                    bucket_seconds: int = K.ALERT_BUCKET_SECONDS) -> Column:
    """``patient:type:bucket`` — the alerts table's unique key."""
    return F.concat_ws(":", patient_id, alert_type, alert_bucket(ts, bucket_seconds).cast("string"))


def alert_message(alert_type: Column) -> Column:
    """Message derived from the alert type on read ('' for unknown types)."""
    return F.when(alert_type == F.lit(K.ALERT_TYPE_HIGH_HR), F.lit(K.ALERT_MESSAGE_HIGH_HR)).otherwise(F.lit(""))
