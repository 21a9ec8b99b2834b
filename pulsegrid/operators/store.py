"""Telemetry/alerts tables: list and range queries, insert-if-absent writes, retention."""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid import constants as K
from pulsegrid.functions.jsonx import RFC3339_PATTERN
from pulsegrid.operators.alerts import insert_if_absent

TELEMETRY_COLUMNS = ["event_id", "device_id", "patient_id", "timestamp", "heart_rate", "spo2", "temperature",
                     "created_at"]


def _parse_rfc3339(name: str, value: str | None) -> dt.datetime | None:
    if value is None or value == "":
        return None
    try:
        if not re.match(RFC3339_PATTERN, value):
            raise ValueError(value)
        parsed = dt.datetime.fromisoformat(value.replace("Z", "+00:00"))
    except ValueError as exc:
        raise ValueError(f"invalid_query: {name} must be RFC3339") from exc
    return parsed.astimezone(dt.timezone.utc)


def normalize_limit(limit: int) -> int:
    """SRT3: 0 or less -> 100, above 1000 -> 1000."""
    if limit <= 0:
        return K.LIST_DEFAULT_LIMIT
    return min(limit, K.LIST_MAX_LIMIT)


@dataclass(frozen=True)
class ListFilter:
    """PRJ8: arguments of the list queries. ``from_``/``to`` are RFC 3339 texts (both ends inclusive)."""

    patient_id: str = ""
    from_: str | None = None
    to: str | None = None
    limit: int = 0

    def __post_init__(self):
        if isinstance(self.limit, str):
            if not re.fullmatch(r"[+-]?[0-9]+", self.limit):
                raise ValueError("invalid_query: limit must be a non-negative integer")
            object.__setattr__(self, "limit", int(self.limit))
        if self.limit < 0:
            raise ValueError("invalid_query: limit must be a non-negative integer")
        _parse_rfc3339("from", self.from_)
        _parse_rfc3339("to", self.to)

    @classmethod
    def parse(cls, params: dict[str, str], path_patient_id: str = "") -> "ListFilter":
        """Query-string style parsing: a path patient id overrides ``patient_id``."""
        return cls(patient_id=path_patient_id or params.get("patient_id", ""), from_=params.get("from") or None,
                   to=params.get("to") or None, limit=params.get("limit") or 0)

    def condition(self, time_col: str) -> Column:
        """PRJ7: patient equality, ``time >= from``, ``time <= to``, ANDed; absent parts are dropped."""
        cond = F.lit(True)
        if self.patient_id:
            cond = cond & (F.col("patient_id") == F.lit(self.patient_id))
        lo, hi = _parse_rfc3339("from", self.from_), _parse_rfc3339("to", self.to)
        if lo is not None:
            cond = cond & (F.col(time_col) >= F.lit(lo))
        if hi is not None:
            cond = cond & (F.col(time_col) <= F.lit(hi))
        return cond


def filter_range(table: DataFrame, flt: ListFilter, time_col: str) -> DataFrame:
    """PRJ7 without ordering or limit: the filter reaches the parquet scan as pushed predicates."""
    return table.filter(flt.condition(time_col))


def list_rows(table: DataFrame, flt: ListFilter, time_col: str, tiebreak: str) -> DataFrame:
    """SRT1/SRT2: newest first, ``limit`` normalised. Planned as TakeOrderedAndProject (per-task top-k, then a
    merge of k rows per task) — no full sort. ``tiebreak`` makes equal timestamps deterministic."""
    return (filter_range(table, flt, time_col)
            .orderBy(F.col(time_col).desc(), F.col(tiebreak).asc())
            .limit(normalize_limit(flt.limit)))


def list_telemetry(table: DataFrame, flt: ListFilter) -> DataFrame:
    return list_rows(table.select(*TELEMETRY_COLUMNS), flt, "timestamp", "event_id")


def store_telemetry(incoming: DataFrame, target: DataFrame) -> DataFrame:
    """SNK4: rows to append: first arrival per event_id, minus ids already stored (silently skipped)."""
    return insert_if_absent(incoming, target, "event_id", ["arrival", "event_id"])


def retention_split(table: DataFrame, now: dt.datetime, days: int = K.RETENTION_DAYS) -> tuple[DataFrame, DataFrame]:
    """RET1: (kept, dropped) with ``created_at < now - days`` dropped (strict)."""
    cutoff = F.lit(now) - F.expr(f"INTERVAL {int(days)} DAYS")
    keep = F.col("created_at") >= cutoff
    return table.filter(keep), table.filter(~keep)


def apply_retention(spark, path: str, now: dt.datetime, partition_col: str, days: int = K.RETENTION_DAYS) -> int:
    """RET1 on a parquet table partitioned by ``partition_col``: remove rows with ``created_at < now - days``.

    For a table that nobody appends to meanwhile (``expire`` is for tables with a running writer). Only partitions
    holding expired rows are touched. Their surviving rows are first written to a staging
    folder next to the table (shared storage), then put back with dynamic partition overwrite (each partition
    is replaced by Spark's commit, so a failure leaves the old or the new partition); partitions with no
    survivor are deleted. A re-run after a failure simply repeats the steps. Returns the rows removed.
    """
    cutoff = now.astimezone(dt.timezone.utc) - dt.timedelta(days=days)
    if not _partitions(spark, path, partition_col):
        return 0  # an empty table has no file to read a schema from
    table = spark.read.parquet(path)
    expired = F.col("created_at") < F.lit(cutoff)
    affected = [r[0] for r in table.filter(expired).select(partition_col).distinct().collect()]  # partition values
    if not affected:
        return 0
    scope = table.filter(F.col(partition_col).isin(affected))
    removed = scope.filter(expired).count()
    staging = path.rstrip("/") + "_retention_staging"
    scope.filter(~expired).write.mode("overwrite").partitionBy(partition_col).parquet(staging)
    survivors = spark.read.parquet(staging)
    kept_parts = {r[0] for r in survivors.select(partition_col).distinct().collect()}
    if kept_parts:
        survivors.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(partition_col).parquet(path)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for value in set(affected) - kept_parts:
        part = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{partition_col}={value}")
        part.getFileSystem(conf).delete(part, True)
    stage = jvm.org.apache.hadoop.fs.Path(staging)
    stage.getFileSystem(conf).delete(stage, True)
    return removed


def _partitions(spark, path: str, partition_col: str) -> list[str]:
    """Values of the partition folders of a table, by listing its folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{partition_col}="))


def _drop_folder(spark, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _replace_day(survivors: DataFrame, path: str) -> None:
    """Put ``survivors`` (of one created_date) in the place of that day's files; other days are not touched."""
    survivors.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("created_date").parquet(path)


def expire(spark, path: str, schema: str, now: dt.datetime, days: int = K.RETENTION_DAYS) -> int:
    """RET1 beside a running writer: remove rows with ``created_at < now - days`` from a table partitioned by
    ``created_date``, the UTC day on which a row was stored. Returns the rows removed.

    A writer only ever adds to the present day, retention only ever changes days that lie ``days`` back, so neither
    can lose what the other does. Days before the cutoff's are dropped as folders; of the cutoff's own day the rows
    that stay are staged and put in its place. What is read and written are those days, however large the table. A
    run that fails is simply repeated. An empty table, or one without days that old, gives 0.
    """
    cutoff = now.astimezone(dt.timezone.utc) - dt.timedelta(days=days)
    edge = cutoff.date()
    old = [d for d in _partitions(spark, path, "created_date") if d <= edge.isoformat()]
    if not old:
        return 0
    table = spark.read.schema(schema).parquet(path).where(F.col("created_date") <= F.lit(edge))
    expired = F.col("created_at") < F.lit(cutoff)
    removed = table.where((F.col("created_date") < F.lit(edge)) | expired).count()
    for day in old:
        if day < edge.isoformat():
            _drop_folder(spark, f"{path.rstrip('/')}/created_date={day}")
    if edge.isoformat() in old:
        own = table.where(F.col("created_date") == F.lit(edge))
        gone, left = own.agg(F.count_if(expired), F.count_if(~expired)).first()
        if gone and left:
            staging = f"{path.rstrip('/')}_expire_staging"
            own.where(~expired).write.mode("overwrite").partitionBy("created_date").parquet(staging)
            _replace_day(spark.read.schema(schema).parquet(staging), path)
            _drop_folder(spark, staging)
        elif gone:
            _drop_folder(spark, f"{path.rstrip('/')}/created_date={edge.isoformat()}")
    return removed


# --- table layout (SNK6) -------------------------------------------------------------------------------------
TELEMETRY_SCHEMA = ("event_id string, device_id string, patient_id string, timestamp timestamp, heart_rate int, "
                    "spo2 int, temperature double, created_at timestamp, created_date date")
ALERTS_SCHEMA = ("dedup_key string, patient_id string, alert_type string, detected_at timestamp, "
                 "created_at timestamp, created_date date")


def create_tables(spark, tables_dir: str) -> None:
    """``CREATE TABLE IF NOT EXISTS`` for the two parquet tables (partitioned by the day on which a row is stored). An
    empty table has no data file to infer from, so readers pass the declared schema (``read_declared``)."""
    import os

    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name, schema in (("telemetry", TELEMETRY_SCHEMA), ("alerts", ALERTS_SCHEMA)):
        path = os.path.join(tables_dir, name)
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(conf).exists(p):
            spark.createDataFrame([], schema).write.partitionBy("created_date").parquet(path)


def read_declared(spark, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_alerts(spark, path: str) -> DataFrame:
    """Alerts table read across layouts with the declared schema: in files written before ``dedup_key`` existed the key
    is null and gets backfilled from (patient, type, 300 s bucket). A table without files has no rows."""
    from pulsegrid.functions.ids import alert_dedup_key
    raw = spark.read.schema(ALERTS_SCHEMA).parquet(path)
    computed = alert_dedup_key(F.col("patient_id"), F.col("alert_type"), F.col("detected_at"))
    return raw.select("patient_id", "alert_type", "detected_at", F.coalesce("dedup_key", computed).alias("dedup_key"),
                      F.col("dedup_key").isNull().alias("backfilled"), "created_at")
