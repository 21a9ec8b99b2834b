"""Readers for the driver's parquet tables (column pruning and filters reach the scan)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.session import configure


# Declared schemas: no inference job per read (on a large table inference lists and opens files).
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events(event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string)``."""
    return read_table(spark, sf_dir, "events")
