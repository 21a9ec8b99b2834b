"""Readers for the message formats: JSON-lines batch documents, accepted-batch logs, Kafka topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import configure

ACCEPTED_LOG_SCHEMA = ("batch_id string, device_id string, patient_id string, event_ids array<string>, "
                       "measurements int, accepted_at timestamp")
LENIENT_BATCH_SCHEMA = ("struct<device_id:string,patient_id:string,batch_id:string,"
                        "measurements:array<struct<timestamp:timestamp,heart_rate:int>>>")


def read_batch_documents(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """SRC1: one JSON batch document per line (``body`` column); ``stream=True`` gives a file stream."""
    configure(spark)
    reader = spark.readStream if stream else spark.read
    return reader.text(path).withColumnRenamed("value", "body")


def parse_batches(docs: DataFrame, body_col: str = "body") -> DataFrame:
    """SRC1 decode (lenient: unknown fields ignored). Adds device_id, patient_id, batch_id, measurements."""
    parsed = F.from_json(F.col(body_col), LENIENT_BATCH_SCHEMA)
    return docs.select("*", parsed["device_id"].alias("device_id"), parsed["patient_id"].alias("patient_id"),
                       parsed["batch_id"].alias("batch_id"), parsed["measurements"].alias("measurements"))


def read_accepted_log(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: the accepted-batch JSON-lines log, read with its fixed schema (no inference)."""
    configure(spark)
    return spark.read.schema(ACCEPTED_LOG_SCHEMA).json(path)


def read_kafka(spark: SparkSession, servers: str, topic: str, stream: bool = True,
               starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """SRC2: a Kafka topic as (key, value, topic, partition, offset, timestamp, headers) with key/value as
    strings. Needs the Kafka connector on the classpath (absent in the test image); offsets are tracked by
    the streaming checkpoint, so a restart resumes where the last committed micro-batch ended."""
    configure(spark)
    reader = (spark.readStream if stream else spark.read).format("kafka")
    reader = (reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
              .option("startingOffsets", starting_offsets).option("includeHeaders", "true"))
    if stream and max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    df = reader.load()
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                     "topic", "partition", "offset", "timestamp", "headers")
