"""Session defaults.

Only runtime SQL settings are applied to an existing session; cluster-level settings (memory, cores,
checkpoint folder) belong to whoever launches the job.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on.
RUNTIME_CONF = {
    # all timestamps are instants rendered in UTC
    "spark.sql.session.timeZone": "UTC",
    # JSON objects with repeated keys keep the last value (Go's decoder does the same)
    "spark.sql.variant.allowDuplicateKeys": "true",
    # base64 without MIME line breaks
    "spark.sql.chunkBase64String.enabled": "false",
    # runtime re-planning: coalesce small shuffles, split skewed join partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app: str = "pulsegrid", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass no master and let spark-submit decide."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # no per-Column Python call-site capture (error context only; it dominates plan-building time)
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher must set it (a folder that every executor can reach); without it this raises. Only a
    local master, as in tests, gets a scratch folder of its own, which is then registered.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="pulsegrid-ckpt-", dir=os.environ.get("PULSEGRID_SCRATCH", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, its lineage cut, safe from lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/pulsegrid/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
