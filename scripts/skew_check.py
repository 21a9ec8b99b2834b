"""Skew diagnostic: one user holding a third of all events.

Derives a skewed copy of the driver's ``events`` (every third event is reassigned to user 0) into a scratch
folder, then reports how many rows the largest task partition holds in the sliced 60 s window versus a plain
``Window.partitionBy(patient_id)``.

usage: python scripts/skew_check.py [sf_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from pulsegrid.operators import detect  # noqa: E402
from pulsegrid.session import build_session  # noqa: E402
from pulsegrid.sources import fixtures, tables  # noqa: E402


def largest_partition(df, used: str) -> tuple[int, int]:
    """Rows per task partition of the stage that computes ``used`` (it is consumed, so the window stays)."""
    per = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("c"), F.sum(used).alias("u"))
    sizes = per.agg(F.max("c"), F.count("*"), F.sum("u")).first()
    return int(sizes[0]), int(sizes[1])


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=64,
                          extra={"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    scratch = tempfile.mkdtemp(prefix="pulsegrid-skew-", dir="/tmp")
    ev = tables.events(spark, sf_dir)
    skewed = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    skewed.write.parquet(os.path.join(scratch, "events.parquet"))
    v = fixtures.telemetry(spark, scratch).select("event_id", "patient_id", "ts", "heart_rate")
    # keep all 64 shuffle partitions visible (the session defaults would coalesce this small input)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    total = v.count()
    hot = v.filter(F.col("patient_id") == "patient-000000").count()
    sliced = detect.window_stats(v)
    plain = v.withColumn("n", F.count(F.lit(1)).over(
        Window.partitionBy("patient_id").orderBy(F.unix_micros("ts")).rangeBetween(-60_000_000, 0)))
    s_max, s_parts = largest_partition(sliced, "window_events")
    p_max, p_parts = largest_partition(plain, "n")
    print(f"rows={total} hot_patient_rows={hot} ({hot / total:.0%})")
    print(f"sliced window : largest partition {s_max} rows of {s_parts} partitions")
    print(f"plain window  : largest partition {p_max} rows of {p_parts} partitions")

    # ordered folds: the largest group one task folds
    from pulsegrid.functions.sliced import segment_by_gap, time_slice
    det = detect.detect_sustained(v)
    per_slice = det.groupBy("patient_id", time_slice(F.col("triggered_at"), 3600)).count().agg(F.max("count")).first()[0]
    per_patient = det.groupBy("patient_id").count().agg(F.max("count")).first()[0]
    print(f"cool-down     : largest (patient, 1 h slice) group {per_slice} detections; whole patient {per_patient}")
    req = fixtures.rate_requests(spark, scratch).withColumn("_s", F.floor(F.col("arrival_ms") / 86_400_000))
    seg = segment_by_gap(req, ["device_id"], ["arrival_ms", "seq"], "_s", "arrival_ms", 10_000)
    largest_seg = seg.groupBy("device_id", "segment").count().agg(F.max("count")).first()[0]
    print(f"token bucket  : largest (device, segment) group {largest_seg} requests (no 10 s pause: one streamed task)")


if __name__ == "__main__":
    main()
