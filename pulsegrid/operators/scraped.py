"""Rates and quantiles over scraped samples ``(ts, job, name, labels, value)``, as a monitoring server computes them.

A rate looks back from an evaluation time over ``lookback`` seconds, (t - lookback, t]: the increase from the first
sample there to the last one, counter resets taken out, extended to the borders of the look-back by the usual rule (as
far as the border, or half an average step where the border is more than 1.1 steps away, and never below zero at the
start). Evaluation times are multiples of ``step``.

Per series every sample gets its reset-corrected running total and its number, and its neighbours' times. Then a
sample is the last one for the evaluation times from itself to the next sample, and the first one for those from one
look-back after the sample before it: two ranges of grid points that need no other row. The two meet in one window
on (series, evaluation time). So the work follows samples and grid points and not their product with the look-back,
and the history of a series is cut into hours throughout (``sliced.chained``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.functions.sliced import US_PER_SECOND, chained
from pulsegrid.operators.metrics import labels_key

SERIES = ["job", "name", "labels_key"]
SLICE_SECONDS = 3600


def _grid(low: Column, high: Column, step: int) -> Column:
    """Numbers k with low <= k * step < high, as an array."""
    first = F.ceil(low / F.lit(step)).cast("bigint")
    last = F.ceil(high / F.lit(step)).cast("bigint") - 1
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.expr("cast(array() as array<bigint>)"))


def _extended(first: Column, last: Column, at: Column, lookback: int) -> Column:
    """Per-second rate from the first to the last sample (structs us, value, total, seq) of a look-back ending at ``at``."""
    second = F.lit(float(US_PER_SECOND))
    increase = last["total"] - first["total"]
    sampled = (last["us"] - first["us"]) / second
    step = sampled / (last["seq"] - first["seq"])
    to_start = (first["us"] - at + F.lit(lookback * US_PER_SECOND)) / second
    to_end = (at - last["us"]) / second
    to_zero = sampled * (first["value"] / F.nullif(increase, F.lit(0.0)))
    to_start = F.when((increase > 0) & (first["value"] >= 0) & (to_zero < to_start), to_zero).otherwise(to_start)
    start = F.when(to_start < step * 1.1, to_start).otherwise(step / 2)
    end = F.when(to_end < step * 1.1, to_end).otherwise(step / 2)
    return increase * ((sampled + start + end) / sampled) / F.lit(float(lookback))


def _rates(samples: DataFrame, carried: dict[str, Column], lookback: int, step: int) -> DataFrame:
    """``rate`` with the columns ``carried`` of a series in place of its labels.

    Rows are sorted once a stage: by series, slice and time, where samples of one time fall together as well, then by
    series and evaluation time, where a look-back's last sample finds its first. Aggregates would sort the same rows
    again in the task that makes them, and most of these rows meet no other there.
    """
    one = samples.select("job", "name", labels_key(F.col("labels")).alias("labels_key"), F.unix_micros("ts").alias("us"), "value",
                         *(c.alias(n) for n, c in carried.items()))
    one = one.withColumn("_slice", F.floor(F.col("us") / F.lit(SLICE_SECONDS * US_PER_SECOND)).cast("bigint"))
    at_once = Window.partitionBy(*SERIES, "_slice").orderBy("us", F.desc("value"))
    one = (one.withColumn("_again", (F.row_number().over(at_once) > 1) & F.col("us").eqNullSafe(F.lag("us").over(at_once)))
           .where("not _again").drop("_again"))
    s = chained(one, SERIES, "us", "value", "_slice")
    width, every = lookback * US_PER_SECOND, step * US_PER_SECOND
    us = F.col("us")
    as_last = _grid(us, F.least(us + width, F.coalesce("next_us", us + width)), every)
    as_first = _grid(F.greatest(us, F.coalesce(F.col("prev_us") + width, us)), us + width, every)
    point = F.struct("us", "value", "total", "seq")

    def marked(points: Column, name: str) -> Column:
        return F.transform(points, lambda k: F.struct(k.alias("k"), *(
            (point if n == name else F.lit(None).cast("struct<us:bigint,value:double,total:double,seq:bigint>")).alias(n) for n in ("first", "last"))))

    met = (s.select(*SERIES, *carried, F.inline(F.concat(marked(as_last, "last"), marked(as_first, "first"))))
           .withColumn("first", F.max("first").over(Window.partitionBy(*SERIES, "k"))).where("last.seq > first.seq"))
    at = F.col("k") * F.lit(every)
    return met.select(*SERIES, *carried, F.timestamp_micros(at).alias("eval_ts"), _extended(F.col("first"), F.col("last"), at, lookback).alias("rate"))


def rate(samples: DataFrame, lookback: int = 60, step: int = 30) -> DataFrame:
    """AGG12: ``(job, name, labels_key, labels, eval_ts, rate)`` for every series and evaluation time whose look-back
    holds two samples or more. Of samples of a series at one time, the largest value counts."""
    return _rates(samples, {"labels": F.col("labels")}, lookback, step)


def rate_by(samples: DataFrame, by: Sequence[str], lookback: int = 60, step: int = 30) -> DataFrame:
    """``sum by (by) (rate(...))``: ``(name, by..., eval_ts, rate, series)``."""
    carried = {f"_by{i}": F.col("labels")[b] for i, b in enumerate(by)}
    return (_rates(samples, carried, lookback, step).groupBy("name", *(F.col(c).alias(b) for c, b in zip(carried, by, strict=True)), "eval_ts")
            .agg(F.sum("rate").alias("rate"), F.count(F.lit(1)).alias("series")))


def quantile_of_buckets(q: float, les: Column, counts: Column) -> Column:
    """Quantile from arrays of upper bounds (ascending) and cumulative counts, made monotone first: linear inside the
    bucket where the rank falls, its lower end 0 for the first; the highest finite bound where it falls in the last.
    NULL without observations, without two buckets, or where the last bound is not +Inf."""
    monotone = F.transform(counts, lambda c, i: F.array_max(F.slice(counts, 1, i + 1)))
    n = F.size(les)
    rank = F.lit(q) * F.element_at(monotone, -1)
    inner = F.slice(monotone, 1, F.greatest(n - 1, F.lit(0)))
    at = F.array_position(F.transform(inner, lambda c: c >= rank), True).cast("int")  # 0: beyond all finite bounds
    low = F.when(at > 1, F.try_element_at(les, at - 1)).otherwise(F.lit(0.0))
    below = F.when(at > 1, F.try_element_at(monotone, at - 1)).otherwise(F.lit(0.0))
    high = F.try_element_at(les, at)
    inside = low + (high - low) * ((rank - below) / (F.try_element_at(monotone, at) - below))
    return (F.when((n < 2) | (F.element_at(les, -1) != float("inf")) | (F.element_at(monotone, -1) <= 0), F.lit(None).cast("double"))
            .when(at == 0, F.try_element_at(les, n - 1))
            .when((at == 1) & (high <= 0), high).otherwise(inside))


def bucket_quantile(samples: DataFrame, q: float = 0.95, by: Sequence[str] = ("operation",), lookback: int = 300, step: int = 60) -> DataFrame:
    """AGG13: ``histogram_quantile(q, sum by (le, by) (rate(..._bucket[lookback])))``: ``(name, by..., eval_ts, rate,
    quantile)``, where rate is that of all observations (the last bucket, made monotone)."""
    per = rate_by(samples.where(F.col("name").endswith("_bucket")), [*by, "le"], lookback, step)
    le = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double"))
    per = per.groupBy("name", *by, "eval_ts").agg(F.array_sort(F.collect_list(F.struct(le.alias("le"), "rate"))).alias("_b"))
    return per.select("name", *by, "eval_ts", F.array_max("_b.rate").alias("rate"), quantile_of_buckets(q, F.col("_b.le"), F.col("_b.rate")).alias("quantile"))
