"""Pipeline metrics: counters, gauges, histograms, the text exposition, rates, quantiles, roll-ups.

Observations are rows ``(seq, ts, kind, name, labels map<string,string>, value)``. Every aggregate is a
``groupBy`` on the series key — partial aggregation happens before the shuffle, so a hot series costs one
row per task, not one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid import constants as K
from pulsegrid.functions.sliced import previous_row

# --- fixed values: histogram bound labels, as the registry prints them ---------------------
BOUND_LABELS = ["0.001", "0.005", "0.01", "0.025", "0.05", "0.1", "0.25", "0.5", "1", "2.5", "5", "10"]

SCRAPE_SECONDS = 5


# --- labels and numbers ------------------------------------------------------------------------

def labels_key(labels: Column) -> Column:
    """AGG4: canonical series key: ``k=v`` pairs sorted by key, joined with ','."""
    entries = F.array_sort(F.map_entries(labels))
    return F.coalesce(F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","),
                      F.lit(""))


def escape_label_value(v: Column) -> Column:
    return F.replace(F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")),
                     F.lit('"'), F.lit('\\"'))


def render_labels(labels: Column) -> Column:
    """AGG4: ``{k="v",...}`` sorted by key with escaping; '' for no labels."""
    entries = F.array_sort(F.map_entries(labels))
    body = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit('="'), escape_label_value(e["value"]),
                                                                F.lit('"'))), ",")
    return F.when(F.size(entries) > 0, F.concat(F.lit("{"), body, F.lit("}"))).otherwise(F.lit(""))


def go_float_text(v: Column) -> Column:
    """Shortest decimal text of a double, plain for exponents -4 to 5 and ``d.ddde±XX`` otherwise; '0' for
    NaN/±Inf (as the exposition writes numbers). The digits are those of the JVM's text of a double: they read back
    as the same number, but before Java 19 the 17th may differ from the closest choice."""
    text = F.abs(v).cast("string")  # shortest digits, as d.ddd or d.dddE-xx
    mant = F.regexp_extract(text, "^([0-9.]+)", 1)
    whole, frac = F.split_part(mant, F.lit("."), F.lit(1)), F.split_part(mant, F.lit("."), F.lit(2))
    every = F.concat(whole, frac)
    led = F.regexp_replace(every, "^0+", "")
    digits = F.regexp_replace(led, "0+$", "")
    exp = (F.length(whole) - 1 - (F.length(every) - F.length(led))
           + F.coalesce(F.regexp_extract(text, "E(.+)$", 1).try_cast("int"), F.lit(0)))

    def pointed(head: Column, tail: Column) -> Column:
        return F.concat(head, F.when(tail != "", F.concat(F.lit("."), tail)).otherwise(F.lit("")))

    def rest(at: Column) -> Column:
        return F.substring(digits, at, F.lit(400))

    sci = F.concat(pointed(F.substring(digits, 1, 1), rest(F.lit(2))), F.lit("e"),
                   F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.when(F.abs(exp) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(exp).cast("string"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    plain = F.when(exp < 0, small).otherwise(
        pointed(F.rpad(F.substring(digits, F.lit(1), exp + 1), exp + 1, F.lit("0")), rest(exp + 2)))
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    finite = ~(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    body = F.when((exp < -4) | (exp >= 6), sci).otherwise(plain)
    return F.when(~finite | (v == 0), F.lit("0")).otherwise(F.concat(sign, body))


# --- aggregates ------------------------------------------------------------------------------

def counters(obs: DataFrame) -> DataFrame:
    """AGG1: sum per (name, labels); negative increments are ignored."""
    c = obs.filter((F.col("kind") == "counter") & (F.col("value") >= 0))
    return (c.groupBy("name", labels_key(F.col("labels")).alias("labels_key"))
            .agg(F.sum("value").alias("value"), F.first("labels").alias("labels")))


def gauges(obs: DataFrame) -> DataFrame:
    """AGG2: last value (by seq) per (name, labels)."""
    g = obs.filter(F.col("kind") == "gauge")
    return (g.groupBy("name", labels_key(F.col("labels")).alias("labels_key"))
            .agg(F.max_by("value", "seq").alias("value"), F.first("labels").alias("labels")))


def histograms(obs: DataFrame) -> DataFrame:
    """AGG3: per (name, labels): ``buckets`` = cumulative counts ``value <= bound`` for the 12 bounds, count, sum
    (one pass, 14 partial aggregates)."""
    h = obs.filter(F.col("kind") == "histogram")
    aggs = [F.count_if(F.col("value") <= F.lit(float(b))).alias(f"_b{i}") for i, b in enumerate(K.HISTOGRAM_BOUNDS)]
    out = (h.groupBy("name", labels_key(F.col("labels")).alias("labels_key"))
           .agg(*aggs, F.count(F.lit(1)).alias("count"), F.sum("value").alias("sum"),
                F.first("labels").alias("labels")))
    return out.select("name", "labels_key", "labels",
                      F.array(*[F.col(f"_b{i}") for i in range(len(K.HISTOGRAM_BOUNDS))]).alias("buckets"),
                      "count", "sum")


def histogram_long(hist: DataFrame) -> DataFrame:
    """Long form: one row per (name, labels, le) including ``+Inf`` (= count)."""
    les = F.array(*[F.lit(x) for x in BOUND_LABELS + ["+Inf"]])
    counts = F.concat(F.col("buckets"), F.array(F.col("count")))
    return hist.select("name", "labels_key",
                       F.inline(F.arrays_zip(les.alias("le"), counts.alias("cum_count"))))


def definitions(spark: SparkSession) -> DataFrame:
    rows = [(n, kind, help_) for n, (kind, help_) in sorted(K.METRIC_DEFINITIONS.items())]
    return spark.createDataFrame(rows, "name string, kind string, help string")


def exposition(spark: SparkSession, obs: DataFrame) -> DataFrame:
    """SNK9: the text exposition as rows ``(name, section, labels_key, ord, line)``; ordering by those columns
    gives the file: metrics by name, each with HELP and TYPE, then its series by label key (histograms:
    12 buckets, +Inf, _sum, _count). Only defined metric names are written."""
    defs = definitions(spark)
    header = defs.select("name", F.lit(0).alias("section"), F.lit("").alias("labels_key"),
                         F.inline(F.array(
                             F.struct(F.lit(0).alias("ord"), F.concat(F.lit("# HELP "), F.col("name"), F.lit(" "),
                                                                      F.col("help")).alias("line")),
                             F.struct(F.lit(1).alias("ord"), F.concat(F.lit("# TYPE "), F.col("name"), F.lit(" "),
                                                                      F.col("kind")).alias("line")))))
    scalar = counters(obs).unionByName(gauges(obs))
    scalar = scalar.join(defs.filter(F.col("kind") != "histogram").select("name"), "name", "left_semi")
    scalar_lines = scalar.select("name", F.lit(1).alias("section"), "labels_key", F.lit(0).alias("ord"),
                                 F.concat(F.col("name"), render_labels(F.col("labels")), F.lit(" "),
                                          go_float_text(F.col("value"))).alias("line"))
    hist = histograms(obs).join(defs.filter(F.col("kind") == "histogram").select("name"), "name", "left_semi")
    les = BOUND_LABELS + ["+Inf"]

    def with_le(le: str) -> Column:
        return F.map_concat(F.map_filter(F.col("labels"), lambda k, _: k != "le"),
                            F.create_map(F.lit("le"), F.lit(le)))

    bucket_lines = [F.struct(F.lit(i).alias("ord"),
                             F.concat(F.col("name"), F.lit("_bucket"), render_labels(with_le(le)), F.lit(" "),
                                      (F.col("buckets")[i] if i < len(BOUND_LABELS) else F.col("count"))
                                      .cast("string")).alias("line"))
                    for i, le in enumerate(les)]
    tail = [F.struct(F.lit(len(les)).alias("ord"),
                     F.concat(F.col("name"), F.lit("_sum"), render_labels(F.col("labels")), F.lit(" "),
                              go_float_text(F.col("sum"))).alias("line")),
            F.struct(F.lit(len(les) + 1).alias("ord"),
                     F.concat(F.col("name"), F.lit("_count"), render_labels(F.col("labels")), F.lit(" "),
                              F.col("count").cast("string")).alias("line"))]
    hist_lines = hist.select("name", F.lit(1).alias("section"), "labels_key", F.inline(F.array(*bucket_lines, *tail)))
    return header.unionByName(scalar_lines).unionByName(hist_lines)


def write_exposition(lines: DataFrame, path: str) -> None:
    """SNK9 writer: text file(s) in exposition order (range-partitioned sort, no single-task funnel)."""
    lines.orderBy("name", "section", "labels_key", "ord").select("line").write.mode("overwrite").text(path)


def counter_samples(obs: DataFrame, reset_col: str, scrape_seconds: int = SCRAPE_SECONDS) -> DataFrame:
    """SRC6: scraped cumulative counter samples ``(ts, seq, name, labels_key, value)``: each counter observation counts
    1, the running count restarts when ``reset_col`` changes (a process restart). Observations are first counted per
    (series, scrape), a partial aggregate, so that the ordered steps see at most one row per series and scrape."""
    from pulsegrid.functions.sliced import running_sum, time_slice

    scrape = F.timestamp_seconds(time_slice(F.col("ts"), scrape_seconds) * scrape_seconds)
    c = (obs.filter(F.col("kind") == "counter")
         .groupBy("name", labels_key(F.col("labels")).alias("labels_key"), F.col(reset_col).alias("_epoch"),
                  scrape.alias("ts"))
         .agg(F.count(F.lit(1)).alias("_n"), F.max("seq").alias("seq"))
         .withColumn("_slice", time_slice(F.col("ts"), 3600)))
    s = running_sum(c, ["name", "labels_key", "_epoch"], ["ts", "seq"], "_slice", "_n", "value")
    return s.select("ts", "seq", "name", "labels_key", F.col("value").cast("double").alias("value"))


def counter_increase(samples: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """Reset-aware increase of each sample over the previous sample of its series (``value`` when the counter
    went down; the first sample counts from 0). Previous sample via a sliced lag (no per-series task)."""
    from pulsegrid.functions.sliced import time_slice

    s = samples.withColumn("_slice", time_slice(F.col("ts"), slice_seconds))
    p = previous_row(s, ["name", "labels_key"], ["ts", "seq"], "_slice", ["value"], prefix="prev_")
    inc = (F.when(F.col("prev_value").isNull(), F.col("value"))
           .when(F.col("value") >= F.col("prev_value"), F.col("value") - F.col("prev_value"))
           .otherwise(F.col("value")))
    return p.select("ts", "seq", "name", "labels_key", inc.alias("increase"))


def rate(samples: DataFrame, window_seconds: int = 60, by_labels: bool = False) -> DataFrame:
    """AGG12: per-second rate per tumbling ``window``: summed reset-aware increase / window seconds, summed over
    series (optionally kept per label set). No edge extrapolation."""
    inc = counter_increase(samples)
    keys = ["name", "labels_key"] if by_labels else ["name"]
    w = F.window("ts", f"{window_seconds} seconds")
    return (inc.groupBy(*keys, w.alias("w"))
            .agg((F.sum("increase") / F.lit(float(window_seconds))).alias("rate"))
            .select(*keys, F.col("w.start").alias("window_start"), F.round("rate", 6).alias("rate")))


def quantile_from_buckets(q: float, buckets: Column, count: Column) -> Column:
    """AGG13: quantile from cumulative bucket counts (12 bounds + count as +Inf): linear interpolation inside
    the bucket where the rank falls (lower edge 0 for the first); the highest finite bound when the rank falls
    in +Inf; NULL for no observations."""
    bounds = F.array(*[F.lit(float(b)) for b in K.HISTOGRAM_BOUNDS])
    cum = F.concat(buckets, F.array(count)).cast("array<double>")
    rank = F.lit(q) * count
    idx = F.array_position(F.transform(cum, lambda c: c >= rank), True)  # 1-based; 13 = +Inf
    hi_b = F.try_element_at(bounds, idx.cast("int"))
    lo_b = F.when(idx > 1, F.try_element_at(bounds, (idx - 1).cast("int"))).otherwise(F.lit(0.0))
    c_hi = F.try_element_at(cum, idx.cast("int"))
    c_lo = F.when(idx > 1, F.try_element_at(cum, (idx - 1).cast("int"))).otherwise(F.lit(0.0))
    inside = lo_b + (hi_b - lo_b) * (rank - c_lo) / (c_hi - c_lo)
    return (F.when(count == 0, F.lit(None).cast("double"))
            .when(idx == len(K.HISTOGRAM_BOUNDS) + 1, F.lit(float(K.HISTOGRAM_BOUNDS[-1])))
            .otherwise(inside))


def histogram_quantile(obs: DataFrame, q: float = 0.95, window_seconds: int = 300) -> DataFrame:
    """AGG13 over tumbling windows: bucket increases per window (= observations in it), then the quantile."""
    h = obs.filter(F.col("kind") == "histogram").withColumn("w", F.window("ts", f"{window_seconds} seconds"))
    aggs = [F.count_if(F.col("value") <= F.lit(float(b))).alias(f"_b{i}") for i, b in enumerate(K.HISTOGRAM_BOUNDS)]
    per = (h.groupBy("name", labels_key(F.col("labels")).alias("labels_key"), "w")
           .agg(*aggs, F.count(F.lit(1)).alias("count")))
    buckets = F.array(*[F.col(f"_b{i}") for i in range(len(K.HISTOGRAM_BOUNDS))])
    return per.select("name", "labels_key", F.col("w.start").alias("window_start"), "count",
                      F.round(quantile_from_buckets(q, buckets, F.col("count")), 6).alias("quantile"))


def service_up(samples: DataFrame) -> DataFrame:
    """AGG14: latest ``up`` sample per job."""
    return samples.groupBy("job").agg(F.max_by("up", F.struct("ts", "seq")).cast("int").alias("up"),
                                      F.max("ts").alias("last_seen"))


def readiness(checks: DataFrame, period: str = "1 minute") -> DataFrame:
    """AGG15: per period, ready only if every dependency check passed."""
    w = F.window("ts", period)
    return (checks.groupBy(w.alias("w"))
            .agg(F.bool_and("ok").alias("_ok"), F.count(F.lit(1)).alias("checks"),
                 F.count_if(~F.col("ok")).alias("failed_checks"))
            .select(F.col("w.start").alias("period_start"),
                    F.when(F.col("_ok"), F.lit("ready")).otherwise(F.lit("not_ready")).alias("status"),
                    "checks", "failed_checks"))


def route_label(method: Column, path: Column) -> Column:
    """AGG6: request route label: 'METHOD /path' for the known paths, else 'unmatched'."""
    known = ["/api/v1/telemetry", "/health", "/ready", "/metrics"]
    return F.when(path.isin(*known), F.concat(method, F.lit(" "), path)).otherwise(F.lit("unmatched"))


def request_counters(access: DataFrame) -> DataFrame:
    """AGG6: ingestion_http_requests_total by (method, route, status)."""
    return (access.groupBy("method", route_label(F.col("method"), F.col("path")).alias("route"),
                           F.col("status").cast("string").alias("status"))
            .agg(F.count(F.lit(1)).alias("requests")))


def ingestion_metrics(access: DataFrame, checks: DataFrame) -> DataFrame:
    """AGG6: the ingestion service's six metrics as scraped samples ``(name, labels_key, value)``.

    ``access``: requests (method, path, status, latency_ms, measurements, reason); ``checks``: readiness checks (ts,
    seq, dependency, ok). Request counts and the duration histogram (the client library's default bounds, cumulative,
    with sum and count) come from one grouping of the log by (method, route, status); events count as published with
    the 202 answers that carry them, errors and backpressure by the answer's reason; a dependency is up as its latest
    check says. The counters without labels are there from the start, at 0.
    """
    route = route_label(F.col("method"), F.col("path"))
    seconds = F.col("latency_ms") / F.lit(1000.0)
    bounds = K.INGESTION_DURATION_BOUNDS
    per = (access.groupBy("method", route.alias("route"), F.col("status").cast("string").alias("status"))
           .agg(F.count(F.lit(1)).alias("n"), F.sum(seconds).alias("sum"),
                F.sum(F.when(F.col("status") == 202, F.col("measurements")).otherwise(F.lit(0))).alias("published"),
                F.count_if(F.col("reason") == "publisher_unavailable").alias("errors"),
                F.count_if(F.col("reason") == "publisher_backpressure").alias("backpressure"),
                *[F.count_if(seconds <= F.lit(float(b))).alias(f"_b{i}") for i, b in enumerate(bounds)]))

    def line(name: str, key: Column, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), key.alias("labels_key"), value.cast("double").alias("value"))

    requests = per.select(F.inline(F.array(line(
        "ingestion_http_requests_total", F.concat(F.lit("method="), "method", F.lit(",route="), "route", F.lit(",status="), "status"), F.col("n")))))
    hist = per.groupBy("method", "route").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"), *[F.sum(f"_b{i}").alias(f"_b{i}") for i in range(len(bounds))])
    name = "ingestion_http_request_duration_seconds"
    labels = F.concat(F.lit("method="), F.col("method"), F.lit(",route="), F.col("route"))

    def le(bound: str) -> Column:
        return F.concat(F.lit(f"le={bound},"), labels)

    buckets = [line(f"{name}_bucket", le(f"{b:g}"), F.col(f"_b{i}")) for i, b in enumerate(bounds)]
    durations = hist.select(F.inline(F.array(*buckets, line(f"{name}_bucket", le("+Inf"), F.col("n")), line(f"{name}_sum", labels, F.col("sum")),
                                             line(f"{name}_count", labels, F.col("n")))))
    total = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("published", "errors", "backpressure")])
    none = F.lit("")
    plain = total.select(F.inline(F.array(line("ingestion_telemetry_events_published_total", none, F.col("published")),
                                          line("ingestion_telemetry_publish_errors_total", none, F.col("errors")),
                                          line("ingestion_publisher_backpressure_total", none, F.col("backpressure")))))
    up = (checks.groupBy("dependency").agg(F.max_by("ok", F.struct("ts", "seq")).alias("ok"))
          .select(F.inline(F.array(line("ingestion_readiness_check_up", F.concat(F.lit("dependency="), F.col("dependency")), F.col("ok").cast("int"))))))
    return requests.unionByName(durations).unionByName(plain).unionByName(up)


def metric_tags(routed: DataFrame) -> DataFrame:
    """AGG5/AGG11: per processed message, the counter increments it causes, as (name, labels_key) rows."""
    def tag(name: str, labels: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), labels.alias("labels_key"))

    dlq = F.col("route") == "dlq"
    tags = F.array(
        tag("processing_kafka_messages_total",
            F.concat(F.lit("status="), F.when(dlq, F.lit("dlq")).otherwise(F.lit("processed")))),
        tag("processing_kafka_commits_total", F.lit("status=success")),
        F.when(dlq, tag("processing_dlq_messages_total", F.concat(F.lit("reason="), F.col("dlq_reason")))),
        F.when(F.col("dlq_reason") == "validation", tag("processing_errors_total", F.lit("stage=validate"))))
    return routed.select(F.inline(F.filter(tags, lambda t: t.isNotNull())))
