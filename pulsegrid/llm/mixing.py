"""Mixing sources to target weights, with DataFrame functions only.

Words are totalled per source (partial sums first). Sources in code-point order, null last, get the weights
1, 2, 3, 1, ...; each is to hold its weight's share of all words, but at most ``MAX_REPEAT`` times its own. The excess
is shared anew by weight until no source is above its cap; that fixed point is found in closed form: sources sorted
by cap per weight are capped in that order, as long as the level of the rest would lift them over their cap. The
repetition rate of a source is target / size; a document is taken floor(rate) times, and once more with probability
equal to the fraction, decided by a hash of seed and doc_id, so that reruns agree.

The per-source table has one row per source; documents meet it in one join on the source (a hot source is split by
adaptive execution, or the table is broadcast after its size is measured).

Defined results: null or wordless text has size 0; a null source is a source of its own; sources without words get
target 0 and rate 0; rows that repeat a doc_id fare alike. Extra columns are kept by ``mix`` and ignored by
``taken``. No documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import materialise, prepare

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEAT = 3
SEED = "mix-1"
_HEX = 12  # hex digits of the hash that make the uniform number: 48 bits, exact in a double


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """``(source, source_size, target)`` of ``sized(source, size)``."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (number % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(MAX_REPEAT)))
    # in order of cap per weight; what is capped before a row, and the weight from it on
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    since = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = (per.withColumn("total", F.sum("source_size").over(everything).cast("double"))
           .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(since))
           .withColumn("capped", F.col("level") * F.col("weight") >= F.col("cap")))
    # the level that holds is that of the first source that keeps under its cap
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)["level"]
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight")))
    return per.select("source", "source_size", target.alias("target"))


def with_copies(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """``rows(doc_id, source, ...)`` with their source's size and target and the ``copies`` to take of each."""
    targets = targets.withColumnRenamed("source", "_of")
    rate = F.least(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0), F.lit(float(MAX_REPEAT)))
    digest = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    uniform = F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("double") / F.lit(float(16 ** _HEX))
    copies = F.floor(rate) + F.when(uniform < rate - F.floor(rate), 1).otherwise(0)
    return (rows.join(targets, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of")
            .withColumn("copies", copies.cast("int")))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: each row of ``docs(doc_id, text, source, ...)`` as often as it is taken, with its own columns."""
    prepare(docs.sparkSession)
    targets = source_targets(docs.select("source", n_words(F.col("text")).alias("size")))
    packed = docs.select("doc_id", "source", F.struct(*(F.col(c) for c in docs.columns)).alias("_row"))
    chosen = with_copies(packed, targets).where("copies > 0")
    return chosen.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_row.*")


def taken(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken (words that the mix takes, repeats counted)."""
    prepare(docs.sparkSession)
    sized = materialise(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    planned = with_copies(sized, source_targets(sized))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


TAKEN_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
per AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS cap,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)),
-- a source is capped when the level at which caps and weights fill up to the total lies over its cap per weight
level AS (
  SELECT max(l) AS level FROM (
    SELECT ((SELECT sum(source_size) FROM per) - coalesce((SELECT sum(cap) FROM per p WHERE p.cap / p.weight < q.cap / q.weight), 0))
           / (SELECT sum(weight) FROM per p WHERE p.cap / p.weight >= q.cap / q.weight) AS l,
           q.cap / q.weight AS ratio
    FROM per q) WHERE l < ratio OR ratio = (SELECT max(cap / weight) FROM per)),
t AS (SELECT source, source_size, least(cap, level * weight) AS target FROM per, level),
r AS (
  SELECT doc_id, size, source_size, target, least(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END, 3.0) AS rate,
         CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, {_HEX}) AS BIGINT)::DOUBLE / {16 ** _HEX}.0 AS u
  FROM d LEFT JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""
