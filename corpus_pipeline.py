"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

toxicity            documents predicted to be toxic go
minhash_near_dedup  one document of each near-duplicate group (five-word shingles, similarity 0.8) stays
secret_scan         reported secrets are masked in the text, n_chars kept in step; every document stays
mixing              documents are taken as often as their source's target asks for
packing             one row per piece of the packed training sequences

All but the last return the columns of their input. SQL cannot express the first two and the last stage, so there is
no ORACLE_SQL; tests/llm compares the pipeline with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import minhash, mixing, packing, secret_scan, toxicity
from pulsegrid.llm.common import materialise, prepare, read_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, read_table(prepare(spark), sf_dir, "labels"))


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.deduplicate(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("minhash_near_dedup", minhash_stage),
    ("secret_scan", secret_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``; returns the packed pieces."""
    docs = read_table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
