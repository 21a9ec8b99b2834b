"""The dealt operators applied to their whole tables with production parameters, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import (
    alignment,
    ann,
    embed_dedup,
    html,
    minhash,
    mixing,
    packing,
    phrases,
    secret_scan,
    substring,
    token_counts,
    toxicity,
    warc,
)
from pulsegrid.llm.common import prepare, read_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(prepare(spark), sf_dir, name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html.extract(_table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words_per_shingle=4)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(_table(spark, sf_dir, "documents"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_table(spark, sf_dir, "documents"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_packing": op7_packing,
    "op8_warc": op8_warc,
    "op9_mixing": op9_mixing,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_token_counts": op13_token_counts,
}

ORACLES: dict[str, str] = {
    "op9_mixing": mixing.TAKEN_SQL,
    "op12_phrase_collocations": phrases.COLLOCATIONS_SQL,
}
