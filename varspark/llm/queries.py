"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varspark.llm import collocations, decontaminate, filter_audit, hilbert_shards, jaccard_join, language_id, line_dedup, mixing, oracle, permutation_index, suffix_dedup, token_store, url_filter, warc

# The rules of the URL contract, then host names that the method itself blocks.
SITE_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
BLOCKED_NAMES = ["ads-track", "adult-x", "casino-win", "cheap-pills"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_json(name: str = "byte_bpe_50k.json") -> str:
    """Content of a tokenizer file of the driver; it goes to the tasks with their code."""
    return Path(public_tokenizers.path(name)).read_text()


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_suffixes(table(spark, sf_dir, "documents")).drop("kept")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_groups(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.neighbours(table(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = language_id.identify(docs.select("doc_id", "text"), language_id.fit(docs))
    return named.select(
        "doc_id",
        language_id.held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_ambiguous").alias("ambiguous"),
    )


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encoded_documents(table(spark, sf_dir, "documents"), tokenizer_json())


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [url_filter.site_rule(*r) for r in SITE_RULES] + [url_filter.name_rule(n) for n in BLOCKED_NAMES]
    judged = url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimensions = {"source": F.col("source"), "lang": F.col("lang"), "bytes": F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")}
    return hilbert_shards.sharded_documents(table(spark, sf_dir, "documents"), dimensions)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = [
    op1_line_dedup, op2_suffix_dedup, op3_warc, op4_jaccard_join, op5_decontaminate, op6_mix_sources, op7_nearest, op8_language_id, op9_token_ids, op10_url_filter,
    op11_filter_audit, op12_hilbert_shards, op13_collocations,
]


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}


def all_sql() -> dict[str, str]:
    return oracle.SQL
