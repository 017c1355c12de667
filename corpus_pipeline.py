"""Corpus pipeline: documents go through the stages one after the other.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept. All but the last return documents with their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varspark.llm import decontaminate, jaccard_join, language_id, mixing, token_store
from varspark.llm.queries import table, tokenizer_json
from varspark.session import stored


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those undetermined or ambiguous go."""
    named = language_id.identify(docs, language_id.fit(docs))
    return named.where((F.col("lang_pred") != language_id.UNDETERMINED) & ~F.col("lang_ambiguous")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of like ones."""
    return jaccard_join.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights; a document comes as often as the mix takes it."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in binary shards, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_store.encoded_documents(docs, tokenizer_json())


STAGES = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_output", token_output),
]

# Language models and tokenizers are not SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
