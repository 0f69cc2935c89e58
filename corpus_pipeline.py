"""From raw documents to packed sequences, stage by stage; each reads what the last one wrote.

Every stage but the last takes and returns documents (doc_id, text, lang, source,
n_chars). Language identification drops documents without a language; of near-duplicates
the smallest doc_id stays; words of repeated passages go, and documents that lose all;
secrets give way to a mark; packing returns the pieces of training sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sieveline.llm.language import keep_identified
from sieveline.llm.near import keep_one
from sieveline.llm.packing import pack_documents
from sieveline.llm.secrets import mask_secrets
from sieveline.llm.substrings import remove_repeats
from sieveline.llm.tokens import added_tokens
from sieveline.sources.writers import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs.select(COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs.select(COLUMNS))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeats(docs.select(COLUMNS))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mask_secrets(docs.select(COLUMNS), *_vocabulary())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(docs, *_vocabulary(), added=added_tokens(public_tokenizers.path("byte_bpe_50k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: Learned, sampled and tokenizing stages: no SQL; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
