"""Corpus build: ingest, clean, deduplicate, chunk, and optionally write."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sieveline.config import MAX_TOKENS, STRIDE
from sieveline.operators.corpus import chunk_documents, clean_docs, dedup_docs
from sieveline.sources.readers import ingest
from sieveline.sources.writers import remove_path, write_corpus


#: Folder of rows without a partition value.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def corpus_pipeline(
    docs: DataFrame, max_tokens: int = MAX_TOKENS, stride: int = STRIDE
) -> DataFrame:
    """Documents to chunks in one lineage with a single shuffle, by ``doc_id``.

    A table without the required columns is an error before anything runs.
    """
    return chunk_documents(dedup_docs(clean_docs(ingest(docs))), max_tokens, stride)


def build_corpus(
    docs: DataFrame, path: str, max_tokens: int = MAX_TOKENS, stride: int = STRIDE
) -> dict[str, float]:
    """Run the pipeline into ``path``; both counts are observed during the write."""
    started = time.perf_counter()
    seen, made = Observation("documents_in"), Observation("chunks_out")
    counted = docs.observe(seen, F.count(F.lit(1)).alias("n"))
    chunks = corpus_pipeline(counted, max_tokens, stride).observe(made, F.count(F.lit(1)).alias("n"))
    write_corpus(chunks, path)
    return {
        "n_docs_in": seen.get["n"],
        "n_chunks_out": made.get["n"],
        "elapsed_s": round(time.perf_counter() - started, 2),
    }


def source_manifest(docs: DataFrame) -> DataFrame:
    """domain, file, n, digest: what each source file holds of each domain, whatever the order of rows."""
    content = F.xxhash64(*docs.columns).cast("decimal(20,0)")
    return (
        docs.groupBy("domain", F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(content).cast("string").alias("digest"))
    )


def update_corpus(
    spark: SparkSession, source: str, target: str, max_tokens: int = MAX_TOKENS, stride: int = STRIDE
) -> list[str]:
    """Bring ``target/corpus`` up to date with the files under ``source``; returns the domains that were built.

    ``target/manifest`` lists the built files with a digest of their content per domain. Domains
    with a new, changed or missing file are built again from their files, others are not
    read beyond the digest. The manifest is written last, as a new version, so that a run that
    ends early is done again; with nothing to build nothing is written.
    """
    docs = spark.read.parquet(source)
    now = source_manifest(docs)
    versions = _manifest_versions(spark, target)
    if versions:
        then = spark.read.parquet(f"{target}/manifest/version={max(versions)}")
        keys = ["domain", "file", "n", "digest"]
        one, other = now.select(keys), then.select(keys)
        changed = one.exceptAll(other).unionByName(other.exceptAll(one)).select("domain").distinct()
        domains = [r["domain"] for r in changed.collect()]
    else:
        domains = [r["domain"] for r in now.select("domain").distinct().collect()]
    if not domains:
        return []
    named = F.col("domain").isin([d for d in domains if d is not None])
    mine = named | F.col("domain").isNull() if None in domains else named
    present = {r["domain"] for r in now.select("domain").distinct().collect()}
    write_corpus(corpus_pipeline(docs.filter(mine), max_tokens, stride), f"{target}/corpus")
    for gone in set(domains) - present:  # ids carry their domain, so no document moves to another
        remove_path(spark, f"{target}/corpus/domain={gone}")
    now.write.mode("overwrite").parquet(f"{target}/manifest/version={max(versions, default=0) + 1}")
    return sorted(domains, key=str)


def _manifest_versions(spark: SparkSession, target: str) -> list[int]:
    try:
        found = spark.read.parquet(f"{target}/manifest").select("version").distinct().collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return [r["version"] for r in found]
