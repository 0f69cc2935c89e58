"""Corpus, search output and report writers, and incremental work lists."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local master may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="sieveline-")
    return f"{shared}/{name}-{uuid.uuid4().hex}"


#: Paths that ``stage`` wrote inside the innermost open ``scratch``.
_HELD: ContextVar[list[str] | None] = ContextVar("held", default=None)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several later steps read, and return the stored form.

    Cuts the lineage without keeping anything on an executor.
    """
    path = scratch_path(df.sparkSession, name)
    held = _HELD.get()
    if held is not None:
        held.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that Spark wrote, in whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Delete at the end what ``stage`` writes inside, but for tables stored with the function given.

    Shuffle files go, too, as soon as no frame refers to their plans: build those in a
    function that has returned by then. What is kept belongs to the next outer scope.
    """
    outer, inner = _HELD.get(), []
    token = _HELD.set(inner)
    kept: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        stored = stage(df, name)
        kept.append(inner[-1])
        return stored

    try:
        yield keep
    finally:
        _HELD.reset(token)
        if outer is not None:
            outer.extend(kept)
        for path in set(inner) - set(kept):
            remove_path(spark, path)
        gc.collect()
        spark._jvm.System.gc()


def write_corpus(chunks: DataFrame, path: str) -> None:
    """Overwrite only the domains present in ``chunks``, one directory each.

    Every task writes its own rows: a large domain becomes many files rather
    than one.
    """
    (
        chunks.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("domain")
        .parquet(path)
    )


def nest_results(hits: DataFrame, topk: int = 10, width: int = 500) -> DataFrame:
    """One row per query with its ranked results as an array of structs."""
    item = F.struct(
        "rank",
        "doc_id",
        "domain",
        "score",
        "fused_score",
        "rerank_score",
        "title",
        F.substring("text", 1, width).alias("text"),
    )
    return (
        hits.filter(F.col("rank") <= topk)
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(item)).alias("results"))
    )


def search_output(queries: DataFrame, hits: DataFrame, topk: int = 10) -> DataFrame:
    """Search response rows; a query without hits keeps an empty result list."""
    nested = nest_results(hits, topk)
    joined = queries.join(nested, "query_id", "left")
    empty = F.array().cast(nested.schema["results"].dataType)
    return joined.withColumn("results", F.coalesce("results", empty))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def pending_queries(queries: DataFrame, done: DataFrame, expected_rows: int) -> DataFrame:
    """Queries with fewer result rows than a complete one has."""
    complete = done.groupBy("query_id").count().filter(F.col("count") >= expected_rows)
    return queries.join(complete, "query_id", "left_anti")


def complete_rows(done: DataFrame, expected_rows: int) -> DataFrame:
    """Stored rows of complete queries; partial groups are dropped before resuming."""
    complete = done.groupBy("query_id").count().filter(F.col("count") >= expected_rows)
    return done.join(complete.select("query_id"), "query_id", "left_semi")
