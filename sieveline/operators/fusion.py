"""Routing, reciprocal rank fusion and rerank merging over tables of hits.

A hit row is ``query_id, domain, doc_id, chunk_id, score, bm25_score, rank`` and
the position of its list, ``list_ord``, makes the order of lists explicit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.config import CONFIDENCE_THRESHOLD, K_FUSION, RERANK_CAP, RRF_K
from sieveline.operators.ranking import top_k

ROUTING_MODES = ("broadcast", "routed_with_general", "routed_only")


def active_domains(
    enabled: Sequence[str],
    mode: str,
    general: str = "general",
    threshold: float = CONFIDENCE_THRESHOLD,
) -> Column:
    """Array of domains to search, in enabled order, from top-1/top-2 columns."""
    if mode not in ROUTING_MODES:
        raise ValueError(f"unknown routing mode {mode!r}")
    if mode == "broadcast":
        return F.array(*[F.lit(d) for d in enabled])
    second = F.when(F.col("top1_prob") < threshold, F.col("top2_domain"))

    def chosen(domain: str) -> Column:
        named = (F.col("top1_domain") == domain) | F.coalesce(second == domain, F.lit(False))
        always = mode == "routed_with_general" and domain == general
        return F.lit(domain) if always else F.when(named, F.lit(domain))

    return F.array_compact(F.array(*[chosen(d) for d in enabled]))


def route_queries(
    classified: DataFrame,
    enabled: Sequence[str],
    mode: str = "routed_with_general",
    general: str = "general",
    threshold: float = CONFIDENCE_THRESHOLD,
) -> DataFrame:
    """One row per (query, active domain) with the domain's place in the order."""
    routed = classified.withColumn("_active", active_domains(enabled, mode, general, threshold))
    order = F.array(*[F.lit(d) for d in enabled])
    exploded = routed.withColumn("domain", F.explode("_active")).drop("_active")
    return exploded.withColumn("domain_ord", F.array_position(order, F.col("domain")).cast("int"))


def rrf_fuse(
    lists: DataFrame,
    group: Sequence[str] = ("query_id",),
    rrf_k: int | Column = RRF_K,
    topk: int = K_FUSION,
) -> DataFrame:
    """Reciprocal rank fusion to one row per document.

    Every chunk of a document in a list adds ``1 / (k + rank)``. The chunk that
    represents it is the best-ranked one, the earlier list winning ties; equal
    sums are ordered by first appearance (list order, then rank).
    """
    group = list(group)
    best = F.struct("rank", "list_ord", "chunk_id", "domain", "score", "bm25_score")
    k = F.lit(rrf_k) if isinstance(rrf_k, int) else rrf_k
    fused = lists.groupBy(*group, "doc_id").agg(
        F.round(F.sum(1.0 / (k + F.col("rank"))), 9).alias("fused_score"),
        F.min(best).alias("_best"),
        F.min(F.struct("list_ord", "rank")).alias("_first"),
    )
    rows = fused.select(
        *group,
        "doc_id",
        F.col("_best.chunk_id").alias("chunk_id"),
        *([] if "domain" in group else [F.col("_best.domain").alias("domain")]),
        F.col("_best.score").alias("score"),
        F.col("_best.bm25_score").alias("bm25_score"),
        "fused_score",
        "_first",
    )
    order = [F.col("fused_score").desc(), F.col("_first"), F.col("doc_id")]
    return top_k(rows, group, order, topk).drop("_first")


def as_lists(dense: DataFrame | None, bm25: DataFrame | None) -> DataFrame:
    """Union of the modality lists: dense first, BM25 second."""
    parts = []
    if dense is not None:
        parts.append(
            dense.select(
                "query_id", "domain", "doc_id", "chunk_id", "score",
                F.lit(0.0).alias("bm25_score"), "rank", F.lit(0).alias("list_ord"),
            )
        )
    if bm25 is not None:
        parts.append(
            bm25.select(
                "query_id", "domain", "doc_id", "chunk_id", F.lit(0.0).alias("score"),
                "bm25_score", "rank", F.lit(1).alias("list_ord"),
            )
        )
    if not parts:
        raise ValueError("at least one of dense and bm25 is needed")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def fuse_hybrid(
    lists: DataFrame,
    enabled: Sequence[str],
    both_modalities: bool,
    rrf_k: int | Column = RRF_K,
    topk: int = K_FUSION,
    extra: Sequence[str] = (),
    single: DataFrame | None = None,
) -> DataFrame:
    """Two-stage fusion: modalities inside a domain, then domains.

    The first stage is skipped when a domain has a single list, so duplicate
    chunks of a document then reach the second stage, which always runs.
    ``extra`` are further grouping columns (a sweep or ablation condition); ``single``
    holds the domains that have one list while others have two.
    """
    group = [*extra, "query_id"]
    stage1 = lists
    if both_modalities:
        twice = lists if single is None else lists.join(single, "domain", "left_anti")
        stage1 = rrf_fuse(twice, [*group, "domain"], rrf_k, topk)
        if single is not None:
            columns = [*group, "domain", "doc_id", "chunk_id", "score", "bm25_score", "rank"]
            stage1 = stage1.select(columns).unionByName(lists.join(single, "domain", "left_semi").select(columns))
    order = F.array(*[F.lit(d) for d in enabled])
    by_domain = stage1.withColumn("list_ord", F.array_position(order, F.col("domain")).cast("int"))
    return rrf_fuse(by_domain, group, rrf_k, topk)


def rerank_merge(
    candidates: DataFrame,
    scores: DataFrame,
    cap: int = RERANK_CAP,
    group: Sequence[str] = ("query_id",),
) -> DataFrame:
    """Reorder the first ``cap`` candidates by an external score.

    Candidates without a score follow the scored ones in fused order, and ranks
    beyond the cap keep their place behind them.
    """
    joined = candidates.join(
        scores.select("query_id", "doc_id", F.col("score").alias("_external")),
        ["query_id", "doc_id"],
        "left",
    )
    head = F.col("rank") <= cap
    scored = joined.withColumn("rerank_score", F.when(head, F.col("_external")))
    w = Window.partitionBy(*group).orderBy(
        head.desc(), F.col("rerank_score").desc_nulls_last(), F.col("rank")
    )
    return (
        scored.withColumn("_new", F.row_number().over(w))
        .drop("rank", "_external")
        .withColumnRenamed("_new", "rank")
    )
