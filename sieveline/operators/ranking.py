"""Ranks, ordinals and exact quantiles that no single task has to sort.

``row_number() <= k`` per query is fine as a plain window: Spark prunes to k rows
per task before the shuffle. Ranks over a whole domain are different, since one
domain may hold most of the corpus. These helpers cut the order into buckets,
count the buckets, and add a prefix sum of the counts to a rank inside each
bucket, so the largest group a task sorts is one bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.config import HASH_BUCKET_CHARS


def top_k(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows per group with a 1-based rank."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def rank_hits(
    hits: DataFrame, score: str = "score", tie: str = "chunk_id", k: int | None = None
) -> DataFrame:
    """Rank by descending score within each query; ties by ascending ``tie``."""
    w = Window.partitionBy("query_id").orderBy(F.col(score).desc(), F.col(tie))
    ranked = hits.withColumn("rank", F.row_number().over(w))
    return ranked if k is None else ranked.filter(F.col("rank") <= k)


def hash_bucket(md5_hex: Column | str, chars: int = HASH_BUCKET_CHARS) -> Column:
    """Order-preserving bucket of an md5 key: its leading hex characters."""
    return F.substring(md5_hex, 1, chars)


def bucketed_rank(
    df: DataFrame,
    group: Sequence[str],
    bucket: str,
    order: Sequence[Column],
    rank: str = "rank",
    keep: Column | int | None = None,
) -> DataFrame:
    """Exact 1-based rank per group in the order ``(bucket, *order)``.

    ``bucket`` must be a column that is monotone in the wanted order. With
    ``keep``, only ranks up to it are returned, and buckets that begin beyond it
    are dropped before anything is sorted.
    """
    group = list(group)
    counts = df.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *group, bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    if keep is not None:
        offsets = offsets.filter(F.col("_offset") < keep)
    inside = Window.partitionBy(*group, bucket).orderBy(*order)
    ranked = (
        df.join(offsets, [*group, bucket])
        .withColumn(rank, F.col("_offset") + F.row_number().over(inside))
        .drop("_offset")
    )
    return ranked if keep is None else ranked.filter(F.col(rank) <= keep)


def first_n_by_hash(
    df: DataFrame, group: Sequence[str], key: Column, n: Column | int, tie: Sequence[Column]
) -> DataFrame:
    """Pseudo-random but repeatable sample: ``n`` smallest md5 keys per group."""
    keyed = df.withColumn("_key", key).withColumn("_bucket", hash_bucket("_key"))
    kept = bucketed_rank(keyed, group, "_bucket", [F.col("_key"), *tie], "_rank", keep=n)
    return kept.drop("_key", "_bucket", "_rank")


def sequence_bucket(seq: Column, width: int) -> Column:
    """Bucket of a unique integer sequence: at most ``width`` values per bucket."""
    return F.floor(seq / F.lit(width)).cast("long")


def exact_quantile(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    q: float,
    name: str,
    resolution: int = 1024,
) -> DataFrame:
    """Linear-interpolated quantile of a column, exact at any size.

    A logarithmic histogram, counted map-side, finds the buckets that hold the two
    order statistics wanted. Only values of those buckets are shuffled, equal ones
    counted together, and ordered.
    """
    group = list(group)
    placed_values = (
        df.filter(F.col(value).isNotNull())
        .select(*group, F.col(value).cast("double").alias("_v"))
        .withColumn("_b", (F.signum("_v") * F.floor(F.log2(F.abs("_v") + 1.0) * resolution)).cast("long"))
    )
    by_bucket = Window.partitionBy(*group).orderBy("_b")
    buckets = placed_values.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_bn")).select(
        *group,
        "_b",
        F.sum("_bn").over(by_bucket.rowsBetween(Window.unboundedPreceding, 0)).alias("_end"),
        F.col("_bn"),
        F.sum("_bn").over(Window.partitionBy(*group)).alias("_total"),
    )
    position = (F.col("_total") - 1) * F.lit(q)
    wanted = (
        buckets.withColumn("_start", F.col("_end") - F.col("_bn"))
        .withColumn("_lo", F.floor(position))
        .withColumn("_hi", F.ceil(position))
        .withColumn("_frac", position - F.floor(position))
        .filter((F.col("_start") <= F.col("_hi")) & (F.col("_end") > F.col("_lo")))
        .select(*group, "_b", "_start", "_lo", "_hi", "_frac")
    )
    inside = Window.partitionBy(*group, "_b").orderBy("_v")
    values = (
        placed_values.join(wanted, [*group, "_b"])
        .groupBy(*group, "_b", "_start", "_lo", "_hi", "_frac", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = (
        values.withColumn(
            "_to",
            F.col("_start") + F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .withColumn("_from", F.col("_to") - F.col("_n"))
    )

    def at(pos: str) -> Column:
        return F.max(F.when((F.col("_from") <= F.col(pos)) & (F.col(pos) < F.col("_to")), F.col("_v")))

    picked = placed.groupBy(*group).agg(
        at("_lo").alias("_vlo"), at("_hi").alias("_vhi"), F.max("_frac").alias("_f")
    )
    return picked.select(
        *group, (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_f")).alias(name)
    )
