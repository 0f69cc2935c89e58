"""Shards of nearly equal bytes from contiguous runs of atomic groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import let, text_or_empty
from sieveline.sources.writers import stage

#: Groups are ordered by md5; those that share its first four hex digits form one block.
BLOCK_DIGITS = 4
BLOCKS = 16**BLOCK_DIGITS
#: Rows of a block are numbered in this many parts, so that copies of one text share no task.
PARTS = 256


def _needed(sizes: Column, capacity: Column) -> Column:
    """Shards that a greedy pass opens at this capacity."""
    return F.aggregate(
        sizes,
        F.struct(F.lit(1).alias("n"), F.lit(0).cast("long").alias("used")),
        lambda s, x: F.when(
            s["used"] + x > capacity, F.struct((s["n"] + 1).alias("n"), x.alias("used"))
        ).otherwise(F.struct(s["n"].alias("n"), (s["used"] + x).alias("used"))),
        lambda s: s["n"],
    )


def smallest_capacity(sizes: Column, n_shards: int) -> Column:
    """Smallest capacity at which ``n_shards`` contiguous runs hold all sizes.

    Binary search between the mean shard (or the largest size) and the mean plus
    the largest size, which always suffices.
    """
    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)
    mean, largest = F.ceil(total / n_shards).cast("long"), F.array_max(sizes)
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(62)),
        F.struct(F.greatest(mean, largest).alias("lo"), (mean + largest).alias("hi")),
        lambda s, _: F.when(s["lo"] >= s["hi"], s).otherwise(_halve(s, sizes, n_shards)),
        lambda s: s["lo"],
    )


def _halve(s: Column, sizes: Column, n_shards: int) -> Column:
    mid = F.shiftright(s["lo"] + s["hi"], 1)
    return F.when(
        _needed(sizes, mid) <= n_shards, F.struct(s["lo"].alias("lo"), mid.alias("hi"))
    ).otherwise(F.struct((mid + 1).alias("lo"), s["hi"].alias("hi")))


def _tail_starts(blocks: Column, capacity: Column) -> Column:
    """Last block before every run but the last, if runs are filled from the end: what any tail needs."""
    return F.aggregate(
        F.reverse(blocks),
        F.struct(F.lit(0).cast("long").alias("used"), F.array().cast("array<int>").alias("ends")),
        lambda s, b: F.when(
            s["used"] + b["size"] > capacity,
            F.struct(b["size"].alias("used"), F.concat(s["ends"], F.array(b["block"])).alias("ends")),
        ).otherwise(F.struct((s["used"] + b["size"]).alias("used"), s["ends"].alias("ends"))),
        lambda s: s["ends"],
    )


def _large_bound(sizes: Column, n_shards: int) -> Column:
    """Mean of what is left after blocks above the mean, again and again, have shards of their own."""
    def lower(bar: Column, _: Column) -> Column:
        return let(
            F.filter(sizes, lambda x: x > bar),
            lambda large: (F.aggregate(sizes, F.lit(0).cast("long"), lambda t, x: t + F.when(x > bar, F.lit(0)).otherwise(x)))
            / F.greatest(F.lit(n_shards) - F.size(large), F.lit(1)),
        )

    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda t, x: t + x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(8)), (total / n_shards).cast("double"), lower)


def _first_blocks(blocks: Column, capacity: Column, n_shards: int) -> Column:
    """First block of every shard but the first.

    A shard ends near the mean of what is left, over the shards left, without blocks
    so large that they have their own; never above the capacity, and only where the
    shards left can hold the rest.
    """
    sizes = F.transform(blocks, lambda b: b["size"])

    def cut(bar: Column, tails: Column) -> Column:
        def small(x: Column) -> Column:
            return F.when(x > bar, F.lit(0).cast("long")).otherwise(x)

        def step(s: Column, b: Column) -> Column:
            size = b["size"]
            large = size > bar
            after = F.lit(n_shards - 1) - F.size(s["cuts"])
            wanted = (
                large | s["large"] | (s["used"] + size / 2 > s["target"]) | (s["used"] + size > capacity) | (s["count"] <= after)
            )
            holds = F.size(F.filter(tails, lambda e: e >= b["block"])) + 1 <= after
            new = (s["used"] > 0) & wanted & holds
            left = s["left"] - small(size)
            larges = s["larges"] - large.cast("int")
            mean = s["left"] / F.greatest(after - s["larges"], F.lit(1))
            here = F.when(s["large"], s["runs"][0]).otherwise(s["here"])
            target = here / F.greatest(F.round(here / F.greatest(mean, F.lit(1.0))), F.lit(1))
            return F.struct(
                F.when(new, size).otherwise(s["used"] + size).alias("used"),
                F.when(new, target).otherwise(s["target"]).cast("double").alias("target"),
                left.alias("left"),
                (here - small(size)).alias("here"),
                F.when(s["large"], F.slice(s["runs"], 2, n_shards)).otherwise(s["runs"]).alias("runs"),
                larges.cast("int").alias("larges"),
                (s["count"] - 1).cast("int").alias("count"),
                large.alias("large"),
                F.when(new, F.concat(s["cuts"], F.array(b["block"]))).otherwise(s["cuts"]).alias("cuts"),
            )

        rest = F.aggregate(sizes, F.lit(0).cast("long"), lambda t, x: t + small(x))
        larges = F.size(F.filter(sizes, lambda x: x > bar))
        # Bytes between large blocks: the shards of each stretch share them evenly.
        ended = F.aggregate(
            sizes,
            F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<bigint>").alias("runs")),
            lambda s, x: F.when(
                x > bar, F.struct(F.lit(0).cast("long").alias("sum"), F.concat(s["runs"], F.array(s["sum"])).alias("runs"))
            ).otherwise(F.struct((s["sum"] + x).alias("sum"), s["runs"].alias("runs"))),
            lambda s: F.concat(s["runs"], F.array(s["sum"])),
        )
        mean = rest / F.greatest(F.lit(n_shards) - larges, F.lit(1))
        return let(ended, lambda runs: walked(rest, larges, mean, runs, step))

    def walked(rest: Column, larges: Column, mean: Column, runs: Column, step) -> Column:
        start = F.struct(
            F.lit(0).cast("long").alias("used"),
            (runs[0] / F.greatest(F.round(runs[0] / F.greatest(mean, F.lit(1.0))), F.lit(1))).cast("double").alias("target"),
            rest.alias("left"),
            runs[0].alias("here"),
            F.slice(runs, 2, n_shards).alias("runs"),
            larges.alias("larges"),
            F.size(blocks).alias("count"),
            F.lit(False).alias("large"),
            F.array().cast("array<int>").alias("cuts"),
        )
        return F.aggregate(blocks, start, step, lambda s: s["cuts"])

    return let(
        F.struct(_large_bound(sizes, n_shards).alias("bar"), _tail_starts(blocks, capacity).alias("tails")),
        lambda f: cut(f["bar"], f["tails"]),
    )


def shard_documents(docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """Put rows into shards of nearly equal bytes; equal texts stay together.

    The atomic groups, in md5 order, are summed into at most 65,536 blocks of
    whole groups. The smallest capacity at which a greedy pass needs no more than
    ``n_shards`` shards is found by binary search over the block sizes, and the
    blocks are cut near the mean of what is left, never above it, so that all shards
    are used. A shard exceeds the best one of single groups by less than one block.

    ``docs`` needs doc_id and text; other columns are ignored. A null text counts
    as empty, size 16, in one group with empty texts; texts have any length. Null and repeated doc_ids
    are rows as any other; rows equal in both share their slots in any order. An
    empty table gives no rows. Fewer groups than shards leave shards unused.

    Returns doc_id, size, text_crc32, law (``bytes``), shard, slot, grown_shard.
    """
    text = text_or_empty()
    rows = stage(
        docs.select("doc_id", text.alias("text")).select(
            "doc_id",
            (F.octet_length("text") + 16).cast("long").alias("size"),
            F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
            F.md5(F.col("text").cast("binary")).alias("digest"),
        ),
        "shard-rows",
    ).withColumns(
        {
            "block": F.conv(F.substring("digest", 1, BLOCK_DIGITS), 16, 10).cast("int"),
            "part": F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int"),
        }
    )
    cells = stage(rows.groupBy("block", "part").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), "shard-cells")
    blocks = cells.groupBy("block").agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
    ordered = blocks.groupBy().agg(F.sort_array(F.collect_list(F.struct("block", "size"))).alias("blocks"))
    cut_at = let(
        F.transform("blocks", lambda b: b["size"]),
        lambda sizes: let(smallest_capacity(sizes, n_shards), lambda most: _first_blocks(F.col("blocks"), most, n_shards)),
    )
    cuts = stage(ordered.select(cut_at.alias("cuts")), "shard-cuts")
    shard = F.size(F.filter("cuts", lambda c: c <= F.col("block")))

    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("cuts", cuts.scalar()).withColumn("shard", shard).select(
        "block", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("block_start")
    )
    within = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(
        "block", "part", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("part_start")
    ).join(starts, "block")
    rank = F.row_number().over(Window.partitionBy("block", "part").orderBy("digest", "doc_id"))
    return rows.join(offsets, ["block", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("block_start") + F.col("part_start") + rank - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
