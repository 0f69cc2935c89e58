"""Near-duplicates: ProbMinHash signatures, banding, and exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import pieces
from sieveline.sources.writers import scratch, stage

SHINGLE_WORDS = 5
#: 24 bands of 4: a pair at similarity 0.8 shares none with a chance of 3 in a million.
BANDS, ROWS = 24, 4
SAMPLES = BANDS * ROWS
#: Longs of the bit sets that are compared before texts are: 2,048 bits, so that few of a text's shingles share one.
WORDS = 32


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles and how often each occurs; fewer words are one shingle."""
    words = (text or "").encode().split()
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE_WORDS, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(total)]
    return np.unique(_mixed(total + np.uint64(size)), return_counts=True)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """One row of samples per weighted set; an empty set gives zeros.

    Every element is a Poisson process whose rate is its weight; each arrival falls on
    a random sample, which keeps the element that came first. Arrivals are drawn in
    order, one per element and round, and an element ends as soon as it comes later
    than all samples of its set already have been filled. Equal samples estimate
    probability Jaccard.
    """
    sizes = [len(h) for h, _ in sets]
    first = np.full(len(sets) * SAMPLES, np.inf)
    name = np.zeros(len(sets) * SAMPLES, np.uint64)
    if sum(sizes):
        element = np.concatenate([h for h, _ in sets])
        weight = np.concatenate([c for _, c in sets]).astype(np.float64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        time = np.zeros(len(element))
        turn = 0
        while len(element):
            turn += 1
            draw = _mixed(element + np.uint64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
            cell = owner * SAMPLES + (_mixed(draw) % np.uint64(SAMPLES)).astype(np.int64)
            np.minimum.at(first, cell, time)
            won = time == first[cell]
            name[cell[won]] = element[won]
            going = time < first.reshape(-1, SAMPLES).max(axis=1)[owner]
            element, weight, owner, time = element[going], weight[going], owner[going], time[going]
    return name.reshape(-1, SAMPLES)


def bands(names: np.ndarray) -> np.ndarray:
    """One key per band, different for each band."""
    keys = np.zeros((len(names), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        keys = _mixed(keys * np.uint64(0xD6E8FEB86659FD93) + names.reshape(-1, BANDS, ROWS)[:, :, i])
    return keys.view(np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact: the sum over shared elements i of 1 / sum_j max(a_j / a_i, b_j / b_i)."""
    both = np.union1d(a[0], b[0])
    if not len(both):
        return 0.0
    x, y = np.zeros(len(both)), np.zeros(len(both))
    x[np.searchsorted(both, a[0])] = a[1]
    y[np.searchsorted(both, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = x / y
    order = np.argsort(ratio)
    x, y, ratio = x[order], y[order], ratio[order]
    shared = np.flatnonzero((x > 0) & (y > 0))
    below = np.searchsorted(ratio, ratio[shared])
    y_below = np.concatenate([[0.0], np.cumsum(y)])[below]
    x_above = x.sum() - np.concatenate([[0.0], np.cumsum(x)])[below]
    return float((1.0 / (x_above / x[shared] + y_below / y[shared])).sum())


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``links`` (a, b) is joined to.

    Each round takes the smallest root among neighbours and jumps along roots; the
    state is written and read again, and only a count reaches the driver.
    """
    edges = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-edges")
    roots = stage(edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "near-roots")
    while True:
        seen = edges.join(roots, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        lower = roots.join(seen, F.col("node") == F.col("a")).select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        lower = stage(lower, "near-lower")
        onward = lower.select(F.col("node").alias("root"), F.col("root").alias("far"))
        roots = stage(lower.join(onward, "root", "left").select("node", "old", F.least("root", "far").alias("root")), "near-roots")
        if roots.where("root < old").isEmpty():
            return roots.select("node", "root")


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, most=1 << 21):
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        keys = bands(signatures(sets))
        rows = [k.tolist() if len(h) else [] for k, (h, _) in zip(keys, sets, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), pa.array(rows, pa.list_(pa.int64()))], ["doc_id", "digest", "bands"]
        )


def _verify(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = lru_cache(64)(shingles)
        for batch in pieces(pieces(batches, "text_a"), "text_b"):
            like = [
                probability_jaccard(of(a), of(b))
                for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True)
            ]
            kept = pa.array([x >= threshold for x in like], pa.bool_())
            yield batch.select(["a", "b"]).filter(kept)

    return verify


def _element_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, most=1 << 19):
        nodes, roots = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "root"))
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        sizes = [len(h) for h, _ in sets]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(nodes, sizes), pa.int64()),
                pa.array(np.repeat(roots, sizes), pa.int64()),
                pa.array(np.concatenate([h for h, _ in sets]).view(np.int64)),
                pa.array(np.concatenate([c / max(c.sum(), 1) for _, c in sets]), pa.float64()),
            ],
            ["node", "root", "element", "mass"],
        )


def alike_candidates(elements: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of nodes with different roots, all that can be at least ``threshold`` alike.

    ``elements`` has node, root, element and mass (the masses of a node sum to 1). If u and
    v are the masses that two documents do not share, probability Jaccard is at most
    1 / (1 / (1 - u) + 1 / (1 - v) - 1), with equality for plain sets. In one order of all
    elements, what comes before the first shared one is not shared. So a pair is left out
    only if at each shared element the masses before it are too large. Elements that one
    root has alone come first, then rare ones: a passage that thousands share comes last,
    and makes no pair of documents that differ enough before it.
    """
    most = 1.0 + 1.0 / threshold + 1e-9
    shared = elements.groupBy("element").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high")
    ).where("low < high")
    order = Window.partitionBy("node").orderBy("n", "element")
    all_of = Window.partitionBy("node")
    prefix = stage(
        elements.join(shared.select("element", "n"), "element")
        .withColumn("after", F.sum("mass").over(all_of) - F.sum("mass").over(order) + F.col("mass"))
        .where(F.col("after") >= threshold - 1e-9)
        .select("element", "node", "root", (1.0 / F.col("after")).alias("need")),
        "near-prefix",
    )
    by_root = prefix.groupBy("element", "root").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need"))
    least = stage(
        by_root.groupBy("element")
        .agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.min(F.struct("need", "root")).alias("least"), F.count(F.lit(1)).alias("roots"))
        .where("roots > 1"),
        "near-least",
    )
    able = prefix.join(least, "element").where((F.col("root") == F.col("least.root")) | (F.col("need") + F.col("least.need") <= most))
    able = stage(able.select("element", "node", "root", "need", (F.col("root") == F.col("main")).alias("main")), "near-able")
    # One bit per element: a bit that the other document lacks is an element that it lacks.
    slot = F.pmod(F.xxhash64("element"), F.lit(64 * WORDS))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(element), {64 * WORDS}) % 64 AS int))")
    marks = elements.groupBy("node").agg(
        F.min("mass").alias("unit"),
        *(F.bit_or(F.when(F.floor(slot / 64) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"bits{w}") for w in range(WORDS)),
    )
    able = stage(able.join(marks, "node"), "near-marked")

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("element", F.struct("node", "root", "need", "unit", "main", *(f"bits{w}" for w in range(WORDS))).alias(name))

    def lacking(x: str, y: str):
        bits = sum((F.bit_count(F.col(f"{x}.bits{w}").bitwiseAND(F.bitwise_not(F.col(f"{y}.bits{w}")))) for w in range(WORDS)), F.lit(0))
        return 1.0 / F.greatest(1.0 - bits * F.col(f"{x}.unit"), F.lit(1e-3))

    # Pairs inside the most frequent root are never made: one side is always of another.
    pairs = side(able.where("NOT main"), "x").join(side(able, "y"), "element").where(
        (F.col("x.root") != F.col("y.root"))
        & (F.col("x.need") + F.col("y.need") <= most)
        & (F.col("y.main") | (F.col("x.node") < F.col("y.node")))
        & (lacking("x", "y") + lacking("y", "x") <= most)
    ).select(F.col("x.node").alias("x"), F.col("y.node").alias("y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Class of every document under "equal or at least ``threshold`` alike", closed transitively.

    Alike is exact probability Jaccard of five-word shingles weighted by their
    counts. Documents with equal texts are one class at once; of each text one
    document goes on. Documents that share a band are a bucket, and its smallest doc_id
    meets all others: a pair per member, whatever the bucket's size. A bucket whose
    members are then one class is done. Members of buckets that still hold several classes
    meet in ``alike_candidates``, which leaves out only pairs below ``threshold``: every
    pair that shares a band is decided.

    ``docs`` needs doc_id and text; other columns are ignored. Rows of one doc_id are one
    document. Null and empty texts, and texts of white space, equal only
    themselves. Rows with a null doc_id are not compared; their class is null. Texts of any
    length are compared whole. Empty tables give no rows.

    Returns doc_id, class_id (the smallest doc_id of the class), class_size, per row.
    """
    with scratch(docs.sparkSession) as keep:
        classes = keep(_classes(docs, threshold), "near-classes")
    sizes = classes.groupBy("class_id").agg(F.count(F.lit(1)).alias("class_size")).where("class_size > 1")
    named = classes.join(sizes, "class_id").select("doc_id", "class_id", "class_size")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(named, "doc_id", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_size", F.lit(1).cast("long"))).alias("class_size"),
    )


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    """doc_id, class_id: one row per document."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.md5(text.cast("binary")).alias("digest"), text.alias("text")
    )
    signed = stage(texts.mapInArrow(_band_rows, "doc_id long, digest string, bands array<long>"), "near-bands")
    owners = stage(signed.groupBy("digest").agg(F.min("doc_id").alias("first"), F.min_by("bands", "doc_id").alias("bands")), "near-texts")

    rows = owners.select(F.explode("bands").alias("key"), F.col("first").alias("node"))
    buckets = rows.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last")
    members = stage(rows.join(buckets.select("key", "hub"), "key"), "near-members")
    needed = members.select(F.col("node").alias("doc_id")).distinct()
    compared = stage(texts.join(needed, "doc_id").select("doc_id", "text"), "near-compared")

    def verified(pairs: DataFrame) -> DataFrame:
        with_texts = pairs.join(compared.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b").join(
            compared.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"
        )
        return stage(with_texts.select("a", "b", "text_a", "text_b").mapInArrow(_verify(threshold), "a long, b long").distinct(), "near-links")

    tested = stage(members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "near-pairs")
    links = verified(tested)
    # A document with several texts links their classes; this is rare.
    several = signed.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low < high").select("doc_id")
    texts_of = stage(signed.select("doc_id", "digest").join(several, "doc_id").distinct().join(owners.select("digest", "first"), "digest"), "near-several")
    if not texts_of.isEmpty():
        least = texts_of.groupBy("doc_id").agg(F.min("first").alias("a"))
        links = links.unionByName(texts_of.join(least, "doc_id").where("a < first").select("a", F.col("first").alias("b")).distinct())
    roots = components(links)
    # Members of buckets that still hold several classes: what no hub met goes to the exact join.
    placed = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    rest = placed.join(mixed.select("key"), "key").select("node", "root").distinct()
    elements = compared.join(rest, F.col("doc_id") == F.col("node")).select("node", "root", "text").mapInArrow(
        _element_rows, "node long, root long, element long, mass double"
    )
    met = stage(alike_candidates(stage(elements, "near-elements"), threshold).join(tested, ["a", "b"], "left_anti"), "near-met")
    if not met.isEmpty():
        # Only new links between the classes found so far are searched.
        found = verified(met)
        for side in ("a", "b"):
            named = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
            found = found.join(named, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
        found = stage(found.where("root_a <> root_b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(), "near-joined")
        if not found.isEmpty():
            higher = components(found)
            above = higher.select(F.col("node").alias("root"), F.col("root").alias("top"))
            lifted = roots.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
            alone = higher.join(roots, "node", "left_anti")
            roots = stage(lifted.unionByName(alone), "near-roots")
    of_text = owners.join(roots, F.col("first") == F.col("node"), "left").select("digest", F.coalesce("root", "first").alias("class_id"))
    return signed.select("doc_id", "digest").join(of_text, "digest").select("doc_id", "class_id").distinct()


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """``docs`` with one document of each class: that with the smallest doc_id.

    Any columns. Rows without a doc_id stay; of several rows of that doc_id the one with the smallest
    text digest stays, of equal texts the smallest row.
    """
    with scratch(docs.sparkSession) as keep:
        dropped = keep(_classes(docs, threshold).where("class_id <> doc_id").select(F.col("doc_id").alias("_gone")), "near-gone")
    kept = docs.join(dropped, F.col("doc_id") == F.col("_gone"), "left_anti")
    repeated = kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"))
    with scratch(docs.sparkSession) as keep:
        repeated = keep(repeated, "near-repeated")
    if repeated.isEmpty():
        return kept
    again = F.col("doc_id") == F.col("_id")
    order = F.struct(F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("a"), F.to_json(F.struct(*kept.columns)).alias("b"))
    one = kept.join(repeated, again, "left_semi").groupBy(F.col("doc_id").alias("_id")).agg(F.min_by(F.struct(*kept.columns), order).alias("_row"))
    return kept.join(repeated, again, "left_anti").unionByName(one.select("_row.*"))
