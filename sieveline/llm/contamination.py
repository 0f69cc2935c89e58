"""Benchmark decontamination: documents scanned for the word windows of benchmark items."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.sources.writers import stage

WINDOW_WORDS = 10
#: Windows of items, and bytes of them, that are broadcast at once; a larger benchmark goes through in blocks.
BLOCK_WINDOWS, BLOCK_BYTES = 400_000, 64 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: all of ASCII but digits and letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _BETWEEN + "+"), lambda w: w != "")


def _normal_words(text: Column) -> Column:
    return _words(F.translate(text, _UPPER, _LOWER))


def _row_key(docs: DataFrame) -> DataFrame:
    """Rows of one doc_id are apart unless their texts are equal."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(_text()).alias("text_key"), _text().alias("text"))


def item_windows(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """One row per hash: the windows that have it (``grams``), and for each the items it occurs in (``owners``)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), _normal_words(_text()).alias("words"))
    long = F.least(F.size("words"), F.lit(window))
    windows = items.where(F.size("words") > 0).select(
        "item_id",
        long.alias("n"),
        F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - long + 1), lambda at: F.slice("words", at, long))).alias("w"),
    )
    grams = windows.groupBy(F.xxhash64("w").alias("hash"), "n", F.array_join("w", " ").alias("gram")).agg(F.collect_set("item_id").alias("items"))
    return grams.groupBy("hash").agg(
        F.sort_array(F.collect_list(F.struct("gram", "items"))).alias("entries"),
        F.collect_set("n").alias("lengths"),
        F.sum(F.octet_length("gram") + 24 * (F.size("items") + 1)).alias("bytes"),
    ).select("hash", F.col("entries.gram").alias("grams"), F.col("entries.items").alias("owners"), "lengths", "bytes")


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Word spans of documents that windows of benchmark items cover, for the documents that have any.

    A window is ``window`` consecutive words of an item, lower-cased and without punctuation;
    an item of fewer words, but not none, is one window. The windows are a hash table that is
    broadcast; every window of every text is looked up, and what is found is compared word by
    word. A benchmark beyond the bound is cut by hash into blocks, each scanned for by itself. Only
    what is found is shuffled, by document.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text; other columns are ignored.
    Null and empty texts have no words. Rows with a null doc_id are scanned, too;
    rows of one doc_id are apart unless their texts are equal; an item without an id is
    found but not listed. Texts of any length are scanned whole. An empty table on either side gives no rows.

    Returns doc_id, text_key (hash of the text), spans (start and end word, merged, in order)
    and items (their item_ids as strings, sorted).
    """
    known = stage(item_windows(benchmark, window), "contamination-windows")
    size = known.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.array_distinct(F.flatten(F.collect_set("lengths"))).alias("lengths")).first()
    blocks = max(1, -(-size["n"] // BLOCK_WINDOWS), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    lengths = sorted(size["lengths"]) or [window]
    places = _row_key(docs).select("doc_id", "text_key", _normal_words(F.col("text")).alias("words"))
    starts = F.when(F.size("words") >= lengths[0], F.sequence(F.lit(0), F.size("words") - lengths[0]))
    places = places.select("*", F.explode(starts).alias("at"))
    if len(lengths) == 1:
        places = places.withColumn("n", F.lit(lengths[0]))
    else:
        places = places.select("*", F.explode(F.array(*map(F.lit, lengths))).alias("n")).where(F.col("at") + F.col("n") <= F.size("words"))
    # Explode, look-up and comparison are one generated loop over the words of a text, which are
    # never copied per place. A lambda there would break the loop in two.
    window_words = F.slice("words", F.col("at") + 1, F.col("n"))
    places = places.withColumn("hash", F.xxhash64(window_words))
    gram = F.array_join(window_words, " ")

    def found_in(block: int) -> DataFrame:
        part = known.select("hash", "grams", "owners")
        if blocks > 1:
            part = part.where(F.pmod(F.xxhash64("hash"), F.lit(blocks)) == block)
        return (
            places.join(F.broadcast(part), "hash")
            .where(F.array_contains("grams", gram))
            .select(
                "doc_id",
                "text_key",
                "at",
                (F.col("at") + F.col("n")).alias("end"),
                F.get("owners", F.array_position("grams", gram).cast("int") - 1).alias("items"),
            )
        )

    if blocks == 1:
        hits = found_in(0)
    else:
        hits = reduce(DataFrame.unionByName, [stage(found_in(b), "contamination-hits") for b in range(blocks)])
    per_doc = hits.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("at", "end"))).alias("found"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    merged = F.expr(
        """aggregate(found, cast(array() AS array<struct<start:int,end:int>>), (acc, x) ->
            CASE WHEN size(acc) > 0 AND element_at(acc, -1).end >= x.at
                 THEN concat(slice(acc, 1, size(acc) - 1),
                             array(named_struct('start', element_at(acc, -1).start, 'end', greatest(element_at(acc, -1).end, x.end))))
                 ELSE concat(acc, array(named_struct('start', x.at, 'end', x.end))) END)"""
    )
    return per_doc.select("doc_id", "text_key", merged.alias("spans"), "items")


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside windows of items), n_items, items (sorted), contaminated.

    See ``contaminated_spans`` for windows, nulls and repeated rows.
    """
    spans = contaminated_spans(docs, benchmark, window).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "spans", "items")
    rows = _row_key(docs).select("doc_id", "text_key", F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    joined = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce(hit, F.lit(0).cast("long")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        items.alias("items"),
        F.col("_key").isNotNull().alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, remove: str = "spans") -> DataFrame:
    """``docs``, of any columns, without what benchmark items cover.

    With ``remove="spans"`` the covered words go, each with what follows it up to the next
    word; a text left without words goes. With ``"documents"`` every document with such
    a span goes. Other rows stay as they are.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove must be 'spans' or 'documents'")
    spans = contaminated_spans(docs, benchmark, window).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("spans").alias("_spans"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(_text()) == F.col("_key"))
    if remove == "documents":
        return docs.join(spans, same, "left_anti")
    parts = F.regexp_extract_all(_text(), F.lit(f"({_WORD}+{_BETWEEN}*)"), F.lit(1))
    kept = F.filter(parts, lambda part, i: ~F.exists("_spans", lambda s: (s["start"] <= i) & (i < s["end"])))
    before = F.regexp_extract(_text(), f"^({_BETWEEN}*)", 1)
    cut = F.when(F.col("_key").isNotNull(), F.concat(before, F.array_join(kept, "")))
    joined = docs.join(spans, same, "left").withColumn("_cut", cut).where(F.col("_cut").isNull() | F.col("_cut").rlike(_WORD))
    new = {"text": F.coalesce("_cut", "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_cut").isNotNull(), F.length("_cut")).otherwise(F.col("n_chars"))
    types = dict(docs.dtypes)
    return joined.select(*(new[c].cast(types[c]).alias(c) if c in new else docs[c] for c in docs.columns))
