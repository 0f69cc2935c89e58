"""Repeated word windows across documents, found by doubling lengths."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import pieces
from sieveline.sources.writers import scratch, stage

# Odd multipliers of two polynomial hashes modulo 2^64, and their inverses.
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Text:
    """Words of a text and hashes of any of their windows."""

    def __init__(self, text: str):
        self.words = text.encode().split()
        self.n = len(self.words)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, self.n)
        self.sums, self.shifts = [], []
        for base, inverse, word in zip(_BASES, _INVERSES, (hashes, _mixed(hashes)), strict=True):
            total = np.zeros(self.n + 1, np.uint64)
            np.cumsum(word * _powers(base, self.n), out=total[1:])
            self.sums.append(total)
            self.shifts.append(_powers(inverse, self.n + 1))

    def window(self, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
        return _mixed((self.sums[lane][ends] - self.sums[lane][starts]) * self.shifts[lane][starts])

    def joined(self, removed: np.ndarray | None = None) -> bytes:
        return b" ".join(self.words if removed is None else [w for w, r in zip(self.words, removed, strict=True) if not r])


@dataclass
class Seeds:
    """Seeds of a text, in order: each owns the windows that start from ``low`` to ``high``.

    ``spans`` are hashes of all that a seed's windows cover. ``after`` and ``before`` are
    hashes of the two half-length windows that extend the seed to its right and to its left.
    """

    at: np.ndarray
    hashes: np.ndarray
    low: np.ndarray
    high: np.ndarray
    spans: np.ndarray
    after: np.ma.MaskedArray
    before: np.ma.MaskedArray


def _halves(text: Text, starts: np.ndarray, half: int) -> np.ma.MaskedArray:
    inside = (starts >= 0) & (starts + half <= text.n)
    safe = np.where(inside, starts, 0)
    return np.ma.masked_array(text.window(safe, np.where(inside, safe + half, 0)), ~inside)


def seeds_of(text: Text, length: int) -> Seeds:
    """Of each window the quarter-length piece with the lowest hash, the leftmost of
    equals: equal windows have equal seeds at equal places, so that a repeated window
    has a repeated seed."""
    short, half = length // 4, length // 2
    n = text.n - length + 1
    if n <= 0:
        none, nothing = np.empty(0, np.int64), np.empty(0, np.uint64)
        return Seeds(none, nothing, none, none, nothing, np.ma.masked_array(nothing), np.ma.masked_array(nothing))
    starts = np.arange(text.n - short + 1)
    hashes = text.window(starts, starts + short)
    reach = length - short + 1
    at = np.concatenate(
        [
            np.lib.stride_tricks.sliding_window_view(hashes[i : i + (1 << 15) + reach - 1], reach).argmin(axis=1) + i
            + np.arange(min(1 << 15, n - i))
            for i in range(0, n, 1 << 15)
        ]
    )
    low = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    high = np.concatenate([low[1:], [n]]) - 1
    seed = at[low]
    shape = ((seed - low).astype(np.uint64) << np.uint64(32)) | (high - low).astype(np.uint64)
    spans = _mixed(text.window(low, high + length, 1) ^ _mixed(shape + np.uint64(1)))
    return Seeds(seed, hashes[seed], low, high, spans, _halves(text, seed, half), _halves(text, seed + short - half, half))


def open_windows(seeds: Seeds, length: int, opened: list[dict]) -> np.ndarray:
    """Starts of the windows of open seeds whose half-length windows, those they hold, are all repeated."""
    half, short = length // 2, length // 4
    parts = [np.empty(0, np.int64)]
    for one in opened:
        j = one["j"]
        at = np.arange(seeds.low[j], seeds.high[j] + 1)
        holds_after, holds_before = at >= seeds.at[j] + half - length, at <= seeds.at[j] + short - half
        parts.append(at[(~holds_after | one["after"]) & (~holds_before | one["before"])])
    return np.concatenate(parts)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    """One list of longs per text; masked values are null."""
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.ma.concatenate(parts) if parts else np.ma.masked_array(np.empty(0, np.uint64))
    values = pa.array(np.ma.getdata(flat).astype(np.uint64).view(np.int64), mask=np.ma.getmaskarray(flat))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_OPEN = pa.list_(pa.struct([("j", pa.int32()), ("after", pa.bool_()), ("before", pa.bool_())]))
_SEEDED = "doc_id long, text_key long, n_words long, sha string, g array<long>, s array<long>, a array<long>, b array<long>"
_JUDGED = pa.schema(
    [
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_removed", pa.int64()), ("sha", pa.string()),
        ("text", pa.string()), ("settled", pa.list_(pa.int32())), ("open", _OPEN), ("kept", pa.string()),
    ]
)
_JUDGED_DDL = (
    "doc_id long, text_key long, n_removed long, sha string, text string, settled array<int>, "
    "open array<struct<j:int,after:boolean,before:boolean>>, kept string"
)
_WINDOWS = "doc_id long, text_key long, w1 long, w2 long, at int"
_KEY = ["doc_id", "text_key"]


def _covered(text: Text, seeds: Seeds, length: int, settled: list[int], starts: list[int]) -> np.ndarray:
    """Words covered by all windows of the settled seeds and by the windows at ``starts``."""
    edge = np.zeros(text.n + 1, np.int64)
    settled_at = np.array(settled, np.int64)
    np.add.at(edge, seeds.low[settled_at], 1)
    np.add.at(edge, seeds.high[settled_at] + length, -1)
    single = np.array(starts, np.int64)
    np.add.at(edge, single, 1)
    np.add.at(edge, single + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut_row(doc_id: int, text_key: int, value: str, length: int, settled: list[int], starts: list[int], with_text: bool) -> tuple:
    text = Text(value)
    gone = _covered(text, seeds_of(text, length), length, settled, starts)
    kept = text.joined(gone)
    count = int(gone.sum())
    return doc_id, text_key, count, sha256(kept).hexdigest(), None, None, None, kept.decode() if with_text and count else None


def repeated_words(docs: DataFrame, length: int = 50) -> DataFrame:
    """Per row, the words covered by windows of ``length`` words that also start in a
    document with a smaller doc_id.

    Lengths double, from a quarter of ``length``, and only what is repeated at one length is
    extended to the next. Level 1: of every window the seed, its quarter-length piece with
    the lowest hash (about one position in twenty); their bare hashes are counted, and
    places are kept only of seeds that several documents have. All windows of a seed at once: a
    span of them that a smaller doc_id has, too, settles them. Level 2: for seeds with
    several spans, the half-length windows that extend the seed to either side. Level 3: the
    full-length windows all of whose halves are repeated, from the first holder of each span;
    longer windows cover no further word, so no candidate survives. Full windows are
    compared by 128 bits of hash.

    ``docs`` needs doc_id and text; other columns are ignored. A null text has no
    words. Rows with a null doc_id keep all words and count for no other row. Rows
    of one doc_id do not count against each other. Texts of any length are
    treated whole, in time that grows with their length. Empty tables give no rows.

    Returns doc_id, n_words, n_removed, kept_sha256.
    """
    texts = _texts(docs)
    with scratch(docs.sparkSession) as keep:
        seeded = keep(texts.mapInArrow(_seed(length), _SEEDED), "substring-seeds")
        changed = keep(_changed(texts, seeded, length, with_text=False), "substring-changed")
    return seeded.join(changed, _KEY, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("cut_sha", "sha").alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """``docs`` without the words that ``repeated_words`` finds.

    A text that loses words becomes its other words joined by spaces; a row that
    loses all its words goes. Other rows keep their text as it is. Takes any columns;
    ``n_chars``, if there, follows the new text.
    """
    texts = _texts(docs)
    with scratch(docs.sparkSession) as keep:
        seeded = stage(texts.mapInArrow(_seed(length), _SEEDED), "substring-seeds")
        changed = _changed(texts, seeded, length, with_text=True).where("n_removed > 0")
        cut = keep(
            changed.select(F.col("doc_id").alias("_cut_id"), F.col("text_key").alias("_cut_key"), F.col("kept").alias("_cut_text")),
            "substring-cut",
        )
        del seeded, changed
    same = (F.col("doc_id").cast("long") == F.col("_cut_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_cut_key"))
    joined = docs.join(cut, same, "left").where("_cut_text IS NULL OR _cut_text <> ''")
    new = {"text": F.coalesce("_cut_text", "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_cut_id").isNotNull(), F.length("_cut_text")).otherwise(F.col("n_chars"))
    types = dict(docs.dtypes)
    return joined.select(*(new[c].cast(types[c]).alias(c) if c in new else docs[c] for c in docs.columns))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _seed(length: int):
    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sizes, shas, found = [], [], []
            for value in batch.column("text").to_pylist():
                text = Text(value)
                sizes.append(text.n)
                shas.append(sha256(text.joined()).hexdigest())
                found.append(seeds_of(text, length))
            lists = [_lists([getattr(f, name) for f in found]) for name in ("hashes", "spans", "after", "before")]
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(shas, pa.string()), *lists]
            yield pa.RecordBatch.from_arrays(columns, [*_KEY, "n_words", "sha", "g", "s", "a", "b"])

    return seed


def _in_several(rows: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that several documents have."""
    ends = rows.groupBy(key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return ends.where("first < last").select(key)


def _changed(texts: DataFrame, seeded: DataFrame, length: int, with_text: bool) -> DataFrame:
    """doc_id, text_key, n_removed, cut_sha, kept of the rows that have repeated seeds."""
    each = seeded.where("doc_id IS NOT NULL").select(*_KEY, F.posexplode(F.arrays_zip("g", "s", "a", "b")).alias("j", "x"))
    each = each.select(*_KEY, "j", "x.*")
    level1 = stage(each.join(_in_several(each, "g"), "g"), "substring-level1")
    spans = stage(level1.groupBy("g", "s").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), "substring-spans")
    several = spans.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("g", F.lit(True).alias("several"))
    facts = spans.join(several, "g", "left").where("several OR first < last").select("g", "s", "first", "several")
    settles = F.col("first") < F.col("doc_id")
    opens = (F.col("first") == F.col("doc_id")) & F.col("several")
    judged = stage(
        level1.join(facts, ["g", "s"]).where(settles | opens).select(*_KEY, "j", settles.alias("settles"), "a", "b"), "substring-level2"
    )
    opened = judged.where("NOT settles")
    halves = _in_several(opened.select("doc_id", F.explode(F.array("a", "b")).alias("h")).where("h IS NOT NULL"), "h")
    for side, name in (("a", "after"), ("b", "before")):
        opened = opened.join(halves.select(F.col("h").alias(side), F.lit(True).alias(name)), side, "left")
    opened = opened.where("after OR before").select(
        *_KEY, F.struct("j", F.coalesce("after", F.lit(False)).alias("after"), F.coalesce("before", F.lit(False)).alias("before")).alias("o")
    )
    left = judged.where("settles").select(*_KEY, "j", F.lit(None).cast("struct<j:int,after:boolean,before:boolean>").alias("o"))
    per_row = left.unionByName(opened.select(*_KEY, F.lit(None).cast("int").alias("j"), "o")).groupBy(*_KEY).agg(
        F.collect_set("j").alias("settled"), F.collect_set("o").alias("open")
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = []
            for doc_id, key, value, settled, opened in _rows(batch):
                if opened:
                    rows.append((doc_id, key, None, None, value, settled, opened, None))
                else:
                    rows.append(_cut_row(doc_id, key, value, length, settled, [], with_text))
            yield _batch(rows, _JUDGED)

    rows = stage(texts.join(stage(per_row, "substring-judged"), _KEY).mapInArrow(judge, _JUDGED_DDL), "substring-texts")
    pending = rows.where("text IS NOT NULL").select(*_KEY, "text", "settled", "open")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, most=1 << 21):
            for doc_id, key, value, _, opened in _rows(batch):
                text = Text(value)
                at = open_windows(seeds_of(text, length), length, opened)
                lanes = [text.window(at, at + length, lane).view(np.int64) for lane in (0, 1)]
                same = [np.full(len(at), x, np.int64) for x in (doc_id, key)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*same, *lanes, at.astype(np.int32))], [*_KEY, "w1", "w2", "at"])

    single = stage(pending.mapInArrow(windows, _WINDOWS), "substring-level3")
    firsts = single.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    starts = single.join(firsts, ["w1", "w2"]).where("first < doc_id").groupBy(*_KEY).agg(F.collect_set("at").alias("starts"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = [_cut_row(doc_id, key, value, length, settled, at or [], with_text) for doc_id, key, value, settled, _, at in _rows(batch)]
            yield _batch(rows, _JUDGED)

    late = pending.join(starts, _KEY, "left").mapInArrow(finish, _JUDGED_DDL)
    changed = rows.where("text IS NULL").unionByName(late).dropDuplicates(_KEY)
    return changed.select(*_KEY, "n_removed", F.col("sha").alias("cut_sha"), "kept")
