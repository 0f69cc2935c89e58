"""Document fingerprints by consistent weighted sampling of words."""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import pieces
from sieveline.sources.writers import stage

#: Samples of a signature: the likeness has a standard error of at most 1 / (2 sqrt(SAMPLES)).
SAMPLES = 64
#: Bytes of text that a range of doc_ids is meant to hold.
RANGE_BYTES = 4 << 20
#: Most ranges: a task sorts and streams its ranges, so larger ones need no more memory.
MAX_RANGES = 4096

PRINTED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


class Sampler:
    """Signatures of word counts. The random variates of a word come from its hash, so
    any worker draws the same ones; those of ``most`` words are kept."""

    def __init__(self, most: int = 200_000):
        self.most = most
        self.place: dict[bytes, int] = {}
        self.r = np.empty((most, SAMPLES), np.float32)
        self.log_c = np.empty((most, SAMPLES), np.float32)
        self.beta = np.empty((most, SAMPLES), np.float32)
        self.once = np.empty((most, SAMPLES), np.float32)
        self.name = np.empty(most, np.uint64)

    def _draw(self, words: list[bytes], at: int) -> None:
        seeds = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
        end = at + len(words)
        lanes = np.arange(1, 3 * SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = seeds[:, None] + lanes
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        # Two uniform variates from each number; five of six are needed.
        u = (x.view(np.uint32) >> np.uint32(8)).astype(np.float32) * np.float32(2.0**-24) + np.float32(2.0**-25)
        u = u.reshape(len(words), 6, SAMPLES)
        self.name[at:end] = seeds
        self.r[at:end] = -np.log(u[:, 0] * u[:, 1])
        self.log_c[at:end] = np.log(-np.log(u[:, 2] * u[:, 3]))
        self.beta[at:end] = u[:, 4]
        # ln a of a word that occurs once: its level t is 0.
        self.once[at:end] = self.log_c[at:end] + self.r[at:end] * (self.beta[at:end] - 1)

    def _places(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in words if w not in self.place]
        if len(new) + len(self.place) > self.most:
            self.place, new = {}, words
        if new:
            at = len(self.place)
            self._draw(new, at)
            self.place.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def signature(self, text: bytes) -> np.ndarray:
        """The sampled (word, level) of each sample as one number; a text without words gives zeros."""
        counts = Counter(text.split())
        words = list(counts)
        best = np.full(SAMPLES, np.inf, np.float32)
        found = np.zeros(SAMPLES, np.uint64)
        step = self.most // 2
        for s in range(0, len(words), step):
            part = words[s : s + step]
            at = self._places(part)
            log_weight = np.log(np.fromiter(map(counts.__getitem__, part), np.float32, len(part)))
            values = self.once[at]
            levels = np.zeros((0, SAMPLES), np.int64)
            many = np.flatnonzero(log_weight > 0)
            if len(many):
                r, beta = self.r[at[many]], self.beta[at[many]]
                t = np.floor(log_weight[many, None] / r + beta)
                values[many] = self.log_c[at[many]] - r * (t - beta) - r
                levels = t.astype(np.int64)
            row = np.argmin(values, axis=0)
            lowest = values[row, np.arange(SAMPLES)]
            place = np.full(len(part), -1)
            place[many] = np.arange(len(many))
            level = np.zeros(SAMPLES, np.uint64)
            hit = place[row] >= 0
            level[hit] = levels[place[row][hit], np.flatnonzero(hit)].astype(np.uint64)
            name = self.name[at[row]] ^ ((level + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))
            better = lowest < best
            best[better], found[better] = lowest[better], name[better]
        return found


@cache
def sampler() -> Sampler:
    return Sampler()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples: an estimate of the generalised Jaccard similarity."""
    return float((a == b).mean())


def printed(signature: np.ndarray) -> str:
    return base64.b64encode(signature.astype("<u8").tobytes()).decode()


def edited(text: str, following: str) -> str:
    """The last quarter of the code points gives way to as many of the next text, or all it has."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _share(hash_: Column, of: Column) -> Column:
    """Number of the share, of ``of`` equal shares of all hashes in their order, that a hash falls into."""
    return F.shiftright((F.shiftright(hash_, 44) + (1 << 19)) * of, 20).cast("int")


def _range_of(cuts: list[int], null_shares: int, width: int = 64) -> Column:
    """Number of the range of a row, found in two steps; needs the columns doc_id and hash.

    A cut that occurs m times is a doc_id that fills m ranges: its rows are dealt to them by
    text hash. Null doc_ids lie above all, in ``null_shares`` ranges by text hash.
    """
    nulls = F.lit(len(cuts) + 1) + _share(F.col("hash"), F.lit(null_shares))
    if not cuts:
        return F.when(F.col("doc_id").isNull(), nulls).otherwise(0)
    below = lambda xs, equal: F.size(
        F.filter(xs, lambda c: (c <= F.col("doc_id")) if equal else (c < F.col("doc_id")))
    )
    blocks = [cuts[i : i + width] for i in range(0, len(cuts), width)]
    longs = lambda xs: F.lit(xs).cast("array<bigint>")

    def count(equal: bool) -> Column:
        coarse = below(longs([x[0] for x in blocks]), equal)
        fine = below(F.get(F.array(*map(longs, blocks)), F.greatest(coarse - 1, F.lit(0))), equal)
        return F.when(coarse == 0, 0).otherwise((coarse - 1) * width + fine)

    upto, less = count(True), count(False)
    # Rows of a repeated cut are dealt over its ranges; larger doc_ids share the last of them.
    dealt = F.when(upto - less > 1, less + 1 + _share(F.col("hash"), upto - less)).otherwise(upto)
    return F.when(F.col("doc_id").isNull(), nulls).otherwise(dealt)


def _cuts(rows: DataFrame, range_bytes: int) -> tuple[list[int], int]:
    """Smallest doc_ids of at most ``MAX_RANGES`` consecutive ranges of similar counts, and the shares of null doc_ids."""
    size = F.octet_length("text")
    total, n_rows, of_nulls, n_nulls = rows.agg(
        F.sum(size), F.count("doc_id"), F.sum(F.when(F.col("doc_id").isNull(), size)), F.count_if(F.col("doc_id").isNull())
    ).first()
    null_shares = max(1, min(n_nulls, -(-int(of_nulls or 0) // range_bytes), MAX_RANGES))
    n = max(1, min(n_rows, -(-int(total or 0) // range_bytes), MAX_RANGES))
    if n == 1:
        return [], null_shares
    shares = [i / n for i in range(1, n)]
    return sorted(int(c) for c in rows.where("doc_id IS NOT NULL").approxQuantile("doc_id", shares, 0.2 / n)), null_shares


def fingerprint_documents(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness.

    A signature holds ``SAMPLES`` consistent weighted samples of the words by their
    counts: two signatures agree in a share of places that estimates the sum of
    smaller over the sum of larger counts. Two texts without words are alike.

    The next document is the one with the next larger doc_id; after the last comes
    the first. Equal doc_ids follow one another by text hash, null doc_ids come last, by
    text hash. The documents are dealt by ranges of doc_id; the first of each range
    is also sent to the range before, so each is sent once or twice, and a task
    streams through its sorted rows. A null text counts as empty. ``docs`` needs
    doc_id and text; other columns are ignored. A single document follows itself.
    Texts of any length are sampled whole. Empty tables give no rows.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.withColumn("hash", F.xxhash64("text")).withColumn("range", _range_of(*_cuts(rows, range_bytes)))
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "hash")
    # At most 2 MAX_RANGES + 1 rows: the first row of each range, and the range before it (before the first, the last).
    firsts = stage(dealt.groupBy("range").agg(F.min(key).alias("first")), "fingerprint-firsts")
    final = firsts.agg(F.max("range")).scalar()
    before = firsts.select(
        "range", "first", F.coalesce(F.lag("range").over(Window.orderBy("range")), final).alias("previous")
    )
    also = F.when(key == F.col("first"), F.array(F.struct(F.col("previous").alias("at"), F.lit(1).alias("ahead"))))
    own = F.array(F.struct(F.col("range").alias("at"), F.lit(0).alias("ahead")))
    sent = (
        dealt.join(F.broadcast(before), "range")
        .select("doc_id", "text", "hash", F.explode(F.concat(own, F.coalesce(also, F.array()))).alias("to"))
        .select("doc_id", "text", "hash", "to.at", "to.ahead")
        .repartition("at")
        .sortWithinPartitions("at", "ahead", F.col("doc_id").isNull(), "doc_id", "hash")
    )
    return sent.select("doc_id", "text", "at", "ahead").mapInArrow(_print_all, PRINTED)


def _print_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams sorted rows; each is finished when the row after it in its range is seen."""
    signature = sampler().signature
    held: tuple | None = None
    for batch in pieces(batches):
        rows = []
        for doc_id, text, at, ahead in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "at", "ahead")), strict=True):
            own = signature(text.encode())
            if held and held[2] == at:
                rows.append(_finish(*held[:2], held[3], text, own))
            held = None if ahead else (doc_id, text, at, own)
        if rows:
            kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2
            names = [part.split()[0] for part in PRINTED.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _finish(doc_id: int | None, text: str, own: np.ndarray, following: str, follower: np.ndarray) -> tuple:
    changed = edited(text, following).encode()
    other = sampler().signature(changed)
    return (
        doc_id,
        len(text),
        sha256(changed).hexdigest(),
        printed(own),
        printed(other),
        likeness(own, other),
        likeness(own, follower),
    )
