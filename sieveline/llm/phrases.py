"""Collocations: frequent phrases of words, counted by sorting suffix pointers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.ranking import top_k
from sieveline.sources.writers import stage

#: Longest phrase, in words.
MOST_WORDS = 5
#: Bits of the map of frequent pairs: 8 MB at any size of the corpus.
MAP_BITS = 1 << 26
#: Slots that triples are counted in, a byte each; slots in one row of counts, and the count at which a slot stays.
SLOTS, BLOCK_SLOTS, FULL_SLOT = 1 << 25, 1 << 16, 255
#: Words that a task looks at before it hands on what it counted, and suffixes that one task sorts.
CHUNK_WORDS, TASK_SUFFIXES = 1_000_000, 1_000_000
#: Words whose triples are put into slots at a time.
SLOT_WORDS = 250_000
#: Rows of an Arrow batch that goes back to Spark.
BATCH_ROWS = 1 << 17
#: Candidates of a language that one task sorts.
SHARE_ROWS = 1_000_000

#: Lower case; all ends of pieces become one of them.
_LOWER = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\x0A\x0B\x0C\x0D", bytes(range(97, 123)) + b"." * 9)
_DEPTHS = [f"k{d}" for d in range(1, MOST_WORDS + 1)]


_FACTORS = 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    for factor in _FACTORS:
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _unmixed(x: np.ndarray) -> np.ndarray:
    """What ``_mixed`` made ``x`` of: it maps 64 bits one to one."""
    for factor in reversed(_FACTORS):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(pow(factor, -1, 1 << 64))
    return x ^ (x >> np.uint64(33))


class _Names(dict):
    """64-bit names of words as bytes, apart for each language; 0 is no word, but the end of a piece, which is first."""

    def __init__(self, lang: str):
        super().__init__({b".": bytes(8)})
        self.seed = xxhash.xxh3_64_intdigest(lang.encode())

    def __missing__(self, word: bytes) -> bytes:
        self[word] = name = (xxhash.xxh3_64_intdigest(word, self.seed) or 1).to_bytes(8, "little")
        return name


def _chunks(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[tuple[np.ndarray, dict[str, _Names]]]:
    """Names of the words of many texts, with a 0 after every piece, and the names per language."""
    names: dict[str, _Names] = {}
    parts: list[bytes] = []
    held = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for text, lang in zip(texts, batch.column("lang").to_pylist(), strict=True):
            name = names.get(lang)
            if name is None:
                name = names[lang] = _Names(lang)
            words = (text.as_py() or b"").translate(_LOWER).replace(b".", b" . ").split()
            parts.append(b"".join(map(name.__getitem__, words)))
            parts.append(name[b"."])
            held += len(words) + 1
            if held >= (most or CHUNK_WORDS):
                whole = np.frombuffer(b"".join(parts), "<u8")
                parts, held = [], 0
                yield whole, names
                names = {}
    if parts:
        yield np.frombuffer(b"".join(parts), "<u8"), names


def _pairs(words: np.ndarray) -> np.ndarray:
    """Key of the two words from each position on; 0 where there are no two."""
    if len(words) < 2:
        return np.zeros(len(words), np.uint64)
    keys = _mixed(words[:-1] * _SPREAD + _mixed(words[1:]))
    keys[(words[:-1] == 0) | (words[1:] == 0)] = 0
    return np.append(keys, np.uint64(0))


def _second(keys: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The second words of pairs, from their keys and first words."""
    return _unmixed(_unmixed(keys) - first * _SPREAD)


def _slices(columns: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays(columns, names)
    for at in range(0, len(whole), BATCH_ROWS):
        yield whole.slice(at, BATCH_ROWS)


def _count_leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and of pairs of neighbours; words carry their language and spelling, pairs their first word."""
    fields = ["key", "n", "first", "lang", "word"]
    for words, names in _chunks(batches):
        used, n = np.unique(words[words != 0], return_counts=True)
        for lang, known in names.items():
            keys = np.frombuffer(b"".join(known.values()), "<u8")[1:]
            spelled = pa.array(list(known)[1:], pa.binary()).cast(pa.string())
            counts = n[np.searchsorted(used, keys)] if len(keys) else n[:0]
            of = [pa.nulls(len(keys), pa.int64()), pa.array([lang] * len(keys), pa.string()), spelled]
            yield from _slices([pa.array(keys.view(np.int64)), pa.array(counts), *of], fields)
        keys = _pairs(words)
        at = np.flatnonzero(keys).astype(np.int32 if len(keys) < 1 << 31 else np.int64)
        at = at[np.argsort(keys[at])]
        keys = keys[at]
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        n = np.diff(np.append(head, len(at)))
        keys, first = keys[head], words[at[head]]
        nothing = pa.nulls(len(head), pa.string())
        yield from _slices([pa.array(keys.view(np.int64)), pa.array(n), pa.array(first.view(np.int64)), nothing, nothing], fields)


def _bits(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the slots of the keys are set in a map."""
    slot = keys % np.uint64(64 * len(table))
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _triples(words: np.ndarray, pair_map: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions from which two frequent pairs follow each other, and keys of their three words."""
    keys = _pairs(words)
    frequent = _bits(pair_map, keys) & (keys != 0)
    at = np.flatnonzero(frequent[:-1] & frequent[1:])
    return at, _mixed(keys[at] * _SPREAD + keys[at + 1])


def _count_slots(pair_map: Broadcast):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of the slots that triples fall into, one byte a slot: rows of the slots used, block by block."""
        counts = np.zeros(SLOTS, np.uint8)
        for words, _ in _chunks(batches, SLOT_WORDS):
            used, n = np.unique((_triples(words, pair_map.value)[1] % np.uint64(SLOTS)).astype(np.uint32), return_counts=True)
            counts[used] = np.minimum(counts[used] + n, FULL_SLOT)
        for block, part in enumerate(counts.reshape(-1, BLOCK_SLOTS)):
            at = np.flatnonzero(part)
            if len(at):
                row = {"block": [block], "at": [at.astype("<u2").tobytes()], "n": [part[at].tobytes()]}
                yield pa.RecordBatch.from_pydict(row, pa.schema([("block", pa.int32()), ("at", pa.binary()), ("n", pa.binary())]))

    return count


def _slot_map(rows: DataFrame, least: int) -> np.ndarray:
    """Map of the slots that ``least`` triples, or all that a slot counts, fall into: at most 512 rows of 8 KB reach the driver."""

    def summed(table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK_SLOTS, np.int64)
        for at, n in zip(table.column("at").to_pylist(), table.column("n").to_pylist(), strict=True):
            total[np.frombuffer(at, "<u2")] += np.frombuffer(n, np.uint8)
        bits = np.packbits(total >= min(least, FULL_SLOT), bitorder="little").tobytes()
        return pa.table({"block": table.column("block").slice(0, 1), "bits": pa.array([bits], pa.binary())})

    table = rows.groupBy("block").applyInArrow(summed, "block int, bits binary").toArrow()
    out = np.zeros((SLOTS // BLOCK_SLOTS, BLOCK_SLOTS // 64), "<u8")
    for block, bits in zip(table.column("block").to_pylist(), table.column("bits").to_pylist(), strict=True):
        out[block] = np.frombuffer(bits, "<u8")
    return out.ravel()


def _folded(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one, with the sum of their weights."""
    if not len(rows):
        return rows, weight
    order = np.lexsort(rows.T[::-1])
    rows, weight = rows[order], weight[order]
    heads = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))
    return rows[heads], np.add.reduceat(weight, heads)


def suffixes(words: np.ndarray, leads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes, to the maximum depth, of three words or more that hold only marked triples; and how often each occurs.

    ``leads`` marks the positions of triples.
    """
    start = np.flatnonzero(leads)
    rows = np.zeros((len(start), MOST_WORDS), np.int64)
    signed = words.view(np.int64)
    goes_on = np.ones(len(start), bool)
    for d in range(MOST_WORDS):
        if d > 2:
            goes_on = goes_on & leads[np.minimum(start + d - 2, len(words) - 1)]
        rows[goes_on, d] = signed[start[goes_on] + d]
    return _folded(rows, np.ones(len(rows), np.int64))


def frequent_prefixes(rows: np.ndarray, weight: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey three-way quicksort of weighted suffixes, to their maximum depth.

    The suffixes of a part agree in the words above its depth. A part is cut by a pivot
    into smaller, equal and larger ones at that word; the equal ones go on at the next
    word, and their weight is the count of the phrase. A part that weighs less than
    ``least`` holds no frequent phrase and is abandoned. Returns the phrases of two words and
    more, as suffixes ended by zeros, and their counts.
    """
    phrases, counts = [], []
    parts = [(np.arange(len(rows)), 0)]
    while parts:
        at, depth = parts.pop()
        if not len(at) or int(weight[at].sum()) < least:
            continue
        words = rows[at, depth]
        middle = len(words) // 2
        pivot = sorted((words[0], words[middle], words[-1]))[1]
        equal = at[words == pivot]
        parts += [(at[words < pivot], depth), (at[words > pivot], depth)]
        count = int(weight[equal].sum())
        if pivot == 0 or count < least:
            continue
        if depth > 0:
            phrase = np.zeros(MOST_WORDS, np.int64)
            phrase[: depth + 1] = rows[equal[0], : depth + 1]
            phrases.append(phrase)
            counts.append(count)
        if depth + 1 < MOST_WORDS:
            parts.append((equal, depth + 1))
    return np.array(phrases, np.int64).reshape(-1, MOST_WORDS), np.array(counts, np.int64)


def _at_border(rows: np.ndarray, weight: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all phrases of two words and more that begin the row ``edge``."""
    phrases, counts = [], []
    inside = np.ones(len(rows), bool)
    for d in range(MOST_WORDS):
        if edge[d] == 0:
            break
        inside = inside & (rows[:, d] == edge[d])
        if d > 0:
            phrases.append(np.where(np.arange(MOST_WORDS) <= d, edge, 0))
            counts.append(int(weight[inside].sum()))
    return np.array(phrases, np.int64).reshape(-1, MOST_WORDS), np.array(counts, np.int64)


def _mine(least: int):
    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of one range of suffixes. What begins its first or last row may go on in the
        next range: that is counted in any case, and summed later."""
        tables = [_folded(np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[:-1]], axis=1), b.columns[-1].to_numpy()) for b in batches]
        if not sum(len(t[0]) for t in tables):
            return
        rows, weight = _folded(np.concatenate([t[0] for t in tables]), np.concatenate([t[1] for t in tables]))
        del tables
        found, counts = frequent_prefixes(rows, weight, least)
        sides = [_at_border(rows, weight, rows[i]) for i in (0, -1)]
        phrases = np.concatenate([found, *(s[0] for s in sides)])
        counts = np.concatenate([counts, *(s[1] for s in sides)])
        phrases, first = np.unique(phrases, axis=0, return_index=True)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in phrases.T] + [pa.array(counts[first])], [*_DEPTHS, "n"])

    return mine


def _pair_map(keys: DataFrame) -> np.ndarray:
    """Map of the keys' last 26 bits: at most 2^20 rows of 64 bits reach the driver, whatever the corpus."""
    slot = F.pmod(F.col("key"), F.lit(MAP_BITS))
    bits = keys.select(F.shiftright(slot, 6).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(pmod(key, {MAP_BITS}) % 64 AS int))").alias("bit"))
    table = bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(MAP_BITS // 64, np.uint64)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out


def count_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): exact counts of all words, and of all phrases of 2 to 5 words that occur ``least`` times.

    ``words`` has lang, key, word, n; ``phrases`` has lang, words (array of their keys), n.
    Words and pairs of neighbours are counted first, one row for each that a task saw: these
    counts are exact, so pairs need no suffix. A phrase occurs no more often than any triple in it. Triples of
    two frequent pairs are counted in a fixed number of slots, a byte each. So only suffixes that
    lead with a triple of a slot that fills up are kept, cut before the next that does not (fixed maps of bits tell;
    they may keep more, never less). Equal suffixes of a task are one weighted row. The suffixes are
    dealt in ranges of their leading words, so that a frequent lead is spread over many tasks, and
    each range is sorted by ``frequent_prefixes``.
    """
    texts = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    spark = texts.sparkSession
    leading = stage(
        texts.mapInArrow(_count_leading, "key long, n long, first long, lang string, word string")
        .groupBy("key", "first", "lang", "word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("word").isNotNull() | (F.col("n") >= least)),
        "phrase-leads",
    )
    words = leading.where("word IS NOT NULL").select("lang", "key", "word", "n")
    pairs = leading.where("word IS NULL").select("key", "first", "n")
    known = spark.sparkContext.broadcast(_pair_map(pairs))
    filled = spark.sparkContext.broadcast(_slot_map(texts.mapInArrow(_count_slots(known), "block int, at binary, n binary"), least))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, n = np.zeros((0, MOST_WORDS), np.int64), np.zeros(0, np.int64)
        for names, _ in _chunks(batches):
            at, keys = _triples(names, known.value)
            leads = np.zeros(len(names), bool)
            leads[at[_bits(filled.value, keys)]] = True
            more, m = suffixes(names, leads)
            rows, n = _folded(np.concatenate([rows, more]), np.concatenate([n, m]))
            if len(rows) >= TASK_SUFFIXES:
                yield from _slices([pa.array(c) for c in rows.T] + [pa.array(n)], [*_DEPTHS, "n"])
                rows, n = rows[:0], n[:0]
        yield from _slices([pa.array(c) for c in rows.T] + [pa.array(n)], [*_DEPTHS, "n"])

    ddl = ", ".join(f"{k} long" for k in [*_DEPTHS, "n"])
    leads = stage(texts.mapInArrow(cut, ddl), "phrase-suffixes")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-leads.count() // TASK_SUFFIXES))
    counted = leads.repartitionByRange(tasks, *_DEPTHS).mapInArrow(_mine(least), ddl)
    longer = counted.where("k3 <> 0").groupBy(*_DEPTHS).agg(F.sum("n").alias("n")).where(F.col("n") >= least)

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, first = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("key", "first"))
            none = pa.array(np.zeros(len(batch), np.int64))
            k2 = pa.array(_second(key, first).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("first"), k2, none, none, none, batch.column("n")], [*_DEPTHS, "n"])

    whole = longer.unionByName(pairs.mapInArrow(spelled, ddl))
    lang = words.select(F.col("key").alias("k1"), "lang")
    phrases = whole.join(lang, "k1").select("lang", F.array_remove(F.array(*_DEPTHS), F.lit(0)).alias("words"), "n")
    return words, stage(phrases, "phrase-counts")


def collocations(docs: DataFrame, least: int = 100, share: int = 100, most: int = 2000) -> DataFrame:
    """The best phrases of 2 to 5 words of each language.

    A phrase that occurs a >= ``least`` times is a candidate. A cut after its first k words gives
    parts that occur l and r times, and floor(1000 * a * n / (l * r)) for n words of the language; the
    lowest cut counts, of equals the smallest k. A candidate inside a longer one that occurs at least
    ``share`` percent as often is left out. Products are decimals of 38 digits, exact up to 10^14 words.

    ``docs`` needs text and lang; other columns are ignored, and any may be null: a null text is
    empty, a null language is ``und``. Repeated rows count each time. Letters A to Z are
    lower-cased; pieces end at ``.,;:!?`` and line ends, words at spaces and tabs. Texts of any length are
    cut into words inside one task. Ties in the score go by count, then by spelling.
    Words are told apart by 64 bits. Empty tables give no rows.

    Returns lang, rank, phrase, a, l, r, n, score: the first ``most`` of each language.
    """
    words, phrases = count_phrases(docs, least)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    parts = phrases.unionByName(words.where(F.col("n") >= least).select("lang", F.array("key").alias("words"), "n"))
    cuts = phrases.select("lang", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumn("head", F.slice("words", F.lit(1), F.col("k"))).withColumn("tail", F.slice("words", F.col("k") + 1, F.size("words")))

    def counts_of(part: str, name: str) -> DataFrame:
        return parts.select("lang", F.col("words").alias(part), F.col("n").alias(name))

    scored = cuts.join(counts_of("head", "l"), ["lang", "head"]).join(counts_of("tail", "r"), ["lang", "tail"]).join(total, "lang")
    count = "decimal(15,0)"
    above = F.lit(1000).cast("decimal(4,0)") * (F.col("a").cast(count) * F.col("n").cast(count))
    below = F.col("l").cast(count) * F.col("r").cast(count)
    scored = scored.withColumn("above", above).withColumn("below", below).withColumn("score", F.expr("above div below"))
    lowest = scored.groupBy("lang", "words").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("best")
    ).select("lang", "words", "best.*")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size("words") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.size("words") - size + 1), lambda at: F.slice("words", at, size)),
        )
    )
    inside = (
        phrases.where(F.size("words") > 2)
        .select("lang", F.explode(F.array_distinct(inner)).alias("words"), F.col("n").alias("longer"))
        .groupBy("lang", "words")
        .agg(F.max("longer").alias("longer"))
    )
    kept = lowest.join(inside, ["lang", "words"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)
    )
    spelled = (
        kept.select("*", F.posexplode("words").alias("at", "key"))
        .join(words.select("lang", "key", "word"), ["lang", "key"])
        .groupBy("lang", "words", "score", "a", "l", "r", "n")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # A language may have any number of candidates: its best ones are taken of shares first.
    held = max(SHARE_ROWS, 2 * most)
    shares = phrases.count() // held
    while shares > 1:
        spelled = spelled.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
        spelled = top_k(spelled, ["lang", "share"], order, most).drop("share", "rank")
        shares = shares * most // held
    ranked = top_k(spelled, ["lang"], order, most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
