"""Periodic runs of words, found on a Re-Pair grammar of the word ids."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import pieces

#: A run has at least this many words, and repeats its period at least this often.
LEAST_WORDS, LEAST_TIMES = 6, 4

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS_DDL = "array<struct<start:long,length:long,period:long>>"


@dataclass
class Words:
    """Words of several texts, one after another; equal ids are equal words of one text."""

    texts: list[list[bytes]]
    owner: np.ndarray  # number of the text of each word
    low: np.ndarray  # first position of each text, and the end of the last
    grams: list[np.ndarray]  # per j: number of the 2^j words from each position, -1 if they occur once

    @classmethod
    def of(cls, texts: list[bytes]) -> Words:
        cut = [t.split() for t in texts]
        low = np.concatenate([[0], np.cumsum([len(w) for w in cut])]).astype(np.int64)
        owner = np.repeat(np.arange(len(cut)), np.diff(low))
        seen: dict[bytes, int] = defaultdict()
        seen.default_factory = seen.__len__
        ids = np.fromiter((seen[w] for words in cut for w in words), np.int64, int(low[-1]))
        return cls(cut, owner, low, _grams(owner, owner * max(len(seen), 1) + ids))

    def same_ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` on."""
        return self._same(a, b, ahead=True)

    def same_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` equal those before ``b``."""
        return self._same(a, b, ahead=False)

    def _same(self, a: np.ndarray, b: np.ndarray, ahead: bool) -> np.ndarray:
        total, last = np.zeros(len(a), np.int64), int(self.low[-1]) - 1
        for j in reversed(range(len(self.grams))):
            x, y = (a + total, b + total) if ahead else (a - total - (1 << j), b - total - (1 << j))
            inside = (x >= 0) & (y >= 0) & (x <= last) & (y <= last)
            left = self.grams[j][np.clip(x, 0, last)]
            equal = inside & (left >= 0) & (left == self.grams[j][np.clip(y, 0, last)])
            total += np.where(equal, 1 << j, 0)
        return total


def _repeated(at: np.ndarray, keys: np.ndarray, size: int) -> np.ndarray:
    """Dense numbers of the keys that occur at several places, -1 elsewhere."""
    table = np.full(size, -1, np.int64)
    if len(at):
        _, number, count = np.unique(keys, return_inverse=True, return_counts=True)
        several = count > 1
        table[at] = np.where(several, np.cumsum(several) - 1, -1)[number]
    return table


def _grams(owner: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
    """Numbers of 1, 2, 4, … words, as long as any are repeated: windows of two repeated halves are looked at."""
    n = len(ids)
    tables = [_repeated(np.arange(n), ids, n)]
    while True:
        width = 1 << (len(tables) - 1)
        last = tables[-1]
        at = np.flatnonzero(last >= 0)
        at = at[at + 2 * width <= n]
        at = at[(last[at + width] >= 0) & (owner[at] == owner[at + 2 * width - 1])]
        table = _repeated(at, last[at] * (last.max(initial=0) + 1) + last[at + width], n)
        if not (table >= 0).any():
            return tables
        tables.append(table)


@dataclass
class Grammar:
    """Derivations of all nonterminals: where each starts, is cut in two, and ends; and which cuts are left."""

    rule: np.ndarray
    start: np.ndarray
    cut: np.ndarray
    end: np.ndarray
    left: np.ndarray


def re_pair(words: Words) -> Grammar:
    """Re-Pair of each text: the most frequent pair of neighbours becomes a nonterminal, until no pair is repeated.

    All texts are treated at once. Pairs of one text that are equally frequent are
    replaced in the same round; where two share a symbol, a shuffled order decides, so
    that a long chain of them takes few rounds. A place between two symbols whose pair occurs once is never looked at
    again, as longer symbols there occur once, too.
    """
    n = len(words.owner)
    symbol = words.grams[0].copy()
    before, after = np.arange(-1, n), np.arange(1, n + 2)
    many = 2 * n + 2
    named = n
    open_cuts = np.ones(n, bool)
    open_cuts[words.low[:-1][words.low[:-1] < n]] = False
    active = np.flatnonzero(words.grams[1] >= 0) + 1 if len(words.grams) > 1 else np.empty(0, np.int64)
    made: list[tuple[np.ndarray, ...]] = []
    while len(active):
        _, pair, count = np.unique(symbol[before[active]] * many + symbol[active], return_inverse=True, return_counts=True)
        several = count[pair] > 1
        active, pair = active[several], pair[several]
        if not len(active):
            break
        beside = np.concatenate([[False], before[active[1:]] == active[:-1]])
        # In a a a a every other place counts.
        place = np.arange(len(active))
        chained = beside & (pair == np.roll(pair, 1))
        usable = (place - np.maximum.accumulate(np.where(chained, 0, place))) % 2 == 0
        value = np.bincount(pair[usable], minlength=len(count))[pair]
        text = words.owner[active]
        heads = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        most = np.repeat(np.maximum.reduceat(value, heads), np.diff(np.append(heads, len(active))))
        best = usable & (value == most) & (most > 1)
        seen = np.empty(len(count), np.int64)
        seen[pair[::-1]] = place[::-1]
        never = np.iinfo(np.uint64).max
        turn = np.where(best, (seen[pair].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15), never)
        ahead, behind = np.append(turn[1:], never), np.concatenate([[never], turn[:-1]])
        best &= ~((beside & (behind < turn)) | (np.append(beside[1:], False) & (ahead < turn)))
        best &= np.bincount(pair[best], minlength=len(count))[pair] > 1
        cut = active[best]
        _, rule = np.unique(pair[best], return_inverse=True)
        start, end = before[cut], after[cut]
        made.append((rule + named, start, cut, end))
        symbol[start] = rule + named
        after[start], before[end] = end, start
        open_cuts[cut] = False
        named += int(rule.max(initial=-1)) + 1
        active = active[~best & (most > 1)]
    parts = [np.concatenate(p) for p in zip(*made, strict=True)] if made else [np.empty(0, np.int64)] * 4
    return Grammar(*parts, np.flatnonzero(open_cuts))


def _periods(words: Words, cut: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the cut, first place, period): all smallest periods that a run across the cut can have.

    On one side of the cut lie two periods of the run. So for a period of 2^j to 2^(j+1)
    words the 2^j words beside the cut occur once more, one period away, and so
    do the 2^j words at the other end of the period. Where the words beside the cut
    keep a smaller period for longer than both together, no such period is the smallest.
    """
    for j, table in enumerate(words.grams):
        width = 1 << j
        at = np.flatnonzero(table >= 0)
        order = at[np.argsort(table[at], kind="stable")]
        same = table[order[1:]] == table[order[:-1]]
        onward, back = np.full(len(table), -1, np.int64), np.full(len(table), -1, np.int64)
        onward[order[:-1][same]] = order[1:][same]
        back[order[1:][same]] = order[:-1][same]
        wide = np.flatnonzero(high - low >= max(LEAST_WORDS, LEAST_TIMES * width))
        for ahead in (True, False):
            links, step = (onward, 1) if ahead else (back, -1)
            room = high[wide] - cut[wide] if ahead else cut[wide] - low[wide]
            number = wide[room >= 2 * width]
            most = np.minimum(2 * width - 1, room[room >= 2 * width] // 2)
            origin = cut[number] if ahead else cut[number] - width
            place = links[origin]
            small = np.flatnonzero((place >= 0) & ((place - origin) * step * 2 <= width))
            near, inner = cut[number[small]], (place[small] - origin[small]) * step
            kept = inner + (words.same_ahead(near, near + inner) if ahead else words.same_before(near, near - inner))
            number, origin, place, most = (np.delete(x, small[kept >= most[small] + inner]) for x in (number, origin, place, most))
            found = []
            while True:
                away = (place - origin) * step
                on = (place >= 0) & (away <= most)
                number, origin, place, most, away = (x[on] for x in (number, origin, place, most, away))
                if not len(number):
                    break
                hit = away >= width
                n, q = number[hit], away[hit]
                one, other = (cut[n] + q - width, cut[n] + 2 * q - width) if ahead else (cut[n] - q, cut[n] - 2 * q)
                square = table[one] == table[other]
                found.append((n[square], q[square]))
                place = links[place]
            if found:
                n, q = (np.concatenate(x) for x in zip(*found, strict=True))
                yield n, cut[n] if ahead else cut[n] - q, q


def find_runs(words: Words) -> np.ndarray:
    """(start, end, period) of all runs, in order of their place; positions are those of ``words``.

    Every run crosses the cut of the nonterminal at the lowest common ancestor of its words, or a cut
    left between the symbols of the whole text. Runs across the cut of a nonterminal
    are computed once, within its expansion, and moved to all its derivations; what goes on
    beyond one of them is found at a higher one, and dropped here.
    """
    if not len(words.owner):
        return np.empty((0, 3), np.int64)
    grammar = re_pair(words)
    rules, once = np.unique(grammar.rule, return_index=True)
    # Two neighbours inside a run occur again in it.
    pairs = words.grams[1] if len(words.grams) > 1 else np.full(len(words.owner), -1, np.int64)
    left = grammar.left[pairs[grammar.left - 1] >= 0]
    cut = np.concatenate([grammar.cut[once], left])
    low = np.concatenate([grammar.start[once], words.low[words.owner[left]]])
    high = np.concatenate([grammar.end[once], words.low[words.owner[left] + 1]])
    parts = []
    for number, first, period in _periods(words, cut, low, high):
        start = np.maximum(first - words.same_before(first, first + period), low[number])
        end = np.minimum(first + period + words.same_ahead(first, first + period), high[number])
        run = (end - start >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)) & (start < cut[number]) & (cut[number] < end)
        parts.append(np.stack([number[run], start[run], end[run], period[run]], axis=1))
    found = np.unique(np.concatenate(parts), axis=0) if parts else np.empty((0, 4), np.int64)
    of_rule = found[:, 0] < len(rules)
    order = np.argsort(grammar.rule, kind="stable")
    heads = np.searchsorted(grammar.rule[order], rules)
    sizes = np.diff(np.append(heads, len(order)))
    number = found[of_rule, 0]
    times = sizes[number]
    member = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(heads[number], times)
    shift = grammar.start[order[member]] - np.repeat(grammar.start[once][number], times)
    moved = np.repeat(found[of_rule, 1:], times, axis=0)
    moved[:, 0] += shift
    moved[:, 1] += shift
    runs = np.concatenate([moved, found[~of_rule, 1:]])
    # Maximal intervals alone, and of one interval the smallest period.
    start, end, period = runs.T
    text, last, ids = words.owner[start], len(words.owner) - 1, words.grams[0]
    goes_on = (end < words.low[text + 1]) & (ids[np.minimum(end, last)] == ids[end - period])
    came_before = (start > words.low[text]) & (ids[np.maximum(start - 1, 0)] == ids[start - 1 + period])
    runs = runs[~(goes_on | came_before)]
    runs = runs[np.lexsort(runs.T[::-1])]
    if len(runs):
        runs = runs[np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapsed(words: Words, runs: np.ndarray) -> list[str]:
    edge = np.zeros(len(words.owner) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 1], -1)
    gone = np.cumsum(edge[:-1]) > 0
    touched = set(words.owner[runs[:, 0]].tolist()) if len(runs) else set()
    out = []
    for i, text in enumerate(words.texts):
        if i in touched:
            mask = gone[words.low[i] : words.low[i + 1]].tolist()
            text = [w for w, g in zip(text, mask, strict=True) if not g]
        out.append(b" ".join(text).decode())
    return out


def _judged(texts: pa.Array) -> tuple[Words, np.ndarray, pa.Array]:
    words = Words.of([t or b"" for t in texts.cast(pa.binary()).to_pylist()])
    runs = find_runs(words)
    text = words.owner[runs[:, 0]]
    offsets = np.searchsorted(text, np.arange(len(words.texts) + 1)).astype(np.int32)
    columns = [runs[:, 0] - words.low[text], runs[:, 1] - runs[:, 0], runs[:, 2]]
    rows = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_RUN))
    return words, runs, pa.ListArray.from_arrays(pa.array(offsets), rows)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of every text: stretches of consecutive words that repeat with a smallest period.

    A run has at least 6 words and 4 periods, and is as long as it can be. Words are what
    stands between white space. Collapsed texts keep the first period of each run, joined
    by spaces. Texts are compared with themselves only, inside a task, about 4 MB of
    text at a time; a longer text is alone, takes about 16 bytes per word and doubling, and has no cap.

    ``docs`` needs doc_id and text; other columns are ignored, any may be null. A null
    or empty text has no words, no runs and an empty collapsed text. Repeated rows each give their
    own row. Empty tables give no rows.

    Returns doc_id, n_words, runs (start word, length, period, in order) and collapsed, per row.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, most=4 << 20):
            words, runs, listed = _judged(batch.column("text"))
            columns = [batch.column("doc_id"), pa.array(np.diff(words.low)), listed, pa.array(_collapsed(words, runs), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(find, f"doc_id long, n_words long, runs {RUNS_DDL}, collapsed string")


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs``, of any columns, with each run cut to its first period; texts without a run stay as they are."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, most=4 << 20):
            words, runs, listed = _judged(batch.column("text"))
            old = batch.column("text").to_pylist()
            new = [c if n else t for c, n, t in zip(_collapsed(words, runs), listed.value_lengths().to_pylist(), old, strict=True)]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(new, batch.schema.field("text").type))

    return docs.mapInArrow(cut, docs.schema)


def run_digests(runs: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs`` the number of runs, the one repeated most often, and digests."""
    fewer = "acc.length * x.period < x.length * acc.period"
    best = F.expr(
        f"aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), try_element_at(runs, 1), (acc, x) -> CASE WHEN {fewer} THEN x ELSE acc END)"
    )
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return runs.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
