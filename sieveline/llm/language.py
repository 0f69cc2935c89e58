"""Language by hyperdimensional profiles: bound letter trigrams, bundled and compared by cosine."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import pieces

DIMENSIONS = 512
#: Letters fall into this many classes: a to z, and hashed classes for all others; class 0 is the gap between words.
CLASSES = 128
GRAMS = CLASSES**3
#: Bytes of texts whose trigrams a worker counts at once; sorting them takes some twenty times as much.
COUNTED_BYTES = 1 << 20
UNKNOWN = "und"
#: Bound of what is broadcast, 2 kB per language; more distinct labels than that are an error, none is dropped.
MAX_LANGUAGES = 100_000
#: Fewer labelled rows of a language and length set none.
LEAST_ROWS = 20
#: Cosines of unrelated vectors stay below this: four standard deviations.
UNRELATED = 4 / DIMENSIONS**0.5
_GAP = np.zeros(1, np.int32)

PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"


def _class_of(cp: int) -> int:
    if not (c := chr(cp)).isalpha():
        return 0
    low = ord(c.lower()[0])
    return low - 96 if 97 <= low <= 122 else 27 + (low * 2654435761 >> 7) % (CLASSES - 27)


@cache
def _classes() -> np.ndarray:
    """Class of every code point below 0x30000; what is no letter is a gap."""
    return np.fromiter((0 if 0xD800 <= cp < 0xE000 else _class_of(cp) for cp in range(0x30000)), np.int16, 0x30000)


@cache
def _letters() -> np.ndarray:
    """One random vector of ±1 per class and place in a trigram: rolling permutes it."""
    base = np.random.default_rng(20240229).integers(0, 2, (CLASSES, DIMENSIONS), np.int8) * 2 - 1
    return np.stack([np.roll(base, 2, axis=1), np.roll(base, 1, axis=1), base])


def bound(grams: np.ndarray) -> np.ndarray:
    """Vectors of trigrams: the product of their letters' permuted vectors."""
    a, b, c = _letters()
    return (a[grams // CLASSES**2] * b[grams // CLASSES % CLASSES] * c[grams % CLASSES]).astype(np.float32)


def trigrams(text: str) -> np.ndarray:
    """Trigram numbers of a text, gaps of any length as one."""
    cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    known = _classes()
    ids = known[np.minimum(cps, len(known) - 1)].astype(np.int32)
    for cp in np.unique(cps[cps >= len(known)]).tolist():
        ids[cps == cp] = _class_of(cp)
    ids = np.concatenate([_GAP, ids, _GAP])
    ids = ids[np.concatenate([[True], (ids[1:] > 0) | (ids[:-1] > 0)])]
    return (ids[:-2] * CLASSES + ids[1:-1]) * CLASSES + ids[2:]


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(trigrams(text), return_counts=True)


def bundle(grams: np.ndarray, counts: np.ndarray, step: int = 1 << 13) -> np.ndarray:
    """Sum of the vectors of all occurrences, in slices of bounded memory."""
    total = np.zeros(DIMENSIONS, np.float32)
    for at in range(0, len(grams), step):
        total += counts[at : at + step].astype(np.float32) @ bound(grams[at : at + step])
    return total


class Cache:
    """Trigram vectors of a worker, kept for the most recent ``most`` trigrams or fewer."""

    def __init__(self, most: int = 1 << 15):
        self.place = np.full(GRAMS, -1, np.int32)
        self.vectors = np.empty((most, DIMENSIONS), np.float32)
        self.known: np.ndarray = np.empty(0, np.int32)

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        new = grams[self.place[grams] < 0]
        if len(new) + len(self.known) > len(self.vectors):
            self.place[self.known] = -1
            self.known, new = self.known[:0], grams
        if len(new) > len(self.vectors):
            return bundle(grams, counts)
        if len(new):
            at = len(self.known)
            self.place[new] = np.arange(at, at + len(new))
            for i in range(0, len(new), 1 << 13):
                self.vectors[at + i : at + min(i + (1 << 13), len(new))] = bound(new[i : i + (1 << 13)])
            self.known = np.concatenate([self.known, new])
        return counts.astype(np.float32) @ self.vectors[self.place[grams]]


def held_out(folds: int = 5):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0


def train_prototypes(docs: DataFrame) -> dict[str, np.ndarray]:
    """One bundle per language over all trigrams of its documents.

    Tasks count the trigrams of each language and bundle them once; the driver
    receives one vector per language.
    """

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        waiting: dict[str, list[np.ndarray]] = {}

        def settle(lang: str) -> None:
            grams, counts = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
            totals[lang] = totals.get(lang, 0) + bundle(grams, counts).astype(np.float64)

        for batch in pieces(batches, most=COUNTED_BYTES):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                waiting.setdefault(lang, []).append(trigrams(text))
                docs_of[lang] = docs_of.get(lang, 0) + 1
            for lang in list(waiting):
                settle(lang)
        for lang, total in totals.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang], "n": [docs_of[lang]], "total": [total.tolist()]},
                pa.schema([("lang", pa.string()), ("n", pa.int64()), ("total", pa.list_(pa.float64()))]),
            )

    parts = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang").mapInArrow(learn, "lang string, n long, total array<double>")
    # One row per task and language; summed per dimension, whatever their number.
    summed = (
        parts.select("lang", "n", F.posexplode("total").alias("i", "x"))
        .groupBy("lang", "i")
        .agg(F.sum("x").alias("x"), F.sum("n").alias("n"))
        .groupBy("lang", "n")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("vector"))
        .limit(MAX_LANGUAGES + 1)
    )
    found = {r["lang"]: np.array(r["vector"], np.float32) for r in summed.collect()}
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} distinct languages")
    return found


def _predictor(prototypes: dict[str, np.ndarray], cache_: Cache | None = None):
    """Function of a text that gives (language, cosine, length class: the bits of its number of distinct trigrams).

    Vectors of trigrams are the same in all languages: predictors of one worker share a cache.
    """
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] for n in names], np.float64).reshape(len(names), DIMENSIONS)
    matrix = (matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    cache_ = cache_ or Cache()

    def predict(text: str | None) -> tuple[str, float, int]:
        grams, counts = counted(text) if text else (np.empty(0, np.int64), None)
        if not names or not len(grams) or not grams.any():
            return UNKNOWN, 0.0, 0
        vector = cache_.bundle(grams, counts)
        cosines = matrix @ vector / max(float(np.linalg.norm(vector)), 1e-12)
        best = int(np.argmax(cosines))
        return names[best], float(min(1.0, max(0.0, cosines[best]))), len(grams).bit_length()

    return predict


def identify_language(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Predict the language of whole texts.

    Prototypes are learned from the documents with a text and a language whose
    ``crc32(doc_id) % folds`` is not 0; a null doc_id counts as the empty string,
    which falls into the held-out fold. A text without letters, or a null one, is ``und`` with score
    0, and so is every text if nothing was learned. Ties go to the first language
    by name. Repeated rows are predicted each. ``docs`` needs doc_id, text, lang;
    other columns are ignored. Texts of any length count whole. Empty tables give no rows.

    Letters are classes (case folded), so scripts with thousands of letters share
    ``CLASSES`` classes. Returns doc_id, held_out, lang_pred, score (the cosine,
    at least 0).
    """
    rows = docs.select("doc_id", "text", "lang")
    prototypes = train_prototypes(rows.where(~held_out(folds)))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _predictor(prototypes)
        for batch in pieces(batches, most=COUNTED_BYTES):
            found = [of(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("held_out"),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.select("doc_id", held_out(folds).alias("held_out"), "text").mapInArrow(predict, PREDICTED)


def least_cosines(docs: DataFrame, prototypes: dict[str, np.ndarray]) -> dict[tuple[str, int], float]:
    """Per language and length class, the least cosine of texts that belong to the language.

    Every labelled document is scored against the prototype of its own label. The least cosine is
    that which 998 of 1,000 reach, or the lower outer fence if that is lower: the first quartile
    less three times the range between the quartiles. So clean documents, and those that quote
    another language, stay.
    Texts of more distinct trigrams have cosines that vary less; hence the length classes.
    """
    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = Cache()
        own: dict[str, Callable] = {}
        for batch in pieces(batches, most=COUNTED_BYTES):
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for lang in {*langs} - {*own}:
                own[lang] = _predictor({lang: prototypes[lang]} if lang in prototypes else {}, shared)
            found = [own[lang](text) for text, lang in zip(texts, langs, strict=True)]
            columns = [batch.column("lang"), pa.array([x[2] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bits", "cosine"])

    quartiles = (
        labelled.mapInArrow(score, "lang string, bits int, cosine double")
        .where("bits > 0")
        .groupBy("lang", "bits")
        .agg(F.percentile_approx("cosine", [0.002, 0.25, 0.75], 10_000).alias("q"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= LEAST_ROWS)
    )
    return {(r["lang"], r["bits"]): min(r["q"][0], r["q"][1] - 3 * (r["q"][2] - r["q"][1])) for r in quartiles.collect()}


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text is in none of the learned languages.

    A text goes if it has no letter, or if its cosine with the best prototype is below the least
    cosine of that language at its length (``least_cosines``): noise, and languages that
    were not learned. Lengths without enough labelled rows take the cutoff of the next shorter
    length that has one. Any columns; the prediction stays in the task that reads the row.
    """
    labelled = docs.select("doc_id", "text", "lang")
    prototypes = train_prototypes(labelled.where(~held_out()))
    least = least_cosines(labelled.where(~held_out()), prototypes)
    cutoffs = {}
    for lang in prototypes:
        last = UNRELATED
        for bits in range(64):
            last = cutoffs[lang, bits] = max(UNRELATED, least.get((lang, bits), last))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _predictor(prototypes)
        for batch in pieces(batches, most=COUNTED_BYTES):
            found = [of(text) for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= cutoffs[lang, bits] for lang, score, bits in found], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
