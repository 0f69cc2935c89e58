"""BM25 as tables: blocks of postings, term statistics, corpus statistics, scoring."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.config import (
    BM25_B,
    BM25_EPSILON,
    BM25_K1,
    MAX_BROADCAST_TERM_ROWS,
    MAX_RUNNING_SCORES,
    SLAB_CHUNKS,
    TOPK_BM25,
)
from sieveline.functions.text import full_text, words
from sieveline.operators.blocks import HIT_ROWS, RunningTopK, query_blocks, round_half_away
from sieveline.sources.writers import stage

#: Term of the row that lists the chunks of a slab; no word is empty.
DIRECTORY = ""
#: One slab in so many, by hash, is searched in a round before the others, for the thresholds of queries.
FIRST_ROUND = 8
#: Blocks of queries that one job searches, so that their slabs are dealt out together.
BLOCKS_AT_ONCE = 8
#: About so many hits of some queries are merged at once.
MERGED_HITS = 1_500_000
#: Scores and postings of queries that a task has in hand at once.
TILE_CELLS = 2_000_000
#: A term that more than one chunk in so many of a slab contains is added up as a row of all its chunks.
COMMON = 16
#: A look-up takes about as long as adding up so many chunks of such a row.
LOOKED_UP = 16
#: Numbers of slabs have this many bits below the number of their segment.
SEGMENT_BITS = 56

_BLOCK = pa.schema(
    [
        ("domain", pa.string()),
        ("slab", pa.int64()),
        ("term", pa.string()),
        ("chunks", pa.binary()),
        ("tf", pa.binary()),
        ("max_tf", pa.int32()),
        ("min_dl", pa.int32()),
        ("doc_ids", pa.list_(pa.string())),
        ("chunk_ids", pa.list_(pa.string())),
        ("dl", pa.list_(pa.int32())),
    ]
)
_BLOCK_DDL = (
    "domain string, slab long, term string, chunks binary, tf binary, max_tf int, min_dl int, "
    "doc_ids array<string>, chunk_ids array<string>, dl array<int>"
)


@dataclass(frozen=True)
class Bm25Index:
    """``blocks`` has a row per (domain, slab, term), and one per slab that lists its chunks.

    A slab is a range of at most ``SLAB_CHUNKS`` chunks of one domain. A block holds the numbers of
    the chunks that contain the term and how often each does, as packed 32-bit numbers, and the
    largest count and least chunk length in it, which bound every score it can give.
    """

    blocks: DataFrame
    terms: DataFrame  # domain, term, df, idf
    corpus: DataFrame  # domain, n_chunks, avgdl, avg_idf

    @property
    def postings(self) -> DataFrame:
        """domain, doc_id, chunk_id, dl, term, tf: one row per posting."""
        def spread(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in tables:
                offsets, chunk = _unpacked(table.column("chunks"))
                sizes = np.diff(offsets)
                kept = [table.column(c).take(pa.array(np.repeat(np.arange(len(table)), sizes))) for c in ("domain", "slab", "term")]
                counts = _unpacked(table.column("tf"))[1].astype(np.int64)
                yield pa.RecordBatch.from_arrays([*kept, pa.array(chunk), pa.array(counts)], ["domain", "slab", "term", "chunk", "tf"])

        keys = ["domain", "slab"]
        listed = self.blocks.filter(F.col("term") == DIRECTORY).select(
            *keys, F.posexplode(F.arrays_zip("doc_ids", "chunk_ids", "dl")).alias("chunk", "c")
        )
        each = self.blocks.filter(F.col("term") != DIRECTORY).select(*keys, "term", "chunks", "tf")
        each = each.mapInArrow(spread, "domain string, slab long, term string, chunk int, tf long")
        return each.join(listed, [*keys, "chunk"]).select(
            "domain", "c.doc_ids", "c.chunk_ids", F.col("c.dl").cast("long").alias("dl"), "term", "tf"
        ).toDF("domain", "doc_id", "chunk_id", "dl", "term", "tf")


def _packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary value of 32-bit numbers per stretch between two offsets."""
    buffers = [None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(values.astype("<i4"))]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and numbers of ``_packed`` values."""
    column = column.cast(pa.binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return (at - at[0]) // 4, whole[at[0] : at[-1]].view("<i4")


class _Slab:
    """Chunks of one domain, as they come, until they are a slab."""

    def __init__(self):
        self.numbers: dict[str, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.words: list[np.ndarray] = []
        self.doc_ids: list[str] = []
        self.chunk_ids: list[str] = []

    def add(self, doc_id: str, chunk_id: str, tokens: list[str]) -> None:
        self.words.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens)))
        self.doc_ids.append(doc_id)
        self.chunk_ids.append(chunk_id)

    def rows(self, domain: str, slab: int) -> pa.RecordBatch:
        n = len(self.words)
        dl = np.array([len(w) for w in self.words], np.int32)
        keys, tf = np.unique(np.concatenate(self.words).astype(np.int64) * n + np.repeat(np.arange(n), dl), return_counts=True)
        number, chunk = keys // n, (keys % n).astype(np.int32)
        starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        terms = list(self.numbers)
        offsets = np.append(np.append(starts, len(keys)), len(keys))  # the last row, the directory, has no postings
        count = len(terms) + 1

        def listing(values: list, kind: pa.DataType) -> pa.Array:
            return pa.array([None] * len(terms) + [values], pa.list_(kind))

        return pa.RecordBatch.from_arrays(
            [
                pa.array([domain] * count, pa.string()),
                pa.array(np.full(count, slab)),
                pa.array([*terms, DIRECTORY], pa.string()),
                _packed(chunk, offsets),
                _packed(tf, offsets),
                pa.array(np.append(np.maximum.reduceat(tf, starts), 0).astype(np.int32)),
                pa.array(np.append(np.minimum.reduceat(dl[chunk], starts), 0).astype(np.int32)),
                listing(self.doc_ids, pa.string()),
                listing(self.chunk_ids, pa.string()),
                listing(dl.tolist(), pa.int32()),
            ],
            schema=_BLOCK,
        )


def posting_blocks(chunks: DataFrame, slab_chunks: int = SLAB_CHUNKS) -> DataFrame:
    """Blocks of postings: each task numbers and counts its own chunks, so nothing is shuffled.

    A task holds one open slab per domain. Chunks without a word are left out.
    """
    lowered = chunks.select("domain", "doc_id", "chunk_id", F.lower(full_text()).alias("text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        slabs: dict[str, _Slab] = defaultdict(_Slab)
        for batch in batches:
            for domain, doc_id, chunk_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # All white space that ``words`` knows, and nothing else, separates words here, too.
                if not (tokens := (text or "").split()):
                    continue
                slabs[domain].add(doc_id, chunk_id, tokens)
                if len(slabs[domain].words) == slab_chunks:
                    yield slabs.pop(domain).rows(domain, made)
                    made += 1
        for domain, slab in slabs.items():
            yield slab.rows(domain, made)
            made += 1

    return lowered.mapInArrow(build, _BLOCK_DDL)


def chunk_lengths(blocks: DataFrame) -> DataFrame:
    """Chunk count and mean length per domain."""
    per_slab = blocks.filter(F.col("term") == DIRECTORY).select(
        "domain",
        F.size("dl").cast("long").alias("n"),
        F.aggregate("dl", F.lit(0).cast("long"), lambda a, x: a + x).alias("length"),
    )
    return per_slab.groupBy("domain").agg(
        F.sum("n").alias("n_chunks"), (F.sum("length") / F.sum("n")).alias("avgdl")
    )


def document_frequencies(blocks: DataFrame) -> DataFrame:
    counted = blocks.filter(F.col("term") != DIRECTORY).select("domain", "term", (F.octet_length("chunks") / 4).cast("long").alias("n"))
    return counted.groupBy("domain", "term").agg(F.sum("n").alias("df"))


def _raw_idf() -> Column:
    return F.log(F.col("n_chunks") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)


def corpus_statistics(frequencies: DataFrame, lengths: DataFrame) -> DataFrame:
    """Lengths plus the mean idf over the whole vocabulary, negatives included."""
    idf = frequencies.join(lengths, "domain").select("domain", _raw_idf().alias("raw_idf"))
    return lengths.join(idf.groupBy("domain").agg(F.avg("raw_idf").alias("avg_idf")), "domain")


def term_weights(frequencies: DataFrame, corpus: DataFrame, epsilon: float) -> DataFrame:
    """idf per term; a negative one becomes a share of the mean idf."""
    raw = frequencies.join(corpus, "domain").withColumn("raw_idf", _raw_idf())
    floor = F.col("avg_idf") * epsilon
    idf = F.when(F.col("raw_idf") < 0, floor).otherwise(F.col("raw_idf"))
    return raw.select("domain", "term", "df", idf.alias("idf"))


def bm25_index(chunks: DataFrame, epsilon: float = BM25_EPSILON) -> Bm25Index:
    """Index of a chunk table as lazy frames."""
    blocks = posting_blocks(chunks)
    frequencies = document_frequencies(blocks)
    corpus = corpus_statistics(frequencies, chunk_lengths(blocks))
    return Bm25Index(blocks, term_weights(frequencies, corpus, epsilon), corpus)


def save_index(
    chunks: DataFrame, name: str, path: str, buckets: int, epsilon: float = BM25_EPSILON
) -> Bm25Index:
    """Write an index under ``path`` as tables ``name_*`` and return the stored form.

    Text is tokenised once. Blocks are partitioned by domain, so that a search reads
    only the domains it asks for; bucketed by slab, so that it shuffles none; and sorted by
    term inside a bucket, so that the statistics of its pages leave out other terms.
    """
    spark = chunks.sparkSession

    def store(df: DataFrame, part: str) -> DataFrame:
        writer = df.write.mode("overwrite").option("path", f"{path}/{part}")
        if part == "blocks":
            writer = writer.partitionBy("domain").bucketBy(buckets, "slab").sortBy("term")
        writer.saveAsTable(f"{name}_{part}")
        return spark.table(f"{name}_{part}")

    # As many tasks as buckets, so that small partitions of the chunks do not make small slabs.
    blocks = store(posting_blocks(chunks.coalesce(buckets)).repartition(buckets, "slab"), "blocks")
    frequencies = store(document_frequencies(blocks), "frequencies")
    store(corpus_statistics(frequencies, chunk_lengths(blocks)), "corpus")
    return load_index(spark, name, epsilon)


def append_to_index(
    chunks: DataFrame, name: str, buckets: int, epsilon: float = BM25_EPSILON
) -> Bm25Index:
    """Add the blocks of new chunks to a stored index, as a segment of its own slabs.

    Only the new text is tokenised. Document frequencies add up; lengths are taken from the
    directories of all slabs. ``buckets`` must be that of the index.
    """
    spark = chunks.sparkSession
    blocks = f"{name}_blocks"
    last = spark.table(blocks).filter(F.col("term") == DIRECTORY).agg(F.max(F.shiftright("slab", SEGMENT_BITS))).first()[0]
    segment = 0 if last is None else last + 1
    added = posting_blocks(chunks.coalesce(buckets)).withColumn("slab", F.col("slab") + F.lit(segment << SEGMENT_BITS))
    added = stage(added.repartition(buckets, "slab"), "bm25-segment")
    summed = spark.table(f"{name}_frequencies").unionByName(document_frequencies(added)).groupBy("domain", "term").agg(F.sum("df").alias("df"))
    frequencies = stage(summed, "bm25-frequencies")
    added.select(spark.table(blocks).columns).write.mode("append").partitionBy("domain").bucketBy(buckets, "slab").sortBy("term").saveAsTable(blocks)
    corpus = stage(corpus_statistics(frequencies, chunk_lengths(spark.table(blocks))), "bm25-corpus")
    for part, table in (("frequencies", frequencies), ("corpus", corpus)):
        table.write.mode("overwrite").insertInto(f"{name}_{part}")
    return load_index(spark, name, epsilon)


def load_index(spark: SparkSession, name: str, epsilon: float = BM25_EPSILON) -> Bm25Index:
    corpus = spark.table(f"{name}_corpus")
    terms = term_weights(spark.table(f"{name}_frequencies"), corpus, epsilon)
    return Bm25Index(spark.table(f"{name}_blocks"), terms, corpus)


def query_weights(queries: DataFrame, index: Bm25Index) -> DataFrame:
    """``(query_id, domain, term, w)``; a repeated query term counts repeatedly."""
    counted = (
        queries.select("query_id", "domain", F.explode(words("text")).alias("term"))
        .groupBy("query_id", "domain", "term")
        .agg(F.count(F.lit(1)).alias("qtf"))
    )
    return counted.join(index.terms, ["domain", "term"]).select(
        "query_id", "domain", "term", (F.col("qtf") * F.col("idf")).alias("w")
    )


def bm25_topk(
    queries: DataFrame,
    index: Bm25Index,
    k: int = TOPK_BM25,
    k1: float = BM25_K1,
    b: float = BM25_B,
    broadcast_bound: int = MAX_BROADCAST_TERM_ROWS,
) -> DataFrame:
    """Top-k chunks per (query, domain) with positive score.

    ``queries`` has one row per (query_id, domain to search, normalised text). The query
    terms are stored and counted, and go to the index in blocks within the bound, some blocks
    in one job. In a large index an eighth of the slabs goes first, for thresholds that hold in
    all others. Each task scores whole slabs: a query opens its terms' blocks from the
    largest bound down, until the bounds that are left cannot lift a new chunk over the
    query's running k-th score; later blocks are only looked up for chunks that still can
    pass it. No posting is shuffled, only what may be in the top-k, as packed numbers: a row
    per slab and range of queries, which are merged range by range.
    """
    weights = stage(query_weights(queries, index), "bm25-query-terms")
    sizes = weights.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("query_id", "domain").alias("queries")).first()
    blocks = query_blocks(sizes["rows"], sizes["queries"], k, broadcast_bound)
    slabs = _n_slabs(index) if sizes["rows"] else 0
    rounds = _rounds(index, slabs)
    part = max(1, MERGED_HITS // (k * (1 + slabs // FIRST_ROUND)))
    if blocks == 1 and rounds == 1:
        return _merged(_search(weights, index, k, k1, b, part=part), k)
    number = F.pmod(F.xxhash64("query_id", "domain"), F.lit(blocks))
    by_block = [weights.filter(number == i) for i in range(blocks)]
    found = [
        _in_rounds(by_block[i : i + BLOCKS_AT_ONCE], index, k, k1, b, rounds, part) for i in range(0, blocks, BLOCKS_AT_ONCE)
    ]
    return reduce(DataFrame.unionByName, [_merged(packed, k) for packed in found])


def _n_slabs(index: Bm25Index) -> int:
    return index.blocks.filter(F.col("term") == DIRECTORY).count()


def _rounds(index: Bm25Index, slabs: int | None = None) -> int:
    """Rounds of a search: two if there are so many slabs that an eighth of them sets useful thresholds."""
    return 1 if (_n_slabs(index) if slabs is None else slabs) < 4 * FIRST_ROUND else 2


def _in_rounds(
    weights: Sequence[DataFrame], index: Bm25Index, k: int, k1: float, b: float, rounds: int, part: int
) -> DataFrame:
    """Stored hits of some blocks of queries, slabs of the first round before the others.

    The k-th score of the first round is one that a hit of the others must reach.
    """

    def search(index: Bm25Index, least: pd.DataFrame | None = None) -> DataFrame:
        found = [_search(w, index, k, k1, b, least, part, i) for i, w in enumerate(weights)]
        return stage(reduce(DataFrame.unionByName, found), "bm25-hits")

    if rounds == 1:
        return search(index)
    first = F.pmod(F.xxhash64("domain", "slab"), F.lit(FIRST_ROUND)) == 0
    some = search(replace(index, blocks=index.blocks.filter(first)))
    last = _merged(some, k).filter(F.col("rank") == k).select("query_id", "domain", F.col("bm25_score").alias("least"))
    least = last.toPandas()  # one row per query of bounded blocks
    return some.unionByName(search(replace(index, blocks=index.blocks.filter(~first)), least))


_HITS = pa.schema(
    [
        ("query_id", pa.string()),
        ("domain", pa.string()),
        ("doc_id", pa.string()),
        ("chunk_id", pa.string()),
        ("bm25_score", pa.float64()),
    ]
)
_RANKED_DDL = "query_id string, domain string, doc_id string, chunk_id string, bm25_score double, rank int"
#: Hits of one slab for a range of queries: the place of query and chunk in the lists of ids, and the score of each.
_PACKED = pa.schema(
    [
        ("domain", pa.string()),
        ("part", pa.int64()),
        ("query_ids", pa.list_(pa.string())),
        ("doc_ids", pa.list_(pa.string())),
        ("chunk_ids", pa.list_(pa.string())),
        ("queries", pa.binary()),
        ("chunks", pa.binary()),
        ("scores", pa.binary()),
    ]
)
_PACKED_DDL = (
    "domain string, part long, query_ids array<string>, doc_ids array<string>, chunk_ids array<string>, "
    "queries binary, chunks binary, scores binary"
)


def _merged(packed: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query with their ranks, merged by range of queries."""

    def numbers(column: pa.Array, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), kind)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches)).combine_chunks()
        query_ids = rows.column("query_ids")[0].values
        lists = [rows.column(c).combine_chunks() for c in ("doc_ids", "chunk_ids")]
        starts = np.concatenate([[0], np.cumsum([len(x) for x in lists[1]])])[:-1]
        doc_ids, chunk_ids = (x.flatten() for x in lists)
        q, c, scores = (numbers(rows.column(n), t) for n, t in (("queries", "<i4"), ("chunks", "<i4"), ("scores", "<f8")))
        c = c + np.repeat(starts, [len(x.as_buffer()) // 4 for x in rows.column("chunks")])
        # Scores first: ids are compared only of hits that reach the k-th score.
        order = np.lexsort((-scores, q))
        q, c, scores = q[order], c[order], scores[order]
        ends = np.searchsorted(q, np.arange(len(query_ids)), side="right")
        last = np.minimum(np.searchsorted(q, np.arange(len(query_ids))) + k, ends) - 1
        able = scores >= scores[np.maximum(last, 0)][q]
        q, c, scores = q[able], c[able], scores[able]
        used, c = np.unique(c, return_inverse=True)
        doc_ids, chunk_ids = doc_ids.take(pa.array(used)), chunk_ids.take(pa.array(used))
        place = np.empty(len(used), np.int64)
        place[pa.compute.sort_indices(chunk_ids, null_placement="at_start").to_numpy()] = np.arange(len(used))
        order = np.lexsort((place[c], -scores, q))
        q, c, scores = q[order], c[order], scores[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q) + 1
        q, c, scores, rank = (x[rank <= k] for x in (q, c, scores, rank))
        domain = rows.column("domain")[0].as_py()
        for i in range(0, len(q), HIT_ROWS):
            some = pa.array(c[i : i + HIT_ROWS])
            names = query_ids.take(pa.array(q[i : i + HIT_ROWS]))
            columns = [names, pa.array([domain] * len(some), pa.string()), doc_ids.take(some), chunk_ids.take(some)]
            columns += [pa.array(scores[i : i + HIT_ROWS]), pa.array(rank[i : i + HIT_ROWS].astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*_HITS.names, "rank"])

    return packed.groupBy("domain", "part").applyInArrow(merge, _RANKED_DDL)


@dataclass(frozen=True)
class _QueryTerms:
    """Queries of one domain: the terms of query i are those from ``starts[i]`` to ``starts[i + 1]``."""

    query_ids: np.ndarray
    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray


def _by_domain(pdf: pd.DataFrame) -> tuple[dict[str, _QueryTerms], pd.DataFrame]:
    """Queries per domain, and the vocabulary that numbers their terms."""
    queries, vocabulary = {}, []
    for domain, part in pdf.groupby("domain"):
        part = part.sort_values(["query_id", "term"], ignore_index=True)
        term_no, terms = pd.factorize(part["term"])
        query_no, query_ids = pd.factorize(part["query_id"])
        starts = np.searchsorted(query_no, np.arange(len(query_ids) + 1))
        queries[domain] = _QueryTerms(np.asarray(query_ids), starts, term_no, part["w"].to_numpy())
        named = [*terms, DIRECTORY]
        vocabulary.append(pd.DataFrame({"domain": domain, "term": named, "term_no": [*range(len(terms)), -1]}))
    return queries, pd.concat(vocabulary) if vocabulary else pd.DataFrame()


def _search(
    weights: DataFrame,
    index: Bm25Index,
    k: int,
    k1: float,
    b: float,
    least: pd.DataFrame | None = None,
    part: int = 1_000,
    number: int = 0,
) -> DataFrame:
    """Packed hits of queries of a bounded number, ``part`` queries in a range; ``number`` tells blocks apart.

    ``least`` has scores that hits of a query must reach.
    """
    spark = weights.sparkSession
    queries, vocabulary = _by_domain(weights.toPandas())  # its size was checked by the caller
    if not queries:
        return spark.createDataFrame([], _PACKED_DDL)
    seeds = {domain: np.full(len(own.query_ids), -np.inf) for domain, own in queries.items()}
    if least is not None:
        for domain, known in least.groupby("domain"):
            if domain in queries:
                place = pd.Index(queries[domain].query_ids).get_indexer(known["query_id"])  # -1: of another block
                seeds[domain][place[place >= 0]] = known["least"].to_numpy()[place >= 0]
    shared = spark.sparkContext.broadcast((queries, seeds))
    numbered = spark.createDataFrame(vocabulary, "domain string, term string, term_no int")
    numbered = numbered.join(index.corpus.select("domain", "avgdl"), "domain")
    # The domains and the range of terms are known here: directories and pages of others are not read.
    asked = (F.col("term") == DIRECTORY) | F.col("term").between(
        min(t for t in vocabulary["term"] if t != DIRECTORY), max(vocabulary["term"])
    )
    rows = index.blocks.filter(F.col("domain").isin(list(queries)) & asked).join(F.broadcast(numbered), ["domain", "term"])
    running: dict[str, RunningTopK] = {}

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab = pa.Table.from_batches(list(batches)).combine_chunks()
        domain = slab.column("domain")[0].as_py()
        own, seed = shared.value[0][domain], shared.value[1][domain]
        if domain not in running:
            running[domain] = RunningTopK(np.repeat(seed[:, None], k, axis=1))
        yield from _packed_hits(slab, domain, own, running[domain], k1, b, part, number << 32)

    return rows.groupBy("domain", "slab").applyInArrow(search, _PACKED_DDL)


def _packed_hits(
    slab: pa.Table, domain: str, queries: _QueryTerms, running: RunningTopK, k1: float, b: float, part: int, first_part: int
) -> Iterator[pa.RecordBatch]:
    """A row for each range of queries that has hits in the slab."""
    doc_ids, chunk_ids = _listed(slab)

    def row(number: int, hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        q, c, scores = (np.concatenate(x) for x in zip(*hits, strict=True))
        used, c = np.unique(c, return_inverse=True)
        names = queries.query_ids[number * part : (number + 1) * part].tolist()
        ids = [pa.array(names, pa.string()), doc_ids.take(pa.array(used)), chunk_ids.take(pa.array(used))]
        values = [(q - number * part).astype("<i4"), c.astype("<i4"), scores.astype("<f8")]
        columns = [pa.array([domain]), pa.array([first_part + number])]
        columns += [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in ids]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array([x.tobytes()], pa.binary()) for x in values)], schema=_PACKED)

    held, at = [], -1
    for q, c, scores in _slab_best(slab, queries, running, k1, b):
        of = q // part
        for some in np.split(np.arange(len(q)), np.flatnonzero(np.diff(of)) + 1):
            if not len(some):
                continue
            if of[some[0]] != at and held:
                yield row(at, held)
                held = []
            at = int(of[some[0]])
            held.append((q[some], c[some], scores[some]))
    if held:
        yield row(at, held)


def _slab_hits(slab: pa.Table, domain: str, queries: _QueryTerms, best: np.ndarray, k1: float, b: float) -> pa.Table:
    """Hits in one slab that may be among the k best of a query; ``best`` holds the k best scores so far."""
    return pa.Table.from_batches(_slab_batches(slab, domain, queries, RunningTopK(best), k1, b), _HITS)


def _listed(slab: pa.Table) -> tuple[pa.Array, pa.Array]:
    """doc_ids and chunk_ids of a slab's directory."""
    at = int(np.flatnonzero(slab.column("term_no").to_numpy() == -1)[0])
    return slab.column("doc_ids")[at].values, slab.column("chunk_ids")[at].values


def _slab_batches(
    slab: pa.Table, domain: str, queries: _QueryTerms, running: RunningTopK, k1: float, b: float
) -> Iterator[pa.RecordBatch]:
    """``_slab_hits`` of some queries at a time, so that a task never holds those of all."""
    doc_ids, chunk_ids = _listed(slab)
    for q, c, scores in _slab_best(slab, queries, running, k1, b):
        for i in range(0, len(q), HIT_ROWS):
            part = pa.array(c[i : i + HIT_ROWS])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(queries.query_ids[q[i : i + HIT_ROWS]], pa.string()),
                    pa.array([domain] * len(part), pa.string()),
                    doc_ids.take(part),
                    chunk_ids.take(part),
                    pa.array(scores[i : i + HIT_ROWS]),
                ],
                schema=_HITS,
            )


def _slab_best(
    slab: pa.Table, queries: _QueryTerms, running: RunningTopK, k1: float, b: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Query, chunk and score of hits in a slab that may be among the k best, some queries at a time, in ascending order."""
    numbers = slab.column("term_no").to_numpy()
    listed = int(np.flatnonzero(numbers == -1)[0])
    lengths = slab.column("dl")[listed].values.to_numpy()
    avgdl = slab.column("avgdl")[0].as_py()
    offsets, chunk = _unpacked(slab.column("chunks").chunk(0))
    offsets, chunk, n = offsets.astype(np.int64), chunk.astype(np.int64), len(lengths)
    tf = _unpacked(slab.column("tf").chunk(0))[1].astype(np.float64)
    impacts = tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[chunk] / avgdl))
    # Ascending, since the chunks of a block are: finds the posting of any term and chunk.
    keys = np.repeat(np.arange(len(numbers)) * n, np.diff(offsets)) + chunk
    # Impacts of terms that many chunks contain, one number per chunk.
    common = np.flatnonzero(np.diff(offsets) * COMMON > n)
    common_of = np.full(len(numbers), -1)
    common_of[common] = np.arange(len(common))
    flat = np.zeros((len(common), n))
    for i, r in enumerate(common):
        flat[i, chunk[offsets[r] : offsets[r + 1]]] = impacts[offsets[r] : offsets[r + 1]]
    term_impacts = np.empty(n)
    most = np.zeros(len(numbers))
    if len(filled := np.flatnonzero(np.diff(offsets))):
        most[filled] = np.maximum.reduceat(impacts, offsets[filled])
    row_of = np.full(int(queries.terms.max()) + 1, -1)
    row_of[numbers[numbers >= 0]] = np.flatnonzero(numbers >= 0)
    place_of = np.empty(n, np.int64)  # of a chunk in the order that settles ties
    place_of[pa.compute.sort_indices(_listed(slab)[1]).to_numpy()] = np.arange(n)

    # Terms of each query that the slab has, those that can add most first.
    query = np.repeat(np.arange(len(queries.query_ids)), np.diff(queries.starts))
    row = row_of[queries.terms]
    query, row, weight = query[row >= 0], row[row >= 0], queries.weights[row >= 0]
    bound = np.maximum(weight * most[row], 0.0)
    starts = np.searchsorted(query, np.arange(len(queries.query_ids) + 1))
    least = running.least - 2e-6
    # Rows of common terms, times the smallest weight that a query gives them: most queries name a term once.
    usual = np.zeros(len(common))
    heaviest = np.argsort(-weight)
    heaviest = heaviest[common_of[row[heaviest]] >= 0]
    usual[common_of[row[heaviest]]] = weight[heaviest]
    weighted = flat * usual[:, None]

    def left_of(bound: np.ndarray) -> np.ndarray:
        """What a term and those of its query after it can add."""
        before = np.concatenate([[0.0], np.cumsum(bound)])
        return before[starts[query + 1]] - before[:-1]

    order = np.lexsort((-bound, query))
    row, weight, bound = row[order], weight[order], bound[order]
    opened = (left_of(bound) >= least[query]) | (least[query] <= 0)
    size = offsets[row + 1] - offsets[row]
    # A query whose opened blocks are not small opens the others, too: cheaper than look-ups for many chunks.
    many = np.bincount(query, np.where(opened, size, 0), len(least)) * LOOKED_UP > n
    opened |= many[query]
    order = np.lexsort((-bound, ~opened, query))
    row, weight, bound, opened, size = row[order], weight[order], bound[order], opened[order], size[order]
    left = left_of(bound)
    size = np.where(opened & (common_of[row] < 0), size, 0)
    reach = np.bincount(query, bound, len(least))
    asked = np.flatnonzero((reach > 0) & (reach >= least))
    cost = np.array([n], np.int64) + np.diff(np.concatenate([[0], np.cumsum(size)])[starts])[asked]
    tile = np.cumsum(cost) // TILE_CELLS
    for some in np.split(asked, np.flatnonzero(np.diff(tile)) + 1):
        if not len(some):
            continue
        # Opened blocks whole: one number per query and chunk.
        at = np.arange(starts[some[0]], starts[some[-1] + 1])
        own = np.searchsorted(some, query[at])
        able = (some[np.minimum(own, len(some) - 1)] == query[at]) & opened[at]
        at, own = at[able], own[able]
        able = common_of[row[at]] < 0
        whole, whole_own = at[~able], own[~able]
        at, own = at[able], own[able]
        ends = np.cumsum(size[at])
        posting = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[row[at]] - ends + size[at], size[at])
        total = np.bincount(
            np.repeat(own * n, size[at]) + chunk[posting], np.repeat(weight[at], size[at]) * impacts[posting], len(some) * n
        ).astype(np.float64, copy=False).reshape(len(some), n)  # without postings, integers
        for i, r, w in zip(whole_own.tolist(), common_of[row[whole]].tolist(), weight[whole].tolist(), strict=True):
            if w == usual[r]:
                np.add(total[i], weighted[r], out=total[i])
                continue
            np.multiply(flat[r], w, out=term_impacts)
            np.add(total[i], term_impacts, out=total[i])
        # Chunks in no opened block have 0 here, and cannot reach the least score by the others.
        n_opened = np.bincount(own, minlength=len(some)) + np.bincount(whole_own, minlength=len(some))
        next_term = starts[some] + n_opened
        rest = np.where(next_term < starts[some + 1], left[np.minimum(next_term, len(left) - 1)], 0.0)
        # Without a k-th score all blocks are opened: the k-th of these totals is one.
        floor = least[some]
        if n > running.k and len(new := np.flatnonzero(floor == -np.inf)):
            floor[new] = np.partition(total[new], n - running.k, axis=1)[:, n - running.k] - 2e-6
        q, c = np.divmod(np.flatnonzero(total >= np.maximum(floor - rest, 1e-9)[:, None]), n)
        scores = total[q, c]
        # The others only for chunks that can still pass.
        term, last = next_term[q], starts[some + 1][q]
        for _ in range(int((starts[some + 1] - next_term).max())):
            on = term < last
            able = ~on | (scores + left[np.minimum(term, len(left) - 1)] >= least[some][q])
            q, c, scores, term, last, on = q[able], c[able], scores[able], term[able], last[able], on[able]
            wanted = row[term[on]] * n + c[on]
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            scores[on] += np.where(keys[place] == wanted, weight[term[on]] * impacts[place], 0.0)
            term = term + 1
        scores = round_half_away(scores)
        able = (scores > 0) & (scores >= least[some][q])
        q, c, scores = some[q[able]], c[able], scores[able]
        able = running.keep(q, scores)
        q, c, scores = q[able], c[able], scores[able]
        first = np.lexsort((place_of[c], -scores, q))
        q, c, scores = q[first], c[first], scores[first]
        able = np.arange(len(q)) - np.searchsorted(q, q) < running.k
        q, c, scores = q[able], c[able], scores[able]
        yield q, c, scores
