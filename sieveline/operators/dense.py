"""Vector operators: exact and cell-probed top-k, pooling, late interaction."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.config import (
    BASE_SEED,
    MAX_BROADCAST_VECTOR_CELLS,
    TOPK_DENSE,
)
from sieveline.functions.vectors import dot, l2_normalize
from sieveline.operators.blocks import HIT_ROWS, MAX_BLOCK_CELLS, HitPool, RunningTopK, query_blocks, round_half_away
from sieveline.operators.broadcasting import extent
from sieveline.operators.ranking import top_k
from sieveline.sources.writers import stage

_HIT_SCHEMA = "query_id string, domain string, doc_id string, chunk_id string, score double"
#: Queries and vectors whose products a task of queries has in hand at once.
QUERY_TILE, VECTOR_TILE = 256, 8_192
#: Vectors go to the queries unless they are so many times as large.
LARGER = 32


def normalize_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    return vectors.withColumn(column, l2_normalize(F.col(column)))


def mean_pool(tokens: DataFrame, key: str = "text_id", mask: str | None = None) -> DataFrame:
    """Mean of the token vectors of each text, as one array per text.

    ``mask`` names a 0/1 column; tokens with 0 do not count, and a text without any
    other gets a zero vector. Rows without a vector are skipped. Vectors are summed
    map-side, so each task sends one row per text.
    """
    weight = F.lit(1.0) if mask is None else F.coalesce(F.col(mask).cast("double"), F.lit(0.0))
    scaled = F.transform("embedding", lambda x: x.cast("double") * weight)
    sums = (
        tokens.filter(F.col("embedding").isNotNull())
        .select(key, array_to_vector(scaled).alias("v"), weight.alias("w"))
        .groupBy(key)
        .agg(Summarizer.sum(F.col("v")).alias("v"), F.sum("w").alias("n"))
    )
    mean = F.transform(vector_to_array("v"), lambda x: x / F.greatest("n", F.lit(1e-9)))
    return sums.select(key, mean.alias("embedding"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64")


def _rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of an Arrow column without nulls, one per row."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_domain(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[str, pa.Table | pa.RecordBatch]]:
    for domain in pa.compute.unique(table.column("domain")).drop_null().to_pylist():
        yield domain, table.filter(pa.compute.equal(table.column("domain"), domain))


def _query_groups(q: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of queries by domain, as Arrow buffers: no object per row."""
    table = q.filter(F.col("embedding").isNotNull()).toArrow()  # its size was checked by the caller
    return {d: (part.column("query_id").to_numpy(), _rows(part.column("embedding"))) for d, part in _by_domain(table)}


def dense_topk(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = TOPK_DENSE,
    broadcast_bound: int = MAX_BROADCAST_VECTOR_CELLS,
) -> DataFrame:
    """Exact inner-product top-k per (query, domain).

    ``queries``: query_id, domain to search, embedding. ``vectors``: chunk_id,
    doc_id, domain, embedding. Queries are stored, and both sides are counted. As a rule the queries are dealt
    out to tasks, and blocks of vectors within the bound visit them one after another: a task then gives away
    no more than k hits of a query and block. Only vectors that are far larger than the queries stay where they
    are; blocks of queries visit those, and each task of vectors gives away the k best of its rows for a query.
    """
    q = stage(queries.select("query_id", "domain", "embedding").filter(F.col("embedding").isNotNull()), "dense-queries")
    n, cells = extent(q, F.size("embedding"))
    domains = [r["domain"] for r in q.filter(F.col("domain").isNotNull()).select("domain").distinct().collect()]
    asked = vectors.filter(F.col("domain").isin(domains) & F.col("embedding").isNotNull())
    size = extent(asked, F.size("embedding"))[1]
    blocks = max(1, -(-size // max(1, broadcast_bound)))
    if blocks == 1 or size <= LARGER * cells:
        hits = _by_queries(q, n, asked, k, blocks)
    else:
        hits = _visit(q, k, broadcast_bound, lambda block: _against_broadcast(block, vectors, k))
    return top_k(hits, ["query_id", "domain"], [F.col("score").desc(), F.col("chunk_id")], k)


def _by_queries(q: DataFrame, n: int, vectors: DataFrame, k: int, blocks: int) -> DataFrame:
    """Hits of all queries, dealt out to tasks, in bounded blocks of vectors, one after another."""
    tasks = max(1, min(4 * q.sparkSession.sparkContext.defaultParallelism, -(-n // QUERY_TILE)))
    q = q.repartition(tasks)
    if blocks == 1:
        return _against_vectors(q, vectors, k)
    number = F.pmod(F.xxhash64("chunk_id", "doc_id"), F.lit(blocks))
    return reduce(DataFrame.unionByName, [stage(_against_vectors(q, vectors.filter(number == i), k), "dense-hits") for i in range(blocks)])


def _best_products(queries: np.ndarray, vectors: np.ndarray, rough: np.ndarray, longest: float, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, vector and rounded product of the k best vectors of each query; of equal ones the first.

    ``rough`` holds the vectors as they are multiplied first, ``longest`` the norm of the longest one: products of
    single precision choose what is multiplied in double precision.
    """
    running = RunningTopK(np.full((len(queries), k), -np.inf))
    asked = queries.astype(rough.dtype)
    unsure = (queries.shape[1] + 4) * 6e-8 * np.sqrt((queries * queries).sum(axis=1)) * longest if rough.dtype == np.float32 else 0.0
    found = []
    for at in range(0, len(vectors), VECTOR_TILE):
        products = asked @ rough[at : at + VECTOR_TILE].T
        # A later vector must be better than the running k-th by a millionth, the last place.
        full = running.least > -np.inf
        floor = np.where(full, running.least + 4e-7, _floor(products, running.least, k) - unsure) - unsure
        rows, cols = np.divmod(np.flatnonzero(products >= floor.astype(rough.dtype)[:, None]), products.shape[1])
        scores = round_half_away(np.einsum("ij,ij->i", queries[rows], vectors[cols + at].astype(np.float64)))
        on = scores > running.least[rows]
        rows, cols, scores = rows[on], cols[on], scores[on]
        on = running.keep(rows, scores)
        found.append((rows[on], cols[on] + at, scores[on]))
    rows, cols, scores = (np.concatenate(x) for x in zip(*found, strict=True))
    on = scores >= running.least[rows]
    rows, cols, scores = rows[on], cols[on], scores[on]
    order = np.lexsort((cols, -scores, rows))
    rows, cols, scores = rows[order], cols[order], scores[order]
    on = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[on], cols[on], scores[on]


def _against_vectors(q: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    table = vectors.select("domain", "chunk_id", "doc_id", "embedding").toArrow()  # its size was checked by the caller
    groups = {}
    for domain, part in _by_domain(table):
        part = part.take(pa.compute.sort_indices(part.column("chunk_id"), null_placement="at_start"))
        groups[domain] = _rows(part.column("embedding")), part.select(["doc_id", "chunk_id"]).combine_chunks()
    shared = q.sparkSession.sparkContext.broadcast(groups)
    step = max(1, min(QUERY_TILE, HIT_ROWS // k))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rough: dict[str, tuple[np.ndarray, float]] = {}
        for batch in batches:
            for domain, part in _by_domain(batch):
                if domain not in shared.value:
                    continue
                matrix, ids = shared.value[domain]
                queries = _rows(part.column("embedding")).astype(np.float64)
                if domain not in rough:
                    longest = math.sqrt(max(np.einsum("ij,ij->i", m, m).max() for m in _in_doubles(matrix)))
                    rough[domain] = matrix.astype(np.float32) if longest < 1e15 else matrix.astype(np.float64), longest
                multiplied, longest = rough[domain]
                if not np.abs(queries).max(initial=0.0) < 1e15:
                    multiplied = matrix.astype(np.float64)
                for at in range(0, len(queries), step):
                    rows, cols, scores = _best_products(queries[at : at + step], matrix, multiplied, longest, k)
                    names = part.column("query_id").take(pa.array(rows + at))
                    hits = [ids.column(c).combine_chunks().take(pa.array(cols)) for c in ("doc_id", "chunk_id")]
                    columns = [names, pa.array([domain] * len(rows), pa.string()), *hits, pa.array(scores)]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "domain", "doc_id", "chunk_id", "score"])

    return q.mapInArrow(score, _HIT_SCHEMA)


def _in_doubles(matrix: np.ndarray) -> Iterator[np.ndarray]:
    for at in range(0, len(matrix), VECTOR_TILE):
        yield matrix[at : at + VECTOR_TILE].astype(np.float64)


def _visit(queries: DataFrame, k: int, bound: int, search: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Hits of all queries, of which bounded blocks are searched one after another."""
    q = stage(queries.select("query_id", "domain", "embedding"), "dense-queries")
    n, cells = extent(q, F.size("embedding"))
    # A task holds about two hits of 16 bytes for each running score.
    blocks = query_blocks(cells, n, 4 * k, bound)
    if blocks == 1:
        return search(q)
    number = F.pmod(F.xxhash64("query_id", "domain"), F.lit(blocks))
    return reduce(DataFrame.unionByName, [stage(search(q.filter(number == i)), "dense-hits") for i in range(blocks)])


def _floor(scores: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """What a score must reach: the running k-th of its query, or without one the k-th of these scores."""
    floor = least - 1e-6
    if scores.shape[1] > k and len(new := np.flatnonzero(least == -np.inf)):
        known = np.where(np.isnan(scores[new]), -np.inf, scores[new])
        floor[new] = np.partition(known, -k, axis=1)[:, -k] - 1e-6
    return floor


def _against_broadcast(q: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    blocks = _query_groups(q)
    shared = q.sparkSession.sparkContext.broadcast(blocks)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pools = {d: HitPool(len(ids), k) for d, (ids, _) in shared.value.items()}
        for batch in batches:
            for domain, part in _by_domain(batch):
                pool, queries = pools[domain], shared.value[domain][1]
                matrix = _rows(part.column("embedding")).astype(np.float64).T
                start = pool.rows(part.select(["doc_id", "chunk_id"]))
                step = max(1, MAX_BLOCK_CELLS // len(part))
                for at in range(0, len(queries), step):
                    scores = queries[at : at + step].astype(np.float64) @ matrix
                    least = pool.running.least[at : at + step]
                    rows, cols = np.divmod(np.flatnonzero(scores >= _floor(scores, least, k)[:, None]), len(part))
                    found = round_half_away(scores[rows, cols])
                    on = found >= least[rows]
                    pool.add(rows[on] + at, cols[on] + start, found[on])
        for domain, pool in pools.items():
            yield from pool.batches(shared.value[domain][0], domain)

    asked = vectors.filter(F.col("domain").isin(list(blocks)) & F.col("embedding").isNotNull())
    return asked.select("chunk_id", "doc_id", "domain", "embedding").mapInArrow(score, _HIT_SCHEMA)


@dataclass(frozen=True)
class IvfIndex:
    """Inverted cells of vectors with product codes of their residuals.

    ``codes`` holds domain, cell, chunk_id, doc_id and code, a byte per part. ``centers`` has a row per
    cell; ``words[p]`` are the code words of part p, whose columns start at ``cuts[p]``.
    """

    codes: DataFrame
    centers: np.ndarray
    words: list[np.ndarray]
    cuts: list[int]

    def parts(self, matrix: np.ndarray) -> list[np.ndarray]:
        return [matrix[:, a:b] for a, b in zip(self.cuts, self.cuts[1:], strict=False)]


def _nearest(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers * centers).sum(axis=1)[None, :] - 2.0 * points @ centers.T, axis=1)


def _k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centers of a bounded sample; a center without points stays where it is."""
    centers = points[rng.permutation(len(points))[: min(k, len(points))]].copy()
    for _ in range(rounds):
        of = _nearest(points, centers)
        n = np.bincount(of, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, of, points)
        centers[n > 0] = sums[n > 0] / n[n > 0, None]
    return centers


def build_ivf(
    vectors: DataFrame,
    path: str,
    nlist: int = 16,
    parts: int = 8,
    sample_rows: int = 65_536,
    seed: int = BASE_SEED,
) -> IvfIndex:
    """Fit and store an approximate index of all vectors under ``path``; ``load_ivf`` opens it again.

    Cell centers and code words are fitted on about ``sample_rows`` vectors, chosen by the
    hash of their ids; every vector is then assigned and coded in one pass. Codes are
    partitioned by domain and cell, and a large cell is many files.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col("embedding").isNotNull())
    share = min(1.0, sample_rows / max(rows.count(), 1))
    chosen = rows.filter(F.pmod(F.xxhash64(F.lit(seed), "chunk_id"), F.lit(1_000_000)) < share * 1_000_000)
    ordered = chosen.select("chunk_id", "embedding").toPandas().sort_values("chunk_id")
    sample = _matrix(ordered["embedding"]) if len(ordered) else np.zeros((1, 1))
    rng = np.random.default_rng(seed)
    centers = _k_means(sample, nlist, rng)
    residuals = sample - centers[_nearest(sample, centers)]
    width = sample.shape[1]
    cuts = [round(i * width / min(parts, width)) for i in range(min(parts, width) + 1)]
    words = [_k_means(residuals[:, a:b], 256, rng) for a, b in zip(cuts, cuts[1:], strict=False)]
    model = [("center", i, x.tolist()) for i, x in enumerate(centers)]
    model += [(f"word{p}", i, x.tolist()) for p, part in enumerate(words) for i, x in enumerate(part)]
    spark.createDataFrame(model, "kind string, number int, vector array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    shared = spark.sparkContext.broadcast((centers, words, cuts))

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, w, at = shared.value
        for batch in batches:
            if not len(batch):
                continue
            matrix = _matrix(batch["embedding"])
            cell = _nearest(matrix, c)
            left = matrix - c[cell]
            coded = np.stack([_nearest(left[:, a:b], x) for a, b, x in zip(at, at[1:], w, strict=False)], axis=1).astype(np.uint8)
            yield batch.drop(columns="embedding").assign(cell=cell.astype(np.int32), code=[x.tobytes() for x in coded])

    coded = rows.select("chunk_id", "doc_id", "domain", "embedding").mapInPandas(
        code, "chunk_id string, doc_id string, domain string, cell int, code binary"
    )
    coded.repartitionByRange("domain", "cell", "chunk_id").write.mode("overwrite").partitionBy("domain", "cell").parquet(f"{path}/codes")
    return load_ivf(spark, path)


def load_ivf(spark: SparkSession, path: str) -> IvfIndex:
    model = spark.read.parquet(f"{path}/model").toPandas().sort_values(["kind", "number"])  # cells, and 256 words a part
    centers = _matrix(model[model["kind"] == "center"]["vector"])
    names = sorted((k for k in model["kind"].unique() if k != "center"), key=lambda k: int(k[4:]))
    words = [_matrix(model[model["kind"] == k]["vector"]) for k in names]
    cuts = [0, *np.cumsum([w.shape[1] for w in words]).tolist()]
    codes = spark.read.schema("chunk_id string, doc_id string, code binary, domain string, cell int").parquet(f"{path}/codes")
    return IvfIndex(codes, centers, words, cuts)


def ann_ivf_topk(
    queries: DataFrame,
    index: IvfIndex,
    vectors: DataFrame,
    k: int = TOPK_DENSE,
    nprobe: int = 4,
    depth: int | None = None,
    broadcast_bound: int = MAX_BROADCAST_VECTOR_CELLS,
) -> DataFrame:
    """Approximate top-k: score the codes of the nearest cells by table look-up, then the best ones exactly.

    Queries go to the codes in bounded blocks, which read only the cells they probe. A task
    keeps the ``depth`` (10 k) best code scores of a query; those candidates alone meet their
    ``vectors`` for the exact score.
    """
    depth = depth or 10 * k
    hits = _visit(queries, depth, broadcast_bound, lambda block: _look_up(block, index, depth, nprobe))
    candidates = top_k(hits, ["query_id", "domain"], [F.col("score").desc(), F.col("chunk_id")], depth).drop("score", "rank")
    asked = queries.select("query_id", "domain", F.col("embedding").alias("_q"))
    exact = candidates.join(asked, ["query_id", "domain"]).join(
        vectors.select("chunk_id", "domain", F.col("embedding").alias("_v")), ["chunk_id", "domain"]
    )
    scored = exact.select("query_id", "domain", "doc_id", "chunk_id", F.round(dot(F.col("_q"), F.col("_v")), 6).alias("score"))
    return top_k(scored, ["query_id", "domain"], [F.col("score").desc(), F.col("chunk_id")], k)


def _probes(queries: np.ndarray, centers: np.ndarray, nprobe: int, step: int = 65_536) -> np.ndarray:
    """The cells that each query probes."""
    squares = (centers * centers).sum(axis=1)[None, :]
    parts = [queries[i : i + step].astype(np.float64) for i in range(0, len(queries), step)]
    return np.concatenate([np.argsort(squares - 2.0 * x @ centers.T, axis=1, kind="stable")[:, :nprobe].astype(np.int32) for x in parts])


def _look_up(q: DataFrame, index: IvfIndex, depth: int, nprobe: int) -> DataFrame:
    spark = q.sparkSession
    groups = _query_groups(q)
    if not groups:
        return spark.createDataFrame([], _HIT_SCHEMA)
    probed = {int(cell) for _, matrix in groups.values() for cell in np.unique(_probes(matrix, index.centers, nprobe))}
    shared = spark.sparkContext.broadcast((groups, index.centers, index.words, index.cuts))
    codes = index.codes.filter(F.col("domain").isin(list(groups)) & F.col("cell").isin(sorted(probed)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, centers, words, cuts = shared.value
        pools: dict[str, HitPool] = {}
        probes: dict[str, np.ndarray] = {}
        for batch in batches:
            for domain, own in _by_domain(batch):
                if domain not in pools:
                    pools[domain] = HitPool(len(queries[domain][0]), depth)
                    probes[domain] = _probes(queries[domain][1], centers, nprobe)
                pool = pools[domain]
                for cell in pa.compute.unique(own.column("cell")).to_pylist():
                    asking = np.flatnonzero((probes[domain] == cell).any(axis=1))
                    if not len(asking):
                        continue
                    part = own.filter(pa.compute.equal(own.column("cell"), cell))
                    start = pool.rows(part.select(["doc_id", "chunk_id"]))
                    coded = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(len(part), -1)
                    for some in np.array_split(asking, -(-len(asking) * len(part) // MAX_BLOCK_CELLS)):
                        matrix = queries[domain][1][some].astype(np.float64)
                        scores = np.repeat((matrix @ centers[cell])[:, None], len(part), axis=1)
                        for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                            scores += (matrix[:, a:b] @ words[p].T)[:, coded[:, p]]
                        rows, cols = np.nonzero(scores >= pool.running.least[some][:, None])
                        pool.add(some[rows], cols + start, scores[rows, cols])
        for domain, pool in pools.items():
            yield from pool.batches(queries[domain][0], domain)

    return codes.select("chunk_id", "doc_id", "domain", "cell", "code").mapInArrow(score, _HIT_SCHEMA)


def recall_at_k(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact hits that the approximate search also returned."""
    found = approximate.select("query_id", "domain", "chunk_id", F.lit(1).alias("_hit"))
    joined = exact.join(found, ["query_id", "domain", "chunk_id"], "left")
    return joined.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n_exact"),
        F.avg(F.coalesce(F.col("_hit"), F.lit(0))).alias("recall"),
    )


def maxsim_score(
    candidates: DataFrame, query_tokens: DataFrame, passage_tokens: DataFrame
) -> DataFrame:
    """Late-interaction score of candidate pairs.

    ``candidates``: query_id, doc_id. Token tables: id, token position, vector.
    Sum over query tokens of the best inner product with any passage token. Each text
    becomes one row with the matrix of its tokens; a pair is one row, and one matrix product.
    """

    def matrices(tokens: DataFrame, key: str, name: str) -> DataFrame:
        rows = tokens.filter(F.col("embedding").isNotNull()).groupBy(key)
        listed = rows.agg(F.sort_array(F.collect_list(F.struct("pos", "embedding"))).alias("t"))
        flat = F.flatten(F.transform("t", lambda x: x["embedding"]))
        return listed.select(key, flat.alias(name), F.size("t").alias(f"n_{name}"))

    pairs = (
        candidates.select("query_id", "doc_id")
        .join(matrices(query_tokens, "query_id", "q"), "query_id")
        .join(matrices(passage_tokens, "doc_id", "p"), "doc_id")
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            scores = [
                (np.asarray(q, np.float64).reshape(nq, -1) @ np.asarray(p, np.float64).reshape(np_, -1).T).max(axis=1).sum()
                for q, nq, p, np_ in zip(batch["q"], batch["n_q"], batch["p"], batch["n_p"], strict=True)
            ]
            yield batch[["query_id", "doc_id"]].assign(score=np.array(scores, np.float64))

    kinds = dict(candidates.dtypes)
    return pairs.mapInPandas(score, f"query_id {kinds['query_id']}, doc_id {kinds['doc_id']}, score double")
