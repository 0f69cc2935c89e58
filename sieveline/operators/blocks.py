"""Running top-k thresholds for tasks that score block after block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from sieveline.config import MAX_RUNNING_SCORES

MAX_BLOCK_CELLS = 4_000_000  # scores held at once by one task
HIT_ROWS = 100_000  # about so many hits leave a task at once


def round_half_away(values: np.ndarray, places: int = 6) -> np.ndarray:
    """Round as SQL does; numpy would round ties to even."""
    factor = 10.0**places
    return np.trunc(values * factor + np.copysign(0.5, values)) / factor


class RunningTopK:
    """The k best scores seen so far, per query, inside one task.

    ``keep`` tells which hits may still belong to the task's top-k. Scores equal to the
    k-th stay in, so that ties are settled by the final rank and never by the order of
    blocks. ``best`` has a row of k scores per query, -inf or a score that its k-th best is
    known to reach where none was seen, and is updated.
    """

    def __init__(self, best: np.ndarray):
        self.best, self.k = best, best.shape[1]
        self.least = best.min(axis=1)

    def keep(self, rows: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Whether each score may be among the best of its query; ``rows`` are query numbers in ascending order."""
        if not len(rows):
            return np.empty(0, bool)
        some, starts, counts = np.unique(rows, return_index=True, return_counts=True)
        merged = np.full((len(some), self.k + int(counts.max())), -np.inf)
        merged[:, : self.k] = self.best[some]
        of = np.repeat(np.arange(len(some)), counts)
        merged[of, self.k + np.arange(len(rows)) - starts[of]] = scores
        merged.partition(merged.shape[1] - self.k, axis=1)
        self.best[some] = merged[:, -self.k :]
        self.least[some] = merged[:, -self.k]
        return (scores >= self.least[rows]) & (scores > -np.inf)


class HitPool:
    """Hits of a task that may be among the k best of a query, given away when all rows were seen.

    What the running scores have passed leaves now and then, and of equal scores those with the
    smallest ids stay, so that about two times k hits a query are held.
    """

    def __init__(self, n_queries: int, k: int):
        self.running = RunningTopK(np.full((n_queries, k), -np.inf))
        self.ids: list[pa.RecordBatch] = []  # doc_id and chunk_id of the rows seen
        self.n_ids = self.n_hits = 0
        self.hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.bound = 2 * n_queries * k + MAX_BLOCK_CELLS

    def rows(self, ids: pa.RecordBatch) -> int:
        """Number of the first of these rows."""
        self.ids.append(ids)
        self.n_ids += len(ids)
        return self.n_ids - len(ids)

    def add(self, queries: np.ndarray, items: np.ndarray, scores: np.ndarray) -> None:
        """Hits by ascending query; ``items`` are numbers of rows."""
        on = self.running.keep(queries, scores)
        if on.any():
            self.hits.append((queries[on].astype(np.int32), items[on].astype(np.int32), scores[on]))
            self.n_hits += len(self.hits[-1][0])
        if self.n_hits > self.bound:
            self.hits = [self._best()[:3]]
            self.n_hits = len(self.hits[0][0])

    def _best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Table]:
        table = pa.Table.from_batches(self.ids)
        queries, items, scores = (np.concatenate(x) for x in zip(*self.hits, strict=True))
        on = scores >= self.running.least[queries]
        queries, items, scores = queries[on], items[on], scores[on]
        place = np.empty(self.n_ids, np.int32)
        place[pa.compute.sort_indices(table.column("chunk_id")).to_numpy()] = np.arange(self.n_ids, dtype=np.int32)
        order = np.lexsort((place[items], -scores, queries))
        queries, items, scores = queries[order], items[order], scores[order]
        on = np.arange(len(queries)) - np.searchsorted(queries, queries) < self.running.k
        return queries[on], items[on], scores[on], table

    def batches(self, query_ids: np.ndarray, domain: str) -> Iterator[pa.RecordBatch]:
        """query_id, domain, doc_id, chunk_id, score of the k best hits of each query."""
        if not self.hits:
            return
        queries, items, scores, table = self._best()
        for i in range(0, len(queries), HIT_ROWS):
            part = table.take(pa.array(items[i : i + HIT_ROWS]))
            names = pa.array(query_ids[queries[i : i + HIT_ROWS]], pa.string())
            columns = [names, pa.array([domain] * len(part), pa.string()), part.column("doc_id").combine_chunks(), part.column("chunk_id").combine_chunks(), pa.array(scores[i : i + HIT_ROWS])]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "domain", "doc_id", "chunk_id", "score"])


def query_blocks(cells: int, queries: int, k: int, bound: int) -> int:
    """Number of blocks that keep what a task holds of the queries within ``bound`` cells, and their running scores small."""
    return max(1, -(-cells // max(1, bound)), -(-queries * k // MAX_RUNNING_SCORES))
