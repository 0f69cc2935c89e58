from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sieveline.catalog.inputs import LETTERS, Inputs, encode
from sieveline.operators import classify, dense, fusion, lexical, metrics

HIT = "query_id string, domain string, doc_id string, chunk_id string, score double, bm25_score double, rank int, list_ord int"


def brute_bm25(chunks, queries, k):
    """Okapi scores of all pairs, straight from the formula."""
    hits = []
    for domain in {c[0] for c in chunks}:
        own = [(c, (c[3] + " " + c[4] if c[3] else c[4]).lower().split()) for c in chunks if c[0] == domain]
        n, avgdl = len(own), sum(len(t) for _, t in own) / len(own)
        df = Counter(t for _, toks in own for t in set(toks))
        raw = {t: math.log(n - d + 0.5) - math.log(d + 0.5) for t, d in df.items()}
        floor = 0.25 * sum(raw.values()) / len(raw)
        idf = {t: (floor if v < 0 else v) for t, v in raw.items()}
        for qid, qdomain, text in queries:
            if qdomain != domain:
                continue
            scored = []
            for c, toks in own:
                tf = Counter(toks)
                s = sum(idf[t] * tf[t] * 2.5 / (tf[t] + 1.5 * (0.25 + 0.75 * len(toks) / avgdl)) for t in text.split() if t in tf)
                if round(s, 6) > 0:
                    scored.append((-round(s, 6), c[2]))
            hits += [(qid, domain, cid, -s, i + 1) for i, (s, cid) in enumerate(sorted(scored)[:k])]
    return sorted(hits)


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(1)
    vocab = ["the", "of"] + [f"t{i}" for i in range(40)]
    p = np.array([8.0, 6.0] + [1.0] * 40)
    text = lambda n: " ".join(rng.choice(vocab, n, p=p / p.sum()))
    chunks = [(f"d{i % 4 // 3}", f"doc{i}", f"doc{i}__chunk0", "Title" if i % 5 == 0 else "", text(12)) for i in range(80)]
    queries = [(f"q{i}", f"d{i % 2}", text(5) + " unseen the the") for i in range(12)]
    return (
        chunks,
        queries,
        spark.createDataFrame(chunks, "domain string, doc_id string, chunk_id string, title string, text string"),
        spark.createDataFrame(queries, "query_id string, domain string, text string"),
    )


@pytest.mark.parametrize("bound", [10**6, 10])
@pytest.mark.parametrize("slab", [16_384, 7])
def test_bm25_equals_brute_force_in_blocks_of_any_size(small, bound, slab):
    chunks, queries, c, q = small
    blocks = lexical.posting_blocks(c, slab)
    frequencies = lexical.document_frequencies(blocks)
    corpus = lexical.corpus_statistics(frequencies, lexical.chunk_lengths(blocks))
    index = lexical.Bm25Index(blocks, lexical.term_weights(frequencies, corpus, 0.25), corpus)
    got = lexical.bm25_topk(q, index, 7, broadcast_bound=bound)
    rows = sorted((r.query_id, r.domain, r.chunk_id, r.bm25_score, r["rank"]) for r in got.collect())
    assert [(r[0], r[1], r[2], r[4]) for r in rows] == [(r[0], r[1], r[2], r[4]) for r in brute_bm25(chunks, queries, 7)]
    assert np.allclose([r[3] for r in rows], [r[3] for r in brute_bm25(chunks, queries, 7)])


def test_bm25_of_queries_without_a_known_term(small, spark):
    _, _, c, _ = small
    unknown = spark.createDataFrame([("q", "d0", "unseen"), ("p", "nowhere", "the")], "query_id string, domain string, text string")
    assert lexical.bm25_topk(unknown, lexical.bm25_index(c)).count() == 0
    assert lexical.bm25_topk(unknown.limit(0), lexical.bm25_index(c)).count() == 0


def test_postings_of_blocks_are_term_counts(small):
    chunks, _, c, _ = small
    want = Counter()
    for domain, doc, chunk, title, text in chunks:
        tokens = (title + " " + text if title else text).lower().split()
        want.update({(domain, doc, chunk, len(tokens), t, n) for t, n in Counter(tokens).items()})
    assert Counter(map(tuple, lexical.bm25_index(c).postings.collect())) == want


def test_bounds_leave_out_no_hit():
    """Scores of one slab, query after query, against all scores."""
    rng = np.random.default_rng(4)
    vocab = [f"t{i}" for i in range(30)]
    texts = [list(rng.choice(vocab, rng.integers(3, 60), p=np.arange(30, 0, -1) / 465)) for _ in range(300)]
    weights = {t: w for t, w in zip(vocab, [-0.3, 0.0, 0.01, 0.02, *rng.uniform(0.05, 6, 26)], strict=True)}
    asked = [(q, list(rng.choice(vocab, 6, replace=False))) for q in range(40)]
    pdf = pd.DataFrame([(f"q{q:02d}", "d", t, weights[t]) for q, ts in asked for t in ts], columns=["query_id", "domain", "term", "w"])
    queries, vocabulary = lexical._by_domain(pdf)
    number = dict(zip(vocabulary["term"], vocabulary["term_no"], strict=True))
    best, hits = np.full((40, 5), -np.inf), set()
    for first in range(0, 300, 60):
        slab = lexical._Slab()
        for i in range(first, first + 60):
            slab.add(f"d{i}", f"c{i}", texts[i])
        table = pa.Table.from_batches([slab.rows("d", 1)])
        table = table.take([i for i, t in enumerate(table.column("term").to_pylist()) if t in number])
        table = table.append_column("term_no", pa.array([number[t] for t in table.column("term").to_pylist()], pa.int32()))
        table = table.append_column("avgdl", pa.array([30.0] * len(table))).combine_chunks()
        found = lexical._slab_hits(table, "d", queries["d"], best, 1.5, 0.75)
        hits |= {(r["query_id"], r["chunk_id"], round(r["bm25_score"], 6)) for r in found.to_pylist()}
    assert len(hits) < 40 * 150
    for q, ts in asked:
        scores = []
        for i, t in enumerate(texts):
            s = sum(weights[x] * t.count(x) * 2.5 / (t.count(x) + 1.5 * (0.25 + 0.75 * len(t) / 30)) for x in ts)
            scores.append((-round(s, 6), f"c{i}"))
        fifth = sorted(scores)[4][0]
        assert {(f"q{q:02d}", c, -s) for s, c in scores if s <= fifth and s < 0} <= hits


def test_a_search_in_rounds_equals_one_of_all_slabs(small):
    """More slabs than ``4 * FIRST_ROUND``: thresholds of the first round leave out no hit of the others."""
    chunks, queries, c, q = small
    blocks = lexical.posting_blocks(c, 2)
    frequencies = lexical.document_frequencies(blocks)
    corpus = lexical.corpus_statistics(frequencies, lexical.chunk_lengths(blocks))
    index = lexical.Bm25Index(blocks, lexical.term_weights(frequencies, corpus, 0.25), corpus)
    assert lexical._rounds(index) == 2
    for k in (1, 3, 50):
        got = sorted((r.query_id, r.domain, r.chunk_id, r["rank"]) for r in lexical.bm25_topk(q, index, k).collect())
        assert got == [(r[0], r[1], r[2], r[4]) for r in brute_bm25(chunks, queries, k)]


def test_hits_of_slabs_are_ranked_packed(small, monkeypatch):
    """A row per slab and range of queries goes to the merge, not one per hit; ties go to the smallest ids."""
    chunks, queries, c, q = small
    copies = [(d, f"e{n}{doc}", f"e{n}{chunk}", title, text) for n in range(4) for d, doc, chunk, title, text in chunks[:20]]
    blocks = lexical.posting_blocks(c.sparkSession.createDataFrame(copies, c.schema).repartition(3), 4)
    frequencies = lexical.document_frequencies(blocks)
    corpus = lexical.corpus_statistics(frequencies, lexical.chunk_lengths(blocks))
    index = lexical.Bm25Index(blocks, lexical.term_weights(frequencies, corpus, 0.25), corpus)
    seen, merged = [], lexical._merged
    monkeypatch.setattr(lexical, "_merged", lambda packed, k: seen.append(packed.count()) or merged(packed, k))
    for at_once, merged_hits, bound in ((1, 1, 30), (8, 10**6, 10**6)):
        monkeypatch.setattr(lexical, "BLOCKS_AT_ONCE", at_once)
        monkeypatch.setattr(lexical, "MERGED_HITS", merged_hits)
        got = sorted((r.query_id, r.domain, r.chunk_id, r["rank"]) for r in lexical.bm25_topk(q, index, 6, broadcast_bound=bound).collect())
        assert got == [(r[0], r[1], r[2], r[4]) for r in brute_bm25(copies, queries, 6)]
    assert seen[-1] <= lexical._n_slabs(index)


def test_rows_of_common_terms_are_weighted_once(monkeypatch):
    """Queries that give a term the same weight add its row as it is; others multiply it, with the same scores."""
    slab = lexical._Slab()
    for i in range(40):
        slab.add(f"d{i}", f"c{i:02d}", ["a"] * (i % 3 + 1) + ["b"] * (i % 2) + ["c"])
    named = [(f"q{i}", "d", t, w * (2.0 if i == 4 else 1.0)) for i in range(6) for t, w in (("a", 0.5), ("b", 0.25), ("c", 0.125))]
    queries, vocabulary = lexical._by_domain(pd.DataFrame(named, columns=["query_id", "domain", "term", "w"]))
    number = dict(zip(vocabulary["term"], vocabulary["term_no"], strict=True))
    table = pa.Table.from_batches([slab.rows("d", 1)])
    table = table.append_column("term_no", pa.array([number[t] for t in table.column("term").to_pylist()], pa.int32()))
    table = table.append_column("avgdl", pa.array([3.5] * len(table))).combine_chunks()
    multiplied = []

    class Counted:
        def __getattr__(self, name):
            return getattr(np, name)

        def multiply(self, *x, **y):
            multiplied.append(1)
            return np.multiply(*x, **y)

    monkeypatch.setattr(lexical, "np", Counted())
    found = lexical._slab_hits(table, "d", queries["d"], np.full((6, 40), -np.inf), 1.5, 0.75).to_pandas()
    assert len(multiplied) == 3  # the terms of the one query that names them twice
    scores = found.pivot(index="chunk_id", columns="query_id", values="bm25_score")
    assert np.allclose(scores["q4"], 2 * scores["q0"], atol=2e-6) and (scores["q0"] == scores["q5"]).all()


def test_a_slab_gives_its_hits_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(lexical, "HIT_ROWS", 10)
    monkeypatch.setattr(lexical, "TILE_CELLS", 100)
    slab = lexical._Slab()
    for i in range(30):
        slab.add(f"d{i}", f"c{i}", ["a"] * (i % 3 + 1) + ["b"])
    pdf = pd.DataFrame([(f"q{i}", "d", t, 1.0) for i in range(9) for t in "ab"], columns=["query_id", "domain", "term", "w"])
    queries, vocabulary = lexical._by_domain(pdf)
    number = dict(zip(vocabulary["term"], vocabulary["term_no"], strict=True))
    table = pa.Table.from_batches([slab.rows("d", 1)])
    table = table.append_column("term_no", pa.array([number[t] for t in table.column("term").to_pylist()], pa.int32()))
    table = table.append_column("avgdl", pa.array([3.0] * len(table))).combine_chunks()
    running = lexical.RunningTopK(np.full((9, 25), -np.inf))
    sizes = [len(x) for x in lexical._slab_batches(table, "d", queries["d"], running, 1.5, 0.75)]
    assert sum(sizes) == 9 * 25 and max(sizes) <= 10


def test_a_task_gives_at_most_k_vectors_per_query(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(25_000, 4))
    v[::2] = v[0]  # one very common vector: ties at the k-th score
    table = pa.table({
        "chunk_id": [f"c{i:05d}" for i in range(len(v))], "doc_id": [f"d{i}" for i in range(len(v))],
        "domain": ["d"] * len(v), "embedding": list(v),
    })
    vectors = spark.createDataFrame(table).coalesce(1)
    queries = vectors.limit(5).select(F.col("chunk_id").alias("query_id"), "domain", "embedding")
    hits = dense._visit(queries, 7, 10**6, lambda q: dense._against_broadcast(q, vectors, 7))
    got = hits.collect()
    assert len(got) == 5 * 7
    for q in range(5):
        scores = np.trunc(v @ v[q] * 1e6 + np.copysign(0.5, v @ v[q])) / 1e6
        want = [f"c{i:05d}" for i in np.lexsort((np.arange(len(v)), -scores))[:7]]
        assert [r.chunk_id for r in got if r.query_id == f"c{q:05d}"] == want


@pytest.mark.parametrize("bound", [10**6, 6_000])
def test_hits_of_vectors_do_not_grow_with_their_partitions(spark, monkeypatch, bound):
    """A task of queries meets all vectors of a block, so that k hits of a query and block are ranked."""
    rng = np.random.default_rng(8)
    v = rng.normal(size=(3_000, 4)) * [1, 1, 1, 1e-3]
    v[::3] = v[0]  # ties at the k-th score, and vectors longer and shorter than 1
    vectors = spark.createDataFrame(pa.table({
        "chunk_id": [f"c{i:04d}" for i in range(3_000)], "doc_id": [f"d{i}" for i in range(3_000)],
        "domain": ["d"] * 3_000, "embedding": list(v),
    })).repartition(8)
    q = [v[0], v[1], np.full(4, np.nan), np.full(4, 1e200), -1e-9 * v[2]]
    queries = spark.createDataFrame(pa.table({"query_id": [f"q{i}" for i in range(5)], "domain": ["d"] * 5, "embedding": q}))
    ranked, top_k = [], dense.top_k
    monkeypatch.setattr(dense, "top_k", lambda hits, *rest: ranked.append(hits.count()) or top_k(hits, *rest))
    monkeypatch.setattr(dense, "LARGER", 10**6)
    monkeypatch.setattr(dense, "VECTOR_TILE", 500)
    got = dense.dense_topk(queries, vectors, 7, broadcast_bound=bound).collect()
    assert ranked[0] <= 4 * 7 * -(-12_000 // bound)
    for i in (0, 1, 4):
        scores = np.trunc(v @ q[i] * 1e6 + np.copysign(0.5, v @ q[i])) / 1e6
        want = [f"c{c:04d}" for c in np.lexsort((np.arange(len(v)), -scores))[:7]]
        assert [r.chunk_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == f"q{i}"] == want
    assert [sum(r.query_id == f"q{i}" for r in got) for i in range(5)] == [7, 7, 0, 7, 7]


def test_a_slab_without_thresholds_keeps_about_k_hits_a_query(monkeypatch):
    """Its own k-th totals are thresholds; look-ups for all its chunks would take most of the time."""
    rng = np.random.default_rng(5)
    part = lexical._Slab()
    for c in range(400):
        part.add(f"d{c}", f"c{c:03d}", [f"w{w}" for w in rng.integers(0, 40, 30)])
    queries, vocabulary = lexical._by_domain(pd.DataFrame(
        [(f"q{q}", "d", f"w{w}", 1.0 + w / 100) for q in range(9) for w in rng.choice(40, 6, replace=False)],
        columns=["query_id", "domain", "term", "w"],
    ))
    rows = pa.Table.from_batches([part.rows("d", 0)]).to_pandas().merge(vocabulary[["term", "term_no"]], on="term")
    table = pa.Table.from_pandas(rows.assign(avgdl=30.0), preserve_index=False).combine_chunks()
    looked_at = []
    keep = lexical.RunningTopK.keep
    monkeypatch.setattr(lexical.RunningTopK, "keep", lambda self, q, scores: looked_at.append(len(q)) or keep(self, q, scores))
    found = lexical._slab_hits(table, "d", queries["d"], np.full((9, 5), -np.inf), 1.5, 0.75).to_pandas()
    assert sum(looked_at) < 9 * 10
    whole = lexical._slab_hits(table, "d", queries["d"], np.full((9, 400), -np.inf), 1.5, 0.75).to_pandas()
    order = {"by": ["query_id", "bm25_score", "chunk_id"], "ascending": [True, False, True]}
    best = whole.sort_values(**order).groupby("query_id").head(5)
    assert found.sort_values(**order).reset_index(drop=True).equals(best.reset_index(drop=True))


def test_first_scores_of_a_vector_task_are_thresholds():
    scores = np.random.default_rng(6).random((3, 50))
    scores[2, :30] = np.nan
    least = np.array([-np.inf, 0.5, -np.inf])
    kept = scores >= dense._floor(scores, least, 4)[:, None]
    assert kept.sum(axis=1).tolist() == [4, (scores[1] >= 0.5 - 1e-6).sum(), 4]
    assert (dense._floor(scores[:, :4], least, 4) == least - 1e-6).all()


def test_encoder_counts_letters_in_one_pass(spark):
    texts = ["aAb z", None, "", "\u00c9t\u00e9 \u212aq\U0001f600", "x" * 3000]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", encode(F.col("t")).alias("v"))
    for i, v in frame.collect():
        counts = [(texts[i] or "").lower().count(c) for c in LETTERS]
        size = math.sqrt(sum(c * c for c in counts))
        assert v == [c / size if size else 0.0 for c in counts]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "replace(" not in plan


def test_segments_add_up_to_a_full_index(small, spark, tmp_path):
    _, _, c, q = small
    second = F.substring("doc_id", 4, 9).cast("int") % 3 == 0
    lexical.save_index(c.filter(~second), "t_seg", str(tmp_path / "idx"), 4)
    whole = lexical.append_to_index(c.filter(second), "t_seg", 4)
    full = lexical.bm25_index(c)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(whole.postings) == rows(full.postings)
    assert rows(whole.terms.select("domain", "term", "df", F.round("idf", 9))) == rows(full.terms.select("domain", "term", "df", F.round("idf", 9)))
    assert rows(lexical.bm25_topk(q, whole, 5)) == rows(lexical.bm25_topk(q, full, 5))
    for part in ("blocks", "frequencies", "corpus"):
        spark.sql(f"drop table t_seg_{part}")


def test_stored_index_is_pruned_and_not_shuffled(small, spark, tmp_path):
    _, _, c, q = small
    stored = lexical.save_index(c, "t_idx", str(tmp_path / "idx"), 4)
    rows = lambda ix: sorted(map(tuple, lexical.bm25_topk(q, ix, 5).collect()))
    assert rows(stored) == rows(lexical.bm25_index(c))
    one = q.filter("domain = 'd1'")
    hits = lexical._search(lexical.query_weights(one, stored), stored, 5, 1.5, 0.75)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert "PartitionFilters: [isnotnull(domain" in plan.replace("domain IN", "isnotnull(domain") and "GreaterThanOrEqual(term" in plan
    for part in ("blocks", "frequencies", "corpus"):
        spark.sql(f"drop table t_idx_{part}")


@pytest.mark.parametrize("bound", [10**6, 150])
def test_dense_topk_equals_brute_force_on_both_paths(spark, bound):
    rng = np.random.default_rng(2)
    v, q = rng.normal(size=(300, 8)), rng.normal(size=(20, 8))
    v[7] = v[3]  # a tie
    vectors = spark.createDataFrame(
        [(f"c{i:03d}", f"doc{i}", f"d{i % 2}", x.tolist()) for i, x in enumerate(v)],
        "chunk_id string, doc_id string, domain string, embedding array<double>",
    )
    queries = spark.createDataFrame(
        [(f"q{i}", f"d{i % 2}", x.tolist()) for i, x in enumerate(q)],
        "query_id string, domain string, embedding array<double>",
    )
    want = []
    for i, x in enumerate(q):
        scored = sorted((-round(float(x @ y), 6), f"c{j:03d}") for j, y in enumerate(v) if j % 2 == i % 2)
        want += [(f"q{i}", c, n + 1) for n, (_, c) in enumerate(scored[:9])]
    got = dense.dense_topk(queries, vectors, 9, broadcast_bound=bound)
    assert sorted((r.query_id, r.chunk_id, r["rank"]) for r in got.collect()) == sorted(want)


def test_ann_with_all_cells_is_exact(spark, data, tmp_path):
    i = Inputs(spark, data)
    exact = dense.dense_topk(i.vector_queries, i.vectors, 5)
    dense.build_ivf(i.vectors, str(tmp_path / "ivf"), nlist=4, parts=16, sample_rows=300)
    index = dense.load_ivf(spark, str(tmp_path / "ivf"))
    assert index.codes.count() == i.vectors.count() and index.centers.shape == (4, 64)
    for bound in (10**7, 64 * 200):
        full = dense.ann_ivf_topk(i.vector_queries, index, i.vectors, 5, nprobe=4, depth=200, broadcast_bound=bound)
        assert {r.recall for r in dense.recall_at_k(full, exact).collect()} == {1.0}
    some = dense.recall_at_k(dense.ann_ivf_topk(i.vector_queries, index, i.vectors, 5, nprobe=2), exact)
    assert min(r.recall for r in some.collect()) > 0.5
    plan = dense._look_up(i.vector_queries.limit(1), index, 5, 1)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "domain" in filters and "cell" in filters


def test_ann_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "chunk_id string, doc_id string, domain string, embedding array<double>")
    index = dense.build_ivf(none, str(tmp_path / "ivf"))
    queries = spark.createDataFrame([("q", "d", [1.0])], "query_id string, domain string, embedding array<double>")
    assert dense.ann_ivf_topk(queries, index, none, 5).count() == 0
    assert dense.ann_ivf_topk(queries.limit(0), index, none, 5).count() == 0


def hit(q, doc, rank, lst, chunk=0, domain="d"):
    return (q, domain, doc, f"{doc}__chunk{chunk}", 0.5, 0.0, rank, lst)


def test_mean_pool_follows_the_mask(spark):
    rows = [(1, [1.0, 2.0], 1), (1, [3.0, 6.0], 1), (1, [9.0, 9.0], 0), (2, [5.0, 5.0], 0), (3, None, 1)]
    df = spark.createDataFrame(rows, "text_id long, embedding array<double>, m int")
    masked = {r.text_id: r.embedding for r in dense.mean_pool(df, mask="m").collect()}
    assert masked == {1: [2.0, 4.0], 2: [0.0, 0.0]}
    plain = {r.text_id: r.embedding for r in dense.mean_pool(df).collect()}
    assert plain[1] == pytest.approx([13 / 3, 17 / 3]) and plain[2] == [5.0, 5.0]


def test_rrf_hand_cases(spark):
    rows = [hit("q", "a", 1, 0), hit("q", "b", 2, 0), hit("q", "b", 1, 1), hit("q", "c", 2, 1)]
    got = {r.doc_id: r for r in fusion.rrf_fuse(spark.createDataFrame(rows, HIT)).collect()}
    assert got["b"].fused_score == pytest.approx(1 / 62 + 1 / 61, abs=1e-9)
    assert got["a"].fused_score == pytest.approx(1 / 61, abs=1e-9)
    assert got["c"].fused_score == pytest.approx(1 / 62, abs=1e-9)
    assert [d for _, d in sorted((r["rank"], r.doc_id) for r in got.values())] == ["b", "a", "c"]
    assert got["b"].chunk_id == "b__chunk0"


def test_rrf_counts_every_chunk_and_breaks_ties_by_list(spark):
    rows = [hit("q", "a", 1, 0, 0), hit("q", "a", 3, 0, 1), hit("q", "x", 1, 1), hit("q", "y", 1, 2)]
    got = sorted(fusion.rrf_fuse(spark.createDataFrame(rows, HIT)).collect(), key=lambda r: r["rank"])
    assert got[0].fused_score == pytest.approx(1 / 61 + 1 / 63, abs=1e-9)
    assert [r.doc_id for r in got] == ["a", "x", "y"]


def test_single_list_skips_the_first_stage(spark):
    rows = [hit("q", "a", 1, 0, 0), hit("q", "a", 2, 0, 1)]
    df = spark.createDataFrame(rows, HIT)
    one = fusion.fuse_hybrid(df, ["d"], both_modalities=False).first().fused_score
    two = fusion.fuse_hybrid(df, ["d"], both_modalities=True).first().fused_score
    assert one == pytest.approx(1 / 61 + 1 / 62, abs=1e-9)
    assert two == pytest.approx(1 / 61, abs=1e-9)


def test_rerank_keeps_tail_and_unscored_order(spark):
    rows = [("q", f"d{i}", i) for i in range(1, 7)]
    df = spark.createDataFrame(rows, "query_id string, doc_id string, rank int")
    scores = spark.createDataFrame([("q", "d3", 5.0), ("q", "d2", -1.0), ("q", "d6", 9.0)], "query_id string, doc_id string, score double")
    got = fusion.rerank_merge(df, scores, cap=4).orderBy("rank").collect()
    assert [r.doc_id for r in got] == ["d3", "d2", "d1", "d4", "d5", "d6"]
    none = fusion.rerank_merge(df, scores.filter("false"), cap=4).orderBy("rank").collect()
    assert [r.doc_id for r in none] == [f"d{i}" for i in range(1, 7)]


def test_routing(spark):
    df = spark.createDataFrame(
        [("a", "sci", 0.45, "fin"), ("b", "sci", 0.44, "fin"), ("c", "gen", 0.9, None)],
        "query_id string, top1_domain string, top1_prob double, top2_domain string",
    )
    enabled = ["gen", "fin", "sci"]

    def active(mode):
        rows = fusion.route_queries(df, enabled, mode, "gen").orderBy("query_id", "domain_ord").collect()
        return {q: [r.domain for r in rows if r.query_id == q] for q in "abc"}

    assert active("routed_only") == {"a": ["sci"], "b": ["fin", "sci"], "c": ["gen"]}
    assert active("routed_with_general") == {"a": ["gen", "sci"], "b": ["gen", "fin", "sci"], "c": ["gen"]}
    assert active("broadcast")["c"] == enabled
    with pytest.raises(ValueError, match="routing"):
        fusion.route_queries(df, enabled, "other")


def test_run_score_rule(spark):
    df = spark.createDataFrame(
        [("q", "a__chunk0", -1.0, 0.2, 9.0, 1), ("q", "a__chunk1", 0.3, 0.1, 9.0, 2), ("q", "b", None, 0.0, 7.0, 3)],
        "query_id string, doc_id string, rerank_score double, fused_score double, score double, rank int",
    )
    assert {r.doc_id: r.run_score for r in metrics.run_best_score(df).collect()} == {"a": 0.3, "b": 7.0}
    assert {r.doc_id: r.run_score for r in metrics.run_best_score(df, score_rule="rank").collect()}["a"] == 1.0


def test_ir_metrics(spark):
    run = spark.createDataFrame([("q1", "a", 3.0), ("q1", "b", 2.0), ("q1", "c", 2.0)], "query_id string, doc_id string, run_score double")
    qrels = spark.createDataFrame([("q1", "b", 2), ("q1", "z", 1), ("q1", "a", -1), ("q2", "a", 1)], "query_id string, doc_id string, relevance int")
    got = {r.query_id: r for r in metrics.ir_metrics_per_query(run, qrels).collect()}
    ideal = 2 + 1 / math.log2(3)
    assert got["q1"].ndcg_10 == pytest.approx((2 / math.log2(4)) / ideal)  # c ranks before b
    assert got["q1"].rr_10 == pytest.approx(1 / 3)
    assert got["q1"].r_100 == 0.5
    assert (got["q2"].ndcg_10, got["q2"].rr_10, got["q2"].r_1000) == (0.0, 0.0, 0.0)


def test_judged_ndcg_and_minmax(spark):
    rows = [("q", 1, 2.0), ("q", 2, 0.0), ("q", 3, 1.0), ("z", 1, 0.0)]
    df = spark.createDataFrame(rows, "query_id string, rank int, judged double")
    got = {r.query_id: r.ndcg for r in metrics.judged_ndcg(df).collect()}
    assert got["q"] == pytest.approx(0.9502, abs=1e-4)
    assert got["z"] == 0.0
    scores = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 5.0)], "query_id string, score double")
    assert sorted((r.query_id, r.judged) for r in metrics.minmax_judge(scores).collect()) == [("a", 0.0), ("a", 2.0), ("b", 1.0), ("b", 1.0)]


def test_judge_cache(spark):
    pairs = spark.createDataFrame([("q", "a"), ("q", "b")], "query_id string, doc_id string")
    cache = spark.createDataFrame([("q", "a", 2, 1), ("q", "a", 0, 2)], "query_id string, doc_id string, score int, seq int")
    known, todo = metrics.judge_cache_join(pairs, cache)
    assert known.first().judge_score == 0
    assert [r.doc_id for r in todo.collect()] == ["b"]
    replies = spark.createDataFrame([("Score: 2",), ("none",), ("1 or 2",)], "r string")
    assert [r[0] for r in replies.select(metrics.judge_score(F.col("r"))).collect()] == [2, 1, 1]


def test_split_bucket(spark):
    import hashlib

    ids = [f"general:{i}" for i in range(1, 400)]
    df = spark.createDataFrame([(x,) for x in ids], "query_id string")
    got = {r.query_id: r.split for r in classify.train_eval_split(df).collect()}
    assert got == {x: "train" if int(hashlib.md5(x.encode()).hexdigest(), 16) % 10 < 7 else "eval" for x in ids}


def test_class_balance_bounds(spark):
    queries = spark.createDataFrame([(f"a:{i}", "a", f"t{i}") for i in range(30)] + [("b:1", "b", "only")], "query_id string, domain string, text string")
    titles = spark.createDataFrame([("b", f"a long enough title {i}") for i in range(3)] + [("a", "unused title of a domain")], "domain string, title string")
    seeds = spark.createDataFrame([("a", ["s"]), ("b", ["s1", "s2"]), ("c", ["z"])], "domain string, seeds array<string>")
    rows = classify.class_balance(queries, titles, seeds, 8, 20).collect()
    assert Counter((r.domain, r.origin) for r in rows) == {("a", "query"): 20, ("b", "query"): 1, ("b", "title"): 3, ("b", "seed"): 4, ("c", "seed"): 8}
    assert Counter(r.text for r in rows if r.origin == "seed" and r.domain == "b") == {"s1": 2, "s2": 2}


def test_routing_metrics(spark):
    rows = [("a", "a", "b"), ("a", "b", "a"), ("b", "b", "a"), ("b", "c", "a")]
    df = spark.createDataFrame(rows, "domain string, top1_domain string, top2_domain string")
    r = classify.routing_metrics(df).first()
    assert (r.top1_accuracy, r.top2_accuracy, r.n_total) == (0.5, 0.75, 4)
    assert r.macro_f1 == pytest.approx((2 / 3 + 0.5) / 2, abs=1e-4)


def test_classifier_learns_the_language(spark, data):
    i = Inputs(spark, data)
    texts = i.train_texts.select("domain", "text", F.lit("doc").alias("origin"), F.col("query_id").alias("item"))
    model, report = classify.train_domain_classifier(texts)
    assert report.first().top1_accuracy > 0.9
    row = classify.predict(model, texts).first()
    assert sum(row.all_probs.values()) == pytest.approx(1.0)
    assert row.all_probs[row.top1_domain] == row.top1_prob >= row.top2_prob
