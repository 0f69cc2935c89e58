from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sieveline.functions.text import normalize_query, sentences, strip, strip_chunk_suffix, words
from sieveline.operators.corpus import (
    chunk_documents,
    clean_docs,
    dedup_docs,
    OrdinalIndex,
    docstore,
    index_metadata,
    metadata_mismatch,
)
from sieveline.operators.ranking import exact_quantile, first_n_by_hash
from sieveline.plans.corpus import build_corpus, corpus_pipeline, update_corpus
from sieveline.sources import readers, writers
from sieveline.sources.writers import remove_path
from sieveline.streaming.ingest import ingest_stream

DOC = "doc_id string, orig_id string, domain string, title string, text string, ingest_seq long"


def docs_of(spark, lengths):
    rows = [
        (f"d:{n}", str(n), "d", "", " ".join(f"w{j}" for j in range(n)), i)
        for i, n in enumerate(lengths)
    ]
    return spark.createDataFrame(rows, DOC)


@pytest.mark.parametrize(
    ("n", "expected"),
    [
        (180, [(0, 180)]),
        (181, [(0, 180), (140, 181)]),
        (320, [(0, 180), (140, 320)]),
        (321, [(0, 180), (140, 320), (280, 321)]),
        (1, [(0, 1)]),
    ],
)
def test_chunk_windows(spark, n, expected):
    rows = chunk_documents(docs_of(spark, [n])).orderBy("start_token").collect()
    assert [(r.start_token, r.end_token) for r in rows] == expected
    assert [r.chunk_id for r in rows] == [f"d:{n}__chunk{i}" for i in range(len(expected))]
    for r in rows:
        assert r.text.split() == [f"w{j}" for j in range(r.start_token, r.end_token)]


def test_short_text_is_kept_as_it_was(spark):
    df = spark.createDataFrame([("d:1", "1", "d", "T", "a  b\n c", 0)], DOC)
    row = chunk_documents(df).first()
    assert (row.text, row.start_token, row.end_token) == ("T a  b\n c", 0, 4)


def test_empty_text_gives_one_empty_chunk(spark):
    row = chunk_documents(spark.createDataFrame([("d:1", "1", "d", "", "", 0)], DOC)).first()
    assert (row.start_token, row.end_token) == (0, 0)


def test_windows_cover_every_token(spark):
    for r in (
        chunk_documents(docs_of(spark, [500, 997]), 50, 7)
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("start_token", "end_token"))).alias("w"))
        .collect()
    ):
        spans = [(w.start_token, w.end_token) for w in r.w]
        assert spans[0][0] == 0 and spans[-1][1] == int(r.doc_id.split(":")[1])
        assert all(b[0] == a[1] - 7 for a, b in zip(spans, spans[1:]))


def test_stride_must_be_smaller(spark):
    with pytest.raises(ValueError, match="stride"):
        chunk_documents(docs_of(spark, [3]), 40, 40)


def test_unicode_whitespace(spark):
    text = "  a b\x1cc　d \x85\n"
    row = spark.createDataFrame([(text,)], "t string").select(
        words("t").alias("w"), strip("t").alias("s")
    ).first()
    assert row.w == text.split()
    assert row.s == text.strip()


def test_normalize_query(spark):
    cases = ["ＦＵＬＬ Width", "  A\tB\x07c ", "ﬁne", "", None, "Ünï  Code"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r.q for r in df.select(normalize_query("t").alias("q")).collect()]
    assert got == ["full width", "a b c", "fine", "", "", "ünï code"]


def test_chunk_suffix(spark):
    df = spark.createDataFrame([("x__chunk1__chunk2",), ("plain",), ("a:1__chunk0",)], "c string")
    got = [r[0] for r in df.select(strip_chunk_suffix("c")).collect()]
    assert got == ["x__chunk1", "plain", "a:1"]


def test_sentences(spark):
    text = "This is a first long sentence. Short one! Is this the third long sentence?\nTail too short"
    row = spark.createDataFrame([(text,)], "t string").select(sentences("t").alias("s")).first()
    assert row.s == ["This is a first long sentence.", "Is this the third long sentence?"]


def test_clean_and_dedup_with_a_hot_id(spark):
    rows = [("d:hot", "hot", "d", None, f"text {i}", i) for i in range(500, 0, -1)]
    rows += [("d:x", "x", "d", "t", " \t\n ", 0), ("d:x", "x", "d", "t", " kept ", 9)]
    for partitions in (1, 7):
        df = spark.createDataFrame(rows, DOC).repartition(partitions)
        got = {r.doc_id: (r.text, r.ingest_seq) for r in dedup_docs(clean_docs(df)).collect()}
        assert got == {"d:hot": ("text 1", 1), "d:x": ("kept", 9)}


def test_dedup_prunes_before_the_shuffle(spark):
    df = dedup_docs(docs_of(spark, [3, 4]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def test_caps(spark):
    docs = docs_of(spark, range(1, 31))
    qrels = spark.createDataFrame([("q", f"d:{n}", 1) for n in (30, 29, 28)], "query_id string, doc_id string, relevance int")
    got = {r.orig_id for r in readers.cap_simple(docs, 4, width=3).collect()}
    assert got == {"1", "2", "3", "4"}
    got = {r.orig_id for r in readers.cap_with_qrel_coverage(docs, qrels, 5, width=4).collect()}
    assert got == {"30", "29", "28", "1", "2"}
    got = {r.orig_id for r in readers.cap_with_qrel_coverage(docs, qrels, 2, width=4).collect()}
    assert got == {"30", "29", "28"}


def test_docstore_ordinals_are_dense(spark):
    chunks = chunk_documents(docs_of(spark, range(1, 60)), 10, 2, carry=["ingest_seq"])
    rows = docstore(chunks, width=5).orderBy("chunk_ord").collect()
    assert [r.chunk_ord for r in rows] == list(range(len(rows)))
    assert [(r.ingest_seq, r.start_token) for r in rows] == sorted((r.ingest_seq, r.start_token) for r in rows)


def test_hash_sample_is_exact_and_repeatable(spark):
    df = spark.range(1000).select(F.lit("g").alias("g"), F.col("id"))
    pick = lambda d: sorted(r.id for r in first_n_by_hash(d, ["g"], F.md5(F.col("id").cast("string")), 37, [F.col("id")]).collect())
    assert len(pick(df)) == 37
    assert pick(df) == pick(df.repartition(5))


def test_exact_quantile(spark):
    import numpy as np

    rng = random.Random(3)
    rows = [("a", rng.expovariate(0.01)) for _ in range(997)] + [("b", 5.0)] * 400 + [("c", 1.5)]
    df = spark.createDataFrame(rows, "stage string, ms double")
    got = {r.stage: r.p for r in exact_quantile(df, ["stage"], "ms", 0.95, "p").collect()}
    for stage in "abc":
        want = np.percentile([v for s, v in rows if s == stage], 95)
        assert got[stage] == pytest.approx(want, abs=1e-9)


def test_ordinals_are_looked_up_without_the_rest(spark):
    docs = docs_of(spark, [(i * 7) % 45 + 1 for i in range(60)])
    chunks = chunk_documents(docs, 10, 2, carry=["ingest_seq"])
    for width in (3, 7, 1000):
        index = OrdinalIndex.of(chunks, width=width)
        rows = {(r.domain, r.chunk_ord): r.chunk_id for r in index.rows().collect()}
        order = sorted((r.ingest_seq, r.start_token, r.chunk_id) for r in chunks.collect())
        assert [rows[d, o] for d, o in sorted(rows)] == [c for _, _, c in order]
        asked = spark.createDataFrame([(d, o) for d, o in rows if o % 5 == 0] + [("x", 1), (order[0][2][:0], 3)], "domain string, chunk_ord long")
        got = {(r.domain, r.chunk_ord): r.chunk_id for r in index.at(asked).collect()}
        assert got == {k: v for k, v in rows.items() if k[1] % 5 == 0}


def test_ingest_checks_columns(spark):
    df = spark.createDataFrame([("d:1", "t", "d")], "doc_id string, text string, domain string")
    assert set(readers.ingest(df, 3).columns) == {"doc_id", "text", "domain", "title", "orig_id"}
    with pytest.raises(ValueError, match="domain"):
        readers.ingest(df.drop("domain"))


def test_load_beir(spark, tmp_path):
    for domain in ("sci", "fin"):
        base = tmp_path / domain
        spark.createDataFrame([(1, None, "text")], "_id long, title string, text string").write.parquet(str(base / "corpus"))
        spark.createDataFrame([(7, "q")], "_id long, text string").write.parquet(str(base / "queries"))
        spark.createDataFrame([(7, 1, 2.0, "test"), (7, 1, 1.0, "dev")], "`query-id` long, `corpus-id` long, score double, split string").write.parquet(str(base / "qrels"))
    docs, queries, qrels = readers.load_beir(spark, {d: str(tmp_path / d) for d in ("sci", "fin")}, "test")
    assert {(r.doc_id, r.title, r.domain) for r in docs.collect()} == {("sci:1", "", "sci"), ("fin:1", "", "fin")}
    assert {r.query_id for r in queries.collect()} == {"sci:7", "fin:7"}
    assert {(r.query_id, r.doc_id, r.relevance) for r in qrels.collect()} == {("sci:7", "sci:1", 2), ("fin:7", "fin:1", 2)}


def test_query_files(spark, tmp_path):
    (tmp_path / "q.jsonl").write_text('{"query_id": "a", "text": "t", "expected_domains": ["x", "y"]}\n\n')
    assert readers.read_query_jsonl(spark, str(tmp_path / "q.jsonl")).first().expected_domains == ["x", "y"]
    (tmp_path / "q.txt").write_text("  one \n\n\ntwo\n")
    assert {r.text for r in readers.read_query_batch(spark, str(tmp_path / "q.txt")).collect()} == {"one", "two"}


def test_build_corpus_replaces_only_its_domains(spark, tmp_path):
    path = str(tmp_path / "corpus")
    other = docs_of(spark, [5]).withColumn("domain", F.lit("other"))
    build_corpus(other, path)
    stats = build_corpus(docs_of(spark, [3, 181]), path)
    assert (stats["n_docs_in"], stats["n_chunks_out"]) == (2, 3)
    counts = {r.domain: r["count"] for r in spark.read.parquet(path).groupBy("domain").count().collect()}
    assert counts == {"d": 3, "other": 1}


def test_pending_and_complete(spark):
    queries = spark.createDataFrame([("a",), ("b",), ("c",)], "query_id string")
    done = spark.createDataFrame([("a",), ("a",), ("b",)], "query_id string")
    assert {r.query_id for r in writers.pending_queries(queries, done, 2).collect()} == {"b", "c"}
    assert [r.query_id for r in writers.complete_rows(done, 2).collect()] == ["a", "a"]


def test_index_metadata(spark):
    df = spark.createDataFrame([("a", [0.6, 0.8]), ("b", [1.0, 1.0])], "domain string, embedding array<float>")
    rows = {r.domain: r for r in index_metadata(df, "m").collect()}
    assert rows["a"].normalized and not rows["b"].normalized
    bad = metadata_mismatch(index_metadata(df, "m"), "other", 2).collect()
    assert {r.domain: len(r.reasons) for r in bad} == {"a": 1, "b": 2}


def test_stream_equals_batch_and_is_idempotent(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first, second = docs_of(spark, [3, 200, 400]), docs_of(spark, [3, 50, 200])
    later = second.withColumn("ingest_seq", F.col("ingest_seq") + 100).withColumn("text", F.concat("text", F.lit(" x")))
    for part in (first, later):
        part.write.mode("append").parquet(source)
        ingest_stream(spark, source, sink, state).awaitTermination()
    ingest_stream(spark, source, sink, state).awaitTermination()
    # A lost checkpoint replays every file; the sink must not change.
    ingest_stream(spark, source, sink, state + "2").awaitTermination()
    columns = ["chunk_id", "text", "start_token", "end_token"]
    got = sorted(map(tuple, spark.read.parquet(sink).select(*columns).collect()))
    want = sorted(map(tuple, corpus_pipeline(first.unionByName(later)).select(*columns).collect()))
    assert got == want


def test_stream_goes_on_after_restart_and_lost_checkpoint(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    copies = docs_of(spark, [3, 50, 200])
    ids = lambda: sorted(r.doc_id for r in spark.read.parquet(sink).select("doc_id").distinct().collect())
    shifted = lambda n: copies.withColumn("doc_id", F.concat("doc_id", F.lit(f"-{n}")))
    chunks = 0
    for n, checkpoint in ((0, state), (1, state), (2, state + "-new"), (3, state + "-new")):
        shifted(n).withColumn("ingest_seq", -F.col("ingest_seq")).write.mode("append").parquet(source)
        shifted(max(0, n - 1)).withColumn("text", F.lit("late")).write.mode("append").parquet(source)
        ingest_stream(spark, source, sink, checkpoint, files_per_trigger=2).awaitTermination()
        assert len(ids()) == 3 * (n + 1)
        assert spark.read.parquet(sink).count() >= chunks
        chunks = spark.read.parquet(sink).count()
        assert spark.read.parquet(sink).groupBy("chunk_id").count().filter("count > 1").isEmpty()


def test_update_builds_changed_domains_only(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    docs = docs_of(spark, [3, 200, 400]).withColumn("n_chars", F.lit(1))
    other = docs.withColumn("domain", F.lit("e")).withColumn("doc_id", F.concat(F.lit("e:"), "orig_id"))
    docs.unionByName(other).write.parquet(f"{source}/a")
    read = lambda: sorted(map(tuple, spark.read.parquet(f"{target}/corpus").select("chunk_id", "domain", "text").collect()))
    state = lambda: sorted((str(p.relative_to(target)), p.stat().st_mtime_ns) for p in (tmp_path / "out").rglob("part-*"))
    glob = f"{source}/*"
    assert update_corpus(spark, glob, target) == ["d", "e"]
    first = state()
    assert update_corpus(spark, glob, target) == [] and state() == first
    more = other.limit(1).withColumn("doc_id", F.lit("e:new")).withColumn("domain", F.lit("e"))
    more.write.parquet(f"{source}/b")
    assert update_corpus(spark, glob, target) == ["e"]
    kept = {p for p in first if "domain=d" in p[0]}
    assert kept and kept <= set(state())
    full = corpus_pipeline(spark.read.parquet(glob))
    want = sorted(map(tuple, full.select("chunk_id", "domain", "text").collect()))
    assert read() == want
    remove_path(spark, f"{source}/b")
    assert update_corpus(spark, glob, target) == ["e"]
    assert read() == [r for r in want if not r[0].startswith("e:new")]


def test_pipeline_checks_required_columns(spark):
    with pytest.raises(ValueError, match="domain"):
        corpus_pipeline(docs_of(spark, [3]).drop("domain"))
