"""One registered query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sieveline.catalog.inputs import DOMAINS, GENERAL, SEEDS, Inputs, encode
from sieveline.config import RERANK_CAP, TOPK_BM25
from sieveline.functions.text import (
    full_text,
    hex_int,
    md5_of,
    normalize_query,
    preview,
    strip_chunk_suffix,
)
from sieveline.operators import abtest, answers, classify, corpus, dense, fusion, grounding, metrics
from sieveline.operators.lexical import bm25_topk
from sieveline.operators.ranking import rank_hits
from sieveline.plans.corpus import corpus_pipeline, update_corpus
from sieveline.plans.evaluation import ablation_table, depth_sweep, rrf_k_sweep
from sieveline.plans.search import SearchConfig, candidate_lists, hybrid_search
from sieveline.sources import readers, writers
from sieveline.streaming.ingest import ingest_stream as run_ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CONFIG = SearchConfig(enabled=DOMAINS, general=GENERAL)
KEY = list(answers.KEY)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to a fixed number of places, so that summation order cannot show."""
    return df.select(*[
        F.round(f.name, places).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def query(build: Callable[[Inputs], DataFrame]) -> Query:
    """Register a query under its function name."""

    @wraps(build)
    def run(spark: SparkSession, path: str) -> DataFrame:
        return rounded(build(Inputs(spark, path)))

    QUERIES[build.__name__] = run
    return run


def md5(column: str) -> Column:
    return F.md5(F.col(column)).alias(f"{column}_md5")


# Shared intermediate results.


def own_hits(i: Inputs, k: int = TOPK_BM25) -> DataFrame:
    """BM25 hits of every query in its own domain."""
    return bm25_topk(i.queries, i.index, k)


def routed(i: Inputs) -> DataFrame:
    joined = i.queries.drop("domain").join(i.classified.drop("domain"), "query_id")
    return fusion.route_queries(joined, DOMAINS, "routed_with_general", GENERAL)


def everywhere(i: Inputs) -> DataFrame:
    return i.queries.withColumn("domain", F.explode(F.array(*[F.lit(d) for d in DOMAINS])))


def lists(i: Inputs, pairs: DataFrame, cfg: SearchConfig = CONFIG) -> DataFrame:
    return candidate_lists(
        pairs.select("query_id", "domain", "text"), i.index, i.doc_vectors, i.page_vectors, cfg
    )


def final_hits(i: Inputs) -> DataFrame:
    """Hybrid search of all queries; the scores stand for an external reranker.

    Candidates are stored, as they would be for a model that scores them.
    """
    fused = hybrid_search(
        i.raw_queries, i.classified.drop("domain"), i.index, i.doc_vectors, i.page_vectors,
        CONFIG.with_(rerank=False),
    ).drop("rerank_score")
    fused = writers.stage(fused, "candidates")
    return fusion.rerank_merge(fused, i.external_scores(fused), RERANK_CAP)


def judged(hits: DataFrame) -> DataFrame:
    judge = (hex_int(md5_of("query_id", "doc_id"), 1, 2) % 3).cast("double")
    return hits.filter("rank <= 10").select("query_id", "doc_id", "rank", judge.alias("judged"))


def own_metrics(i: Inputs) -> DataFrame:
    run = metrics.run_best_score(own_hits(i).withColumnRenamed("bm25_score", "score"))
    return metrics.ir_metrics_per_query(run, i.qrels)


def marked_answers(i: Inputs) -> DataFrame:
    return i.answers.withColumn("abstained", answers.is_abstention()).withColumn(
        "cited_ids", answers.cited_ids()
    )


def measurable_answers(i: Inputs) -> DataFrame:
    return marked_answers(i).filter(~F.col("abstained") & (F.size("passages") > 0))


def balanced_texts(i: Inputs) -> DataFrame:
    return classify.class_balance(
        classify.training_queries(i.queries, i.qrels), classify.title_candidates(i.docs), i.seed_texts, 60, 140
    )


# Sources and sinks.


@query
def load_beir(i: Inputs) -> DataFrame:
    """Files by domain, whatever domains there are; a judgement belongs to the domain of its query."""
    bare = F.substring_index("query_id", ":", -1)
    parts = {
        "corpus": i.docs.select("domain", F.col("orig_id").alias("_id"), "title", "text"),
        "queries": i.raw_queries.select("domain", bare.alias("_id"), "text"),
        "qrels": i.qrels.select(
            F.substring_index("query_id", ":", 1).alias("domain"),
            bare.alias("query-id"),
            F.substring_index("doc_id", ":", -1).alias("corpus-id"),
            F.col("relevance").alias("score"),
        ),
    }
    path = writers.scratch_path(i.spark, "beir")
    for part, rows in parts.items():
        rows.write.partitionBy("domain").parquet(f"{path}/{part}")
    docs, queries, qrels = readers.load_beir_tree(i.spark, path)
    none = F.lit(None).cast("string")
    return (
        docs.select(
            F.lit("docs").alias("part"), F.col("doc_id").alias("id"), F.col("orig_id").alias("other"),
            "domain", md5("text"), F.lit(None).cast("int").alias("relevance"),
        )
        .unionByName(queries.select(
            F.lit("queries").alias("part"), F.col("query_id").alias("id"), none.alias("other"),
            "domain", md5("text"), F.lit(None).cast("int").alias("relevance"),
        ))
        .unionByName(qrels.select(
            F.lit("qrels").alias("part"), F.col("query_id").alias("id"), F.col("doc_id").alias("other"),
            F.substring_index("query_id", ":", 1).alias("domain"), none.alias("text_md5"), "relevance",
        ))
    )


@query
def cap_simple(i: Inputs) -> DataFrame:
    return readers.cap_simple(i.docs, 120).select("doc_id", "domain")


@query
def cap_with_qrel_coverage(i: Inputs) -> DataFrame:
    return readers.cap_with_qrel_coverage(i.docs, i.qrels, 150).select("doc_id", "domain")


@query
def ingest_validate(i: Inputs) -> DataFrame:
    df = readers.ingest(i.docs.drop("title", "orig_id"))
    return df.select("doc_id", "domain", "title", "orig_id", md5("text"))


@query
def write_corpus(i: Inputs) -> DataFrame:
    path = writers.scratch_path(i.spark, "corpus")
    writers.write_corpus(i.chunks, path)
    return i.spark.read.parquet(path).select("domain", "chunk_id", "start_token", "end_token", md5("text"))


@query
def corpus_stats(i: Inputs) -> DataFrame:
    return corpus.corpus_stats(i.chunks)


@query
def incremental_build(i: Inputs) -> DataFrame:
    return writers.pending_queries(i.raw_queries, i.judgements, 2).select("query_id", "domain")


@query
def incremental_corpus(i: Inputs) -> DataFrame:
    """Corpus built from the first half of the documents, then brought up to date with the rest."""
    source = writers.scratch_path(i.spark, "sources")
    target = writers.scratch_path(i.spark, "incremental")
    half = F.col("ingest_seq") % 2 == 0
    for arrival in (half, ~half):
        i.docs.filter(arrival).write.mode("append").parquet(source)
        update_corpus(i.spark, source, target)
    return i.spark.read.parquet(f"{target}/corpus").select(
        "domain", "chunk_id", "start_token", "end_token", md5("text")
    )


@query
def read_query_jsonl(i: Inputs) -> DataFrame:
    path = writers.scratch_path(i.spark, "queries")
    writers.write_json(i.cross_queries, path)
    df = readers.read_query_jsonl(i.spark, path)
    return df.select("query_id", "text", F.array_join("expected_domains", ",").alias("expected"))


@query
def read_query_batch(i: Inputs) -> DataFrame:
    path = writers.scratch_path(i.spark, "batch")
    i.queries.select("text").write.text(path)
    return readers.read_query_batch(i.spark, path)


@query
def search_output(i: Inputs) -> DataFrame:
    hits = corpus.docstore_lookup(final_hits(i), i.chunks)
    path = writers.scratch_path(i.spark, "search")
    asked = i.raw_queries.drop("domain").join(i.classified.drop("domain"), "query_id").select(
        "query_id",
        F.col("text").alias("query"),
        fusion.active_domains(DOMAINS, "routed_with_general", GENERAL).alias("active_domains"),
        "top1_domain",
        "top1_prob",
        F.length("text").cast("double").alias("latency_ms"),
    )
    writers.write_json(writers.search_output(asked, hits), path)
    schema = (
        "query_id string, query string, active_domains array<string>, top1_domain string, top1_prob double, "
        "latency_ms double, results array<struct<rank int, doc_id string, domain string, "
        "fused_score double, title string, text string>>"
    )
    rows = i.spark.read.schema(schema).json(path)
    rows = rows.select(*(c for c in rows.columns if c != "results"), F.inline("results"))
    return rows.select(
        "query_id", F.md5("query").alias("query_md5"), F.array_join("active_domains", ",").alias("active_domains"),
        "top1_domain", F.round("top1_prob", 6).alias("top1_prob"), "latency_ms",
        "rank", "doc_id", "domain", "fused_score", "title", md5("text"),
    )


@query
def report_sinks(i: Inputs) -> DataFrame:
    per_domain = metrics.ir_metrics_domain(own_metrics(i), i.queries)
    as_json = writers.scratch_path(i.spark, "metrics-json")
    as_csv = writers.scratch_path(i.spark, "metrics-csv")
    writers.write_json(rounded(per_domain), as_json)
    stored = i.spark.read.schema(per_domain.schema).json(as_json)
    writers.write_csv(stored, as_csv)
    return i.spark.read.schema(per_domain.schema).option("header", True).csv(as_csv)


@query
def docstore(i: Inputs) -> DataFrame:
    chunks = corpus.chunk_documents(i.clean, carry=["ingest_seq"])
    return corpus.docstore(chunks).select("domain", "chunk_id", "chunk_ord")


@query
def index_metadata(i: Inputs) -> DataFrame:
    return corpus.index_metadata(i.vectors, "stored-vectors")


# Projections and filters.


@query
def clean_docs(i: Inputs) -> DataFrame:
    return corpus.clean_docs(i.raw_docs).select("doc_id", "ingest_seq", "title", md5("text"))


@query
def full_text_column(i: Inputs) -> DataFrame:
    return i.docs.select("doc_id", F.md5(full_text()).alias("full_md5"))


QUERIES["full_text"] = QUERIES.pop("full_text_column")


@query
def normalize_queries(i: Inputs) -> DataFrame:
    return i.raw_queries.select("query_id", normalize_query("text").alias("text"))


@query
def strip_chunk_suffixes(i: Inputs) -> DataFrame:
    nested = F.concat("chunk_id", F.lit("__chunk2"))
    return i.chunks.select(
        "chunk_id",
        strip_chunk_suffix("chunk_id").alias("doc_id"),
        nested.alias("nested"),
        strip_chunk_suffix(nested).alias("nested_doc"),
    )


QUERIES["strip_chunk_suffix"] = QUERIES.pop("strip_chunk_suffixes")


@query
def domain_filter(i: Inputs) -> DataFrame:
    own = i.raw_queries.select("query_id", "domain")
    return final_hits(i).join(own, ["query_id", "domain"], "left_semi").select("query_id", "doc_id", "rank")


@query
def train_eval_split(i: Inputs) -> DataFrame:
    return classify.train_eval_split(i.raw_queries).select("query_id", "split")


@query
def preview_text(i: Inputs) -> DataFrame:
    return i.docs.select("doc_id", preview("text", 80).alias("preview"))


@query
def title_candidates(i: Inputs) -> DataFrame:
    return classify.title_candidates(i.docs)


# Chunking and corpus build.


@query
def chunk_documents(i: Inputs) -> DataFrame:
    return i.chunks.select("chunk_id", "doc_id", "domain", "start_token", "end_token", md5("text"))


@query
def build_corpus(i: Inputs) -> DataFrame:
    chunks = corpus_pipeline(i.raw_docs)
    return chunks.select("chunk_id", "doc_id", "domain", "start_token", "end_token", md5("text"))


QUERIES["corpus_pipeline"] = QUERIES.pop("build_corpus")


@query
def dedup_docs(i: Inputs) -> DataFrame:
    return corpus.dedup_docs(i.raw_docs).select(
        "doc_id", "ingest_seq", "title", F.coalesce(F.md5("text"), F.lit("null")).alias("text_md5")
    )


# Joins.


@query
def annotated_queries(i: Inputs) -> DataFrame:
    judged = i.qrels.select("query_id").distinct()
    return i.queries.join(judged, "query_id", "left_semi").select("query_id", "text")


@query
def sample_queries(i: Inputs) -> DataFrame:
    judged = i.queries.join(i.qrels.select("query_id").distinct(), "query_id", "left_semi")
    sample = judged.orderBy(md5_of(F.lit(42), "query_id"), "query_id").limit(100)
    return i.qrels.join(sample.select("query_id"), "query_id", "left_semi")


@query
def docstore_lookup(i: Inputs) -> DataFrame:
    return corpus.docstore_lookup(own_hits(i), i.chunks).select(
        "query_id", "rank", "chunk_id", "title", md5("text")
    )


@query
def paired_merge(i: Inputs) -> DataFrame:
    normal = i.arms.filter("condition = 'normal'")
    return abtest.paired_merge(
        normal.filter("arm = 'control'"), normal.filter("arm = 'treatment'"), "sentence_faithfulness"
    )


@query
def cited_passage_join(i: Inputs) -> DataFrame:
    return answers.cited_passages(marked_answers(i)).select(*KEY, "doc_id", md5("text"))


@query
def judge_cache_join(i: Inputs) -> DataFrame:
    known, todo = metrics.judge_cache_join(i.qrels.select("query_id", "doc_id"), i.judgements)
    return known.withColumn("status", F.lit("cached")).unionByName(
        todo.withColumn("judge_score", F.lit(None).cast("int")).withColumn("status", F.lit("to_judge"))
    )


# Lexical and vector retrieval.


@query
def bm25_index(i: Inputs) -> DataFrame:
    return i.index.terms.select("domain", "term", "df", "idf")


@query
def bm25_search(i: Inputs) -> DataFrame:
    return own_hits(i).select("query_id", "domain", "rank", "chunk_id", "bm25_score")


QUERIES["bm25_topk"] = QUERIES.pop("bm25_search")


@query
def dense_topk(i: Inputs) -> DataFrame:
    return dense.dense_topk(i.vector_queries, i.vectors, 10).select(
        "query_id", "rank", "chunk_id", "score"
    )


@query
def ann_ivf_topk(i: Inputs) -> DataFrame:
    """Recall of the stored index against exact search, per domain, and whether it is at least 0.9."""
    hits = dense.ann_ivf_topk(i.vector_queries, i.ivf, i.vectors, 10, nprobe=13, depth=100)
    found = dense.recall_at_k(hits, dense.dense_topk(i.vector_queries, i.vectors, 10))
    return found.select("domain", "n_exact", (F.col("recall") >= 0.9).alias("recall_ok"))


@query
def l2_normalize(i: Inputs) -> DataFrame:
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1))
    unit = dense.normalize_vectors(i.vectors.withColumn("embedding", scaled))
    return unit.select("vec_id", F.posexplode("embedding").alias("pos", "value"))


@query
def mean_pool(i: Inputs) -> DataFrame:
    """Four vectors are the tokens of one text; one token in five is masked."""
    mask = (F.col("vec_id") % 5 != 0).cast("int")
    grouped = i.vectors.withColumn("text_id", F.floor(F.col("vec_id") / F.lit(4))).withColumn("mask", mask)
    pooled = dense.mean_pool(grouped, mask="mask")
    return pooled.select("text_id", F.posexplode("embedding").alias("pos", "value"))


@query
def maxsim_score(i: Inputs) -> DataFrame:
    group = F.floor(F.col("vec_id") / F.lit(4))
    text = F.concat(F.lit("t"), group)
    tokens = i.vectors.select(text.alias("id"), (F.col("vec_id") % 4).alias("pos"), "embedding")

    def text_of(number: Column) -> Column:
        return F.concat(F.lit("t"), F.floor(number.cast("long") / F.lit(4)))

    pairs = dense.dense_topk(i.vector_queries, i.vectors, 10).select(
        text_of(F.substring("query_id", 2, 20)).alias("query_id"),
        text_of(F.substring_index("doc_id", ":", -1)).alias("doc_id"),
    ).distinct()
    return dense.maxsim_score(
        pairs, tokens.withColumnRenamed("id", "query_id"), tokens.withColumnRenamed("id", "doc_id")
    )


# Routing, fusion, reranking.


@query
def route_queries(i: Inputs) -> DataFrame:
    return routed(i).select("query_id", "domain", "domain_ord")


@query
def rrf_fuse(i: Inputs) -> DataFrame:
    return fusion.rrf_fuse(lists(i, routed(i))).select("query_id", "rank", "doc_id", "chunk_id", "fused_score")


@query
def hybrid_retrieval(i: Inputs) -> DataFrame:
    return final_hits(i).select(
        "query_id", "rank", "doc_id", "chunk_id", "domain", "fused_score", "rerank_score"
    )


QUERIES["hybrid_search"] = QUERIES.pop("hybrid_retrieval")


@query
def hybrid_modalities(i: Inputs) -> DataFrame:
    """Search where each domain has its own lists: both, dense only, or BM25 only."""
    rows = [("en", True, True), ("de", True, False), ("es", False, True), ("fr", True, True)]
    cfg = CONFIG.with_(
        modalities=i.spark.createDataFrame(rows, "domain string, dense boolean, bm25 boolean"), rerank=False
    )
    hits = hybrid_search(
        i.raw_queries, i.classified.drop("domain"), i.index, i.doc_vectors, i.page_vectors, cfg
    )
    return hits.select("query_id", "rank", "doc_id", "chunk_id", "domain", F.round("fused_score", 6).alias("fused_score"))


@query
def rerank_merge(i: Inputs) -> DataFrame:
    fused = writers.stage(fusion.rrf_fuse(lists(i, routed(i))), "candidates")
    return fusion.rerank_merge(fused, i.external_scores(fused), 20).select(
        "query_id", "rank", "doc_id", "rerank_score"
    )


@query
def rank_all_hits(i: Inputs) -> DataFrame:
    hits = bm25_topk(routed(i).select("query_id", "domain", "text"), i.index).drop("rank")
    return rank_hits(hits, "bm25_score").select("query_id", "chunk_id", "rank")


QUERIES["rank_hits"] = QUERIES.pop("rank_all_hits")


@query
def rrf_k_sweep_query(i: Inputs) -> DataFrame:
    return rrf_k_sweep(lists(i, routed(i)), i.queries, i.qrels, DOMAINS)


QUERIES["rrf_k_sweep"] = QUERIES.pop("rrf_k_sweep_query")


@query
def depth_sweep_query(i: Inputs) -> DataFrame:
    deep = lists(i, i.queries, CONFIG.with_(topk_dense=1000, topk_bm25=1000))
    return depth_sweep(deep, i.queries, i.qrels, DOMAINS)


QUERIES["depth_sweep"] = QUERIES.pop("depth_sweep_query")


@query
def ablation(i: Inputs) -> DataFrame:
    candidates = writers.stage(lists(i, everywhere(i)), "candidates")
    return ablation_table(
        candidates, i.classified, i.queries, i.qrels, i.external_scores(candidates), DOMAINS, GENERAL
    )


QUERIES["ablation_table"] = QUERIES.pop("ablation")


# Metrics.


@query
def run_best_score(i: Inputs) -> DataFrame:
    return metrics.run_best_score(final_hits(i))


@query
def ir_metrics_per_query(i: Inputs) -> DataFrame:
    return own_metrics(i)


@query
def ir_metrics_domain(i: Inputs) -> DataFrame:
    return metrics.ir_metrics_domain(own_metrics(i), i.queries)


@query
def macro_average(i: Inputs) -> DataFrame:
    return metrics.macro_average(metrics.ir_metrics_domain(own_metrics(i), i.queries))


@query
def latency_stats(i: Inputs) -> DataFrame:
    return metrics.latency_stats(i.stage_times)


@query
def cross_domain_metrics(i: Inputs) -> DataFrame:
    hits = final_hits(i)
    return metrics.cross_domain_metrics(
        hits, i.cross_queries.select("query_id", "expected_domains"), judged(hits)
    )


@query
def topn_domains(i: Inputs) -> DataFrame:
    return metrics.topn_domains(final_hits(i)).select(
        "query_id", F.array_join("domains", ",").alias("domains")
    )


@query
def minmax_judge(i: Inputs) -> DataFrame:
    scores = writers.stage(i.external_scores(lists(i, everywhere(i))), "scores")
    return metrics.minmax_judge(scores).select("query_id", "doc_id", "judged")


@query
def judged_ndcg(i: Inputs) -> DataFrame:
    return metrics.judged_ndcg(judged(final_hits(i)))


# Classification.


@query
def class_balance(i: Inputs) -> DataFrame:
    return balanced_texts(i).select("domain", "text", "origin")


@query
def train_domain_classifier(i: Inputs) -> DataFrame:
    """Trained and validated on the balanced table; accuracies against their floors."""
    found = classify.train_domain_classifier(balanced_texts(i))[1]
    return found.select(
        "n_validation", (F.col("top1_accuracy") >= 0.7).alias("top1_ok"), (F.col("top2_accuracy") >= 0.85).alias("top2_ok")
    )


@query
def classify_queries(i: Inputs) -> DataFrame:
    return i.classified.select(
        "query_id", "top1_domain", "top1_prob", "top2_domain", "top2_prob",
        *[F.element_at("all_probs", F.lit(d)).alias(f"p_{d}") for d in DOMAINS],
    )


@query
def routing_samples(i: Inputs) -> DataFrame:
    return classify.routing_samples(i.queries, i.qrels).select("query_id", "domain")


def _classified_samples(i: Inputs) -> DataFrame:
    sample = classify.routing_samples(i.queries, i.qrels).select("query_id")
    return i.classified.join(sample, "query_id", "left_semi")


@query
def routing_metrics(i: Inputs) -> DataFrame:
    return classify.routing_metrics(_classified_samples(i))


@query
def routing_by_domain(i: Inputs) -> DataFrame:
    return classify.routing_by_domain(_classified_samples(i))


@query
def combine_domains(i: Inputs) -> DataFrame:
    def part(df: DataFrame, source: str, column: str) -> DataFrame:
        return df.select("domain", F.lit(source).alias("source"), F.md5(F.col(column)).alias("text_md5"))

    return (
        part(i.queries, "query", "text")
        .unionByName(part(i.docs, "document", "text"))
        .unionByName(part(classify.title_candidates(i.docs), "title", "title"))
    )


# Grounding.


def grounding_passages(i: Inputs) -> DataFrame:
    chunks = corpus.chunk_documents(i.clean, carry=["ingest_seq"])
    hits = corpus.docstore_lookup(own_hits(i).filter("rank <= 5"), i.chunks)
    return grounding.condition_passages(i.queries, hits, corpus.OrdinalIndex.of(chunks), SEEDS)


@query
def condition_passages(i: Inputs) -> DataFrame:
    """All six conditions; a list without passages is one row without a position."""
    lists = grounding.passage_lists(
        i.queries.select("query_id"), grounding_passages(i), SEEDS, fields=("chunk_id",)
    )
    shown = lists.select("query_id", "seed", "condition", F.posexplode_outer("passages").alias("i", "p"))
    return shown.select(
        "query_id", "seed", "condition", (F.col("i") + 1).alias("position"), F.col("p.chunk_id").alias("chunk_id")
    )


@query
def corrupt_text(i: Inputs) -> DataFrame:
    changed = grounding.corrupt_text(F.col("text"), F.lit(42), F.col("doc_id"))
    return i.docs.select("doc_id", F.md5(changed).alias("text_md5"))


@query
def extract_citations(i: Inputs) -> DataFrame:
    return i.answers.select(*KEY, F.array_join(answers.cited_ids(), ",").alias("cited"))


@query
def detect_abstention(i: Inputs) -> DataFrame:
    return i.answers.select(*KEY, answers.is_abstention().alias("abstained"))


@query
def extract_verdict(i: Inputs) -> DataFrame:
    return i.answers.select(*KEY, answers.verdict().alias("verdict"))


@query
def build_prompts(i: Inputs) -> DataFrame:
    """Prompts of all modes; the opening turn of a conversation is its question."""
    asked = i.table("conversations").filter("role <> 'assistant' AND text IS NOT NULL")
    questions = asked.groupBy(F.concat(F.lit("c"), F.col("conv_id")).alias("query_id")).agg(
        F.min_by("text", "turn").alias("text")
    )
    requests = i.answers.join(questions, "query_id", "left").withColumn("text", F.coalesce("text", F.lit("")))
    modes = [
        answers.build_prompts(requests, mode).select(F.lit(mode).alias("mode"), *KEY, md5("prompt"))
        for mode in answers.INSTRUCTIONS
    ]
    return reduce(DataFrame.unionByName, modes)


@query
def answer_similarity(i: Inputs) -> DataFrame:
    return answers.answer_similarity(i.answers, encode).select(
        *KEY, "similarity_to_normal", "answer_changed"
    )


@query
def response_type(i: Inputs) -> DataFrame:
    similar = answers.answer_similarity(marked_answers(i), encode)
    return answers.with_response_type(similar).select(*KEY, "response_type")


@query
def split_sentences(i: Inputs) -> DataFrame:
    return answers.split_sentences(i.answers).select(*KEY, "pos", md5("sentence"))


@query
def sentence_faithfulness(i: Inputs) -> DataFrame:
    return answers.sentence_faithfulness(measurable_answers(i), encode)


@query
def citation_support(i: Inputs) -> DataFrame:
    return answers.citation_support(measurable_answers(i), encode)


@query
def grounding_rows(i: Inputs) -> DataFrame:
    rows = answers.grounding_rows(i.answers, encode)
    return rows.withColumn("answer_md5", F.md5("answer")).drop("answer")


@query
def answer_change_ablation(i: Inputs) -> DataFrame:
    support = answers.citation_support(measurable_answers(i), encode)
    return answers.answer_change_ablation(i.answers, support, encode, against="normal")


@query
def grounding_summary(i: Inputs) -> DataFrame:
    return grounding.grounding_summary(i.arms, ["arm", "condition"])


@query
def grounding_score(i: Inputs) -> DataFrame:
    summary = grounding.grounding_summary(i.arms, ["arm", "condition"])
    return grounding.grounding_score(summary, ["arm"])


@query
def verdict_accuracy(i: Inputs) -> DataFrame:
    qrels = i.table("conversations").filter("role = 'system'").select(
        F.concat(F.lit("c"), F.col("conv_id")).alias("query_id"), F.lit(1).alias("relevance")
    )
    return grounding.verdict_accuracy(marked_answers(i), qrels)


# A/B tests.


@query
def ab_metric_stats(i: Inputs) -> DataFrame:
    return abtest.ab_metric_stats(i.arms).drop("domain")


@query
def bh_fdr(i: Inputs) -> DataFrame:
    stand_in = abtest.ab_metric_stats(i.arms).withColumn("p_value", F.exp(-F.abs("statistic")))
    return abtest.bh_fdr(stand_in).select("condition", "metric", "p_value", "p_adjusted")


@query
def ab_test(i: Inputs) -> DataFrame:
    return abtest.ab_test(i.arms)


# Streaming.


@query
def ingest_stream(i: Inputs) -> DataFrame:
    """All raw documents in two arrivals: earlier copies first, later ones after."""
    source = writers.scratch_path(i.spark, "arrivals")
    sink = writers.scratch_path(i.spark, "stream-sink")
    checkpoint = writers.scratch_path(i.spark, "stream-state")
    later = F.col("text").endswith(" copy")
    for arrival in (~F.coalesce(later, F.lit(False)), later):
        i.raw_docs.filter(arrival).write.mode("append").parquet(source)
        run_ingest_stream(i.spark, source, sink, checkpoint, state_partitions=8).awaitTermination()
    return i.spark.read.parquet(sink).select(
        "chunk_id", "doc_id", "domain", "start_token", "end_token", md5("text")
    )


