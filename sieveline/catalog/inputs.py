"""Input tables of the registered queries, derived from the given parquet files.

Every view covers its source tables whole. The SQL twin of each method is the
view of the same name, prefixed ``f_``, in ``catalog.oracle``.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from sieveline.config import CONDITIONS, TOPK_PASSAGES
from sieveline.functions.text import hex_int, md5_of, normalize_query
from sieveline.functions.vectors import l2_normalize, let
from sieveline.operators.answers import with_response_type
from sieveline.operators.classify import classify_queries
from sieveline.operators.corpus import chunk_documents, clean_docs, dedup_docs
from sieveline.operators.dense import IvfIndex, build_ivf
from sieveline.operators.lexical import Bm25Index, load_index, save_index
from sieveline.operators.ranking import bucketed_rank, sequence_bucket, top_k
from sieveline.sources.writers import scratch_path

DOMAINS = ("en", "de", "es", "fr")
GENERAL = "en"
SEEDS = (42, 43, 44)
LETTERS = "abcdefghijklmnopqrstuvwxyz"

# Seed texts that top up a domain with few queries.
SEED_TEXTS = {
    "en": ["what is the rest of the", "how is it with the", "where and when is that"],
    "de": ["was ist der die das", "wie und wo ist ein", "nicht mit dem und von"],
    "es": ["que es de la el los", "como y donde en las", "por que se con una"],
    "fr": ["quel est le la les des", "comment et dans une", "pour que qui est sur"],
}

# Names of the stored indexes by session, data directory and state of its files.
_STORED_INDEXES: dict[tuple, str] = {}
# Paths of other stored tables, likewise.
_STORED_TABLES: dict[tuple, str] = {}


@F.arrow_udf(ArrayType(DoubleType()))
def _letter_counts(texts: pa.Array) -> pa.Array:
    """How often each letter is in a lower-cased text, all in one pass; nulls without a text."""
    texts = texts.cast(pa.large_binary())
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), np.int64)
    data = np.frombuffer(b"".join(t or b"" for t in texts.to_pylist()), np.uint8)
    ends = np.cumsum(sizes)
    counts = np.zeros((len(texts), len(LETTERS)))
    for i, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
        counts[i] = np.bincount(data[end - size : end], minlength=256)[ord("a") : ord("z") + 1]
    missing = np.repeat(np.asarray(texts.is_null()), len(LETTERS))
    offsets = np.arange(len(texts) + 1, dtype=np.int32) * len(LETTERS)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts.ravel(), mask=missing))


def encode(text: Column) -> Column:
    """Stand-in encoder: unit vector of letter counts of the whole text."""
    return l2_normalize(_letter_counts(F.lower(text)))


class Inputs:
    """Lazily built DataFrames over one data directory."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    @cached_property
    def docs(self) -> DataFrame:
        """Documents; a short first line that is followed by more text is the title."""
        cut = F.locate("\n", F.col("text"))
        title = F.when(cut.between(2, 81), F.substring(F.col("text"), F.lit(1), cut - 1)).otherwise("")
        return self.table("documents").select(
            F.concat_ws(":", "lang", "doc_id").alias("doc_id"),
            F.col("doc_id").cast("string").alias("orig_id"),
            F.col("lang").alias("domain"),
            title.alias("title"),
            "text",
            F.col("doc_id").alias("ingest_seq"),
        )

    @cached_property
    def raw_docs(self) -> DataFrame:
        """Every document, a later copy of each, and earlier empty copies of labelled ones."""
        docs = self.docs
        later = docs.withColumn("title", F.lit(None).cast("string")).withColumn(
            "text", F.concat("text", F.lit(" copy"))
        )
        labels = self.table("labels").select(F.col("doc_id").cast("string").alias("orig_id"), "toxic")
        empty = docs.join(labels, "orig_id").withColumn(
            "text", F.when(F.col("toxic") == 1, F.lit(None).cast("string")).otherwise("  \t\n")
        )

        def at(df: DataFrame, k: int) -> DataFrame:
            return df.select(
                "doc_id", "orig_id", "domain", "title", "text",
                (F.col("ingest_seq") * 4 + k).alias("ingest_seq"),
            )

        return at(docs, 2).unionByName(at(later, 3)).unionByName(at(empty, 0))

    @cached_property
    def clean(self) -> DataFrame:
        return dedup_docs(clean_docs(self.docs))

    @cached_property
    def chunks(self) -> DataFrame:
        return chunk_documents(self.clean)

    @cached_property
    def _state(self) -> tuple:
        files = self.table("documents").agg(
            F.max("_metadata.file_modification_time").alias("modified"),
            F.count_distinct("_metadata.file_path").alias("files"),
        ).first()
        return self.spark.sparkContext.applicationId, self.path, files["modified"], files["files"]

    @cached_property
    def index(self) -> Bm25Index:
        """Stored index of the corpus, built once per session and state of its files."""
        if (key := self._state) not in _STORED_INDEXES:
            path = scratch_path(self.spark, "bm25")
            name = "sieveline_" + path.rsplit("-", 1)[1]
            cores = self.spark.sparkContext.defaultParallelism
            buckets = min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 4 * cores)
            save_index(self.chunks, name, path, buckets)
            _STORED_INDEXES[key] = name
        return load_index(self.spark, _STORED_INDEXES[key])

    @cached_property
    def ivf(self) -> IvfIndex:
        """Stored approximate index of the vectors, fitted on about 16,384 of them."""
        return build_ivf(self.vectors, scratch_path(self.spark, "ivf"), nlist=16, parts=16, sample_rows=16_384)

    @cached_property
    def page_titles(self) -> DataFrame:
        """Pages as known-item queries: the page title, and the document its URL names."""
        return self.table("pages").select(
            "page_id",
            F.regexp_extract("url", "/([a-z]{2})/([0-9]+)", 1).alias("domain"),
            F.regexp_extract("url", "/([a-z]{2})/([0-9]+)", 2).alias("orig_id"),
            F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("text"),
        )

    @cached_property
    def raw_queries(self) -> DataFrame:
        """All page titles and all benchmark passages."""
        pages = self.page_titles.select(
            F.concat(F.col("domain"), F.lit(":q"), F.col("page_id")).alias("query_id"), "text", "domain"
        )
        bench = self.table("benchmark").select(
            F.concat(F.lit("en:b"), F.col("item_id")).alias("query_id"), "text", F.lit("en").alias("domain")
        )
        return pages.unionByName(bench)

    @cached_property
    def queries(self) -> DataFrame:
        return self.raw_queries.withColumn("text", normalize_query("text"))

    @cached_property
    def qrels(self) -> DataFrame:
        """The document a page's URL names (1, or 2 when labelled good), and the one
        with the page's own number (1 when labelled toxic, else 0)."""
        docs = self.docs.select("doc_id", "orig_id", "domain")
        labels = self.table("labels").select(
            F.col("doc_id").cast("string").alias("orig_id"), "quality", "toxic"
        )
        pages = self.page_titles.withColumn(
            "query_id", F.concat(F.col("domain"), F.lit(":q"), F.col("page_id"))
        )
        named = pages.join(docs, ["domain", "orig_id"]).join(labels, "orig_id", "left").select(
            "query_id", "doc_id", (F.coalesce("quality", F.lit(0)) + 1).cast("int").alias("relevance")
        )
        other = (
            pages.filter(F.col("orig_id") != F.col("page_id").cast("string"))
            .drop("domain")
            .withColumn("orig_id", F.col("page_id").cast("string"))
            .join(docs, "orig_id")
            .join(labels, "orig_id", "left")
            .select("query_id", "doc_id", F.coalesce("toxic", F.lit(0)).cast("int").alias("relevance"))
        )
        return named.unionByName(other)

    @cached_property
    def probs(self) -> DataFrame:
        """Class probabilities per query, spread by md5 and tilted to the true domain."""
        def weight(d: Column) -> Column:
            w = 1.0 + hex_int(md5_of("query_id", d), 1, 4) % 1000
            return w * w * F.when(F.col("domain") == d, 4.0).otherwise(1.0)

        weights = F.array(*[
            F.struct(F.lit(d).alias("domain"), weight(F.lit(d)).alias("p")) for d in DOMAINS
        ])
        def shares(w: Column) -> Column:
            total = F.aggregate(w, F.lit(0.0), lambda a, s: a + s["p"])
            return let(
                total,
                lambda t: F.transform(
                    w,
                    lambda s: F.struct(
                        s["domain"].alias("domain"), F.round(s["p"] / t, 6).alias("p")
                    ),
                ),
            )

        return self.raw_queries.select("query_id", "domain", let(weights, shares).alias("probs"))

    @cached_property
    def classified(self) -> DataFrame:
        return classify_queries(self.probs)

    @cached_property
    def vectors(self) -> DataFrame:
        """All vectors as a corpus of three domains."""
        domain = F.concat(F.lit("d"), F.col("label") % 3)
        doc = F.concat(domain, F.lit(":"), F.col("vec_id"))
        return self.table("embeddings").select(
            F.concat(doc, F.lit("__chunk0")).alias("chunk_id"),
            doc.alias("doc_id"),
            domain.alias("domain"),
            "embedding",
            "vec_id",
            "label",
        )

    @cached_property
    def vector_queries(self) -> DataFrame:
        """All vectors again, as queries against their own domain."""
        return self.vectors.select(
            F.concat(F.lit("v"), F.col("vec_id")).alias("query_id"), "domain", "embedding"
        )

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        """Stored once per session and state of the documents."""
        if (key := (name, *self._state)) not in _STORED_TABLES:
            path = scratch_path(self.spark, name)
            df.write.parquet(path)
            _STORED_TABLES[key] = path
        return self.spark.read.parquet(_STORED_TABLES[key])

    @cached_property
    def doc_vectors(self) -> DataFrame:
        """Vectors of all chunks."""
        return self._stored("chunk-vectors", self.chunks.select("chunk_id", "doc_id", "domain", encode(F.col("text")).alias("embedding")))

    @cached_property
    def page_vectors(self) -> DataFrame:
        """Vectors of all queries."""
        return self.raw_queries.select("query_id", encode(F.col("text")).alias("embedding"))

    def external_scores(self, pairs: DataFrame) -> DataFrame:
        """Rerank scores in [-2, 1.4] from md5; about one pair in seven has none."""
        raw = hex_int(md5_of("query_id", "doc_id"), 1, 4) / 65536.0 * 4.0 - 2.0
        scored = pairs.select("query_id", "doc_id").distinct().withColumn("score", F.round(raw, 6))
        return scored.filter(F.col("score") <= 1.4)

    @cached_property
    def train_texts(self) -> DataFrame:
        """Documents as labelled texts: the text, keyed by document."""
        return self.docs.select(F.col("doc_id").alias("query_id"), "domain", "text")

    @cached_property
    def seed_texts(self) -> DataFrame:
        rows = [(d, SEED_TEXTS[d]) for d in DOMAINS]
        return self.spark.createDataFrame(rows, "domain string, seeds array<string>")

    @cached_property
    def stage_times(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_type").alias("stage"), F.col("value").alias("ms")
        )

    @cached_property
    def answers(self) -> DataFrame:
        """Every assistant turn as an answer; the first five other turns are its passages.

        The n-th exchange of a conversation stands for the n-th condition.
        """
        conv = self.table("conversations")
        others = conv.filter(F.col("role") != "assistant")
        passages = (
            top_k(others, ["conv_id"], [F.col("turn"), F.col("text")], TOPK_PASSAGES)
            .groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("_p"))
        )
        key = F.concat(F.lit("c"), F.col("conv_id"))
        turns = conv.filter(F.col("role") == "assistant").join(passages, "conv_id", "left")
        bucket = hex_int(md5_of("conv_id", "turn"), 1, 1)
        mark = (
            F.when(bucket < 5, " [P1] is the source of this.")
            .when(bucket < 9, " [P3] [P1] [P9]")
            .otherwise("")
        )
        head = (
            F.when(bucket == 0, "SUPPORTED. ").when(bucket == 1, "Refuted: ")
            .when(bucket == 2, "Not enough info. ").when(bucket == 3, "UNSUPPORTED ")
            .otherwise("")
        )
        body = F.when(bucket == 15, F.lit("I don't know.")).otherwise(F.concat(head, F.col("text"), mark))
        nth = F.floor((F.col("turn") - 1) / F.lit(2)).cast("int")
        names = F.array(*[F.lit(c) for c in CONDITIONS])
        items = F.transform(
            "_p",
            lambda p: F.struct(
                F.concat(key, F.lit(":"), p["turn"]).alias("doc_id"),
                F.when(p["turn"] == 0, "opening").otherwise("").alias("title"),
                p["text"].alias("text"),
            ),
        )
        none = F.array().cast("array<struct<doc_id:string,title:string,text:string>>")
        condition = F.get(names, F.pmod(nth, F.lit(6)))
        return turns.select(
            key.alias("query_id"),
            condition.alias("condition"),
            (F.lit(42) + F.floor(nth / F.lit(6)).cast("int")).alias("seed"),
            body.alias("answer"),
            F.when(condition == "no_retrieval", none).otherwise(F.coalesce(items, none)).alias("passages"),
            F.length("text").cast("double").alias("latency_ms"),
            "turn",
        ).transform(self._one_per_key)

    @staticmethod
    def _one_per_key(rows: DataFrame) -> DataFrame:
        """Conversations open with one or two turns; the earliest answer of a key counts."""
        return top_k(rows, ["query_id", "condition", "seed"], [F.col("turn")], 1).drop("rank", "turn")

    @cached_property
    def arms(self) -> DataFrame:
        """Events as grounding rows of two arms, one row per event.

        One event in seven stands for an answer without passages, whatever its type. The n-th event of an arm, user and condition has seed 41 + n.
        """
        conditions = F.create_map(*[F.lit(x) for x in (
            "view", "normal", "click", "swapped_context", "purchase", "random_in_domain",
            "signup", "shuffled_order", "error", "corrupted_context",
        )])
        k = F.get_json_object("props", "$.k").cast("int")
        events = self.table("events").select(
            F.when(F.col("event_id") % 2 == 0, "control").otherwise("treatment").alias("arm"),
            F.concat(F.lit("u"), F.col("user_id")).alias("query_id"),
            F.when(k % 7 == 3, "no_retrieval").otherwise(conditions[F.col("event_type")]).alias("condition"),
            "event_id",
            sequence_bucket(F.col("event_id"), 100_000).alias("bucket"),
            "value",
            k.alias("k"),
        ).filter(F.col("condition").isNotNull())
        ranked = bucketed_rank(
            events, ["arm", "query_id", "condition"], "bucket", [F.col("event_id")], "nth"
        )
        k, value = F.col("k"), F.col("value")
        rows = ranked.select(
            F.lit("all").alias("domain"),
            "arm", "query_id", "condition", (F.col("nth") + 41).alias("seed"),
            (k % 10 == 0).alias("abstained"),
            (k / 100.0).alias("similarity_to_normal"),
            (k / 100.0 < 0.9).alias("answer_changed"),
            F.when(k % 10 != 0, F.least(value / 100.0, F.lit(1.0))).alias("sentence_faithfulness"),
            F.when((k % 10 != 0) & (k % 4 != 0), (k % 5) / 4.0).alias("citation_support"),
            value.alias("latency_ms"),
        )
        keyed = rows.withColumn("query_id", F.concat_ws("|", "arm", "query_id"))
        typed = with_response_type(keyed)
        return typed.withColumn("query_id", F.element_at(F.split("query_id", "[|]"), 2))

    @cached_property
    def cross_queries(self) -> DataFrame:
        """Queries with 0, 1 or 2 expected domains."""
        h = hex_int(md5_of("query_id"), 1, 2)
        n = h % 3
        first = F.element_at(F.array(*[F.lit(d) for d in DOMAINS]), (h % 4 + 1).cast("int"))
        second = F.element_at(F.array(*[F.lit(d) for d in DOMAINS]), ((h + 1) % 4 + 1).cast("int"))
        none = F.array().cast("array<string>")
        return self.queries.select(
            "query_id",
            "text",
            F.when(n == 0, none).when(n == 1, F.array(first)).otherwise(F.array(first, second)).alias(
                "expected_domains"
            ),
        )

    @cached_property
    def judgements(self) -> DataFrame:
        """Append-only judge cache over all judged pairs: two entries each, some missing."""
        pairs = self.qrels.select("query_id", "doc_id")

        def entry(seq: int) -> DataFrame:
            h = hex_int(md5_of("query_id", "doc_id", F.lit(seq)), 1, 4)
            return pairs.select(
                "query_id", "doc_id", (h % 3).cast("int").alias("score"), F.lit(seq).cast("long").alias("seq"),
                h.alias("h"),
            )

        return entry(1).unionByName(entry(2)).filter("h < 36000").drop("h")
