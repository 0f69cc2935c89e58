"""Corpora, queries and judgements from files, and caps on corpus size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions.text import strip
from sieveline.operators.ranking import bucketed_rank, sequence_bucket

REQUIRED = ("doc_id", "text", "domain")
OPTIONAL = ("title", "orig_id")


def namespaced(domain: Column | str, original: Column) -> Column:
    """``domain:id``, so that an id belongs to exactly one domain."""
    d = F.lit(domain) if isinstance(domain, str) else domain
    return F.concat(d, F.lit(":"), original.cast("string"))


def beir_docs(corpus: DataFrame, domain: Column | str) -> DataFrame:
    """Corpus table (``_id``, ``title``, ``text``) to documents."""
    d = F.lit(domain) if isinstance(domain, str) else domain
    title = F.col("title") if "title" in corpus.columns else F.lit("")
    extra = [c for c in ("ingest_seq",) if c in corpus.columns]
    return corpus.select(
        namespaced(domain, F.col("_id")).alias("doc_id"),
        F.col("_id").cast("string").alias("orig_id"),
        d.alias("domain"),
        F.coalesce(title, F.lit("")).alias("title"),
        F.coalesce("text", F.lit("")).alias("text"),
        *extra,
    )


def beir_queries(queries: DataFrame, domain: Column | str) -> DataFrame:
    d = F.lit(domain) if isinstance(domain, str) else domain
    return queries.select(
        namespaced(domain, F.col("_id")).alias("query_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        d.alias("domain"),
    )


def beir_qrels(qrels: DataFrame, domain: Column | str) -> DataFrame:
    """Judgements (``query-id``, ``corpus-id``, ``score``) with integer relevance."""
    return qrels.select(
        namespaced(domain, F.col("query-id")).alias("query_id"),
        namespaced(domain, F.col("corpus-id")).alias("doc_id"),
        F.col("score").cast("int").alias("relevance"),
    )


def load_beir(
    spark: SparkSession, paths: dict[str, str], split: str | None = None, fmt: str = "parquet"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents, queries and judgements of several datasets as three tables.

    ``paths`` maps a domain to a directory with ``corpus``, ``queries`` and
    ``qrels``. With ``split``, judgements are filtered on a ``split`` column if
    they have one.
    """
    def read(part: str, to: object) -> DataFrame:
        frames = []
        for domain, path in paths.items():
            raw = spark.read.format(fmt).load(f"{path}/{part}")
            if part == "qrels" and split is not None and "split" in raw.columns:
                raw = raw.filter(F.col("split") == split)
            frames.append(to(raw, domain))
        return reduce(DataFrame.unionByName, frames)

    return read("corpus", beir_docs), read("queries", beir_queries), read("qrels", beir_qrels)


def load_beir_tree(
    spark: SparkSession, path: str, split: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As ``load_beir``, of one tree whose parts are partitioned by domain (``corpus/domain=…``).

    The domains are those of the folders, whatever their number; rows without one are kept.
    """

    def read(part: str) -> DataFrame:
        found = spark.read.parquet(f"{path}/{part}")
        return found.withColumn("domain", F.col("domain").cast("string"))

    qrels = read("qrels")
    if split is not None and "split" in qrels.columns:
        qrels = qrels.filter(F.col("split") == split)
    return beir_docs(read("corpus"), F.col("domain")), beir_queries(read("queries"), F.col("domain")), beir_qrels(qrels, F.col("domain"))


def cap_simple(docs: DataFrame, max_docs: int, seq: str = "ingest_seq", width: int = 100_000) -> DataFrame:
    """First ``max_docs`` documents of each domain in corpus order.

    The cut is found from bucket counts, so it works for caps of any size
    without bringing the kept rows to one task.
    """
    bucketed = docs.withColumn("_bucket", sequence_bucket(F.col(seq), width))
    kept = bucketed_rank(bucketed, ["domain"], "_bucket", [F.col(seq)], "_r", keep=max_docs)
    return kept.drop("_bucket", "_r")


def cap_with_qrel_coverage(
    docs: DataFrame, qrels: DataFrame, max_docs: int, seq: str = "ingest_seq", width: int = 100_000
) -> DataFrame:
    """All judged documents, then unjudged ones in corpus order up to the cap.

    When the judged documents alone exceed the cap, all of them stay.
    """
    judged_ids = qrels.select("doc_id").distinct()
    judged = docs.join(judged_ids, "doc_id", "left_semi")
    others = docs.join(judged_ids, "doc_id", "left_anti")
    n_judged = judged.groupBy("domain").agg(F.count(F.lit(1)).alias("_n"))
    room = docs.select("domain").distinct().join(n_judged, "domain", "left").select(
        "domain", F.greatest(F.lit(max_docs) - F.coalesce("_n", F.lit(0)), F.lit(0)).alias("_room")
    )
    bucketed = others.join(room.filter("_room > 0"), "domain").withColumn(
        "_bucket", sequence_bucket(F.col(seq), width)
    )
    fill = bucketed_rank(
        bucketed, ["domain", "_room"], "_bucket", [F.col(seq)], "_r", keep=F.col("_room")
    )
    return judged.unionByName(fill.select(*judged.columns))


def ingest(docs: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """Check the required columns and default the optional ones.

    Only ``n_partitions`` moves rows, which it spreads evenly. They are not placed by ``doc_id``: one
    id may have very many copies, which deduplication drops before it shuffles.
    """
    missing = [c for c in REQUIRED if c not in docs.columns]
    if missing:
        raise ValueError(f"corpus lacks required columns: {missing}")
    for column in OPTIONAL:
        if column not in docs.columns:
            docs = docs.withColumn(column, F.lit(""))
    return docs if n_partitions is None else docs.repartition(n_partitions)


def read_query_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Queries with an ``expected_domains`` array; blank lines are skipped."""
    schema = "query_id string, text string, expected_domains array<string>"
    return spark.read.schema(schema).json(path).filter(F.col("query_id").isNotNull())


def read_query_batch(spark: SparkSession, path: str) -> DataFrame:
    """One query text per line, stripped, blank lines dropped."""
    return spark.read.text(path).select(strip("value").alias("text")).filter(F.col("text") != "")
