"""Corpus preparation: clean, deduplicate, chunk, ordinals, statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.config import MAX_TOKENS, STRIDE
from sieveline.functions.text import full_text, strip, strip_or_empty, words
from sieveline.functions.vectors import norm
from sieveline.operators.ranking import sequence_bucket


def clean_docs(docs: DataFrame) -> DataFrame:
    """Strip text and title, NULL title to ``''``, drop documents without text."""
    cleaned = docs.withColumn("text", strip_or_empty("text"))
    if "title" in docs.columns:
        cleaned = cleaned.withColumn("title", strip_or_empty("title"))
    return cleaned.filter(F.length("text") > 0)


def dedup_docs(docs: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """One row per ``doc_id``: the one with the smallest ``order``.

    The rank filter is pushed below the shuffle, so however many copies one id
    has, each task sends at most one of them. The result stays partitioned by
    ``doc_id``, which chunking and term counting below reuse.
    """
    tie = [F.col(order)] + [F.col(c) for c in ("text", "title") if c in docs.columns]
    w = Window.partitionBy("doc_id").orderBy(*tie)
    return docs.withColumn("_copy", F.row_number().over(w)).filter("_copy = 1").drop("_copy")


def chunk_documents(
    docs: DataFrame,
    max_tokens: int = MAX_TOKENS,
    stride: int = STRIDE,
    tokenize: Callable[[Column], Column] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Overlapping token windows; ``tokenize`` maps a text column to a token array.

    ``carry`` names further document columns to keep. A text of at most ``max_tokens`` tokens is one chunk with its original text.
    The windows of a document are built inside its own row, so there is no
    shuffle and the token array is never copied per chunk.
    """
    if stride >= max_tokens:
        raise ValueError(f"stride {stride} must be smaller than max_tokens {max_tokens}")
    step = max_tokens - stride
    token_array = (tokenize or words)(F.col("_full"))
    base = docs.select(
        "doc_id",
        *(["orig_id"] if "orig_id" in docs.columns else []),
        "domain",
        *(["title"] if "title" in docs.columns else []),
        *carry,
        strip(full_text("title" if "title" in docs.columns else F.lit(""), "text")).alias("_full"),
    ).withColumn("_tokens", token_array)
    n = F.size("_tokens")
    last_start = (F.ceil((n - max_tokens) / F.lit(step)) * step).cast("int")
    single = F.array(
        F.struct(
            F.lit(0).alias("i"),
            F.col("_full").alias("text"),
            F.lit(0).cast("long").alias("start_token"),
            n.cast("long").alias("end_token"),
        )
    )

    def window(start: Column) -> Column:
        return F.struct(
            (start / F.lit(step)).cast("int").alias("i"),
            F.array_join(F.slice("_tokens", start + 1, F.lit(max_tokens)), " ").alias("text"),
            start.cast("long").alias("start_token"),
            F.least(start + max_tokens, n).cast("long").alias("end_token"),
        )

    starts = F.sequence(F.lit(0), F.greatest(last_start, F.lit(0)), F.lit(step))
    windows = F.when(n <= max_tokens, single).otherwise(F.transform(starts, window))
    kept = [c for c in base.columns if not c.startswith("_")]
    exploded = base.select(*kept, F.explode(windows).alias("_w"))
    return exploded.select(
        F.concat(F.col("doc_id"), F.lit("__chunk"), F.col("_w.i")).alias("chunk_id"),
        *kept,
        F.col("_w.text").alias("text"),
        F.col("_w.start_token").alias("start_token"),
        F.col("_w.end_token").alias("end_token"),
    )


def corpus_stats(chunks: DataFrame) -> DataFrame:
    """Documents and chunks per domain.

    Chunk rows are first folded to one row per document (free when the chunks
    are still partitioned by ``doc_id``), which avoids a distinct count.
    """
    per_doc = chunks.groupBy("domain", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_doc.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_chunks")
    )


def chunk_number() -> Column:
    """Number of a chunk in its document, from its id."""
    return F.regexp_extract("chunk_id", "__chunk([0-9]+)$", 1).cast("long")


@dataclass(frozen=True)
class OrdinalIndex:
    """Dense 0-based ordinals of the chunks of each domain, in corpus order, without their text.

    Two levels: ``buckets`` (domain, bucket, start, size) are ranges of at most ``width`` document
    positions, ``documents`` (domain, seq, bucket, n) count the chunks of each document. An ordinal is
    found by a range look-up among the buckets, then among the documents of its bucket.
    """

    chunks: DataFrame
    buckets: DataFrame
    documents: DataFrame
    seq: str
    width: int

    @classmethod
    def of(cls, chunks: DataFrame, seq: str = "ingest_seq", width: int = 100_000) -> OrdinalIndex:
        documents = chunks.groupBy("domain", F.col(seq).alias("seq")).agg(F.count(F.lit(1)).alias("n"))
        documents = documents.withColumn("bucket", sequence_bucket(F.col("seq"), width))
        sizes = documents.groupBy("domain", "bucket").agg(F.sum("n").alias("size"))
        before = Window.partitionBy("domain").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        buckets = sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0).cast("long")))
        return cls(chunks, buckets, documents, seq, width)

    def sizes(self) -> DataFrame:
        return self.buckets.groupBy("domain").agg(F.sum("size").alias("n_chunks"))

    def starts(self, touched: DataFrame | None = None) -> DataFrame:
        """domain, bucket, seq, n, first: the ordinal of each document's first chunk in its bucket."""
        documents = self.documents if touched is None else self.documents.join(touched, ["domain", "bucket"], "left_semi")
        before = Window.partitionBy("domain", "bucket").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
        return documents.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")))

    def rows(self) -> DataFrame:
        """All chunks with their ordinals; only counts were windowed, text moves once."""
        first = self.starts().join(self.buckets, ["domain", "bucket"]).select(
            "domain", F.col("seq").alias(self.seq), (F.col("start") + F.col("first")).alias("_first")
        )
        return self.chunks.join(first, ["domain", self.seq]).select(
            *self.chunks.columns, (F.col("_first") + chunk_number()).alias("chunk_ord")
        )

    def at(self, ordinals: DataFrame) -> DataFrame:
        """The chunks at the ``(domain, chunk_ord)`` asked for, and no others."""
        asked = ordinals.select("domain", "chunk_ord").distinct()
        # Ranges meet ordinals by equal cells of a grid, so no ordinal is compared with all ranges.
        wide = _in_cells(self.buckets, "start", "size", self.width)
        near = asked.withColumn("cell", F.expr(f"chunk_ord div {self.width}")).join(wide, ["domain", "cell"])
        near = near.filter((F.col("start") <= F.col("chunk_ord")) & (F.col("chunk_ord") < F.col("start") + F.col("size")))
        near = near.select("domain", "bucket", "chunk_ord", (F.col("chunk_ord") - F.col("start")).alias("inner"))
        narrow = _in_cells(self.starts(near.select("domain", "bucket").distinct()), "first", "n", 64)
        found = near.withColumn("cell", F.expr("inner div 64")).join(narrow, ["domain", "bucket", "cell"])
        found = found.filter((F.col("first") <= F.col("inner")) & (F.col("inner") < F.col("first") + F.col("n")))
        found = found.select(
            "domain", F.col("seq").alias(self.seq), (F.col("inner") - F.col("first")).alias("_number"), "chunk_ord"
        )
        numbered = self.chunks.withColumn("_number", chunk_number())
        return numbered.join(found, ["domain", self.seq, "_number"]).drop("_number")


def _in_cells(ranges: DataFrame, start: str, size: str, width: int) -> DataFrame:
    """``ranges`` once per cell of ``width`` values that they reach into."""
    return ranges.withColumn("cell", F.explode(F.expr(f"sequence({start} div {width}, ({start} + {size} - 1) div {width})")))


def docstore(
    chunks: DataFrame, seq: str = "ingest_seq", width: int = 100_000
) -> DataFrame:
    """Chunk table with a dense 0-based ordinal per domain in corpus order.

    ``seq`` is the unique integer position of the document in its corpus, so a
    bucket holds at most ``width`` documents whatever the size of a domain.
    """
    return OrdinalIndex.of(chunks, seq, width).rows()


def docstore_lookup(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Attach chunk metadata to hits; hits of unknown chunks are dropped."""
    meta = chunks.select("chunk_id", "doc_id", "domain", "title", "text")
    drop = [c for c in ("doc_id", "domain", "title", "text") if c in hits.columns]
    return hits.drop(*drop).join(meta, "chunk_id")


def index_metadata(vectors: DataFrame, model: str, kind: str = "exact") -> DataFrame:
    """What an index holds, computed from its vectors rather than declared."""
    length = norm(F.col("embedding"))
    return vectors.groupBy("domain").agg(
        F.lit(model).alias("encoder_model"),
        F.max(F.size("embedding")).alias("dimension"),
        (F.min(F.size("embedding")) == F.max(F.size("embedding"))).alias("uniform_dimension"),
        F.count(F.lit(1)).alias("num_vectors"),
        F.lit(kind).alias("index_type"),
        (F.max(F.abs(length - 1.0)) < 1e-3).alias("normalized"),
    )


def metadata_mismatch(
    metadata: DataFrame, model: str | None = None, dimension: int | None = None
) -> DataFrame:
    """Indexes that do not fit the encoder about to be used, with the reason."""
    checks = [F.when(~F.col("normalized"), F.lit("not normalized"))]
    if model is not None:
        checks.append(F.when(F.col("encoder_model") != model, F.lit("encoder differs")))
    if dimension is not None:
        checks.append(F.when(F.col("dimension") != dimension, F.lit("dimension differs")))
    reasons = F.filter(F.array(*checks), lambda r: r.isNotNull())
    return metadata.withColumn("reasons", reasons).filter(F.size("reasons") > 0)
