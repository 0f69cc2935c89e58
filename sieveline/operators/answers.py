"""Measures on generated answers, which enter as a table.

An answer row is ``query_id, condition, seed, answer, passages`` with passages an
ordered array of ``struct<doc_id, title, text>``. Vectors come from an ``encode``
hook that maps a text column to a unit-vector column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.config import SENTENCE_THRESHOLD, SIMILARITY_THRESHOLD
from sieveline.functions.text import sentences, strip
from sieveline.functions.vectors import dot

Encode = Callable[[Column], Column]
KEY = ("query_id", "condition", "seed")

# Phrases that mark an abstention, matched in the lower-cased answer.
ABSTENTION_PHRASES = (
    "i don't know",
    "i cannot answer",
    "i do not have",
    "no information",
    "cannot be determined",
    "not enough information",
    "the provided passages do not",
    "the passages do not",
    "no relevant",
)

# The instruction that opens a prompt, by mode.
INSTRUCTIONS = {
    "strict": (
        "Answer the question using ONLY the provided passages below. "
        "Cite passage numbers inline as [P1], [P2], etc. "
        "If the passages do not contain enough information, say so explicitly."
    ),
    "partial": (
        "Answer the question using the provided passages as primary evidence. "
        "Cite passage numbers inline as [P1], [P2], etc. "
        "If the passages are insufficient, supplement with your knowledge "
        "but clearly indicate which parts come from the passages and which from general knowledge."
    ),
    "claim_verify": (
        "You are a fact-checker. Using ONLY the provided passages, determine whether "
        "the following claim is SUPPORTED, REFUTED, or NOT ENOUGH INFO. "
        "Cite the relevant passage numbers inline as [P1], [P2], etc. "
        "Give a one-sentence verdict followed by a brief explanation."
    ),
}
NO_PASSAGES = "(No passages provided.)"  # fixed value


def cited_ids(answer: str = "answer", passages: str = "passages") -> Column:
    """Ids of the passages an answer cites as ``[Pn]``, in first-seen order."""
    numbers = F.regexp_extract_all(F.col(answer), F.lit(r"\[P(\d+)\]"), F.lit(1))
    ids = F.transform(
        numbers, lambda n: F.get(F.col(passages), n.try_cast("int") - F.lit(1))["doc_id"]
    )
    return F.array_distinct(F.filter(ids, lambda i: i.isNotNull()))


def is_abstention(answer: str = "answer") -> Column:
    return F.lower(F.col(answer)).rlike("|".join(ABSTENTION_PHRASES))


def verdict(answer: str = "answer") -> Column:
    """Verdict named in the first 100 characters; "UNSUPPORTED" reads as SUPPORTED."""
    head = F.substring(F.upper(strip(answer)), 1, 100)
    return (
        F.when(F.contains(head, F.lit("SUPPORTED")), "SUPPORTED")
        .when(F.contains(head, F.lit("REFUTED")), "REFUTED")
        .when(
            F.contains(head, F.lit("NOT ENOUGH")) | F.contains(head, F.lit("INSUFFICIENT")),
            "NOT ENOUGH INFO",
        )
        .otherwise("UNKNOWN")
    )


def prompt(query: Column, passages: Column, mode: str = "strict") -> Column:
    """Generation prompt of a query and its passages."""
    def block(p: Column, i: Column) -> Column:
        title = F.when(p["title"] != "", F.concat(F.lit(" — "), p["title"]))
        head = F.concat(F.lit("[P"), i + 1, F.lit("]"), F.coalesce(title, F.lit("")))
        return F.concat(head, F.lit("\n"), strip(p["text"]))

    context = F.when(
        F.size(passages) > 0, F.array_join(F.transform(passages, block), "\n\n")
    ).otherwise(NO_PASSAGES)
    return F.concat(
        F.lit(INSTRUCTIONS.get(mode, INSTRUCTIONS["strict"]) + "\n\nPassages:\n"),
        context,
        F.lit("\n\nQuestion: "),
        query,
        F.lit("\n\nAnswer:"),
    )


def build_prompts(requests: DataFrame, mode: str = "strict") -> DataFrame:
    return requests.withColumn("prompt", prompt(F.col("text"), F.col("passages"), mode))


def split_sentences(answers: DataFrame, text: str = "answer", min_len: int = 25) -> DataFrame:
    """One row per sentence with its position; texts without sentences give none."""
    kept = [c for c in answers.columns if c != text]
    return answers.select(*kept, F.posexplode(sentences(text, min_len)).alias("pos", "sentence"))


def answer_similarity(
    answers: DataFrame,
    encode: Encode,
    threshold: float = SIMILARITY_THRESHOLD,
    against: str = "normal",
) -> DataFrame:
    """Cosine of each answer to the answer of the ``against`` condition.

    0 when either answer is blank or there is no such answer.
    """
    base = answers.filter(F.col("condition") == against).select(
        "query_id", "seed", F.col("answer").alias("_base"), encode(F.col("answer")).alias("_bv")
    )
    joined = answers.withColumn("_v", encode(F.col("answer"))).join(
        base, ["query_id", "seed"], "left"
    )
    comparable = (strip("answer") != "") & (strip(F.coalesce("_base", F.lit(""))) != "")
    similarity = F.when(comparable, dot(F.col("_v"), F.col("_bv"))).otherwise(F.lit(0.0))
    return (
        joined.withColumn("similarity_to_normal", F.round(similarity, 6))
        .withColumn("answer_changed", F.col("similarity_to_normal") < threshold)
        .drop("_base", "_bv", "_v")
    )


def response_type(
    condition: Column,
    normal_abstained: Column,
    abstained: Column,
    similarity: Column,
    threshold: float = SIMILARITY_THRESHOLD,
) -> Column:
    return (
        F.when(condition == "normal", "reference")
        .when(normal_abstained & abstained, "both_abstain")
        .when(normal_abstained | abstained, "abstention_shift")
        .when(similarity < threshold, "content_change")
        .otherwise("both_answer_same")
    )


def with_response_type(
    rows: DataFrame, threshold: float = SIMILARITY_THRESHOLD
) -> DataFrame:
    """Type of each answer against the normal one of its (query, seed).

    A missing normal answer counts as an abstention.
    """
    normal = rows.filter(F.col("condition") == "normal").select(
        "query_id", "seed", F.col("abstained").alias("_normal")
    )
    joined = rows.join(normal, ["query_id", "seed"], "left")
    kind = response_type(
        F.col("condition"),
        F.coalesce("_normal", F.lit(True)),
        F.col("abstained"),
        F.col("similarity_to_normal"),
        threshold,
    )
    return joined.withColumn("response_type", kind).drop("_normal")


def cited_passages(answers: DataFrame) -> DataFrame:
    """Text of each cited passage; unknown ids and blank texts are dropped.

    Needs ``cited_ids``. If a list holds one id twice, the later text counts.
    """
    cited = answers.select(*KEY, F.explode("cited_ids").alias("doc_id"))
    shown = (
        answers.select(*KEY, F.posexplode("passages").alias("pos", "p"))
        .select(*KEY, "pos", F.col("p.doc_id").alias("doc_id"), F.col("p.text").alias("text"))
        .groupBy(*KEY, "doc_id")
        .agg(F.max_by("text", "pos").alias("text"))
    )
    return cited.join(shown, [*KEY, "doc_id"]).filter(strip("text") != "")


def sentence_faithfulness(
    answers: DataFrame, encode: Encode, threshold: float = SENTENCE_THRESHOLD
) -> DataFrame:
    """Share of answer sentences close to some passage, per answer key.

    No row where the answer has no sentence; 0 where no passage has text.
    """
    said = split_sentences(answers.select(*KEY, "answer")).select(
        *KEY, "pos", encode(F.col("sentence")).alias("_sv")
    )
    shown = (
        answers.select(*KEY, F.explode("passages").alias("p"))
        .filter(strip(F.col("p.text")) != "")
        .select(*KEY, encode(F.col("p.text")).alias("_pv"))
    )
    best = (
        said.join(shown, list(KEY), "left")
        .groupBy(*KEY, "pos")
        .agg(F.max(F.round(dot(F.col("_sv"), F.col("_pv")), 6)).alias("best"))
    )
    supported = F.coalesce(F.col("best") >= threshold, F.lit(False)).cast("double")
    return best.groupBy(*KEY).agg(F.avg(supported).alias("sentence_faithfulness"))


def citation_support(
    answers: DataFrame, encode: Encode, threshold: float = SENTENCE_THRESHOLD
) -> DataFrame:
    """Share of cited passages with a sentence close to an answer sentence.

    Only answers that cite something have a row; 0 where no cited id resolves to
    text, NULL where the answer has no sentence. Needs ``cited_ids``.
    """
    citing = answers.filter(F.size("cited_ids") > 0)
    cited = cited_passages(citing)
    counts = cited.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_cited"))
    said = split_sentences(citing.select(*KEY, "answer")).select(
        *KEY, encode(F.col("sentence")).alias("_sv")
    )
    shown = split_sentences(cited, "text").select(
        *KEY, "doc_id", encode(F.col("sentence")).alias("_pv")
    )
    supported = (
        said.join(shown, list(KEY))
        .groupBy(*KEY, "doc_id")
        .agg(F.max(F.round(dot(F.col("_sv"), F.col("_pv")), 6)).alias("best"))
        .groupBy(*KEY)
        .agg(F.count_if(F.col("best") >= threshold).alias("n_supported"))
    )
    spoke = F.size(sentences("answer")) > 0
    rows = citing.select(*KEY, spoke.alias("_spoke")).join(counts, list(KEY), "left")
    share = F.coalesce("n_supported", F.lit(0)) / F.col("n_cited")
    value = F.when(F.col("n_cited").isNull(), F.lit(0.0)).when(F.col("_spoke"), share)
    return rows.join(supported, list(KEY), "left").select(*KEY, value.alias("citation_support"))


def grounding_rows(
    answers: DataFrame,
    encode: Encode,
    threshold: float = SIMILARITY_THRESHOLD,
    sentence_threshold: float = SENTENCE_THRESHOLD,
) -> DataFrame:
    """Fact table with one row per (query, condition, seed).

    Faithfulness and citation support are NULL where they cannot be measured:
    abstained answers, empty passage lists, nothing cited.
    """
    marked = answers.withColumn("abstained", is_abstention()).withColumn("cited_ids", cited_ids())
    measured = marked.filter(~F.col("abstained") & (F.size("passages") > 0))
    typed = with_response_type(answer_similarity(marked, encode, threshold), threshold)
    return (
        typed.join(sentence_faithfulness(measured, encode, sentence_threshold), list(KEY), "left")
        .join(citation_support(measured, encode, sentence_threshold), list(KEY), "left")
        .select(
            *KEY,
            "answer",
            "abstained",
            "similarity_to_normal",
            "answer_changed",
            "response_type",
            "sentence_faithfulness",
            "citation_support",
            "latency_ms",
        )
    )


def answer_change_ablation(
    answers: DataFrame,
    support: DataFrame,
    encode: Encode,
    against: str = "hybrid_with_rerank",
    threshold: float = SIMILARITY_THRESHOLD,
) -> DataFrame:
    """Per condition: change rate and similarity to one condition's answers."""
    compared = answer_similarity(answers, encode, threshold, against)
    return (
        compared.join(support, list(KEY), "left")
        .groupBy("condition")
        .agg(
            F.avg(F.col("answer_changed").cast("double")).alias("answer_change_rate"),
            F.avg("similarity_to_normal").alias("mean_answer_similarity"),
            F.avg("citation_support").alias("citation_support"),
            F.count(F.lit(1)).alias("n_answers"),
        )
    )
