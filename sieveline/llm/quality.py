"""Quality rules whose cutoffs bound the share of good documents they reject."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import SPACE, let, text_or_empty, words_of
from sieveline.sources.writers import stage


@dataclass(frozen=True)
class QualityConfig:
    """``risk``: the most of a stratum's good documents that all rules together may
    reject; ``doubt``: the chance that any stratum exceeds it."""

    risk: float = 0.03
    doubt: float = 0.05
    steps: int = 24
    shrink: float = 0.8
    min_good: int = 100
    max_strata: int = 500


#: Rule and its most lenient cutoff; a document is rejected if its value is above the cutoff.
RULES = {"symbols": 4.0, "shouting": 1.0, "dup_lines": 1.0, "repeats": 0.5}
#: Name of the pooled stratum; no language is called so.
POOL = "\0pool"


def measured(docs: DataFrame) -> DataFrame:
    """One row of counts per document, by functions of its whole text."""
    count_of = lambda kept: F.length(F.regexp_replace("text", kept, "")).cast("long")
    base = docs.select("doc_id", F.col("lang").alias("stratum"), F.xxhash64(text_or_empty()).alias("text_key"), text_or_empty().alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    return base.select(
        "doc_id",
        "stratum",
        "text_key",
        let(
            words_of(F.col("text")),
            lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words")),
        ).alias("w"),
        count_of(SPACE + "+").alias("word_chars"),
        count_of("[^#*$%&|<>]+").alias("n_symbols"),
        count_of("[^A-Z!]+").alias("n_shouted"),
        let(
            lines,
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("l"),
    ).select("doc_id", "stratum", "text_key", "w.*", "word_chars", "n_symbols", "n_shouted", "l.*")


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur twice or more, the first included."""
    grams = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )

    def covered(g: Column) -> Column:
        placed = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            placed,
            lambda s: F.size(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            F.filter(
                                s,
                                lambda x, j: F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False))
                                | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False)),
                            ),
                            lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2),
                        )
                    )
                )
            ),
        )

    none = F.lit(0)
    return (
        F.when(F.size(words) < 4, none)
        .otherwise(let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), none).otherwise(covered(g))))
        .cast("long")
    )


def _values() -> Column:
    """Rules and their values, one array per document."""
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    value = {
        "symbols": per("n_symbols", "n_words"),
        "shouting": per("n_shouted", "word_chars"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"),
    }
    return F.array(*(F.struct(F.lit(r).alias("rule"), value[r].cast("double").alias("value")) for r in RULES))


def _cutoff(rule: Column, step: Column, config: QualityConfig) -> Column:
    """Cutoffs fall from lenient to strict; they are fixed before any label is seen."""
    top = F.coalesce(*(F.when(rule == r, F.lit(t)) for r, t in RULES.items()))
    return top * F.pow(F.lit(config.shrink), step.cast("double"))


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """P(X <= k) for X ~ Bin(n, rate): the exact sum, scaled by logarithms.

    At or above the mean it is given as 1: no test accepts there.
    """
    odds = math.log(rate) - math.log1p(-rate)
    zero = n * math.log1p(-rate)
    summed = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1).cast("long"))),
        F.struct(zero.alias("log"), zero.alias("peak"), F.lit(1.0).alias("sum")),
        lambda s, i: F.when(i > k, s).otherwise(
            let(
                s["log"] + F.log((n - i + 1).cast("double")) - F.log(i.cast("double")) + odds,
                lambda t: F.when(
                    t > s["peak"],
                    F.struct(t.alias("log"), t.alias("peak"), (s["sum"] * F.exp(s["peak"] - t) + 1.0).alias("sum")),
                ).otherwise(
                    F.struct(t.alias("log"), s["peak"].alias("peak"), (s["sum"] + F.exp(t - s["peak"])).alias("sum"))
                ),
            )
        ),
        lambda s: F.least(F.lit(1.0), F.exp(s["peak"] + F.log(s["sum"]))),
    )
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(summed)


def risk_tests(measures: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Every tested cutoff: stratum, rule, step, cutoff, counts, p_value, certified.

    The hypothesis "good documents of this stratum are rejected by this rule more
    often than risk / rules" is tested by the exact binomial tail. A rule's
    cutoffs are tested from lenient to strict and end at the first that fails
    (fixed sequence); the doubt is divided by rules and strata (Bonferroni).
    Strata with fewer than ``min_good`` good labels, or beyond the ``max_strata``
    largest, are pooled. Of rows with one doc_id, and of equal labelled texts of a stratum, one
    counts, with the lowest label.
    """
    label = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good"))
    # A label is one trial: of several rows of its doc_id one counts, and equal texts are one text.
    row = F.struct("text_key", "stratum", "good", _values().alias("rules"))
    labelled = measures.where("NOT base_failed").join(label, "doc_id").groupBy("doc_id").agg(F.min_by(row, "text_key").alias("row"))
    held = labelled.select("row.*").groupBy("stratum", "text_key").agg(F.min("good").alias("good"), F.any_value("rules").alias("rules"))
    # One row per stratum, rule, label and first step that rejects: all later steps work on these counts.
    first = lambda x: F.size(
        F.filter(F.sequence(F.lit(0), F.lit(config.steps - 1)), lambda i: _cutoff(x["rule"], i, config) >= x["value"])
    )
    seen = stage(
        held.select("stratum", "good", F.explode("rules").alias("x"))
        .select("stratum", "good", F.col("x.rule").alias("rule"), first(F.col("x")).alias("first"))
        .groupBy("stratum", "rule", "first")
        .agg(F.sum((F.col("good") >= 1).cast("long")).alias("good"), F.sum((F.col("good") < 1).cast("long")).alias("bad")),
        "quality-holdout",
    )
    sizes = seen.where(F.col("rule") == next(iter(RULES))).groupBy("stratum").agg(F.sum("good").alias("n"))
    own = sizes.where((F.col("n") >= config.min_good) & F.col("stratum").isNotNull()).orderBy(
        F.desc("n"), "stratum"
    ).limit(config.max_strata)
    named = seen.join(own.select("stratum", F.lit(True).alias("own")), "stratum", "left").withColumn(
        "stratum", F.when(F.col("own"), F.col("stratum")).otherwise(F.lit(POOL))
    )
    dense = (
        named.groupBy("stratum", "rule")
        .agg(F.collect_list(F.struct("first", "good", "bad")).alias("seen"), F.sum("good").alias("n"), F.sum("bad").alias("n_bad"))
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(config.steps - 1))))
    )
    rejected = lambda what: F.aggregate(
        "seen", F.lit(0).cast("long"), lambda a, x: a + F.when(x["first"] <= F.col("step"), x[what]).otherwise(0)
    )
    counted = stage(
        dense.select(
            "stratum",
            "rule",
            "step",
            _cutoff(F.col("rule"), F.col("step"), config).alias("cutoff"),
            "n",
            "n_bad",
            rejected("good").alias("k"),
            rejected("bad").alias("k_bad"),
        ),
        "quality-tests",
    )
    strata = counted.agg(F.count_distinct("stratum").alias("strata")).scalar()
    upto = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return (
        counted.withColumn("p_value", binomial_tail(F.col("n"), F.col("k"), config.risk / len(RULES)))
        .withColumn("level", config.doubt / (len(RULES) * strata))
        .withColumn("certified", F.max(F.col("p_value") > F.col("level")).over(upto) == F.lit(False))
    )


def chosen_cutoffs(tests: DataFrame) -> DataFrame:
    """Of each stratum and rule, the certified cutoff that tells bad from good best.

    The share of bad documents caught less the share of good ones lost decides;
    ties go to the most lenient. Rules without a useful certified cutoff are absent.
    """
    gain = F.col("k_bad") / F.greatest("n_bad", F.lit(1)) - F.col("k") / F.greatest("n", F.lit(1))
    best = Window.partitionBy("stratum", "rule").orderBy(F.desc("gain"), "step")
    return (
        tests.where("certified")
        .withColumn("gain", gain)
        .where("gain > 0")
        .withColumn("place", F.row_number().over(best))
        .where("place = 1")
        .select("stratum", "rule", "cutoff", "n", "k", "n_bad", "k_bad", "p_value")
    )


def quality_filter(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Base rules, then rules at cutoffs that labelled documents certify per language.

    ``docs`` needs doc_id, text, lang; ``labels`` needs doc_id, quality (1 good, 0
    bad); other columns are ignored. A null text counts as empty and fails the base
    rules. A null language is a stratum of the pool. Labels without doc_id or
    quality are left out; of several labels of a doc_id the lowest counts. Rows
    with a null or repeated doc_id are judged as any other row. Without labels no
    cutoff is certified and the base rules alone decide. Texts of any length are counted
    whole. Empty tables give no rows.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, failed_rules.
    """
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measures = stage(measured(docs).withColumn("base_failed", base), "quality-measures")
    tests = stage(risk_tests(measures, labels, config), "quality-risks")
    cuts = chosen_cutoffs(tests)
    # One row with at most max_strata + 1 strata of len(RULES) cutoffs each.
    # A stratum that was tested alone and certified nothing has an empty map, not the pool's cutoffs.
    table = stage(
        tests.select("stratum").distinct()
        .join(cuts.select("stratum", "rule", "cutoff"), "stratum", "left")
        .groupBy("stratum")
        .agg(F.map_from_entries(F.collect_list(F.when(F.col("rule").isNotNull(), F.struct("rule", "cutoff")))).alias("cutoffs"))
        .groupBy()
        .agg(F.map_from_entries(F.collect_list(F.struct("stratum", "cutoffs"))).alias("table")),
        "quality-cutoffs",
    )
    own = F.coalesce(F.try_element_at("table", F.coalesce("stratum", F.lit(POOL))), F.try_element_at("table", F.lit(POOL)))
    failed = F.transform(
        F.filter("rules", lambda x: x["value"] > F.try_element_at("cutoffs", x["rule"])), lambda x: x["rule"]
    )
    return (
        measures.withColumn("table", table.scalar())
        .withColumn("cutoffs", own)
        .withColumn("rules", _values())
        .withColumn("failed_rules", F.coalesce(failed, F.array().cast("array<string>")))
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & (F.size("failed_rules") == 0)).alias("kept"),
            "failed_rules",
        )
    )
