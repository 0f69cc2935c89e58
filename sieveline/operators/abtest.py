"""A/B comparison of two arms of grounding rows, with false-discovery control.

Rows carry ``domain, arm`` (``control`` or ``treatment``), the answer key and the
measures; one comparison is made per domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.stats import cohens_d, cohens_h, effect_label, p_value, two_prop_z

_CHANGED = ("swapped_context", "random_in_domain", "shuffled_order", "corrupted_context")

# The tests of one comparison, 21 when all data exist.
TESTS = (
    [("normal", "abstained", "lower")]
    + [
        ("normal", m, "higher")
        for m in ("sentence_faithfulness", "citation_support", "similarity_to_normal")
    ]
    + [(c, "conditional_grounding_score", "higher") for c in (*_CHANGED, "no_retrieval")]
    + [(c, m, "higher") for c in _CHANGED for m in ("sentence_faithfulness", "citation_support")]
    + [(c, "abstained", "lower") for c in _CHANGED]
)
PROPORTIONS = ("abstained", "conditional_grounding_score")


def paired_merge(
    control: DataFrame, treatment: DataFrame, metric: str, keys: tuple[str, ...] = ("query_id", "seed")
) -> DataFrame:
    """Pairs of one metric matched on the keys; NULLs are dropped first."""
    left = control.filter(F.col(metric).isNotNull()).select(*keys, F.col(metric).alias(f"{metric}_c"))
    right = treatment.filter(F.col(metric).isNotNull()).select(
        *keys, F.col(metric).alias(f"{metric}_t")
    )
    return left.join(right, list(keys))


def _observations(rows: DataFrame) -> DataFrame:
    """One row per (answer, test) with a value; the untested ones are left out."""
    grounded = F.when(F.col("response_type") == "content_change", 1.0).when(
        F.col("response_type") == "both_answer_same", 0.0
    )
    values = {
        "abstained": F.col("abstained").cast("double"),
        "conditional_grounding_score": grounded,
        "sentence_faithfulness": F.col("sentence_faithfulness"),
        "citation_support": F.col("citation_support"),
        "similarity_to_normal": F.col("similarity_to_normal"),
    }
    cells = F.array(
        *[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in values.items()]
    )
    better = F.create_map(
        *[F.lit(x) for c, m, b in TESTS for x in (f"{c}|{m}", b)]
    )
    return (
        rows.select("domain", "arm", "query_id", "seed", "condition", F.explode(cells).alias("_m"))
        .select("domain", "arm", "query_id", "seed", "condition", "_m.metric", "_m.value")
        .withColumn("better_is", better[F.concat_ws("|", "condition", "metric")])
        .filter(F.col("better_is").isNotNull() & F.col("value").isNotNull())
    )


def ab_metric_stats(rows: DataFrame) -> DataFrame:
    """Test statistic, effect size and sample sizes per (domain, condition, metric).

    Proportions are compared by a pooled z. Other measures are paired on (query,
    seed) when at least two pairs exist, else compared by Welch's t. Tests
    without enough data are left out.
    """
    obs = _observations(rows)
    test = ["domain", "condition", "metric", "better_is"]
    control, treatment = F.col("arm") == "control", F.col("arm") == "treatment"

    def arm_stats(prefix: str, is_arm: Column) -> list[Column]:
        v = F.when(is_arm, F.col("value"))
        return [
            F.count(v).alias(f"n_{prefix}"),
            F.avg(v).alias(f"mean_{prefix}"),
            F.coalesce(F.var_samp(v), F.lit(0.0)).alias(f"var_{prefix}"),
            F.sum(v).alias(f"k_{prefix}"),
        ]

    arms = obs.groupBy(*test).agg(*arm_stats("c", control), *arm_stats("t", treatment))
    # Keys are unique inside an arm, so folding by key pairs the arms without a join.
    pairs = (
        obs.filter(~F.col("metric").isin(*PROPORTIONS))
        .groupBy(*test, "query_id", "seed")
        .agg(
            F.max(F.when(control, F.col("value"))).alias("c"),
            F.max(F.when(treatment, F.col("value"))).alias("t"),
        )
        .filter(F.col("c").isNotNull() & F.col("t").isNotNull())
        .groupBy(*test)
        .agg(
            F.count(F.lit(1)).alias("n_p"),
            F.avg("c").alias("mean_pc"),
            F.avg("t").alias("mean_pt"),
            F.var_samp("c").alias("var_pc"),
            F.var_samp("t").alias("var_pt"),
            F.avg(F.col("t") - F.col("c")).alias("mean_d"),
            F.stddev_samp(F.col("t") - F.col("c")).alias("sd_d"),
        )
    )
    joined = arms.join(pairs.drop("better_is"), test[:3], "left")
    is_prop = F.col("metric").isin(*PROPORTIONS)
    paired = ~is_prop & (F.coalesce("n_p", F.lit(0)) >= 2)

    def pick(pair_col: str, arm_col: str) -> Column:
        return F.when(paired, F.col(pair_col)).otherwise(F.col(arm_col))

    n_c, n_t = pick("n_p", "n_c"), pick("n_p", "n_t")
    mean_c, mean_t = pick("mean_pc", "mean_c"), pick("mean_pt", "mean_t")
    var_c, var_t = pick("var_pc", "var_c"), pick("var_pt", "var_t")
    se_c, se_t = F.col("var_c") / F.col("n_c"), F.col("var_t") / F.col("n_t")
    zero = F.lit(0.0)
    paired_se = F.nullif(F.col("sd_d") / F.sqrt(F.col("n_p").cast("double")), zero)
    infinite = F.signum(F.col("mean_d")) * F.lit(float("inf"))
    paired_t = F.when(
        (F.col("sd_d") == 0) & (F.col("mean_d") != 0), infinite
    ).otherwise(F.col("mean_d") / paired_se)
    welch_t = (F.col("mean_t") - F.col("mean_c")) / F.nullif(F.sqrt(se_c + se_t), zero)
    welch_df = (se_c + se_t) ** 2 / F.nullif(
        se_c**2 / F.nullif(F.col("n_c") - 1, F.lit(0)) + se_t**2 / F.nullif(F.col("n_t") - 1, F.lit(0)),
        zero,
    )
    z = two_prop_z(F.col("n_c"), F.col("k_c"), F.col("n_t"), F.col("k_t"))
    enough = F.when(is_prop, (F.col("n_c") > 0) & (F.col("n_t") > 0)).otherwise(
        paired | ((F.col("n_c") >= 2) & (F.col("n_t") >= 2))
    )
    return joined.filter(enough).select(
        *test,
        n_c.alias("n_control"),
        n_t.alias("n_treatment"),
        mean_c.alias("control_mean"),
        mean_t.alias("treatment_mean"),
        (mean_t - mean_c).alias("delta"),
        ((mean_t - mean_c) / F.greatest(F.abs(mean_c), F.lit(1e-9)) * 100.0).alias("relative_pct"),
        F.when(is_prop, cohens_h(mean_c, mean_t))
        .otherwise(cohens_d(mean_c, var_c, mean_t, var_t))
        .alias("effect_size"),
        F.when(is_prop, z).when(paired, paired_t).otherwise(welch_t).alias("statistic"),
        F.when(is_prop, F.lit(None).cast("double"))
        .when(paired, F.col("n_p") - 1.0)
        .otherwise(welch_df)
        .alias("dof"),
        F.when(is_prop, "z-test")
        .when(paired, "paired t-test")
        .otherwise("t-test (unpaired)")
        .alias("test_type"),
    )


def bh_fdr(tests: DataFrame, group: tuple[str, ...] = ("domain",), p: str = "p_value") -> DataFrame:
    """Benjamini-Hochberg adjusted p within each comparison, at most 1.

    A comparison holds at most a few dozen tests, so the window is small.
    """
    ascending = Window.partitionBy(*group).orderBy(p)
    ranked = tests.withColumn("_r", F.row_number().over(ascending)).withColumn(
        "_m", F.count(F.lit(1)).over(Window.partitionBy(*group))
    )
    downward = (
        Window.partitionBy(*group)
        .orderBy(F.col("_r").desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    adjusted = F.least(F.min(F.col(p) * (F.col("_m") / F.col("_r"))).over(downward), F.lit(1.0))
    return ranked.withColumn("p_adjusted", adjusted).drop("_r", "_m")


def ab_test(rows: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Full comparison table: statistics, p, adjusted p, label, direction, tallies."""
    tested = bh_fdr(
        ab_metric_stats(rows).withColumn("p_value", p_value("statistic", "dof"))
    )
    significant = F.col("p_adjusted") < alpha
    improved = ((F.col("better_is") == "higher") & (F.col("delta") > 0)) | (
        (F.col("better_is") == "lower") & (F.col("delta") < 0)
    )
    direction = F.when(~significant, "neutral").when(improved, "improvement").otherwise("regression")
    w = Window.partitionBy("domain")

    def tally(name: str) -> Column:
        return F.count_if(F.col("direction") == name).over(w)

    return (
        tested.withColumn("significant", significant)
        .withColumn("effect", effect_label(F.col("effect_size")))
        .withColumn("direction", direction)
        .withColumn("wins", tally("improvement"))
        .withColumn("losses", tally("regression"))
        .withColumn("ties", tally("neutral"))
    )
