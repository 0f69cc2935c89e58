"""Inputs that once broke operators: foreign digits, huge domains, large samples, negatives."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.functions.stats import p_value
from sieveline.operators.grounding import corrupt_text, random_ordinals
from sieveline.operators.ranking import exact_quantile


def test_digits_of_other_scripts_stay(spark):
    df = spark.createDataFrame([("rate ٣ rises 3",)], "t string")
    assert "٣" in df.select(corrupt_text(F.col("t"), F.lit(42), F.lit("k"))).first()[0]


def test_ordinals_of_a_huge_domain(spark):
    queries = spark.createDataFrame([("q", "d")], "query_id string, domain string")
    sizes = spark.createDataFrame([("d", 3_000_000_000)], "domain string, n_chunks long")
    drawn = [r.chunk_ord for r in random_ordinals(queries, sizes, [1], 5).collect()]
    assert len(set(drawn)) == 5 and all(0 <= x < 3_000_000_000 for x in drawn)


def test_draws_reach_the_last_chunk_of_a_domain_of_any_size(spark):
    n = 10**12
    queries = spark.range(3000).select(F.concat(F.lit("q"), "id").alias("query_id"), F.lit("d").alias("domain"))
    sizes = spark.createDataFrame([("d", n)], "domain string, n_chunks long")
    drawn = [r.chunk_ord for r in random_ordinals(queries, sizes, [1], 5).collect()]
    assert len(drawn) == 15_000 and min(drawn) < n / 1000 and max(drawn) > n - n / 1000
    assert 0.48 < sum(drawn) / len(drawn) / n < 0.52


def test_large_samples_have_the_normal_tail(spark):
    df = spark.createDataFrame([(2.0, 10.0**power) for power in range(3, 13)], "s double, d double")
    for r in df.select(p_value("s", "d").alias("p")).collect():
        assert r.p == pytest.approx(0.0455, abs=0.0006)


def t_two_sided(t, df):
    """P(|T| > t) by Simpson's rule on the density after x = tan(u) * sqrt(df)."""
    upper = math.atan(abs(t) / math.sqrt(df))
    log_norm = math.lgamma((df + 1) / 2) - math.lgamma(df / 2) - 0.5 * math.log(math.pi)
    u = np.linspace(upper, math.pi / 2, 20001)
    with np.errstate(divide="ignore"):
        y = np.exp(log_norm + (df - 1) * np.log(np.clip(np.cos(u), 0.0, None)))
    h = (math.pi / 2 - upper) / 20000
    return 2.0 * h / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())


def test_p_values_equal_an_integral(spark):
    rows = [(t, d) for t in (1e-6, 0.01, 0.3, 1.0, 1.96, 2.5, 4.0, 7.0, 12.0) for d in (2.0, 2.7, 5.0, 30.0, 333.3, 5e3, 9e5)]
    df = spark.createDataFrame(rows + [(-t, d) for t, d in rows], "s double, d double")
    for r in df.select("s", "d", p_value("s", "d").alias("p")).collect():
        assert r.p == pytest.approx(t_two_sided(r.s, r.d), abs=1e-8, rel=1e-5), (r.s, r.d)
    normal = spark.createDataFrame([(x / 10,) for x in range(-90, 91)], "s double")
    for r in normal.select("s", p_value(F.col("s"), F.lit(None).cast("double")).alias("p")).collect():
        assert r.p == pytest.approx(math.erfc(abs(r.s) / math.sqrt(2)), abs=1e-13, rel=1e-8), r.s


def test_quantile_of_negatives(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (-5, -3, -1, 0, 1, 3)], "g string, v double")
    assert exact_quantile(df, ["g"], "v", 0.5, "median").first()["median"] == -0.5
