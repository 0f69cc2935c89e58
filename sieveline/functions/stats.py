"""Interval, effect-size and p-value expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Z95 = 1.96  # fixed value


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL where the denominator is 0."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def wilson(k: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """Wilson score interval for k of n, clipped to [0, 1]; NULL at n = 0."""
    nd = F.when(n > 0, n.cast("double"))
    p = k.cast("double") / nd
    denom = 1.0 + z * z / nd
    centre = (p + z * z / (2.0 * nd)) / denom
    margin = z * F.sqrt(p * (1.0 - p) / nd + z * z / (4.0 * nd * nd)) / denom
    low = F.when(centre.isNotNull(), F.greatest(F.lit(0.0), centre - margin))
    high = F.when(centre.isNotNull(), F.least(F.lit(1.0), centre + margin))
    return low, high


def mean_ci(mean: Column, sd: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """Normal interval of a mean; NULL below two values."""
    se = F.when(n >= 2, sd / F.sqrt(n.cast("double")))
    return mean - z * se, mean + z * se


def cohens_h(p1: Column, p2: Column) -> Column:
    def phi(p: Column) -> Column:
        return 2.0 * F.asin(F.sqrt(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))))

    return phi(p2) - phi(p1)


def cohens_d(mean_c: Column, var_c: Column, mean_t: Column, var_t: Column) -> Column:
    pooled = F.sqrt((var_c + var_t) / 2.0)
    return F.when(pooled > 1e-12, (mean_t - mean_c) / pooled).otherwise(F.lit(0.0))


def two_prop_z(n1: Column, k1: Column, n2: Column, k2: Column) -> Column:
    """Pooled two-proportion z; 0 where the standard error vanishes."""
    a, b = F.greatest(n1, F.lit(1)).cast("double"), F.greatest(n2, F.lit(1)).cast("double")
    pool = (k1 + k2).cast("double") / F.greatest(n1 + n2, F.lit(1)).cast("double")
    se = F.sqrt(F.greatest(pool * (1.0 - pool) * (1.0 / a + 1.0 / b), F.lit(0.0)))
    return F.when(se < 1e-12, F.lit(0.0)).otherwise((k2 / b - k1 / a) / F.nullif(se, F.lit(0.0)))


def effect_label(effect: Column) -> Column:
    e = F.abs(effect)
    return (
        F.when(e < 0.2, "negligible")
        .when(e < 0.5, "small")
        .when(e < 0.8, "medium")
        .otherwise("large")
    )


def _log_gamma(x: Column) -> Column:
    """Stirling's series, eight steps up; positive arguments."""
    z = x + 8.0
    series = 1.0 / (12.0 * z) - 1.0 / (360.0 * F.pow(z, F.lit(3.0))) + 1.0 / (1260.0 * F.pow(z, F.lit(5.0)))
    below = sum((F.log(x + float(i)) for i in range(8)), F.lit(0.0))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2.0 * math.pi) + series - below


def _beta_fraction(a: Column, b: Column, x: Column, steps: int = 300) -> Column:
    """Continued fraction of the incomplete beta, from its far end inwards."""
    m = F.sequence(F.lit(steps), F.lit(1), F.lit(-1))

    def term(k: Column) -> Column:
        half = F.floor(k / 2).cast("double")
        even = half * (b - half) * x / ((a + 2.0 * half - 1.0) * (a + 2.0 * half))
        odd = -(a + half) * (a + b + half) * x / ((a + 2.0 * half) * (a + 2.0 * half + 1.0))
        return F.when(k % 2 == 0, even).otherwise(odd)

    return 1.0 / F.aggregate(m, F.lit(1.0), lambda acc, k: 1.0 + term(k) / acc)


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """Regularised incomplete beta function of 0 < x < 1."""

    def side(p: Column, q: Column, y: Column) -> Column:
        log_front = _log_gamma(p + q) - _log_gamma(p) - _log_gamma(q) + p * F.log(y) + q * F.log1p(-y)
        return F.exp(log_front) * _beta_fraction(p, q, y) / p

    return F.when(x < (a + 1.0) / (a + b + 2.0), side(a, b, x)).otherwise(1.0 - side(b, a, 1.0 - x))


def _normal_tails(z: Column) -> Column:
    """P(|Z| > z): a series of positive terms near 0, a continued fraction beyond."""
    x = F.abs(z) / math.sqrt(2.0)
    terms = F.aggregate(
        F.sequence(F.lit(60), F.lit(1), F.lit(-1)), F.lit(1.0), lambda acc, n: 1.0 + acc * 2.0 * x * x / (2.0 * n + 1.0)
    )
    near = 1.0 - 2.0 / math.sqrt(math.pi) * x * F.exp(-x * x) * terms
    fraction = F.aggregate(F.sequence(F.lit(80), F.lit(1), F.lit(-1)), x, lambda acc, n: x + n / 2.0 / acc)
    return F.when(x < 2.0, near).otherwise(F.exp(-x * x) / math.sqrt(math.pi) / fraction)


def p_value(statistic: Column | str, df: Column | str) -> Column:
    """Two-sided p: normal where ``df`` is NULL or above a million, else Student's t; NULL and NaN give 1.

    Student's t is the incomplete beta function, as expressions alone.
    """
    t = F.col(statistic) if isinstance(statistic, str) else statistic
    n = F.col(df) if isinstance(df, str) else df
    normal = n.isNull() | F.isnan(n) | (n > 1e6)
    # 1 - x is t^2 / (n + t^2), and x is kept inside (0, 1).
    beyond = F.greatest(t * t / (n + t * t), F.lit(1e-300))
    student = F.least(1.0 - _beta_or_whole(beyond, n), F.lit(1.0))
    return (
        F.when(t.isNull() | F.isnan(t) | (t == 0), F.lit(1.0))
        .when(F.abs(t) == float("inf"), F.lit(0.0))
        .when(normal, F.greatest(_normal_tails(t), F.lit(0.0)))
        .otherwise(F.greatest(student, F.lit(0.0)))
    )


def _beta_or_whole(y: Column, n: Column) -> Column:
    """P(|T| < t) for y = t^2 / (n + t^2)."""
    return F.when(y > 1.0 - 1e-15, F.lit(1.0)).otherwise(incomplete_beta(F.lit(0.5), n / 2.0, y))
