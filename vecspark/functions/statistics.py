"""Tail probabilities as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: From here on Student's t is the normal distribution to seven digits.
MAX_DEGREES = 4_000_000.0
#: Terms of the continued fraction; about the square root of the degrees of freedom are needed.
TERMS = 2_500
_TINY = 1e-300


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function of positive numbers, by Stirling's series at ``z + 8``."""
    shifted = z + 8
    series = F.lit(0.0)
    for power, factor in ((1, 12), (3, -360), (5, 1260), (7, -1680)):
        series = series + 1 / (factor * F.pow(shifted, F.lit(power)))
    stirling = (shifted - 0.5) * F.log(shifted) - shifted + 0.5 * math.log(2 * math.pi) + series
    product = z
    for i in range(1, 8):
        product = product * (z + i)
    return stirling - F.log(product)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, by Lentz's method."""

    def away(v: Column) -> Column:
        return F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)

    def step(s: Column, factor: Column) -> Column:
        d = 1 / away(1 + factor * s["d"])
        c = away(1 + factor / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    def terms(s: Column, m: Column) -> Column:
        m = m.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        first = F.transform(F.array(s), lambda v: step(v, even))
        return F.get(F.transform(first, lambda v: step(v, odd)), F.lit(0))

    d = 1 / away(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, terms, lambda s: s["h"])


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """The regularised incomplete beta function."""
    front = F.exp(
        log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x)
    )
    near = front * _fraction(a, b, x) / a
    far = 1 - front * _fraction(b, a, 1 - x) / b
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(x < (a + 1) / (a + b + 2), near).otherwise(far)


def two_sided_p(t: Column, degrees: Column) -> Column:
    """How likely a t at least as far from zero is by chance; null without degrees of freedom."""
    v = F.least(degrees.cast("double"), F.lit(MAX_DEGREES))
    p = incomplete_beta(v / 2, F.lit(0.5), v / (v + t * t))
    return F.when(t.isNotNull() & (degrees > 0), p)
