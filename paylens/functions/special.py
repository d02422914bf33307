"""Special functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_gamma_ratio(a: Column) -> Column:
    """Logarithm of gamma(a + 1/2) / gamma(a) for a > 0: the asymptotic series, 16 places further up."""
    steps = F.aggregate(F.sequence(F.lit(0), F.lit(15)), F.lit(0.0), lambda s, i: s + F.log((a + i) / (a + i + 0.5)))
    z = a + 16
    # fixed values: coefficients of the series
    return steps + F.log(z) / 2 - 1 / (8 * z) + 1 / (192 * z**3) - 1 / (640 * z**5) + 17 / (14336 * z**7)


def _continued_fraction(a: Column, b: Column, x: Column) -> Column:
    """The fraction of the incomplete beta function, evaluated forwards (modified Lentz); the terms needed grow with the root of a and b."""
    tiny = 1e-300
    safe = lambda v: F.when(F.abs(v) < tiny, F.lit(tiny)).otherwise(v)

    def step(s: Column, term: Column) -> Column:
        d = 1 / safe(1 + term * s["d"])
        c = safe(1 + term / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    def pair(s: Column, i: Column) -> Column:
        m = i.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        # the state of the first half is named once, not repeated in every field of the second
        return F.aggregate(F.array(even, odd), s, step)

    d = 1 / safe(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h"))
    terms = F.sequence(F.lit(1), (60 + 6 * F.sqrt(F.greatest(a, b))).cast("int"))
    return F.aggregate(terms, start, pair, lambda s: s["h"])


def student_p(t: str, df: str) -> Column:
    """Two-sided p-value of Student's t: the regularised incomplete beta function of df / (df + t**2) at (df / 2, 1 / 2)."""
    t, df = F.col(t), F.col(df)
    a, half = df / 2, F.lit(0.5)
    x, rest = df / (df + t * t), t * t / (df + t * t)
    log_beta = F.lit(0.5723649429247001) - log_gamma_ratio(a)  # log of gamma(1/2), fixed value
    front = F.exp(a * F.log(x) + F.log(F.greatest(rest, F.lit(1e-300))) / 2 - log_beta)
    low = front * _continued_fraction(a, half, x) / a
    high = 1 - front * _continued_fraction(half, a, rest) / half
    value = F.when(x < (a + 1) / (a + 2.5), low).otherwise(high)
    return F.when(t.isNull() | (df <= 0), None).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))
