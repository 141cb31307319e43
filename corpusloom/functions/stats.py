"""Statistics as columns: intervals, tests, association measures, floors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Two-sided 95 % point of the normal distribution.
Z95 = 1.959963984540054

# Coefficients of the published rational-exponential form of the
# complementary error function (fractional error below 1.2e-7).
ERFC_TERMS = (
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
    0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
)


def half_up(c: Column, digits: int) -> Column:
    """Rounds a double half up on its scaled value, alike on every engine."""
    scale = float(10**digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def share(hits: Column, n: Column) -> Column:
    return F.when(n == 0, F.lit(0.0)).otherwise(hits / n)


def wilson(hits: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """Lower and upper bound of a share; both 0 where ``n`` is 0."""
    zz = F.lit(z * z)
    p = hits / n
    base = 1 + zz / n
    centre = (p + zz / (2 * n)) / base
    half = (F.lit(z) / base) * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))
    zero = F.lit(0.0)
    return (
        F.when(n == 0, zero).otherwise(F.greatest(zero, centre - half)),
        F.when(n == 0, zero).otherwise(F.least(F.lit(1.0), centre + half)),
    )


def erfc(x: Column) -> Column:
    """Complementary error function for ``x >= 0``."""
    t = 1 / (1 + F.lit(0.5) * x)
    poly = F.lit(ERFC_TERMS[-1])
    for term in reversed(ERFC_TERMS[:-1]):
        poly = F.lit(term) + t * poly
    return t * F.exp(-x * x + poly)


def two_proportions(h1: Column, n1: Column, h2: Column, n2: Column) -> tuple[Column, Column, Column]:
    """Difference, z and two-sided p of two shares with a pooled error.

    All null where a side has no ads; z and p null where the pooled error is 0.
    """
    nothing = F.lit(None).cast("double")
    there = (n1 > 0) & (n2 > 0)
    p1, p2 = h1 / n1, h2 / n2
    pooled = (h1 + h2) / (n1 + n2)
    error = F.sqrt(pooled * (1 - pooled) * (F.lit(1.0) / n1 + F.lit(1.0) / n2))
    z = F.when(there & (error > 0), (p2 - p1) / error).otherwise(nothing)
    return F.when(there, p2 - p1).otherwise(nothing), z, erfc(F.abs(z) / F.sqrt(F.lit(2.0)))


def floor_of(n: Column, percent: int, least: int) -> Column:
    """``max(least, ceil(percent / 100 * n))`` in whole numbers."""
    return F.greatest(F.lit(least).cast("long"), F.floor((F.lit(percent) * n + 99) / 100).cast("long"))


def lift(ab: Column, a: Column, b: Column, n: Column) -> Column:
    return (ab * n) / (a * b)


def geo_confidence(ab: Column, a: Column, b: Column) -> Column:
    return F.sqrt((ab / a) * (ab / b))


def drift_limit(delta: Column, ratio: float = 1.2, least: float = 0.02, most: float = 0.40) -> Column:
    """Allowed change of a parent's children when the corpus changes by ``delta``."""
    return F.least(F.greatest(F.lit(ratio) * delta, F.lit(least)), F.lit(most))


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)

    def norm(v: Column) -> Column:
        return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))

    return dot / (norm(a) * norm(b))
