"""Tail probabilities of the normal and chi-square distributions, and points of Student's t, as column expressions."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, functions as F

#: Degrees of freedom up to which the chi-square tail is a finite sum.
EXACT_DF = 1_000_000
#: Degrees of freedom up to which points of Student's t come from a table.
EXACT_T = 60
_TERMS = 80


def _erfc(z: Column) -> Column:
    """Complementary error function of z >= 0: a series of positive terms up to 2, a continued fraction beyond."""
    start = F.struct(z.alias("term"), z.alias("total"))

    def more(acc: Column, n: Column) -> Column:
        term = acc["term"] * 2.0 * z * z / (2.0 * n + 1.0)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    series = F.aggregate(F.sequence(F.lit(1), F.lit(_TERMS)), start, more, lambda acc: acc["total"])
    small = 1.0 - 2.0 / math.sqrt(math.pi) * F.exp(-z * z) * series
    depth = F.sequence(F.lit(_TERMS), F.lit(1))
    fraction = F.aggregate(depth, z, lambda acc, k: z + k / 2.0 / acc)
    return F.when(z <= 2.0, small).otherwise(F.exp(-z * z) / math.sqrt(math.pi) / fraction)


def normal_two_sided(z: Column) -> Column:
    """Probability that a standard normal value lies at least as far from zero as z; NULL for NULL."""
    return _erfc(F.abs(z) / math.sqrt(2.0))


def chi_square_tail(x: Column, df: Column) -> Column:
    """Probability of a chi-square value of x or more with df >= 1 degrees of freedom; NULL for NULL or df < 1.

    Half the degrees of freedom step up from 1/2 or 1, each step adding one term, whose logarithm is summed so that neither
    large x nor many degrees leave the range of a double. Above ``EXACT_DF`` degrees the cube root is taken as normal,
    whose error there is below 1e-6.
    """
    half = F.greatest(x, F.lit(0.0)) / 2.0
    odd = df % 2 == 1
    steps = F.when(odd, (df - 1) / 2).otherwise(df / 2 - 1).cast("int")
    # The first term is e^-h h^(1/2) / gamma(3/2) for odd degrees and e^-h h for even ones.
    at = F.when(odd, 0.5).otherwise(1.0)
    first = F.when(odd, 0.5 * F.ln(half) - math.lgamma(1.5)).otherwise(F.ln(half)) - half
    start = F.struct(first.alias("log"), F.lit(0.0).alias("total"))

    def more(acc: Column, k: Column) -> Column:
        return F.struct((acc["log"] + F.ln(half) - F.ln(at + k)).alias("log"), (acc["total"] + F.exp(acc["log"])).alias("total"))

    counted = F.when(steps > 0, F.sequence(F.lit(1), F.greatest(steps, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    added = F.aggregate(counted, start, more, lambda acc: acc["total"])
    exact = F.when(odd, _erfc(F.sqrt(half))).otherwise(F.exp(-half)) + added
    narrow = F.lit(2.0) / (9.0 * df)
    z = (F.pow(x / df, F.lit(1.0 / 3.0)) - (1.0 - narrow)) / F.sqrt(narrow)
    one_side = F.when(z >= 0, _erfc(F.abs(z) / math.sqrt(2.0)) / 2.0).otherwise(1.0 - _erfc(F.abs(z) / math.sqrt(2.0)) / 2.0)
    tail = F.when(half <= 0, 1.0).when(df <= EXACT_DF, F.least(exact, F.lit(1.0))).otherwise(one_side)
    return F.when(x.isNotNull() & (df >= 1), tail)


def _t_share(t: float, df: int) -> float:
    """Probability that a value of Student's t lies within t of zero, by its finite sum."""
    angle = math.atan2(t, math.sqrt(df))
    cos2 = math.cos(angle) ** 2
    odd = df % 2
    term, total = (math.cos(angle), 0.0) if odd else (1.0, 0.0)
    for k in range(df // 2):
        total += term
        term *= cos2 * (2 * k + 1 + odd) / (2 * k + 2 + odd)
    total *= math.sin(angle)
    return 2.0 / math.pi * (angle + total) if odd else total


def _t_point(df: int, level: float) -> float:
    low, high = 0.0, 1.0
    while _t_share(high, df) < level:
        high *= 2.0
    for _ in range(200):
        middle = (low + high) / 2.0
        low, high = (middle, high) if _t_share(middle, df) < level else (low, middle)
    return (low + high) / 2.0


def t_point(df: Column, level: float) -> Column:
    """The distance from zero within which Student's t falls with the given probability; NULL for df < 1.

    A short table up to ``EXACT_T`` degrees of freedom, beyond it the expansion about the normal point (error below 1e-7 there
    at levels up to 0.999).
    """
    z = NormalDist().inv_cdf((1.0 + level) / 2.0)
    terms = (
        (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    )
    far = F.lit(z)
    for power, term in enumerate(terms, 1):
        far = far + term / F.pow(df.cast("double"), F.lit(float(power)))
    near = F.get(F.array(*[F.lit(_t_point(k, level)) for k in range(1, EXACT_T + 1)]), (df - 1).cast("int"))
    return F.when(df < 1, None).when(df <= EXACT_T, near).otherwise(far)
