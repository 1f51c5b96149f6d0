"""Upper tail of the chi-square distribution as a Column expression.

With ``h = x / 2`` the tail is a finite sum for whole degrees of freedom (Abramowitz and Stegun,
26.4.4 and 26.4.5): Poisson terms for an even number, ``erfc`` plus half-integer terms for an odd one. Above
``MOST_SUMMED`` degrees of freedom the uniform expansion of the incomplete gamma function (Temme, DLMF 8.12)
takes its place, so the work for one test never grows with the table; its error there is below 1e-7.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


MOST_SUMMED = 2000


def _erfc(z: Column) -> Column:
    """Complementary error function for ``z >= 0``: power series below 2, continued fraction above."""
    steps = F.sequence(F.lit(1), F.lit(100))
    series = F.aggregate(
        steps,
        F.struct(z.alias("term"), z.alias("total")),
        lambda acc, k: F.struct(
            (acc["term"] * 2 * z * z / (2 * k + 1)).alias("term"),
            (acc["total"] + acc["term"] * 2 * z * z / (2 * k + 1)).alias("total"),
        ),
        lambda acc: 1 - 2 / math.sqrt(math.pi) * F.exp(-z * z) * acc["total"],
    )
    fraction = F.aggregate(F.reverse(steps), z, lambda acc, k: z + k / 2 / acc)
    return F.when(z < 2, series).otherwise(F.exp(-z * z) / (math.sqrt(math.pi) * fraction))


def tail_probability(statistic: Column, dof: Column) -> Column:
    """P(X >= statistic) for a chi-square variable with ``dof`` degrees of freedom; NULL when dof is 0."""
    h = statistic.cast("double") / 2
    odd = (dof % 2) == 1
    terms = F.least(F.floor(dof / 2), F.lit(MOST_SUMMED // 2)).cast("int")
    # Even: terms i = 0 .. m-1 of h^i / i!; odd: i = 1 .. m of h^(i - 1/2) / gamma(i + 1/2).
    # Each is kept as a logarithm, so neither a large statistic nor a large dof overflows.
    half = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    first = F.when(odd, 0.5 * F.log(h) - math.log(math.sqrt(math.pi) / 2) - h).otherwise(-h)
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(terms, F.lit(1))),
        F.struct(first.alias("log"), F.lit(0.0).alias("total")),
        lambda acc, i: F.struct(
            (acc["log"] + F.log(h) - F.log(i + half)).alias("log"),
            (acc["total"] + F.when(i <= terms, F.exp(acc["log"])).otherwise(0.0)).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    p = F.when(h <= 0, F.lit(1.0)).when(odd, _erfc(F.sqrt(h)) + total).otherwise(total)
    p = F.when((h > 0) & (dof > MOST_SUMMED), _large_tail(h, dof.cast("double") / 2)).otherwise(p)
    return F.when(dof > 0, F.greatest(F.least(p, F.lit(1.0)), F.lit(0.0)))


def _large_tail(h: Column, a: Column) -> Column:
    """Q(a, h) for large ``a`` by the first two terms of the uniform expansion."""
    mu = h / a - 1
    eta = F.signum(mu) * F.sqrt(F.greatest(2 * (mu - F.log1p(mu)), F.lit(0.0)))
    # Near the mean both quotients are large and nearly equal; their difference has a power series.
    first = F.when(F.abs(eta) < 0.02, -1 / 3 + eta / 12 - 2 * eta * eta / 135).otherwise(1 / mu - 1 / eta)
    z = F.abs(eta) * F.sqrt(a / 2)
    body = F.when(eta < 0, 2 - _erfc(z)).otherwise(_erfc(z)) / 2
    return body + F.exp(-a * eta * eta / 2) / F.sqrt(2 * math.pi * a) * first
