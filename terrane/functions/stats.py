"""Significance of a correlation as a column expression."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson_p_value(r: Column, n: Column) -> Column:
    """Two-sided p-value of a Pearson r over n pairs under rho = 0.

    With v = n - 2 degrees of freedom and x the angle whose tangent is
    t / sqrt(v), so that sin(x) = |r| and cos(x)^2 = 1 - r^2, the Student t
    distribution's share within +-t is a finite sum of powers of cos(x): for even v
    sin(x) * (1 + 1/2 cos^2 + 1*3/(2*4) cos^4 + ...) up to cos^(v-2), for odd v
    2/pi * (x + sin(x) cos(x) * (1 + 2/3 cos^2 + 2*4/(3*5) cos^4 + ...)) up to cos^(v-2).
    NULL r or n <= 2 gives NaN.
    """
    v = (n - 2).cast("int")
    c2, s = 1 - r * r, F.abs(r)
    odd = (v % 2 == 1).cast("int")
    terms = F.floor((v - odd) / 2).cast("int")  # number of powers of cos^2

    def add(state: Column, k: Column) -> Column:
        # term k from term k - 1: (2k - 1) / 2k for even v, 2k / (2k + 1) for odd v
        ratio = (2 * k - 1 + odd) / (2 * k + odd)
        term = state["term"] * ratio * c2
        return F.struct((state["sum"] + term).alias("sum"), term.alias("term"))

    first = F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term"))
    powers = F.when(terms > 1, F.sequence(F.lit(1), terms - 1)).otherwise(F.array().cast("array<int>"))
    total = F.aggregate(powers, first, add, lambda state: state["sum"])
    total = F.when(terms > 0, total).otherwise(F.lit(0.0))
    within = F.when(odd == 0, s * total).otherwise(
        F.lit(2 / math.pi) * (F.asin(F.least(s, F.lit(1.0))) + s * F.sqrt(F.greatest(c2, F.lit(0.0))) * total))
    p = F.greatest(F.lit(0.0), 1 - within)
    return F.when(r.isNull() | F.isnan(r) | n.isNull() | (n <= 2), F.lit(float("nan"))).otherwise(
        F.when(s >= 1, F.lit(0.0)).otherwise(p))
