"""Two-sided p-value of a Pearson correlation."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Steps of Simpson's rule, an even number, and how many standard deviations its range covers.
STEPS, RANGE = 400, 12.0


def _integral(low: Column, high: Column, power: Column) -> Column:
    """The integral of cos(x)^power by Simpson's rule."""
    width = (high - low) / STEPS

    def term(k: Column) -> Column:
        x = low + k * width
        # log(cos(x)) from the sine, as the cosine of a small x has lost it.
        log = F.log1p(F.greatest(-F.sin(x) * F.sin(x), F.lit(-1 + 1e-16))) / 2
        weight = F.when((k == 0) | (k == STEPS), 1.0).when(k % 2 == 1, 4.0).otherwise(2.0)
        return weight * F.exp(power * log)

    places = F.sequence(F.lit(0), F.lit(STEPS))
    return F.aggregate(places, F.lit(0.0), lambda total, k: total + term(k)) * width / 3


def p_value(r: Column, n: Column) -> Column:
    """Column form: NULL without a correlation or below three rows.

    With r = sin(t) for n rows, the density of t under no correlation is proportional to
    cos(t)^(n - 3). Beyond RANGE of its deviations nothing is left of it.
    """
    power = (n - 3).cast("double")
    least = F.asin(F.least(F.abs(r), F.lit(1.0)))
    most = F.least(F.lit(math.pi / 2), F.lit(RANGE) / F.sqrt(F.greatest(power, F.lit(1.0))))
    share = _integral(least, most, power) / _integral(F.lit(0.0), most, power)
    known = r.isNotNull() & ~F.isnan(r) & (n >= 3)
    return F.when(known, F.when(least >= most, 0.0).otherwise(share))
