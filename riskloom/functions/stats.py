"""Aggregate expressions that stay defined under ANSI mode."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both sides are present; null when one side is constant."""
    both = x.isNotNull() & y.isNotNull()
    px = F.when(both, x.cast("double"))
    py = F.when(both, y.cast("double"))
    spread = F.stddev_samp(px) * F.stddev_samp(py)
    return F.try_divide(F.covar_samp(px, py), spread)


def share(part: Column, whole: Column) -> Column:
    """part / whole as double; null when whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


# From here on the continued fraction is used, before it the series; and the terms that give full precision on both sides.
_CROSSING, _TERMS = 2.5, 120


def erfc(x: Column) -> Column:
    """Complementary error function of a double that is at least 0, to about 12 digits; null stays null."""
    down = F.lit(list(range(_TERMS, 0, -1)))
    square = x * x
    bell = F.exp(-square)
    series = F.aggregate(down, F.lit(1.0), lambda acc, n: 1 + acc * 2 * square / (2 * n + 1))
    below = 1 - 2 / math.sqrt(math.pi) * x * bell * series
    # Written with max(x, crossing), so that the branch that is not taken divides by no zero.
    far = F.greatest(x, F.lit(_CROSSING))
    fraction = F.aggregate(down, F.lit(0.0), lambda acc, n: n / 2 / (far + acc))
    above = bell / math.sqrt(math.pi) / (far + fraction)
    return F.when(x < _CROSSING, below).when(x.isNotNull(), above)
