"""Hours on a 24-hour circle."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from playmart.config import DAYPARTS

_TURN = 2 * math.pi / 24


def sine(hour: Column) -> Column:
    return F.sin(hour * F.lit(_TURN))


def cosine(hour: Column) -> Column:
    return F.cos(hour * F.lit(_TURN))


def mean_hour(sine_sum: Column, cosine_sum: Column) -> Column:
    """Clock hour of a summed direction; NULL when the parts cancel out."""
    hour = F.pmod(F.atan2(sine_sum, cosine_sum) / F.lit(_TURN), F.lit(24.0))
    return F.when((sine_sum != 0) | (cosine_sum != 0), hour)


def circular_mean_hour(hour: Column, weight: Column | None = None) -> Column:
    """Aggregate: 23:00 and 01:00 average to midnight."""
    w = F.lit(1.0) if weight is None else weight.cast("double")
    return mean_hour(F.sum(w * sine(hour)), F.sum(w * cosine(hour)))


def hour_difference(a: Column, b: Column) -> Column:
    """Signed shortest way from b to a, in [-12, 12)."""
    return F.pmod(a - b + F.lit(12.0), F.lit(24.0)) - F.lit(12.0)


def daypart(hour: Column) -> Column:
    name = F.lit(DAYPARTS[0][1])
    for start, part in DAYPARTS[1:]:
        name = F.when(hour >= start, part).otherwise(name)
    return F.when(hour.isNotNull(), name)
