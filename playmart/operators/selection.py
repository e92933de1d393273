"""Exact quantiles per key, however many values one key holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.operators.ordered import ranked


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, fractions: Mapping[str, float]
) -> DataFrame:
    """Interpolated quantiles of a number per key, equal to `percentile` but without its buffer.

    `fractions`: output column -> fraction in [0, 1]. Rows with a NULL value do not count, a NULL key
    is a key of its own, and a key without values has no row.

    Equal values are counted before anything moves. The distinct ones are ranked by range partitions
    over (keys, value), so a key with a third of all rows spans several of them; what is then taken
    from each key are minima, combined on the map side. Nothing holds one key's values at once.
    """
    odd = [f for f in fractions.values() if not 0 <= f <= 1]
    if odd:
        raise ValueError(f"fractions must lie in [0, 1]: {odd}")
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("__v")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    order = [F.asc_nulls_first(k) for k in keys] + [F.asc("__v")]
    placed = ranked(counts, order, None, running_sum={"__upto": "__n"})
    # where each key starts in the one order, and how many rows it has
    spans = placed.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.min(F.col("__upto") - F.col("__n")).alias("__start"), F.sum("__n").alias("__rows")
    )
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    rows = placed.join(spans, same)
    reached = F.col("__upto") - F.col("__start")  # rows of the key up to and with this value

    def at(spot):
        """The value at a place counted from 0: the least one whose rows reach beyond it."""
        return F.min(F.when(reached > spot, F.col("__v")))

    picks = []
    for out, fraction in fractions.items():
        place = F.lit(float(fraction)) * (F.col("__rows") - 1)
        picks += [at(F.floor(place)).alias(f"__lo_{out}"), at(F.ceil(place)).alias(f"__hi_{out}")]
    found = rows.groupBy(*keys).agg(F.max("__rows").alias("__rows"), *picks)

    def between(out: str, fraction: float):
        place = F.lit(float(fraction)) * (F.col("__rows") - 1)
        low, high = F.col(f"__lo_{out}").cast("double"), F.col(f"__hi_{out}").cast("double")
        # equal ends stay as they are: infinity minus itself is no number
        return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place))).alias(out)

    return found.select(*keys, *[between(out, f) for out, f in fractions.items()])


def counted_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, fractions: Mapping[str, float]
) -> DataFrame:
    """The same for values that repeat: one row per key, from a count per distinct value.

    A buffer holds the distinct values of a key. Use it where they are bounded: counts of things
    (at most the square root of twice the things), ages, rounded spans.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("__v")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    return counts.groupBy(*keys).agg(
        *[F.percentile("__v", f, F.col("__n")).alias(out) for out, f in fractions.items()]
    )
