"""Set algebra on keys and shares of a whole."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.operators.ordered import top_per_group


def missing_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of left that right does not hold."""
    return left.select(*on).distinct().join(right.select(*on), list(on), "left_anti")


def shared_keys(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.select(*on).distinct().join(right.select(*on), list(on), "left_semi")


def is_subset(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row: how many keys of left are outside right, and whether none is."""
    return missing_keys(left, right, on).agg(
        F.count(F.lit(1)).alias("outside"), (F.count(F.lit(1)) == 0).alias("is_subset")
    )


def tagged(df: DataFrame, keys: DataFrame, on: Sequence[str], flag: str) -> DataFrame:
    """`df` with a boolean telling whether its key is among `keys`; no row is added or lost."""
    known = keys.select(*on).distinct().withColumn(flag, F.lit(True))
    return df.join(known, list(on), "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def with_share(df: DataFrame, value: str, keys: Sequence[str], name: str, scale: float = 100.0) -> DataFrame:
    """`value` as a share of its group's total. The totals are aggregated, then joined back."""
    if not keys:
        whole = df.agg(F.sum(value)).scalar()
        return df.withColumn(name, F.lit(scale) * F.col(value) / F.nullif(whole, F.lit(0)))
    total = df.groupBy(*keys).agg(F.sum(value).alias("__total"))
    share = F.lit(scale) * F.col(value) / F.nullif(F.col("__total"), F.lit(0))
    return df.join(total, list(keys)).withColumn(name, share).drop("__total")


def lump_rest(
    df: DataFrame, value: Column, keys: Sequence[str], top: int, name: str, weight: str | None = None
) -> DataFrame:
    """Replace values outside each group's `top` most frequent ones by 'other'.

    Rows count once, or `weight` times where they are counts already. NULL is a value like any other
    and leads if it is frequent enough; NULL keys form a group.
    """
    labelled = df.withColumn(name, value)
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = labelled.groupBy(*keys, name).agg(n.alias("__n"))
    leaders = top_per_group(counts, keys, [F.desc("__n"), F.asc_nulls_first(name)], top, "__rank")
    fields = [*keys, name]
    known = leaders.select(*[F.col(c).alias(f"__{c}") for c in fields], F.lit(True).alias("__leads"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in fields])
    return (
        labelled.join(known, same, "left")
        .withColumn(name, F.when(F.col("__leads"), F.col(name)).otherwise(F.lit("other")))
        .drop("__leads", *[f"__{c}" for c in fields])
    )


def pair_overlaps(
    members: DataFrame, owner: str, keys: Sequence[str], pairs: DataFrame
) -> DataFrame:
    """Sizes and shared keys of the asked pairs of owners.

    `pairs` holds left_id and right_id. Each pair costs one pass over its left side and a semi join
    into its right side: no key's owners are gathered, and pairs nobody asked for are not formed.
    """
    have = members.select(F.col(owner).alias("__owner"), *keys).dropna(subset=list(keys)).distinct()
    sizes = have.groupBy("__owner").agg(F.count(F.lit(1)).alias("size"))
    side = lambda name: have.withColumnRenamed("__owner", name)
    size = lambda name, n: sizes.withColumnsRenamed({"__owner": name, "size": n})
    shared = (
        side("left_id").join(pairs, "left_id")
        .join(side("right_id"), ["right_id", *keys], "left_semi")
        .groupBy("left_id", "right_id").agg(F.count(F.lit(1)).alias("overlap"))
    )
    return (
        pairs.join(size("left_id", "left_size"), "left_id")
        .join(size("right_id", "right_size"), "right_id")
        .join(shared, ["left_id", "right_id"], "left")
        .withColumn("overlap", F.coalesce("overlap", F.lit(0)))
    )
