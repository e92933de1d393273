"""Ordered computations that never put a whole hot group into one task.

`split_scan` cuts each key's ordered rows into chunks, scans every chunk on its own and stitches the
chunks with a table of one row per (key, chunk). `ranked` does the same for one order over the whole
table, using range partitions as the chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmart.session import pinned

_CHUNK = "__chunk"


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in `order`.

    Spark limits every group to one row before the shuffle (WindowGroupLimit), so a key holding a
    third of the table still sends one row per map task.
    """
    spot = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(spot)).filter("__rn = 1").drop("__rn")


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    spot = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(spot)).filter(F.col(rank) <= k)


def latest_observation(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]
) -> DataFrame:
    """The most recent row per key; `newest_first` must be a total order."""
    return keep_first(df, keys, newest_first)


def split_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Column,
    *,
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    running_sum: Mapping[str, str] | None = None,
    max_before: Mapping[str, str] | None = None,
    row_number: str | None = None,
) -> DataFrame:
    """lag / lead / running sum / max of earlier rows / row number per key, in `order`.

    `chunk` must not decrease along `order`; `keys`, `order` and `chunk` must not be NULL, and
    (keys, order) must be unique. The mappings are output column -> input column.
    """
    lag, lead = dict(lag or {}), dict(lead or {})
    running_sum, max_before = dict(running_sum or {}), dict(max_before or {})
    rows = df.withColumn(_CHUNK, chunk)
    spot = F.struct(*order)
    part = [*keys, _CHUNK]

    inner = Window.partitionBy(*part).orderBy(*order)
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = inner.rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*keys).orderBy(_CHUNK)
    before = across.rowsBetween(Window.unboundedPreceding, -1)

    ends, stitched, local, final = [F.count(F.lit(1)).alias("__n")], {}, {}, {}
    stitched["__base_n"] = F.coalesce(F.sum("__n").over(before), F.lit(0))
    local["__in"] = F.row_number().over(inner)
    for out, src in lag.items():
        ends.append(F.max_by(src, spot).alias(f"__last_{out}"))
        stitched[f"__prev_{out}"] = F.lag(f"__last_{out}").over(across)
        local[out] = F.lag(src).over(inner)
        final[out] = F.when(F.col("__in") == 1, F.col(f"__prev_{out}")).otherwise(F.col(out))
    for out, src in lead.items():
        ends.append(F.min_by(src, spot).alias(f"__first_{out}"))
        stitched[f"__next_{out}"] = F.lead(f"__first_{out}").over(across)
        local[out] = F.lead(src).over(inner)
        final[out] = F.when(F.col("__in") == F.col("__n"), F.col(f"__next_{out}")).otherwise(
            F.col(out)
        )
    for out, src in running_sum.items():
        ends.append(F.sum(src).alias(f"__sum_{out}"))
        stitched[f"__base_{out}"] = F.sum(f"__sum_{out}").over(before)
        local[out] = F.sum(src).over(upto)
        base = F.col(f"__base_{out}")
        final[out] = F.when(base.isNull(), F.col(out)).otherwise(
            base + F.coalesce(F.col(out), F.lit(0))
        )
    for out, src in max_before.items():
        ends.append(F.max(src).alias(f"__max_{out}"))
        stitched[f"__top_{out}"] = F.max(f"__max_{out}").over(before)
        local[out] = F.max(src).over(earlier)
        final[out] = F.greatest(F.col(out), F.col(f"__top_{out}"))
    if row_number:
        final[row_number] = (F.col("__base_n") + F.col("__in")).cast("bigint")

    edges = rows.groupBy(*part).agg(*ends).withColumns(stitched)
    edges = edges.select(*part, "__n", *stitched)
    return (
        rows.withColumns(local)
        .join(edges, part)
        .withColumns(final)
        .select(*df.columns, *final)
    )


def ranked(
    df: DataFrame,
    order: Sequence[Column],
    rank: str | None = "rank",
    *,
    running_sum: Mapping[str, str] | None = None,
    slots: int | None = None,
) -> DataFrame:
    """1..N in one order over the whole table, and running sums along it, with no one-task window.

    Rows are range-partitioned and written once, because range bounds are sampled per execution and
    a rerun must not move rows between slots. Each slot is numbered on its own and shifted by the
    totals of the slots before it; that table has one row per slot.
    """
    running_sum = dict(running_sum or {})
    by_range = df.repartitionByRange(slots, *order) if slots else df.repartitionByRange(*order)
    placed = pinned(by_range.withColumn("__slot", F.spark_partition_id()))
    before = Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("__slot").agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(src).alias(f"__sum_{out}") for out, src in running_sum.items()],
    )
    offsets = totals.select(
        "__slot",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base_n"),
        *[
            F.coalesce(F.sum(f"__sum_{out}").over(before), F.lit(0)).alias(f"__base_{out}")
            for out in running_sum
        ],
    )
    inner = Window.partitionBy("__slot").orderBy(*order)
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {"__in": F.row_number().over(inner)}
    local.update({out: F.sum(src).over(upto) for out, src in running_sum.items()})
    # one row per range partition: its size is the partition count, never the data
    out = placed.withColumns(local).join(F.broadcast(offsets), "__slot")
    final = {o: F.coalesce(F.col(o), F.lit(0)) + F.col(f"__base_{o}") for o in running_sum}
    if rank:
        final[rank] = (F.col("__in") + F.col("__base_n")).cast("bigint")
    return out.withColumns(final).select(*([rank] if rank else []), *df.columns, *running_sum)


def dense_surrogate(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """A 1..N key in the given total order, as the first column."""
    return ranked(df, order, name)


def islands(df: DataFrame, keys: Sequence[str], number: str, name: str = "island") -> DataFrame:
    """Label runs of consecutive integers per key. For small, already aggregated tables."""
    spot = Window.partitionBy(*keys).orderBy(number)
    return df.withColumn(name, F.col(number) - F.row_number().over(spot))
