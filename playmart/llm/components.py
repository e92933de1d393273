"""Connected components by alternating large-star and small-star steps over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import Stored, stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.join(least, "a").filter("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(edges: DataFrame, rounds: int = 60) -> Stored:
    """Label every node that has an edge with the smallest node of its component.

    `edges`: columns a, b (long), any order, repeats and loops allowed. Returns stored rows
    (node, label), nodes that are their own label left out. Every round groups and joins, never
    gathers a component, and is stored in the shared folder, so its lineage stays one round long.
    The number of rounds grows with the logarithm of the longest path. An empty table gives an
    empty table; a bound of `rounds` that is reached raises.
    """
    now = stored(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    mark = _mark(now.rows)
    for _ in range(rounds):
        if not mark[0]:
            break
        new = stored(_small_star(_large_star(now.rows)), "edges")
        now.drop()
        now, before, mark = new, mark, _mark(new.rows)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return Stored(now.rows.select(F.col("a").alias("node"), F.col("b").alias("label")), now.path)
