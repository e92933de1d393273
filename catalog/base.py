"""Registration of queries and the helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where it can be said in SQL, its oracle."""

    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


_tables: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One of the given tables; its files are listed once per session."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _tables:
        _tables[key] = spark.read.parquet(f"{d}/{name}.parquet")
    return _tables[key]


def utc(col: str) -> Column:
    """The tables store zone-less timestamps; they are read as UTC once, here."""
    return F.col(col).cast("timestamp")


def day(col: str, name: str | None = None) -> Column:
    return F.date_format(F.col(col), "yyyy-MM-dd").alias(name or col)


def stamp(col: str, name: str | None = None) -> Column:
    return F.date_format(F.col(col), "yyyy-MM-dd HH:mm:ss").alias(name or col)


def r(col: str, digits: int = 4, name: str | None = None) -> Column:
    return F.round(F.col(col).cast("double"), digits).alias(name or col)
