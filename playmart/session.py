"""Session helpers: the settings every job relies on, and where lineage is cut."""

from __future__ import annotations

import tempfile

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def build_session(app: str = "playmart", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, (int, float)):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def small_table(
    spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType
) -> DataFrame:
    """A handful of fixed rows as a local relation.

    Unlike `createDataFrame` it needs no Python worker, and its exact size is known to the planner,
    so joins with it are broadcast without a hint.
    """
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    cols = ", ".join(f"cast(`{f.name}` as {f.dataType.simpleString()}) as `{f.name}`" for f in fields)
    names = ", ".join(f"`{f.name}`" for f in fields)
    if not rows:
        empty = ", ".join(f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in fields)
        return spark.sql(f"select {empty} where false")
    values = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    return spark.sql(f"select {cols} from values {values} as t({names})")


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the one setting results depend on; everything else is the cluster's business."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """For a `repartition` whose partitions must not be merged again by their compressed size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only in local mode."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="playmart-ckpt-")
    spark.sparkContext.setCheckpointDir(named)
    return named


def pinned(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder once, so a lost executor reads the same placement back."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
