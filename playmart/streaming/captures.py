"""Streaming form of the capture dedupe, and landing files as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playmart.operators.ordered import keep_first
from playmart.sources import schemas
from playmart.sources.generations import Generations

KEY = ["profile_slug", "content_uri", "minute"]
ORDER = ("ingested_at", "raw_response_id", "item_ordinal")


def landed_responses(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed captures as a stream of raw rows; each new file is a new micro-batch's input."""
    reader = spark.readStream.schema(schemas.RAW_RESPONSE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _earliest(items: DataFrame) -> DataFrame:
    return keep_first(items, KEY, [F.col(c).asc_nulls_last() for c in ORDER])


STORED = ("profile_slug", "play_month")


def _store(spark: SparkSession, path: str, schema: T.StructType) -> Generations:
    added = [T.StructField("minute", T.TimestampType()), T.StructField("play_month", T.StringType())]
    return Generations(spark, path, T.StructType([*schema.fields, *added]), STORED)


def start_capture_dedupe(items: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Captured plays as they stream in, with no bound on how late a play may come.

    Polls overlap, so the same play comes again. Kept plays lie by profile and month; a micro-batch
    reads the months its plays fall into, keeps the earliest capture of every play and writes those
    months under its own number, so repeated after a failure it writes the same. No state is kept
    between batches, nothing expires, and no batch looks at what it doesn't touch. `captured_plays`
    reads the result.
    """
    schema = items.schema

    def step(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        minute = F.date_trunc("minute", "played_at_utc")
        store = _store(batch.sparkSession, path, schema)
        dated = rows.withColumns({"minute": minute, "play_month": F.date_format("played_at_utc", "yyyy-MM")}).select(*store.columns)
        before = store.read_touched(number - 1, dated.select(*STORED).distinct())
        store.commit(number, _earliest(before.union(dated)))
        rows.unpersist()

    return (
        items.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def captured_plays(spark: SparkSession, path: str) -> DataFrame:
    """One row per (profile, content, minute): the earliest capture over all batches."""
    gens = _store(spark, path, T.StructType())
    newest = spark.read.option("basePath", f"{path}/data").parquet(f"{path}/data/gen={gens.latest()}")
    fields = [f for f in newest.schema.fields if f.name not in ("gen", "minute", *STORED)]
    slug = T.StructField("profile_slug", T.StringType())
    store = _store(spark, path, T.StructType([*fields, slug]))
    return store.read(store.latest()).drop("play_month")
