"""Plays of both sources merged as they arrive, however late.

The store is partitioned by profile and month of the play. Everything that decides whether a play stays
(the same end, the same minute) lies in one such partition, so a micro-batch reads and writes only the
partitions its plays fall into, and the result equals the dedupe of everything seen so far: an export
that comes months later displaces the captured plays of its minutes then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playmart.plans.events import dedupe_play_events
from playmart.sources.generations import Generations

KEYS = ("profile_slug", "play_month")


def play_store(spark: SparkSession, path: str, schema: T.StructType) -> Generations:
    """`schema`: of the play events; the month is added."""
    fields = [f for f in schema.fields if f.name != "play_month"]
    return Generations(spark, path, T.StructType([*fields, T.StructField("play_month", T.StringType())]), KEYS)


def merge_plays(store: Generations, events: DataFrame, version: int) -> None:
    """Make version `version` of the store from the one before it and `events` (both sources, any age)."""
    dated = events.withColumn("play_month", F.date_format("ended_at_utc", "yyyy-MM")).select(*store.columns)
    before = store.read_touched(version - 1, dated.select(*KEYS).distinct())
    store.commit(version, dedupe_play_events(before.union(dated)))


def start_play_merge(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merge a stream of play events (see `union_play_events`) into the store at `path`.

    A micro-batch makes the version of its own number from its predecessor's, so one that is repeated
    after a failure writes the same again. The checkpoint and the store belong together.
    """
    schema = events.schema

    def step(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        merge_plays(play_store(batch.sparkSession, path, schema), rows, number)
        rows.unpersist()

    return (
        events.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def merged_plays(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The plays of the newest version."""
    store = play_store(spark, path, schema)
    return store.read(store.latest()).drop("play_month")
