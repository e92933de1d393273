"""Play events: two overlapping sources reconciled into one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmart.config import CONTENT_TYPES
from playmart.operators.ordered import keep_first


def union_play_events(api: DataFrame, export: DataFrame) -> DataFrame:
    """Recently-played items and export records under one set of columns.

    The API tells neither duration nor flags, so those stay NULL there.
    """
    from_api = api.withColumnRenamed("played_at_utc", "ended_at_utc").select(
        "profile_slug", "content_uri", "content_type", "ended_at_utc",
        F.lit("api").alias("source_system"), "source_file", "ingested_at", "raw_response_id",
        "item_ordinal",
    )
    from_export = export.filter(F.col("content_type").isin(*CONTENT_TYPES)).select(
        "profile_slug", "content_uri", "content_type", "ended_at_utc", "ms_played",
        "reason_start", "reason_end", "was_skipped", "was_shuffled", "was_offline", "platform",
        "conn_country", F.lit("export").alias("source_system"), "source_file", "ingested_at",
        F.col("raw_record_id").alias("raw_response_id"),
        F.col("record_index").alias("item_ordinal"),
    )
    both = from_export.unionByName(from_api, allowMissingColumns=True)
    return both.withColumn("is_ms_played_imputed", F.lit(False))


def dedupe_play_events(events: DataFrame) -> DataFrame:
    """One row per play.

    Export rows are one play per exact end; API rows one per minute; an API row whose minute an
    export row holds is dropped whole. Within a key the earliest capture stays. The feed is read once.
    Keeping one row per key limits every group before its shuffle, so endless captures of one play
    cost one row per task; what is left, at most one API row and one export row per exact end, is
    looked over by minute.
    """
    minute = F.date_trunc("minute", "ended_at_utc")
    from_export = F.col("source_system") == "export"
    keyed = events.withColumn("__minute", minute).withColumn(
        "__key", F.when(from_export, F.col("ended_at_utc")).otherwise(minute)
    )
    first = keep_first(
        keyed,
        ["source_system", "profile_slug", "content_uri", "__key"],
        [F.col(c).asc_nulls_last() for c in ("ingested_at", "raw_response_id", "item_ordinal")],
    )
    same_minute = Window.partitionBy("profile_slug", "content_uri", "__minute")
    covered = F.max(from_export).over(same_minute)
    return (
        first.withColumn("__covered", covered).filter(from_export | ~F.col("__covered"))
        .drop("__minute", "__key", "__covered")
    )


def coverage_windows(plays: DataFrame, profiles: DataFrame) -> DataFrame:
    """First and last exported play per profile as local dates: the window every report keeps to."""
    spans = plays.filter("source_system = 'export'").groupBy("profile_slug").agg(
        F.min("ended_at_utc").alias("__first"), F.max("ended_at_utc").alias("__last")
    )
    zoned = spans.join(profiles.select("profile_slug", "home_timezone"), "profile_slug")
    zone = F.coalesce("home_timezone", F.lit("UTC"))
    return zoned.select(
        "profile_slug",
        F.to_date(F.from_utc_timestamp("__first", zone)).alias("window_start"),
        F.to_date(F.from_utc_timestamp("__last", zone)).alias("window_end"),
        F.col("__last").alias("export_end"),
    )
