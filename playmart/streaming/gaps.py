"""High-water marks and overflow gaps over a profile's captures, in batch and as a stream.

A capture frame has one row per poll: profile_slug, captured_at, oldest, newest, items_returned.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playmart.operators.ordered import split_scan
from playmart.session import small_table

PROFILE = "profile_slug"
MARKS = "profile_slug string, high_water_mark timestamp"


def captures_of(items: DataFrame) -> DataFrame:
    """Captures from staged items: the span of every landed page. Empty pages have no span."""
    return items.groupBy(PROFILE, "raw_response_id").agg(
        F.min("ingested_at").alias("captured_at"), F.min("played_at_utc").alias("oldest"),
        F.max("played_at_utc").alias("newest"), F.count(F.lit(1)).alias("items_returned"),
    )


def high_water_mark(captures: DataFrame) -> DataFrame:
    """The newest play any capture of the profile has seen."""
    return captures.filter("newest is not null").groupBy(PROFILE).agg(
        F.max("newest").alias("high_water_mark")
    )


def detect_gaps(captures: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Captures whose oldest play is newer than everything captured before.

    Equal times overlap, an empty page proves nothing, and neither does a first capture. `marks`
    carries what earlier batches had seen. A profile's captures are scanned by day, so one that owns
    most of the polls is still spread out.
    """
    seen = captures.filter("oldest is not null")
    scanned = split_scan(
        seen, [PROFILE], ["captured_at", "oldest", "newest"], F.to_date("captured_at"),
        max_before={"__before": "newest"},
    )
    before = F.col("__before")
    if marks is not None:
        scanned = scanned.join(marks.select(PROFILE, "high_water_mark"), PROFILE, "left")
        before = F.greatest(before, F.col("high_water_mark"))
    return scanned.withColumn("gap_start", before).filter("oldest > gap_start").select(
        PROFILE, "gap_start", F.col("oldest").alias("gap_end"), "items_returned",
        F.col("captured_at").alias("detected_at"),
    )


def poll_status(
    polls: DataFrame, gaps: DataFrame, marks: DataFrame, profiles: DataFrame, now: str
) -> DataFrame:
    """Per profile: last poll and its outcome, last good one, a day's polls and errors, gaps."""
    recent = F.col("finished_at") >= F.to_timestamp(F.lit(now)) - F.expr("interval 24 hour")
    ok, failed = F.col("status") == "ok", F.col("status") == "error"
    ran = polls.groupBy(PROFILE).agg(
        F.max("finished_at").alias("last_poll_at"),
        F.max_by("status", F.struct("finished_at", "poll_run_id")).alias("last_poll_status"),
        F.max(F.when(ok, F.col("finished_at"))).alias("last_ok_at"),
        F.count_if(recent).alias("polls_24h"), F.count_if(recent & failed).alias("errors_24h"),
    )
    held = gaps.groupBy(PROFILE).agg(
        F.count(F.lit(1)).alias("gap_count"),
        F.max_by(
            F.struct("gap_start", "gap_end", "items_returned"), F.struct("detected_at", "gap_end")
        ).alias("last_gap"),
    )
    out = profiles.select(PROFILE)
    for side in (ran, marks, held):
        out = out.join(side, PROFILE, "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("polls_24h", "errors_24h", "gap_count")}
    return out.withColumns(zero)


def api_access(registry: DataFrame, tokens: DataFrame, observed_at: str) -> DataFrame:
    """One observation per registered profile: does it hold a token at this moment."""
    held = tokens.select(PROFILE).distinct().withColumn("__held", F.lit(True))
    return registry.select(PROFILE).join(held, PROFILE, "left").select(
        PROFILE, F.col("__held").isNotNull().alias("has_stored_token"),
        F.to_timestamp(F.lit(observed_at)).alias("observed_at"),
    )


def run_of(checkpoint: str) -> str:
    """The name under which a checkpoint's stream keeps what it writes."""
    return "run=" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]  # noqa: S324 - a name, no secret


def start_gap_stream(
    captures: DataFrame, gaps_path: str, marks_path: str, checkpoint: str
) -> StreamingQuery:
    """Gaps of a capture stream, written per micro-batch.

    A batch reads the marks its predecessor left and writes its own gaps and marks under its own
    number, so a batch repeated after a failure overwrites exactly what it wrote before. Only the
    first batch of a checkpoint has no predecessor: marks that are missing later are an error. A new
    checkpoint reads everything again and writes beside the old results, under `run_of(checkpoint)`.
    """
    run = run_of(checkpoint)

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist()
        marks = (
            spark.read.schema(MARKS).parquet(f"{marks_path}/{run}/batch={number - 1}")
            if number else small_table(spark, [], MARKS)
        )
        detect_gaps(rows, marks).write.mode("overwrite").parquet(f"{gaps_path}/{run}/batch={number}")
        merged = marks.unionByName(high_water_mark(rows)).groupBy(PROFILE).agg(
            F.max("high_water_mark").alias("high_water_mark")
        )
        merged.write.mode("overwrite").parquet(f"{marks_path}/{run}/batch={number}")
        rows.unpersist()

    return (
        captures.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
