"""What still has to be looked up, and what the next lookups would buy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.functions.text import is_mbid, normalize_isrc, track_id_from_uri
from playmart.operators.ordered import ranked

CHECKPOINTS = (100, 500, 1_000, 2_500, 5_000, 10_000, 20_000)
SECONDS_PER_CALL = 1.13


def track_totals(export: DataFrame) -> DataFrame:
    """Listening time and plays per exported track id."""
    rows = export.filter("content_type = 'track'").groupBy("content_uri").agg(
        F.coalesce(F.sum("ms_played"), F.lit(0)).alias("ms_played"), F.count(F.lit(1)).alias("plays")
    )
    named = rows.withColumn("track_id", track_id_from_uri(F.col("content_uri"))).filter(
        "track_id is not null"
    )
    return named.groupBy("track_id").agg(
        F.sum("ms_played").alias("ms_played"), F.sum("plays").alias("plays")
    )


def pending_tracks(totals: DataFrame, played: DataFrame, looked_up: DataFrame,
                   attempts: DataFrame) -> DataFrame:
    """Tracks neither described by any capture nor known not to exist."""
    settled = (
        played.select(F.col("content_id").alias("track_id"))
        .unionByName(looked_up.select(F.col("content_id").alias("track_id")))
        .unionByName(attempts.filter("status in ('ok', 'not_found')").select("track_id"))
    )
    return totals.join(settled, "track_id", "left_anti")


def order_for_resolution(pending: DataFrame) -> DataFrame:
    """Most-listened first, ties by plays, then by id: a rank over the whole table."""
    return ranked(
        pending, [F.desc("ms_played"), F.desc("plays"), F.asc("track_id")], "position",
        running_sum={"cumulative_ms": "ms_played", "cumulative_plays": "plays"},
    )


def coverage_table(
    ordered: DataFrame, all_track_ms: DataFrame, checkpoints: Sequence[int] = CHECKPOINTS
) -> DataFrame:
    """What the first N calls buy at each checkpoint below the total, and at the total.

    `all_track_ms`: one row, one column.
    """
    whole = ordered.agg(
        F.count(F.lit(1)).alias("n"), F.sum("ms_played").alias("ms"), F.sum("plays").alias("plays")
    )
    n, ms, plays = (whole.select(c).scalar() for c in ("n", "ms", "plays"))
    points = ordered.filter(F.col("position").isin(*checkpoints) | (F.col("position") == n))
    pct = lambda part, all_: F.lit(100.0) * part / F.greatest(all_, F.lit(1))
    return points.select(
        F.col("position").alias("calls"),
        pct(F.col("cumulative_ms"), ms).alias("pct_unresolved_ms"),
        pct(F.col("cumulative_plays"), plays).alias("pct_unresolved_plays"),
        pct(F.col("cumulative_ms"), all_track_ms.scalar()).alias("pct_all_track_ms"),
        (F.col("position") * SECONDS_PER_CALL / 3600).alias("hours"),
    )


def pending_isrcs(tracks: DataFrame, lookups: DataFrame) -> DataFrame:
    """Well-formed recording codes on described tracks that were never looked up."""
    named = tracks.select(normalize_isrc(F.col("isrc")).alias("isrc")).filter("isrc is not null")
    return named.distinct().join(lookups.select("isrc"), "isrc", "left_anti")


def pending_mbids(lookups: DataFrame, fetched: DataFrame) -> DataFrame:
    """Well-formed first credits of looked-up recordings whose artist was never fetched."""
    rec = lookups.select(F.explode("recordings").alias("rec"))
    first = F.get(F.col("rec")["artist-credit"], F.lit(0))["artist"]["id"].alias("artist_mbid")
    named = rec.select(first).filter(is_mbid(F.col("artist_mbid"))).distinct()
    return named.join(fetched.select("artist_mbid"), "artist_mbid", "left_anti")


def pending_artists(items: DataFrame, fetched: DataFrame, refresh: bool = False) -> DataFrame:
    """Artists credited on described tracks or their albums and never fetched; all on refresh."""
    credited = items.select(F.explode(F.concat("track_artists", "album_artists")).alias("a"))
    named = credited.select(F.col("a.id").alias("artist_id")).filter(
        "artist_id is not null"
    ).distinct()
    if refresh:
        return named
    return named.join(fetched.select("artist_id"), "artist_id", "left_anti")
