"""From plays to genre buckets, naming at every step the time that could not be carried on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.config import MS_PER_HOUR, OTHER_BUCKET, SETTINGS

STEPS = ("total_listening", "music", "artist_identified", "genre_allocated")


def residual_names(tag_type: str) -> tuple[str | None, ...]:
    """What each step loses. Reports match on them."""
    return (
        None,
        "not_music (episodes, audiobook chapters and unknown content)",
        "primary_artist_unidentified (track not yet resolved to a primary artist id)",
        f"unclassified (primary artist has no MusicBrainz {tag_type})",
    )


def _steps(depth: Column, tag_type: str) -> Column:
    """One struct per step; `depth` is how many steps the play survives (1..4)."""
    names = residual_names(tag_type)
    return F.array(
        *[
            F.struct(
                F.lit(n).alias("step_number"),
                F.lit(STEPS[n - 1]).alias("step_name"),
                F.lit(names[n - 1]).cast("string").alias("residual_name"),
                (depth >= n).alias("kept"),
                (depth == n - 1).alias("lost"),
            )
            for n in range(1, 5)
        ]
    )


def play_depth(plays: DataFrame, primary: DataFrame, with_genre: DataFrame) -> DataFrame:
    """Plays per content with the number of steps they survive. `primary`: content_uri -> artist_id.

    How far a play gets hangs on its content alone, so plays collapse to one row per (profile,
    content) with n, ms and timed before anything is joined.
    """
    grouped = plays.groupBy("profile_slug", "content_uri", "content_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ms_played").alias("ms"), F.count("ms_played").alias("timed")
    )
    rows = grouped.join(primary.select("content_uri", "artist_id"), "content_uri", "left")
    known = with_genre.select("artist_id").distinct().withColumn("has_genre", F.lit(True))
    music = F.coalesce(F.col("content_type") == "track", F.lit(False))
    identified = music & F.col("artist_id").isNotNull()
    depth = (
        F.when(identified & F.col("has_genre").isNotNull(), 4)
        .when(identified, 3).when(music, 2).otherwise(1)
    )
    return rows.join(known, "artist_id", "left").withColumn("depth", depth)


def allocation_reconciliation(
    plays: DataFrame, primary: DataFrame, with_genre: DataFrame, tag_type: str = SETTINGS.tag_type
) -> DataFrame:
    """Four nested steps per profile, each with its count, time and named loss.

    Plays collapse to one row per (profile, depth) first; the four steps are read off that.
    """
    small = play_depth(plays, primary, with_genre).groupBy("profile_slug", "depth").agg(
        F.sum("n").alias("n"), F.sum("ms").alias("ms"), F.sum("timed").alias("timed"),
    )
    steps = small.select("*", F.explode(_steps(F.col("depth"), tag_type)).alias("s"))
    kept, lost = F.col("s.kept"), F.col("s.lost")
    out = steps.groupBy("profile_slug", "s.step_number", "s.step_name", "s.residual_name").agg(
        F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).alias("play_count"),
        F.sum(F.when(kept, F.col("ms"))).alias("ms_played"),
        F.coalesce(F.sum(F.when(kept, F.col("timed"))), F.lit(0)).alias("rows_with_duration"),
        F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("residual_play_count"),
        F.sum(F.when(lost, F.col("ms"))).alias("residual_ms_played"),
    )
    share = F.lit(100.0) * F.col("rows_with_duration") / F.nullif(F.col("play_count"), F.lit(0))
    return out.withColumn("pct_rows_with_duration", F.round(share, 2))


def artist_enrichment_coverage(
    plays: DataFrame, primary: DataFrame, artists: DataFrame
) -> DataFrame:
    fetched = artists.filter("is_fetched").select("artist_id", F.lit(True).alias("fetched"))
    music = (
        plays.filter("content_type = 'track'").groupBy("profile_slug", "content_uri")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(primary.select("content_uri", "artist_id"), "content_uri", "left")
        .groupBy("profile_slug", "artist_id").agg(F.sum("n").alias("n"))
        .join(fetched, "artist_id", "left")
    )
    has_id, has_object = F.col("artist_id").isNotNull(), F.col("fetched").isNotNull()
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    out = music.groupBy("profile_slug").agg(
        F.sum("n").alias("music_play_count"),
        count(has_id).alias("artist_identified_play_count"),
        count(has_object).alias("artist_object_play_count"),
        F.count("artist_id").alias("primary_artists_identified"),
        F.count_if(has_object).alias("primary_artists_with_object"),
    )
    share = F.lit(100.0) * F.col("artist_object_play_count") / F.nullif(
        F.col("artist_identified_play_count"), F.lit(0)
    )
    return out.withColumn("pct_identified_plays_with_object", F.round(share, 2))


def genre_bucket_map(genres: DataFrame, seed: DataFrame, buckets: DataFrame,
                     tag_type: str = SETTINGS.tag_type) -> DataFrame:
    """Every string of the vocabulary in exactly one bucket; an unlisted one goes to `other`."""
    wanted = genres.filter(F.col("tag_type") == tag_type).select("genre_key", "genre_name")
    listed = seed.select("genre_name", F.col("bucket_name").alias("__seed"))
    return (
        wanted.join(listed, "genre_name", "left")
        .withColumn("bucket_name", F.coalesce("__seed", F.lit(OTHER_BUCKET)))
        .join(buckets, "bucket_name")
        .select("genre_key", "genre_name", "genre_bucket_key", "bucket_name", "bucket_order",
                F.col("__seed").isNotNull().alias("is_mapped"))
    )


def genre_bucket_allocation(
    fact: DataFrame, profiles: DataFrame, dates: DataFrame, content: DataFrame,
    credits: DataFrame, artist_genres: DataFrame, bucket_map: DataFrame, artists: DataFrame,
    tag_type: str = SETTINGS.tag_type,
) -> DataFrame:
    """(profile, month, bucket, genre, artist): plays and time shared out 1/N over the genres.

    Weights hang on the artist alone, so plays are summed per (profile, month, artist) before the
    many-to-many join; the fan-out touches aggregates, never plays. Contents and credits grow with the
    catalogue and are never a broadcast side.
    """
    tracks = content.filter("content_type = 'track'").select("content_key")
    primary = credits.filter("is_primary").select("content_key", "artist_key")
    by_day = (
        fact.select("profile_key", "date_key", "content_key", "ms_played")
        .join(tracks.hint("merge"), "content_key")
        .join(primary.hint("merge"), "content_key")
        .groupBy("profile_key", "date_key", "artist_key")
        .agg(F.count(F.lit(1)).alias("n"), F.count("ms_played").alias("timed"),
             F.sum("ms_played").alias("ms"))
    )
    by_month = (
        by_day.join(dates.select("date_key", "year", "month_start"), "date_key")
        .join(profiles.select("profile_key", "profile_slug"), "profile_key")
        .groupBy("profile_slug", "year", "month_start", "artist_key")
        .agg(F.sum("n").alias("n"), F.sum("timed").alias("timed"), F.sum("ms").alias("ms"))
    )
    weights = artist_genres.filter(F.col("tag_type") == tag_type).select(
        "artist_key", "genre_key", "weight_factor"
    ).join(bucket_map, "genre_key")
    return (
        by_month.join(weights, "artist_key")
        .join(artists.select("artist_key", "artist_name"), "artist_key", "left")
        .select(
            "profile_slug", "year", "month_start", "genre_bucket_key", "bucket_name",
            "bucket_order", "genre_key", "genre_name", "artist_key", "artist_name",
            F.col("n").alias("play_rows"),
            (F.col("n") * F.col("weight_factor")).alias("allocated_plays"),
            F.col("timed").alias("rows_with_duration"),
            (F.col("ms") * F.col("weight_factor")).alias("allocated_ms"),
        )
    )


def bucket_shares(
    allocation: DataFrame, buckets: Sequence[str], keys: Sequence[str] = ("profile_slug",)
) -> DataFrame:
    """Share of allocated time per bucket, in the fixed order; buckets with nothing are kept."""
    sums = allocation.groupBy(*keys, F.col("bucket_name").alias("bucket")).agg(
        F.sum("allocated_ms").alias("allocated_ms"),
        F.sum("allocated_plays").alias("allocated_plays"),
    )
    listed = F.array(
        *[F.struct(F.lit(n).alias("bucket_order"), F.lit(b).alias("bucket"))
          for n, b in enumerate(buckets, start=1)]
    )
    totals = sums.groupBy(*keys).agg(F.sum("allocated_ms").alias("__total"))
    frame = totals.select(*keys, "__total", F.explode(listed).alias("b")).select(
        *keys, "__total", "b.*"
    )
    share = F.lit(100.0) * F.coalesce("allocated_ms", F.lit(0.0)) / F.nullif(
        F.col("__total"), F.lit(0.0)
    )
    return frame.join(sums, [*keys, "bucket"], "left").select(
        *keys, "bucket_order", "bucket", "allocated_ms",
        (F.col("allocated_ms") / MS_PER_HOUR).alias("hours"), share.alias("share_pct"),
        F.coalesce("allocated_plays", F.lit(0.0)).alias("allocated_plays"),
    )


def trailing_months(windows: DataFrame, months: int = 12) -> DataFrame:
    """First and last month start of the last `months` calendar months of each window."""
    last = F.trunc("window_end", "month")
    return windows.select(
        "profile_slug", F.add_months(last, 1 - months).alias("first_month"),
        last.alias("last_month"),
    )


def in_months(allocation: DataFrame, span: DataFrame) -> DataFrame:
    return (
        allocation.join(span, "profile_slug")
        .filter(F.col("month_start").between(F.col("first_month"), F.col("last_month")))
        .drop("first_month", "last_month")
    )
