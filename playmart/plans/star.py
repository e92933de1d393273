"""The dimensional star: dimensions with their unknown members, bridges, and the two facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.config import HISTORY_EPOCH, SETTINGS
from playmart.functions.clock import daypart
from playmart.functions.keys import attribute_hash, play_event_key
from playmart.operators.ordered import dense_surrogate, keep_first, latest_observation
from playmart.operators.versions import version_starts, with_epoch
from playmart.session import small_table


def with_members(df: DataFrame, *members: dict) -> DataFrame:
    """The dimension plus fixed members; columns a member does not name are NULL."""
    rows = [tuple(m.get(c) for c in df.columns) for m in members]
    typed = small_table(df.sparkSession, rows, df.schema)
    return df.unionByName(typed)


def dim_date(spark: SparkSession, end: str, start: str = HISTORY_EPOCH) -> DataFrame:
    days = spark.range(1).select(
        F.explode(F.expr(f"sequence(date'{start}', date'{end}', interval 1 day)")).alias("full_date")
    )
    d = F.col("full_date")
    weekday = F.extract(F.lit("DAYOFWEEK_ISO"), d).cast("int")
    calendar = days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.trunc(d, "month").alias("month_start"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week_iso"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.weekofyear(d).alias("iso_week"),
        F.extract(F.lit("YEAROFWEEK"), d).cast("int").alias("iso_year"),
        (weekday >= 6).alias("is_weekend"),
    )
    return with_members(calendar, {"date_key": -1})


def dim_time_of_day(spark: SparkSession) -> DataFrame:
    minutes = spark.range(1440).select(F.col("id").cast("int").alias("m"))
    hour, minute = F.floor(F.col("m") / 60).cast("int"), F.col("m") % 60
    times = minutes.select(
        (hour * 100 + minute).alias("time_of_day_key"), hour.alias("hour"),
        minute.alias("minute"), daypart(hour).alias("daypart"),
    )
    return with_members(times, {"time_of_day_key": -1, "daypart": "unknown"})


def dim_content(
    tracks: DataFrame, export: DataFrame, playlist: DataFrame, plays: DataFrame
) -> DataFrame:
    """One row per uri, described by the best source that has it: API, then export, then playlist.

    The three sources are ranked rather than anti-joined: one aggregate per uri picks the winner and
    the smallest match key over every source.
    """
    cols = ["content_uri", "content_type", "content_name", "parent_name", "primary_creator_name",
            "duration_ms", "content_match_key"]
    best = [
        tracks.withColumn("parent_name", F.col("album_name")).withColumn(
            "primary_creator_name", F.get("album_artists", F.lit(0))["name"]
        ).select(*cols, F.lit(1).alias("source_rank")),
        export.withColumn("duration_ms", F.lit(None).cast("int")).select(
            *cols, F.lit(2).alias("source_rank")
        ),
        playlist.select(*cols, F.lit(3).alias("source_rank")),
    ]
    stacked = best[0].unionByName(best[1]).unionByName(best[2])
    shown = F.struct(*[c for c in cols if c not in ("content_uri", "content_match_key")])
    merged = stacked.groupBy("content_uri").agg(
        F.min_by(shown, "source_rank").alias("shown"),
        F.min("source_rank").alias("source_rank"),
        F.min("content_match_key").alias("content_match_key"),
    )
    seen = plays.groupBy("content_uri").agg(
        F.min("ended_at_utc").alias("first_seen_at"), F.max("ended_at_utc").alias("last_seen_at")
    )
    rows = merged.join(seen, "content_uri", "left").select(
        "content_uri", "shown.*", (F.col("source_rank") == 1).alias("is_resolved"),
        "first_seen_at", "last_seen_at", "content_match_key",
    )
    keyed = dense_surrogate(
        rows, [F.asc_nulls_last("first_seen_at"), F.asc("content_uri")], "content_key"
    )
    return with_members(
        keyed,
        {"content_key": -1, "content_uri": "(absent)", "content_type": "unknown",
         "content_name": "Unknown content", "is_resolved": False},
        {"content_key": -2, "content_uri": "(pending)", "content_type": "unknown",
         "content_name": "Pending resolution", "is_resolved": False},
    )


def dim_album(albums: DataFrame) -> DataFrame:
    keyed = dense_surrogate(albums, [F.asc("album_id")], "album_key")
    return with_members(
        keyed, {"album_key": -1, "album_id": "(unknown)", "album_name": "Unknown album"}
    )


def dim_track_detail(tracks: DataFrame, content: DataFrame, albums: DataFrame) -> DataFrame:
    keyed = tracks.join(content.select("content_key", "content_uri"), "content_uri").join(
        albums.select("album_key", "album_id"), "album_id", "left"
    )
    return keyed.select(
        "content_key", F.coalesce("album_key", F.lit(-1)).alias("album_key"), "isrc",
        "is_explicit", "disc_number", "track_number", "is_local",
    )


def genre_signatures(tags: DataFrame) -> DataFrame:
    """The set of strings of a response as one text; votes are not part of it."""
    entry = F.concat_ws(":", "tag_type", "tag_name")
    # one response is one JSON document, so its set is bounded by the document
    return tags.groupBy("raw_response_id").agg(
        F.array_join(F.array_sort(F.collect_set(entry)), "|").alias("genre_signature")
    )


def dim_artist(
    artists: DataFrame, mapping: DataFrame, responses: DataFrame, tags: DataFrame,
    epoch: str = HISTORY_EPOCH,
) -> DataFrame:
    """Type 2 on the set of genre strings; the name is current on every version."""
    known = mapping.filter("artist_mbid is not null").select("artist_id", "artist_mbid")
    seen = (
        responses.select("artist_mbid", "raw_response_id", "ingested_at")
        .join(known, "artist_mbid")
        .join(genre_signatures(tags), "raw_response_id", "left")
        .withColumn("genre_signature", F.coalesce("genre_signature", F.lit("")))
    )
    spans = with_epoch(
        version_starts(
            seen, "artist_id", ["ingested_at", "raw_response_id"], "genre_signature",
            F.trunc("ingested_at", "month"),
        ),
        epoch,
    ).select(
        "artist_id",
        F.when(F.col("genre_signature") != "", "musicbrainz").alias("genre_source"),
        F.col("artist_mbid").alias("musicbrainz_artist_id"),
        F.col("raw_response_id").alias("genre_raw_response_id"),
        F.col("ingested_at").alias("genre_observed_at"),
        "valid_from", "valid_to", "is_current",
    )
    start = F.to_timestamp(F.lit(epoch))
    rows = artists.select("artist_id", "artist_uri", "artist_name").join(
        spans, "artist_id", "left"
    ).withColumns(
        {
            "valid_from": F.coalesce("valid_from", start),
            "is_current": F.coalesce("is_current", F.lit(True)),
        }
    )
    keyed = dense_surrogate(rows, [F.asc("artist_id"), F.asc("valid_from")], "artist_key")
    return with_members(
        keyed,
        {"artist_key": -1, "artist_id": "(unknown)", "artist_name": "Unknown artist",
         "valid_from": epoch, "is_current": True},
    )


PLAYLIST_TRACKED = ("playlist_name", "description", "is_owned_by_profile", "is_collaborative",
                    "is_public", "track_total")


def dim_playlist(pages: DataFrame) -> DataFrame:
    """Type 2 on a digest of the tracked attributes."""
    one = keep_first(
        pages, ["playlist_id", "ingested_at"], [F.asc("item_ordinal"), F.asc("raw_response_id")]
    )
    hashed = one.withColumn("__hash", attribute_hash(*[F.col(c) for c in PLAYLIST_TRACKED]))
    spans = version_starts(
        hashed, "playlist_id", ["ingested_at"], "__hash", F.trunc("ingested_at", "month")
    )
    rows = spans.select(
        "playlist_id", "playlist_uri", *PLAYLIST_TRACKED[:5], "snapshot_id", "track_total",
        "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"),
    )
    keyed = dense_surrogate(rows, [F.asc("playlist_id"), F.asc("valid_from")], "playlist_key")
    return with_members(
        keyed,
        {"playlist_key": -1, "playlist_id": "(unknown)", "playlist_name": "Unknown playlist",
         "is_current": False},
    )


def dim_profile(
    registry: DataFrame, me: DataFrame, tokens: DataFrame, polls: DataFrame, export: DataFrame
) -> DataFrame:
    on = "profile_slug"
    person = latest_observation(
        me, [on], [F.desc("ingested_at"), F.desc("raw_response_id")]
    ).select(on, "display_name", "user_id")
    token = latest_observation(
        tokens, [on], [F.desc("observed_at"), F.desc("api_access_observation_id")]
    ).select(on, "has_stored_token")
    first_ok = polls.filter("status = 'ok'").groupBy(on).agg(
        F.min("finished_at").alias("api_coverage_start")
    )
    span = export.groupBy(on).agg(
        F.min("ended_at_utc").alias("export_coverage_start"),
        F.max("ended_at_utc").alias("export_coverage_end"),
    )
    joined = registry
    for side in (person, token, first_ok, span):
        joined = joined.join(side, on, "left")
    access = F.coalesce("has_stored_token", F.lit(False)) & F.col("api_coverage_start").isNotNull()
    rows = joined.select(
        on, "display_name", "user_id", "household_role", "home_timezone",
        access.alias("has_api_access"), "export_coverage_start", "export_coverage_end",
        "api_coverage_start",
    )
    keyed = dense_surrogate(rows, [F.asc(on)], "profile_key")
    return with_members(
        keyed,
        {"profile_key": -1, on: "(unknown)", "display_name": "Unknown profile",
         "has_api_access": False},
    )


def dim_genre(tags: DataFrame) -> DataFrame:
    seen = tags.select("tag_type", F.col("tag_name").alias("genre_name")).distinct()
    keyed = dense_surrogate(
        seen.withColumn("genre_source", F.lit("musicbrainz")),
        [F.asc("tag_type"), F.asc("genre_name")], "genre_key",
    )
    return with_members(
        keyed, {"genre_key": -1, "genre_name": "(unknown)", "tag_type": "unknown"}
    )


def dim_genre_bucket(seed: DataFrame) -> DataFrame:
    return seed.select(
        F.col("bucket_order").alias("genre_bucket_key"), "bucket_name", "bucket_order"
    )


def is_qualified(ms: Column, duration: Column) -> Column:
    """30 seconds or half the item; a play without a duration never counts."""
    long = ms >= SETTINGS.qualified_ms
    return F.coalesce(long | (ms >= duration * SETTINGS.qualified_share), F.lit(False))


_FACT = ["ms_played", "is_ms_played_imputed", "reason_start", "reason_end", "was_skipped",
         "was_shuffled", "was_offline", "platform", "conn_country", "source_system", "source_file"]


def fct_play_event(plays: DataFrame, profiles: DataFrame, content: DataFrame) -> DataFrame:
    """One row per play. Dates and minutes are the profile's own; a failed lookup points at -1."""
    who = profiles.filter("profile_key > 0").select("profile_key", "profile_slug", "home_timezone")
    what = content.filter("content_key > 0").select(
        "content_key", "content_uri", F.col("duration_ms").alias("__duration")
    )
    # contents grow with the catalogue, so they are never a broadcast side
    rows = plays.join(who, "profile_slug", "left").join(what.hint("merge"), "content_uri", "left")
    local = F.from_utc_timestamp("ended_at_utc", F.col("home_timezone"))
    unknown = F.lit(-1)
    return rows.select(
        play_event_key(F.col("profile_slug"), F.col("content_uri"), F.col("ended_at_utc")).alias(
            "play_event_key"
        ),
        F.coalesce("profile_key", unknown).alias("profile_key"),
        F.coalesce("content_key", unknown).alias("content_key"),
        F.coalesce(
            F.year(local) * 10_000 + F.month(local) * 100 + F.dayofmonth(local), unknown
        ).alias("date_key"),
        F.coalesce(F.hour(local) * 100 + F.minute(local), unknown).alias("time_of_day_key"),
        "ended_at_utc",
        is_qualified(F.col("ms_played"), F.col("__duration")).alias("is_qualified_play"),
        *_FACT,
    )


def fct_playlist_membership(
    items: DataFrame, playlists: DataFrame, content: DataFrame
) -> DataFrame:
    """One row per (snapshot, playlist, uri) at its lowest position; always the current version."""
    first = keep_first(
        items, ["snapshot_date", "playlist_id", "content_uri"],
        [F.asc("position"), F.asc("raw_response_id")],
    )
    current = playlists.filter("is_current").select("playlist_key", "playlist_id")
    known = content.select("content_key", "content_uri")
    return first.join(current, "playlist_id", "left").join(known, "content_uri", "left").select(
        "snapshot_date", F.coalesce("playlist_key", F.lit(-1)).alias("playlist_key"), "content_key",
        "content_uri", "position", "added_at", "content_name", "primary_creator_name", "isrc",
        "is_local",
    )


def br_content_artist(credits: DataFrame, content: DataFrame, artists: DataFrame) -> DataFrame:
    """The primary artist carries a play whole; featured artists are listed with weight 0."""
    now = artists.filter("is_current").select("artist_key", "artist_id")
    known = content.select("content_key", "content_uri").hint("merge")
    joined = credits.join(known, "content_uri").join(now, "artist_id")
    return joined.select(
        "content_key", "artist_key", "is_primary",
        F.when(F.col("is_primary"), F.lit(1.0)).otherwise(F.lit(0.0)).alias("weight_factor"),
        "artist_ordinal",
    )


def br_artist_genre(artists: DataFrame, tags: DataFrame, genres: DataFrame) -> DataFrame:
    """1/N inside one (artist version, vocabulary); the vocabularies never share a denominator."""
    versions = artists.filter("genre_raw_response_id is not null").select(
        "artist_key", F.col("genre_raw_response_id").alias("raw_response_id")
    )
    rows = versions.join(tags, "raw_response_id").select(
        "artist_key", "tag_type", F.col("tag_name").alias("genre_name"), "vote_count"
    )
    on = ["artist_key", "tag_type"]
    size = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    return (
        rows.join(size, on)
        .join(genres.select("genre_key", "genre_name", "tag_type"), ["genre_name", "tag_type"])
        .select(
            "artist_key", "genre_key", "tag_type", "vote_count",
            (F.lit(1.0).cast("double") / F.col("__n")).alias("weight_factor"),
        )
    )
