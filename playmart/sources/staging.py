"""One typed relation per feed: flatten, cast, rename. Lazy, so a consumer prunes what it skips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.sources import schemas

_LINEAGE = ("raw_response_id", "profile_slug", "ingested_at", "source_file")


def _feed(raw: DataFrame, feed: str) -> DataFrame:
    return raw.filter(F.col("feed") == feed).withColumnRenamed("id", "raw_response_id")


def _parsed(rows: DataFrame, schema: str, name: str) -> DataFrame:
    """The rows with their payload parsed once.

    A filter on a parsed field would be pushed down with a second parse inside it; the generator
    keeps it above the one parse.
    """
    return rows.select("*", F.explode(F.array(F.from_json("payload", schema))).alias(name))


def _has_key(payload: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(payload), key), F.lit(False))


def _credits(artists: Column) -> Column:
    return F.coalesce(artists, F.expr(f"cast(array() as array<{schemas.ARTIST_REF}>)"))


def _track_columns(track: str) -> list[Column]:
    t = F.col(track)
    album = t["album"]
    return [
        t["uri"].alias("content_uri"),
        t["id"].alias("content_id"),
        t["type"].alias("content_type"),
        t["name"].alias("content_name"),
        t["duration_ms"].alias("duration_ms"),
        t["explicit"].alias("is_explicit"),
        t["disc_number"].alias("disc_number"),
        t["track_number"].alias("track_number"),
        t["is_local"].alias("is_local"),
        t["external_ids"]["isrc"].alias("isrc"),
        album["id"].alias("album_id"),
        album["uri"].alias("album_uri"),
        album["name"].alias("album_name"),
        album["album_type"].alias("album_type"),
        album["release_date"].alias("album_release_date"),
        album["release_date_precision"].alias("album_release_date_precision"),
        album["total_tracks"].alias("album_total_tracks"),
        _credits(t["artists"]).alias("track_artists"),
        _credits(album["artists"]).alias("album_artists"),
    ]


def recently_played(raw: DataFrame) -> DataFrame:
    """One row per item of a captured page; rows without a time or a uri are no plays."""
    pages = _feed(raw, "recently_played").withColumn(
        "page", F.from_json("payload", schemas.RECENTLY_PLAYED)
    )
    items = pages.select(*_LINEAGE, F.posexplode("page.items").alias("at", "item"))
    return (
        items.filter("item.played_at is not null and item.track.uri is not null")
        .withColumn("track", F.col("item.track"))
        .select(
            *_LINEAGE,
            (F.col("at") + 1).alias("item_ordinal"),
            F.col("item.played_at").alias("played_at_utc"),
            *_track_columns("track"),
            F.col("item.context.type").alias("context_type"),
            F.col("item.context.uri").alias("context_uri"),
        )
    )


def track(raw: DataFrame) -> DataFrame:
    """One row per track lookup, shaped like a recently-played item that was never played."""
    rows = _parsed(_feed(raw, "track"), schemas.TRACK, "track")
    return rows.filter("track.uri is not null").select(
        *_LINEAGE,
        F.lit(1).alias("item_ordinal"),
        F.lit(None).cast("timestamp").alias("played_at_utc"),
        *_track_columns("track"),
    )


def artist(raw: DataFrame) -> DataFrame:
    rows = _parsed(_feed(raw, "artist"), schemas.ARTIST, "a")
    return rows.filter("a.id is not null").select(
        *_LINEAGE,
        F.col("a.id").alias("artist_id"),
        F.col("a.uri").alias("artist_uri"),
        F.col("a.name").alias("artist_name"),
        _has_key(F.col("payload"), "genres").alias("has_genres_key"),
    )


def me(raw: DataFrame) -> DataFrame:
    rows = _feed(raw, "me").withColumn("m", F.from_json("payload", schemas.ME))
    return rows.select(
        *_LINEAGE,
        F.col("m.id").alias("user_id"),
        F.col("m.display_name").alias("display_name"),
        F.col("m.country").alias("country"),
        F.col("m.product").alias("product"),
    )


def playlist(raw: DataFrame) -> DataFrame:
    pages = _feed(raw, "playlist").withColumn(
        "page", F.from_json("payload", schemas.PLAYLIST_PAGE)
    )
    rows = pages.select(*_LINEAGE, F.posexplode("page.items").alias("at", "p"))
    return rows.filter("p.id is not null").select(
        *_LINEAGE,
        F.to_date("ingested_at").alias("snapshot_date"),
        (F.col("at") + 1).alias("item_ordinal"),
        F.col("p.id").alias("playlist_id"),
        F.col("p.uri").alias("playlist_uri"),
        F.col("p.name").alias("playlist_name"),
        F.nullif(F.col("p.description"), F.lit("")).alias("description"),
        F.col("p.is_owned_by_profile").alias("is_owned_by_profile"),
        F.col("p.collaborative").alias("is_collaborative"),
        F.col("p.public").alias("is_public"),
        F.col("p.snapshot_id").alias("snapshot_id"),
        F.coalesce(F.col("p.items.total"), F.col("p.tracks.total")).alias("track_total"),
    )


def playlist_item(raw: DataFrame) -> DataFrame:
    """One row per track of a page; the page's own link names the playlist."""
    pages = _feed(raw, "playlist_item").withColumn(
        "page", F.from_json("payload", schemas.PLAYLIST_ITEM_PAGE)
    )
    entries = pages.select(
        *_LINEAGE,
        F.nullif(F.regexp_extract("page.href", r"playlists/([A-Za-z0-9]+)/", 1), F.lit("")).alias(
            "playlist_id"
        ),
        F.coalesce(F.col("page.offset"), F.lit(0)).alias("page_offset"),
        F.posexplode("page.items").alias("at", "entry"),
    ).withColumn("track", F.coalesce(F.col("entry.item"), F.col("entry.track")))
    return entries.filter("track.uri is not null").select(
        *_LINEAGE,
        F.to_date("ingested_at").alias("snapshot_date"),
        "playlist_id",
        (F.col("at") + 1).alias("item_ordinal"),
        (F.col("page_offset") + F.col("at") + 1).alias("position"),
        F.nullif(F.col("entry.added_at"), F.lit("")).cast("timestamp").alias("added_at"),
        F.col("track.uri").alias("content_uri"),
        F.col("track.type").alias("content_type"),
        F.col("track.name").alias("content_name"),
        F.col("track.album.name").alias("parent_name"),
        F.get("track.artists", F.lit(0))["name"].alias("primary_creator_name"),
        F.col("track.external_ids.isrc").alias("isrc"),
        F.col("track.duration_ms").alias("duration_ms"),
        F.col("track.is_local").alias("is_local"),
    )


def export_play_record(raw: DataFrame) -> DataFrame:
    """One row per exported play. The content type is whichever uri the record carries."""
    rec = _parsed(raw, schemas.EXPORT_RECORD, "r")
    r = F.col("r")
    track_uri, episode_uri = r["spotify_track_uri"], r["spotify_episode_uri"]
    chapter_uri = r["audiobook_chapter_uri"]
    blank = F.lit("")
    typed = rec.select(
        *[c for c in ("raw_record_id", "record_index") if c in raw.columns],
        "profile_slug",
        "source_file",
        "ingested_at",
        r["ts"].alias("ended_at_utc"),
        r["ms_played"].alias("ms_played"),
        F.when(track_uri.isNotNull(), "track")
        .when(episode_uri.isNotNull(), "episode")
        .when(chapter_uri.isNotNull(), "audiobook_chapter")
        .alias("content_type"),
        F.coalesce(track_uri, episode_uri, chapter_uri).alias("content_uri"),
        r["master_metadata_track_name"].alias("track_name"),
        r["master_metadata_album_album_name"].alias("album_name"),
        r["master_metadata_album_artist_name"].alias("album_artist_name"),
        *[
            r[name].alias(name)
            for name in (
                "episode_name", "episode_show_name", "audiobook_title", "audiobook_chapter_title"
            )
        ],
        F.nullif(r["reason_start"], blank).alias("reason_start"),
        F.nullif(r["reason_end"], blank).alias("reason_end"),
        r["skipped"].alias("was_skipped"),
        r["shuffle"].alias("was_shuffled"),
        r["offline"].alias("was_offline"),
        r["incognito_mode"].alias("was_incognito"),
        r["offline_timestamp"].alias("offline_timestamp_raw"),
        r["platform"].alias("platform"),
        r["conn_country"].alias("conn_country"),
    )
    return typed.filter("ended_at_utc is not null and content_uri is not null")


def isrc_lookup(external: DataFrame) -> DataFrame:
    rows = _feed(external, "isrc")
    return rows.select(
        "raw_response_id",
        "ingested_at",
        F.col("request_key").alias("isrc"),
        (~_has_key(F.col("payload"), "error")).alias("is_found"),
        F.from_json("payload", schemas.ISRC_LOOKUP)["recordings"].alias("recordings"),
    )


def external_artist(external: DataFrame) -> DataFrame:
    rows = _feed(external, "artist").withColumn(
        "a", F.from_json("payload", schemas.EXTERNAL_ARTIST)
    )
    return rows.select(
        "raw_response_id",
        "ingested_at",
        F.col("request_key").alias("artist_mbid"),
        (~_has_key(F.col("payload"), "error")).alias("is_found"),
        F.col("a.name").alias("artist_name"),
        F.col("a.genres").alias("genres"),
        F.col("a.tags").alias("tags"),
    )


def poll_run(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("id").alias("poll_run_id"), "profile_slug", "started_at", "finished_at", "status",
        "items_returned", F.col("raw_id").alias("raw_response_id"), "error_message",
    )


def api_access_observation(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("id").alias("api_access_observation_id"), "profile_slug", "has_stored_token",
        "observed_at",
    )


def profile_registry(rows: DataFrame) -> DataFrame:
    return rows.select("profile_slug", "household_role", "home_timezone")


def records_at(raw: DataFrame, path: str) -> DataFrame:
    """The objects at a dotted path of each payload, one row each; a lone object counts as one.

    `self` is the payload. What is not an object is dropped.
    """
    where = "$" if path == "self" else f"$.{path}"
    node = F.try_variant_get(F.parse_json("payload"), where, "variant")
    many = F.try_variant_get(F.parse_json("payload"), where, "array<variant>")
    listed = raw.withColumn("node", node).withColumn("many", many)
    listed = listed.withColumn("many", F.coalesce("many", F.array("node")))
    return (
        listed.select(*raw.columns, F.explode("many").alias("record"))
        .filter(F.schema_of_variant("record").startswith("OBJECT"))
    )
