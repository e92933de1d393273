"""What was played: tracks, albums, artists and their identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.functions.text import content_match_key, is_mbid
from playmart.operators.ordered import latest_observation


def _with_match_key(df: DataFrame, name: str, creator: str) -> DataFrame:
    """`content_match_key` per row, folding each distinct (name, creator) once.

    Use on tables of distinct names; on raw plays call it after grouping.
    """
    return df.withColumn("content_match_key", content_match_key(F.col(name), F.col(creator)))


def _newest_with_min_key(
    rows: DataFrame, attributes: list[str], newest: list[Column], name: str, creator: str
) -> DataFrame:
    """Attributes of the newest row per uri, and the smallest match key over all its rows.

    Rows shrink to one per (uri, name, creator) before names are folded, and both results come out
    of aggregates with a map-side step, so a uri with very many rows is no burden. That step sorts
    every row, so attributes that are grouped by are not carried a second time.
    """
    carried = [a for a in attributes if a not in (name, creator)]
    packed = rows.withColumn("__a", F.struct(*carried)).withColumn("__o", F.struct(*newest))
    by_name = packed.groupBy("content_uri", name, creator).agg(
        F.max_by("__a", "__o").alias("__a"), F.max("__o").alias("__o")
    )
    whole = F.struct(*[F.col(f"__a.{a}" if a in carried else a).alias(a) for a in attributes])
    keyed = _with_match_key(by_name, name, creator).withColumn("__a", whole)
    return keyed.groupBy("content_uri").agg(
        F.max_by("__a", "__o").alias("__a"), F.min("content_match_key").alias("content_match_key")
    ).select("content_uri", "__a.*", "content_match_key")


def export_content(plays: DataFrame) -> DataFrame:
    """URI -> display attributes of its newest export record, and its order-invariant match key."""
    named = plays.select(
        "content_uri",
        "content_type",
        "ended_at_utc",
        "raw_record_id",
        F.coalesce("track_name", "episode_name", "audiobook_chapter_title").alias("content_name"),
        F.coalesce("album_name", "episode_show_name", "audiobook_title").alias("parent_name"),
        F.col("album_artist_name").alias("primary_creator_name"),
    ).filter(F.col("content_type").isin("track", "episode", "audiobook_chapter"))
    return _newest_with_min_key(
        named,
        ["content_type", "content_name", "parent_name", "primary_creator_name"],
        [F.col("ended_at_utc"), F.col("raw_record_id")],
        "content_name",
        "primary_creator_name",
    )


def playlist_content(items: DataFrame) -> DataFrame:
    return _newest_with_min_key(
        items,
        ["content_type", "content_name", "parent_name", "primary_creator_name", "duration_ms",
         "isrc"],
        [F.col("ingested_at"), -F.col("item_ordinal"), F.col("raw_response_id")],
        "content_name",
        "primary_creator_name",
    )


_TRACK = [
    "content_id", "content_type", "content_name", "duration_ms", "is_explicit", "disc_number",
    "track_number", "is_local", "isrc", "album_id", "album_name", "track_artists", "album_artists",
]


def tracks_latest(plays: DataFrame, lookups: DataFrame) -> DataFrame:
    """Newest description per track over both feeds, its smallest match key, and when it was seen."""
    seen = plays.unionByName(lookups, allowMissingColumns=True)
    creator = F.get("album_artists", F.lit(0))["name"]
    rows = seen.withColumn("__creator", creator)
    newest = [
        F.col("ingested_at"), F.col("played_at_utc"), F.col("raw_response_id"),
        -F.col("item_ordinal"),
    ]
    described = _newest_with_min_key(rows, _TRACK, newest, "content_name", "__creator")
    spans = plays.groupBy("content_uri").agg(
        F.min("played_at_utc").alias("first_seen_at"), F.max("played_at_utc").alias("last_seen_at")
    )
    # both sides have a row per content, so neither is ever a broadcast side
    return described.join(spans.hint("merge"), "content_uri", "left")


def albums_latest(plays: DataFrame, lookups: DataFrame) -> DataFrame:
    seen = plays.unionByName(lookups, allowMissingColumns=True).filter("album_id is not null")
    return latest_observation(
        seen,
        ["album_id"],
        [F.desc("ingested_at"), F.desc_nulls_last("played_at_utc"), F.desc("raw_response_id"),
         F.asc("item_ordinal")],
    ).select(
        "album_id", "album_uri", "album_name", "album_type",
        F.col("album_release_date").alias("release_date"),
        F.col("album_release_date_precision").alias("release_date_precision"),
        F.col("album_total_tracks").alias("total_tracks"),
    )


def artists_latest(plays: DataFrame, lookups: DataFrame, fetched: DataFrame) -> DataFrame:
    """Every credited artist, described by its own lookup where there is one."""
    cols = ["track_artists", "album_artists", "ingested_at", "raw_response_id"]
    seen = plays.select(*cols).unionByName(lookups.select(*cols))
    credited = seen.select(
        "ingested_at", "raw_response_id",
        F.explode(F.concat("track_artists", "album_artists")).alias("a"),
    ).filter("a.id is not null")
    order = F.struct("ingested_at", "raw_response_id", "a.name")
    named = credited.groupBy(F.col("a.id").alias("artist_id")).agg(
        F.max_by("a", order).alias("ref")
    )
    own = latest_observation(
        fetched, ["artist_id"], [F.desc("ingested_at"), F.desc("raw_response_id")]
    ).select(
        "artist_id", F.col("artist_uri").alias("own_uri"), F.col("artist_name").alias("own_name"),
        "has_genres_key", F.lit(True).alias("is_fetched"),
    )
    return named.join(own, "artist_id", "full_outer").select(
        "artist_id",
        F.coalesce("own_uri", "ref.uri").alias("artist_uri"),
        F.coalesce("own_name", "ref.name").alias("artist_name"),
        F.coalesce("is_fetched", F.lit(False)).alias("is_fetched"),
        F.coalesce("has_genres_key", F.lit(False)).alias("has_genres_key"),
    )


def content_artists(tracks: DataFrame) -> DataFrame:
    """(content, artist) with the artist's first place among the credits; the lowest is primary."""
    credits = tracks.select("content_uri", F.posexplode("track_artists").alias("at", "a")).filter(
        "a.id is not null"
    )
    placed = credits.groupBy("content_uri", F.col("a.id").alias("artist_id")).agg(
        (F.min("at") + 1).alias("artist_ordinal")
    )
    lead = tracks.select(
        "content_uri",
        (
            F.array_position(F.transform("track_artists", lambda a: a["id"].isNotNull()), True)
        ).cast("int").alias("__first"),
    )
    return placed.join(lead.hint("merge"), "content_uri").select(
        "content_uri", "artist_id", "artist_ordinal",
        (F.col("artist_ordinal") == F.col("__first")).alias("is_primary"),
    )


def unanimous(value: Column) -> Column:
    """Aggregate: the value when every non-NULL input agrees, else NULL. Needs no distinct count."""
    return F.when(F.min(value) == F.max(value), F.min(value))


def isrc_artist(lookups: DataFrame) -> DataFrame:
    """Per recording code: its newest lookup, and the external artist its recordings agree on.

    Only well-formed ids count, both for the agreement and for the answer.
    """
    newest = latest_observation(
        lookups, ["isrc"], [F.desc("ingested_at"), F.desc("raw_response_id")]
    )
    rec = newest.select("isrc", "is_found", F.explode_outer("recordings").alias("rec"))
    credits = F.col("rec")["artist-credit"]
    first = F.get(credits, F.lit(0))["artist"]["id"]
    valid = F.when(is_mbid(first), first)
    return rec.groupBy("isrc").agg(
        F.bool_or("is_found").alias("is_found"),
        F.count("rec").alias("recording_count"),
        F.count_if(F.size(credits) > 0).alias("recordings_with_credit"),
        F.count_distinct(valid).alias("distinct_primary_mbids"),
        unanimous(valid).alias("primary_artist_mbid"),
    )


def artist_external_map(
    credits: DataFrame, tracks: DataFrame, isrcs: DataFrame
) -> DataFrame:
    """Artist -> external id, reached through recording codes only; NULL when they disagree.

    Credits, codes and lookups grow with the catalogue, so none is ever a broadcast side.
    """
    code = F.upper(F.replace(F.col("isrc"), F.lit("-"), F.lit("")))
    coded = tracks.filter("isrc is not null").select("content_uri", code.alias("isrc"))
    primary = credits.filter("is_primary").join(coded.hint("merge"), "content_uri").select("artist_id", "isrc")
    mapped = primary.join(isrcs.select("isrc", "primary_artist_mbid").hint("merge"), "isrc", "left")
    mbid = F.col("primary_artist_mbid")
    return mapped.groupBy("artist_id").agg(
        F.count(F.lit(1)).alias("primary_track_isrcs"),
        F.count(mbid).alias("isrcs_resolved"),
        F.count_distinct(mbid).alias("distinct_mbids"),
        unanimous(mbid).alias("artist_mbid"),
    )


def artist_tags(responses: DataFrame) -> DataFrame:
    """(response, vocabulary, string, votes); strings nobody voted for are dropped."""
    none = F.expr("cast(array() as array<struct<name:string,count:int>>)")

    def labelled(kind: str, column: str) -> Column:
        return F.transform(
            F.coalesce(column, none),
            lambda t: F.struct(
                F.lit(kind).alias("tag_type"), t["name"].alias("tag_name"),
                t["count"].alias("vote_count"),
            ),
        )

    kinds = F.concat(labelled("genre", "genres"), labelled("tag", "tags"))
    rows = responses.filter("is_found").select(
        "raw_response_id", "artist_mbid", "ingested_at", F.explode(kinds).alias("t")
    )
    return rows.select("raw_response_id", "artist_mbid", "ingested_at", "t.*").filter(
        "tag_name is not null and vote_count > 0"
    )


def artist_genres_current(mapping: DataFrame, responses: DataFrame, tags: DataFrame) -> DataFrame:
    """The strings of the newest response of each mapped artist."""
    newest = latest_observation(
        responses, ["artist_mbid"], [F.desc("ingested_at"), F.desc("raw_response_id")]
    ).select("artist_mbid", "raw_response_id")
    known = mapping.filter("artist_mbid is not null").select("artist_id", "artist_mbid")
    return known.join(newest, "artist_mbid").join(
        tags.select("raw_response_id", "tag_type", "tag_name", "vote_count"), "raw_response_id"
    ).select("artist_id", "artist_mbid", "tag_type", "tag_name", "vote_count")
