"""Raw captures in, star and reports' inputs out: the whole build as one lazy graph."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from playmart.config import SETTINGS
from playmart.plans import allocation, content, star
from playmart.plans.events import dedupe_play_events, union_play_events
from playmart.sources import staging


@dataclass(frozen=True)
class Raw:
    """The landed tables. `responses` and `external` hold every feed; `export` one row per record."""

    responses: DataFrame
    external: DataFrame
    export: DataFrame
    registry: DataFrame
    polls: DataFrame
    tokens: DataFrame
    bucket_seed: DataFrame
    genre_seed: DataFrame


def build(spark: SparkSession, raw: Raw, calendar_end: str,
          tag_type: str = SETTINGS.tag_type) -> dict[str, DataFrame]:
    """Every relation by name. The deduplicated plays and the bridges are kept: each has several
    consumers, and the reports come back to them."""
    played = staging.recently_played(raw.responses)
    looked_up = staging.track(raw.responses)
    export = staging.export_play_record(raw.export)
    pages = staging.playlist(raw.responses)
    items = staging.playlist_item(raw.responses)
    responses = staging.external_artist(raw.external)
    polls = staging.poll_run(raw.polls)
    tokens = staging.api_access_observation(raw.tokens)

    plays = dedupe_play_events(union_play_events(played, export)).persist()
    tracks = content.tracks_latest(played, looked_up).persist()
    credits = content.content_artists(tracks)
    artists = content.artists_latest(played, looked_up, staging.artist(raw.responses))
    isrcs = content.isrc_artist(staging.isrc_lookup(raw.external))
    mapping = content.artist_external_map(credits, tracks, isrcs).persist()
    tags = content.artist_tags(responses).persist()
    current = content.artist_genres_current(mapping, responses, tags)

    registry = staging.profile_registry(raw.registry)
    dim_profile = star.dim_profile(registry, staging.me(raw.responses), tokens, polls, export)
    dim_content = star.dim_content(
        tracks, content.export_content(export), content.playlist_content(items), plays
    )
    dim_album = star.dim_album(content.albums_latest(played, looked_up))
    dim_artist = star.dim_artist(artists, mapping, responses, tags)
    dim_playlist = star.dim_playlist(pages)
    dim_genre = star.dim_genre(tags)
    dim_bucket = star.dim_genre_bucket(raw.bucket_seed)
    dim_date = star.dim_date(spark, calendar_end)
    fact = star.fct_play_event(plays, dim_profile, dim_content)
    br_artist = star.br_content_artist(credits, dim_content, dim_artist)
    br_genre = star.br_artist_genre(dim_artist, tags, dim_genre).persist()
    bucket_map = allocation.genre_bucket_map(dim_genre, raw.genre_seed, dim_bucket, tag_type)
    primary = credits.filter("is_primary")
    with_genre = current.filter(current["tag_type"] == tag_type).select("artist_id")
    return {
        "plays": plays,
        "dim_profile": dim_profile,
        "dim_content": dim_content,
        "dim_track_detail": star.dim_track_detail(tracks, dim_content, dim_album),
        "dim_album": dim_album,
        "dim_artist": dim_artist,
        "dim_playlist": dim_playlist,
        "dim_genre": dim_genre,
        "dim_genre_bucket": dim_bucket,
        "dim_date": dim_date,
        "dim_time_of_day": star.dim_time_of_day(spark),
        "fct_play_event": fact,
        "fct_playlist_membership": star.fct_playlist_membership(items, dim_playlist, dim_content),
        "br_content_artist": br_artist,
        "br_artist_genre": br_genre,
        "genre_bucket_map": bucket_map,
        "allocation_reconciliation": allocation.allocation_reconciliation(
            plays, primary, with_genre, tag_type
        ),
        "artist_enrichment_coverage": allocation.artist_enrichment_coverage(plays, primary, artists),
        "genre_bucket_allocation": allocation.genre_bucket_allocation(
            fact, dim_profile, dim_date, dim_content, br_artist, br_genre, bucket_map, dim_artist,
            tag_type,
        ),
    }
