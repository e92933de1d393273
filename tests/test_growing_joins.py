"""Sides that grow with the catalogue are never broadcast, however small they look."""

from __future__ import annotations

import re

from playmart.plans import allocation as al
from playmart.plans import content, star

ARTISTS = "array<struct<id:string,name:string>>"


def joins(df) -> list[str]:
    """Kind and first key of every join of the plan, without the small calendar, profile and artist tables."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"(\w+Join) \[(\w+)#", plan)
    return sorted({f"{kind} {key}" for kind, key in found if key in ("content_uri", "content_key", "isrc", "artist_ordinal")})


def test_contents_and_credits_are_merged(spark, rows):
    tracks = rows([("u1", "I-1"), ("u2", "I2")], "content_uri string, isrc string").selectExpr(
        "*", f"cast(array(struct(concat('a', content_uri), 'n')) as {ARTISTS}) as track_artists")
    credits = content.content_artists(tracks)
    assert sorted((r.content_uri, r.artist_id, r.is_primary) for r in credits.collect()) == [
        ("u1", "au1", True), ("u2", "au2", True)]
    mapped = content.artist_external_map(credits, tracks, rows([("I1", "m1")], "isrc string, primary_artist_mbid string"))
    assert {r.artist_id: r.artist_mbid for r in mapped.collect()} == {"au1": "m1", "au2": None}
    contents = rows([(1, "u1", "track", 10), (2, "u2", "track", None)], "content_key int, content_uri string, content_type string, duration_ms int")
    artists = rows([(7, "au1", "A", True)], "artist_key int, artist_id string, artist_name string, is_current boolean")
    bridge = star.br_content_artist(credits, contents, artists)
    profiles = rows([(1, "p", "UTC")], "profile_key int, profile_slug string, home_timezone string")
    plays = rows([("p", "u1", "2024-01-01 00:00:00", 5), ("p", None, "2024-01-01 00:00:00", 5)],
                 "profile_slug string, content_uri string, ended_at_utc timestamp, ms_played bigint").selectExpr(
        "*", *[f"null as {c}" for c in star._FACT if c != "ms_played"])
    fact = star.fct_play_event(plays, profiles, contents)
    assert sorted(r.content_key for r in fact.collect()) == [-1, 1]
    shared = al.genre_bucket_allocation(
        fact, profiles, rows([(20240101, 2024, "2024-01-01")], "date_key int, year int, month_start date"), contents, bridge,
        rows([(7, 3, "genre", 1.0)], "artist_key int, genre_key int, tag_type string, weight_factor double"),
        rows([(3, "g", 1, "other", 1)], "genre_key int, genre_name string, genre_bucket_key int, bucket_name string, bucket_order int"),
        artists, "genre")
    assert [(r.artist_key, r.play_rows, r.allocated_ms) for r in shared.collect()] == [(7, 1, 5.0)]
    for plan, keys in ((mapped, {"content_uri", "isrc"}), (bridge, {"content_uri"}), (fact, {"content_uri"}), (shared, {"content_key", "content_uri"})):
        found = joins(plan)
        assert all(x.startswith("SortMergeJoin") for x in found) and keys <= {x.split()[1] for x in found}
