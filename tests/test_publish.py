from __future__ import annotations

import pytest

from playmart.config import ExtractOptions
from playmart.plans import publish as pb

PLAYS = [
    ("p0", "1999-01-02", 1999, "track", "7", "100", "true"), ("p0", "1999-01-02", 1999, "track", "7", None, "false"),
    ("p0", "1999-01-02", 1999, "track", None, "5", "false"), ("p0", "1999-01-03", 1999, "episode", None, None, None),
    ("p1", "2000-01-02", 2000, "track", "8", "30", "true"), ("p1", "2000-02-02", 2000, "track", "9", "40", "true"),
]


@pytest.fixture(scope="module")
def tables(spark):
    from playmart.session import small_table

    plays = small_table(spark, PLAYS, "profile_slug string, full_date date, year int, content_type string, artist_key bigint, ms_played bigint, is_qualified_play boolean")
    genres = small_table(spark, [(7, 1, "genre", 0.5), (7, 2, "genre", 0.5), (8, 1, "genre", 1.0)], "artist_key bigint, genre_key bigint, tag_type string, weight_factor double")
    buckets = small_table(spark, [(1, "pop"), (2, "rock")], "genre_key bigint, bucket_name string")
    artists = small_table(spark, [(7, "A"), (8, "B")], "artist_key bigint, artist_name string")
    return plays, genres, buckets, artists


def test_sums_give_the_extracts_of_their_plays(tables):
    plays, *weights, artists = tables
    sums = pb.published_sums(plays)
    assert sums.count() == 5
    opts = ExtractOptions()
    for make in (lambda p: pb.plays_daily(p, *weights, opts), lambda p: pb.published_steps(p, *weights, opts),
                 lambda p: pb.artists(p, artists), lambda p: pb.genres(pb.plays_daily(p, *weights, opts))):
        of_plays, of_sums = make(plays), make(sums)
        assert of_plays.columns == of_sums.columns
        assert sorted(map(str, of_plays.collect())) == sorted(map(str, of_sums.collect()))


def test_a_play_meets_content_and_artist_in_one_join(spark, rows):
    fact = rows([("k", 1, 5, 20000101, "2000-01-01 10:00:00"), ("l", 1, 6, 20000101, "2000-01-01 11:00:00"), ("m", 1, 6, 20000101, "2000-01-01 12:00:00")],
                "play_event_key string, profile_key int, content_key bigint, date_key int, ended_at_utc timestamp")
    content = rows([(5, "u5", "track"), (6, "u6", "track")], "content_key bigint, content_uri string, content_type string")
    credits = rows([(5, 50, True), (5, 51, False)], "content_key bigint, artist_key bigint, is_primary boolean")
    dates = rows([(20000101, "2000-01-01", 2000, "2000-01-01")], "date_key int, full_date date, year int, month_start date")
    private = rows([("p0", "u6", "2000-01-01 12:00:00", True)], "profile_slug string, content_uri string, ended_at_utc timestamp, was_incognito boolean")
    out = pb.published_plays(fact, rows([(1, "p0")], "profile_key int, profile_slug string"), content, credits, dates, private, ExtractOptions())
    assert {(r["play_event_key"], r["artist_key"]) for r in out.collect()} == {("k", 50), ("l", None)}
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert len(joins) == 5 and "LeftAnti" in joins[0]  # nothing meets the plays after the private ones have gone
