from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from playmart.plans import star
from playmart.plans.content import export_content
from playmart.plans.events import dedupe_play_events

EVENT = ("profile_slug string, content_uri string, ended_at_utc timestamp, source_system string, "
         "ingested_at timestamp, raw_response_id bigint, item_ordinal int")

SAME_MINUTE = [
    ("p", "t1", "2026-01-01 12:00:10", "api", "2026-01-02", 1, 1),
    ("p", "t1", "2026-01-01 12:00:10", "api", "2026-01-03", 2, 1),
    ("p", "t1", "2026-01-01 12:00:40", "api", "2026-01-02", 3, 2),
    ("p", "t2", "2026-01-01 12:00:40", "api", "2026-01-02", 4, 3),
    ("p", "t1", "2026-01-01 12:01:05", "api", "2026-01-02", 5, 4),
    ("p", "t3", "2026-01-01 12:05:59", "api", "2026-01-01", 6, 5),
    ("p", "t3", "2026-01-01 12:05:30", "export", "2026-01-09", 7, 1),
]
TWICE = [
    ("p", uri, f"2026-09-14 {at}", "api", f"2026-09-14 {seen}", poll, n)
    for poll, seen in ((10, "09:00:00"), (11, "09:30:00"))
    for n, (uri, at) in enumerate([("a", "08:00:01"), ("b", "08:04:30"), ("a", "08:09:59")], 1)
]
SECONDS = [
    ("p", "e1", "2026-01-01 12:00:10", "export", "2026-01-09", 1, 0),
    ("p", "e1", "2026-01-01 12:00:40", "export", "2026-01-09", 2, 1),
    ("p", "e1", "2026-01-01 12:00:55.123", "api", "2026-01-01 13:00:00", 90, 1),
    ("p", "e2", "2026-01-01 12:01:00", "export", "2026-01-09", 4, 3),
    ("p", "e2", "2026-01-01 12:01:00", "export", "2026-01-09", 3, 2),
    ("p", "e3", "2026-01-01 12:02:05", "api", "2026-01-01 13:00:00", 91, 2),
    ("p", "e3", "2026-01-01 12:03:00", "export", "2026-01-09", 5, 4),
]


@pytest.mark.parametrize(
    ("given", "kept"),
    [(SAME_MINUTE, [1, 4, 5, 7]), (TWICE, [10, 10, 10]), (SECONDS, [1, 2, 3, 5, 91])],
)
def test_dedupe(rows, given, kept):
    for order in (given, given[::-1]):
        out = dedupe_play_events(rows(order, EVENT).repartition(3)).collect()
        assert sorted(r["raw_response_id"] for r in out) == kept


def test_match_key_ignores_arrival_order(rows):
    given = [
        (1, "t1", "2024-01-01", "Achtung Baby", "U2"), (2, "t1", "2024-01-02", "Zoo Station", "U2"),
        (3, "t2", "2024-01-01", "Otis", "JAY-Z"), (4, "t2", "2024-01-02", "Otis", "JAŸ-Z"),
    ]
    schema = ("raw_record_id bigint, content_uri string, ended_at_utc timestamp, track_name string, "
              "album_artist_name string")
    blank = ("episode_name", "audiobook_chapter_title", "album_name", "episode_show_name",
             "audiobook_title")
    for order in (given, given[::-1]):
        plays = rows(order, schema).withColumn("content_type", F.lit("track")).withColumns(
            {c: F.lit(None).cast("string") for c in blank}
        )
        got = {r["content_uri"]: r for r in export_content(plays).collect()}
        assert got["t1"]["content_name"] == "Zoo Station"
        assert got["t1"]["content_match_key"] == "achtung baby|u2"
        assert got["t2"]["primary_creator_name"] == "JAŸ-Z"
        assert got["t2"]["content_match_key"] == "otis|jay-z"


def test_names_that_are_grouped_by_are_not_carried_twice(rows):
    names = ("track_name", "episode_name", "audiobook_chapter_title", "album_name", "episode_show_name",
             "audiobook_title", "album_artist_name")
    plays = rows([("t1", "track", 1, "2024-01-01")],
                 "content_uri string, content_type string, raw_record_id bigint, ended_at_utc timestamp")
    found = export_content(plays.withColumns({c: F.lit(c) for c in names}))
    assert tuple(found.first()) == ("t1", "track", "track_name", "album_name", "album_artist_name",
                                    "track_name|album_artist_name")
    packed = [x for x in found._jdf.queryExecution().analyzed().toString().splitlines() if " AS __a#" in x][-1]
    assert "struct(content_type" in packed and "struct(content_type, content_type" in packed
    assert ", content_name, " not in packed.split(" AS __a#")[0].split("struct(")[-1]


def test_fact_uses_local_time_and_unknown_members(spark, rows):
    plays = rows(
        [("p", "u1", "2024-01-01 03:30:00", 29_000), ("p", "u2", "2024-01-01 03:30:00", 30_000),
         ("q", "u1", "2024-01-01 03:30:00", None)],
        "profile_slug string, content_uri string, ended_at_utc timestamp, ms_played bigint",
    ).withColumns({c: F.lit(None).cast("string") for c in star._FACT if c != "ms_played"})
    who = rows([(1, "p", "America/New_York")], "profile_key int, profile_slug string, home_timezone string")
    what = rows([(7, "u1", 58_000)], "content_key int, content_uri string, duration_ms int")
    got = {(r["profile_key"], r["content_key"]): r for r in star.fct_play_event(plays, who, what).collect()}
    assert got[(1, 7)]["date_key"] == 20231231 and got[(1, 7)]["time_of_day_key"] == 2230
    assert got[(1, 7)]["is_qualified_play"] and got[(1, -1)]["is_qualified_play"]
    assert got[(-1, 7)]["date_key"] == -1 and not got[(-1, 7)]["is_qualified_play"]
    assert len({r["play_event_key"] for r in got.values()}) == 3


def test_calendar_and_clock(spark):
    dates = star.dim_date(spark, "2012-12-31")
    assert dates.filter("date_key = -1").count() == 1
    row = dates.filter("date_key = 20101231").first()
    assert (row["iso_week"], row["iso_year"], row["day_of_week_name"]) == (52, 2010, "Friday")
    assert dates.agg(F.min("full_date")).first()[0].isoformat() == "2008-10-07"
    times = star.dim_time_of_day(spark)
    assert times.count() == 1441
    parts = {r["hour"]: r["daypart"] for r in times.filter("minute = 0").collect()}
    assert (parts[4], parts[5], parts[12], parts[22]) == ("overnight", "morning", "afternoon", "night")
