from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playmart.streaming import captures as cp
from playmart.plans.events import dedupe_play_events
from playmart.sources.generations import Generations
from playmart.streaming import gaps as gp
from playmart.streaming import marks as mk
from playmart.streaming import merge as mg
from playmart.streaming import pending as pd

CAPTURE = ("profile_slug string, captured_at timestamp, oldest timestamp, newest timestamp, items_returned bigint")
DAY = "2024-01-01 "


def page(at, oldest, newest, n=2):
    return ("p", DAY + at, oldest and DAY + oldest, newest and DAY + newest, n)


@pytest.mark.parametrize(("second", "expected"), [
    (page("10:00:00", "08:00:00", "09:00:00"), [("07:00", "08:00", 2)]),
    (page("10:00:00", "06:30:00", "09:00:00"), []),
    (page("10:00:00", "07:00:00", "09:00:00"), []),
    (page("10:00:00", None, None, 0), []),
])
def test_gap_rules(rows, second, expected):
    first = page("07:30:00", "06:00:00", "07:00:00")
    got = gp.detect_gaps(rows([first, second], CAPTURE)).collect()
    assert [(f"{r['gap_start']:%H:%M}", f"{r['gap_end']:%H:%M}", r["items_returned"]) for r in got] == expected


def test_first_capture_shows_no_gap(rows):
    assert gp.detect_gaps(rows([page("10:00:00", "08:00:00", "09:00:00")], CAPTURE)).count() == 0


def test_gap_stream_carries_marks_over_batches(spark, rows, tmp_path):
    landing, base = tmp_path / "in", str(tmp_path)
    pages = [page("07:30:00", "06:00:00", "07:00:00"), page("09:30:00", "09:00:00", "09:10:00", 1)]
    for n, row in enumerate(pages):
        rows([row], CAPTURE).coalesce(1).write.mode("append").parquet(str(landing))
        stream = spark.readStream.schema(CAPTURE).parquet(str(landing))
        gp.start_gap_stream(stream, f"{base}/gaps", f"{base}/marks", f"{base}/ckpt").awaitTermination()
        time.sleep(0.1)
    gaps = spark.read.parquet(f"{base}/gaps").collect()
    assert [(f"{g['gap_start']:%H:%M}", f"{g['gap_end']:%H:%M}", g["items_returned"]) for g in gaps] == [("07:00", "09:00", 1)]


def test_status(rows):
    polls = rows([(1, "p", "ok", DAY + "07:30:00"), (2, "p", "ok", DAY + "09:30:00")],
                 "poll_run_id bigint, profile_slug string, status string, finished_at timestamp")
    caps = rows([page("07:30:00", "06:00:00", "07:00:00"), page("09:30:00", "09:00:00", "09:00:00", 1)], CAPTURE)
    who = rows([("p",), ("idle",)], "profile_slug string")
    got = {r["profile_slug"]: r for r in gp.poll_status(
        polls, gp.detect_gaps(caps), gp.high_water_mark(caps), who, "2024-01-01 12:00:00").collect()}
    assert got["p"]["gap_count"] == 1 and got["p"]["last_poll_status"] == "ok"
    assert f"{got['p']['high_water_mark']:%H:%M}" == "09:00" and got["p"]["last_gap"]["items_returned"] == 1
    assert got["idle"]["polls_24h"] == 0 and got["idle"]["last_poll_at"] is None


ITEM = ("profile_slug string, content_uri string, played_at_utc timestamp, ingested_at timestamp, "
        "raw_response_id bigint, item_ordinal int")


def test_streaming_dedupe_has_no_lateness(spark, rows, tmp_path):
    """Later batches bring a play of long ago, an earlier capture of a known play, and repeats."""
    old = "2020-05-05 "
    batches = [
        [("p", "a", DAY + "10:00:01", DAY + "11:00:00", 1, 1), ("p", "a", DAY + "10:00:40", DAY + "11:00:00", 1, 2),
         ("p", "a", DAY + "10:01:00", DAY + "11:00:00", 1, 3), ("p", "b", DAY + "10:00:01", DAY + "11:00:00", 1, 4)],
        [("q", "a", old + "10:00:01", DAY + "12:00:00", 2, 1), ("p", "a", DAY + "10:00:59", DAY + "10:30:00", 3, 1)],
        [("p", "b", DAY + "10:00:01", DAY + "13:00:00", 4, 1), ("q", "a", old + "10:00:30", DAY + "13:00:00", 4, 2)],
    ]
    for batch in batches:
        rows(batch, ITEM).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(ITEM).parquet(str(tmp_path / "in"))
        cp.start_capture_dedupe(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
        time.sleep(0.1)
    kept = cp.captured_plays(spark, str(tmp_path / "out")).collect()
    assert sorted((r["profile_slug"], r["content_uri"], f"{r['played_at_utc']:%Y %H:%M:%S}", r["raw_response_id"]) for r in kept) == [
        ("p", "a", "2024 10:00:59", 3), ("p", "a", "2024 10:01:00", 1), ("p", "b", "2024 10:00:01", 1), ("q", "a", "2020 10:00:01", 2)]
    # the last batch brought nothing new for January 2024, but rewrote both months it touched and no others
    assert sorted(p.name for p in (tmp_path / "out" / "data" / "gen=2").rglob("play_month=*")) == ["play_month=2020-05", "play_month=2024-01"]


def test_gap_stream_fails_when_marks_are_lost(spark, rows, tmp_path):
    for at in ("07:30:00", "09:30:00"):
        rows([page(at, "06:00:00", "07:00:00")], CAPTURE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(CAPTURE).parquet(str(tmp_path / "in"))
        query = gp.start_gap_stream(stream, f"{tmp_path}/g", f"{tmp_path}/m{at[:2]}", f"{tmp_path}/c")
        if at == "07:30:00":
            query.awaitTermination()
        else:
            with pytest.raises(Exception, match="PATH_NOT_FOUND|Path does not exist"):
                query.awaitTermination()


def test_order_and_coverage(rows):
    items = rows([("a", 60, 1), ("b", 30, 2), ("c", 10, 3), ("d", 0, 4)], "track_id string, ms_played bigint, plays bigint")
    ordered = pd.order_for_resolution(items)
    assert [r["track_id"] for r in ordered.orderBy("position").collect()] == ["a", "b", "c", "d"]
    total = rows([(200,)], "ms bigint")
    table = pd.coverage_table(ordered, total, (1, 2, 99)).orderBy("calls").collect()
    assert [(r["calls"], r["pct_unresolved_ms"], r["pct_all_track_ms"]) for r in table] == [(1, 60, 30), (2, 90, 45), (4, 100, 50)]


def test_isrcs_are_normalised(rows):
    tracks = rows([("usum71703861",), ("US-UM7-17-03862",), ("junk",), (None,)], "isrc string")
    done = rows([], "isrc string")
    assert sorted(r["isrc"] for r in pd.pending_isrcs(tracks, done).collect()) == ["USUM71703861", "USUM71703862"]


def test_only_first_well_formed_credits(spark, rows):
    good, other = "a" * 8 + "-aaaa-aaaa-aaaa-" + "a" * 12, "b" * 8 + "-bbbb-bbbb-bbbb-" + "b" * 12
    doc = ('{"recordings":[{"artist-credit":[{"artist":{"id":"%s"}},{"artist":{"id":"%s"}}]},'
           '{"artist-credit":[{"artist":{"id":"bad"}}]},{"artist-credit":[]}]}' % (good, other))
    from playmart.sources.schemas import ISRC_LOOKUP
    lookups = rows([(doc,)], "payload string").select(F.from_json("payload", ISRC_LOOKUP)["recordings"].alias("recordings"))
    got = pd.pending_mbids(lookups, rows([], "artist_mbid string")).collect()
    assert [r["artist_mbid"] for r in got] == [good]


def many_captures(n_batches):
    """Overlapping, silent and empty pages of a few profiles in micro-batches; one profile starts late."""
    out = []
    for b in range(n_batches):
        for who in ("p", "q", "r") if b >= 2 else ("p", "q"):
            for k in range(3):
                lead = b * 180 + k * 60
                skip = 50 if (b + k + len(who)) % 2 == 0 else 5  # minutes between pages: some overlap the page before
                old, new = lead + skip, lead + 62
                at = lambda m: f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"
                empty = who == "q" and k == 1
                out.append((b, (who, at(lead + 63), None if empty else at(old), None if empty else at(new + b), 7)))
    return out


@pytest.mark.parametrize("restart", [True, False])
def test_stateful_gaps_equal_the_batch(spark, rows, tmp_path, restart):
    pages = many_captures(4)
    for b in range(4):
        rows([p for n, p in pages if n == b], CAPTURE).repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
        if restart or b == 3:
            stream = spark.readStream.schema(CAPTURE).parquet(str(tmp_path / "in"))
            mk.start_stateful_gaps(stream, str(tmp_path / "gaps"), str(tmp_path / "c")).awaitTermination()
            time.sleep(0.1)
    want = gp.detect_gaps(rows([p for _, p in pages], CAPTURE)).collect()
    got = spark.read.schema(mk.GAPS).parquet(str(tmp_path / "gaps")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 3
    assert "r" in {g.profile_slug for g in got}


def test_stateful_gaps_ignore_what_is_older_than_the_mark(spark, rows, tmp_path):
    for batch in ([page("10:00:00", "09:00:00", "10:00:00")], [page("08:00:00", "07:00:00", "07:30:00")],
                  [(None, DAY + "11:00:00", DAY + "10:30:00", DAY + "11:00:00", 1)], [page("12:00:00", "11:00:00", "11:30:00")]):
        rows(batch, CAPTURE).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(CAPTURE).parquet(str(tmp_path / "in"))
        mk.start_stateful_gaps(stream, str(tmp_path / "gaps"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.schema(mk.GAPS).parquet(str(tmp_path / "gaps")).collect()
    assert [(f"{g.gap_start:%H:%M}", f"{g.gap_end:%H:%M}") for g in got] == [("10:00", "11:00")]


PLAY = ("profile_slug string, content_uri string, ended_at_utc timestamp, source_system string, ingested_at timestamp, "
        "raw_response_id bigint, item_ordinal int")


def test_late_exports_displace_captured_plays(spark, rows, tmp_path):
    """An export that comes months later; a repeated share; a month nobody touches again."""
    api = [("p", "a", DAY + "10:00:10", "api", DAY + "11:00:00", 1, 1), ("p", "a", DAY + "10:05:10", "api", DAY + "11:00:00", 1, 2),
           ("p", "b", "2024-02-01 10:00:00", "api", "2024-02-01 11:00:00", 2, 1), ("q", "a", DAY + "10:00:10", "api", DAY + "11:00:00", 3, 1)]
    later = [("p", "a", DAY + "10:00:40", "api", DAY + "10:30:00", 4, 1)]
    export = [("p", "a", DAY + "10:05:55", "export", "2024-06-01 00:00:00", 9, 1), ("p", "a", DAY + "10:05:55", "export", "2024-06-02 00:00:00", 9, 2),
              ("p", "c", DAY + "12:00:00", "export", "2024-06-01 00:00:00", 9, 3)]
    shares, seen = [api, later, export, api], []
    for n, share in enumerate(shares):
        seen += share
        df = rows(share, PLAY)
        df.repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        mg.start_play_merge(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
        got = mg.merged_plays(spark, str(tmp_path / "out"), df.schema)
        want = dedupe_play_events(rows(seen, PLAY))
        assert sorted(map(tuple, got.select(*df.columns).collect())) == sorted(map(tuple, want.collect())), n
    store = mg.play_store(spark, str(tmp_path / "out"), df.schema)
    touched = {(r.profile_slug, r.play_month): r.gen for r in store.index(2).collect()}
    assert touched == {("p", "2024-01"): 2, ("p", "2024-02"): 0, ("q", "2024-01"): 0}
    before = sorted(map(tuple, store.read(3).collect()))
    assert store.vacuum(3) > 0 and sorted(map(tuple, store.read(store.latest()).collect())) == before


def test_a_repeated_refresh_and_odd_keys(spark, rows, tmp_path):
    schema = T.StructType.fromDDL("k string, v int")
    store = Generations(spark, str(tmp_path), schema, ["k"])
    assert store.latest() == -1 and store.read(-1).collect() == []
    store.commit(0, rows([("a b", 1), ("c=/d%", 2), (None, 3), ("", 4)], "k string, v int"))
    for _ in range(2):  # a batch that is run again writes the same
        store.commit(1, rows([("c=/d%", 5)], "k string, v int"))
    assert {(r.k, r.v) for r in store.read(1).collect()} == {("a b", 1), ("c=/d%", 5), (None, 3), (None, 4)}
    assert {(r.k, r.v) for r in store.read(0).collect()} == {("a b", 1), ("c=/d%", 2), (None, 3), (None, 4)}
    asked = rows([(None,), ("a b",)], "k string")
    assert {r.v for r in store.read_touched(1, asked).collect()} == {1, 3, 4}
    store.commit(2, rows([], "k string, v int"))
    assert store.read(2).count() == 4
