from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from playmart.functions.clock import circular_mean_hour, hour_difference
from playmart.functions.periods import grain_for
from playmart.functions.text import platform_family
from playmart.plans import allocation as al
from playmart.plans import listening as li
from playmart.plans import timeseries as ts

WINDOW = "profile_slug string, window_start date, window_end date"
PLAY = ("profile_slug string, full_date date, ms_played bigint, is_qualified_play boolean, "
        "was_skipped boolean, was_shuffled boolean, was_offline boolean")


def test_clip_keeps_and_flags_edges(rows):
    months = rows([("p", f"2024-0{m}-01") for m in range(1, 7)], "profile_slug string, period date")
    out = ts.clip_to_window(months, rows([("p", "2024-02-15", "2024-05-10")], WINDOW), "month")
    got = sorted((r["period"].month, r["is_partial"]) for r in out.collect())
    assert got == [(2, True), (3, False), (4, False), (5, True)]
    weeks = rows([("p", f"2024-01-{d:02d}") for d in (1, 8, 15, 22)], "profile_slug string, period date")
    out = ts.clip_to_window(weeks, rows([("p", "2024-01-03", "2024-01-21")], WINDOW), "week")
    assert sorted((r["period"].day, r["is_partial"]) for r in out.collect()) == [
        (1, True), (8, False), (15, False)
    ]


def test_silent_periods_are_zero(rows):
    plays = rows(
        [("p", "2024-01-20", 3_600_000, True, False, False, False),
         ("p", "2024-03-05", 1_800_000, True, False, True, False),
         ("p", "2024-03-06", None, False, True, False, False)], PLAY,
    )
    out = ts.time_series(plays, rows([("p", "2024-01-15", "2024-03-31")], WINDOW), "month").orderBy("period").collect()
    assert [r["hours"] for r in out] == [1.0, 0.0, 0.5]
    assert [r["is_partial"] for r in out] == [True, False, False]
    assert out[2]["pct_rows_with_duration"] == 50.0 and out[1]["pct_rows_with_duration"] is None


def test_time_without_any_duration_is_null(rows):
    data = [(g, "2024-01-01", ms, False, None, None, None) for g, ms in
            (("a", 1000), ("a", None), ("b", None), ("b", None))]
    got = {r["profile_slug"]: r for r in ts.with_coverage(rows(data, PLAY), ["profile_slug"]).collect()}
    assert got["a"]["ms_played"] == 1000 and got["a"]["pct_rows_with_duration"] == 50.0
    assert got["b"]["ms_played"] is None and got["b"]["hours"] is None
    assert got["b"]["play_count"] == 2 and got["b"]["pct_rows_with_duration"] == 0.0
    assert got["b"]["skipped_count"] == 0


def test_grain(rows):
    spans = rows([("2014-02-24", "2026-09-13"), ("2025-01-01", "2026-01-01")], "a date, b date")
    assert {r[0]: r[1] for r in spans.select("a", grain_for(F.col("a"), F.col("b"))).collect()} == {
        date(2014, 2, 24): "week", date(2025, 1, 1): "day"}


def test_clock_circle(rows):
    mean = lambda hours: rows([(h,) for h in hours], "h double").agg(
        circular_mean_hour(F.col("h"))).first()[0]
    wrapped = mean([23.0, 1.0])
    assert min(wrapped, 24 - wrapped) < 1e-9
    assert mean([9.0, 11.0]) == pytest.approx(10.0)
    diff = rows([(1.0, 23.0)], "a double, b double").select(hour_difference(F.col("a"), F.col("b")))
    assert diff.first()[0] == pytest.approx(2.0)


def test_a_two_month_shift_is_one_run(spark):
    months = spark.range(36).select(F.add_months(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("m"))
    plays = months.select(
        F.lit("p").alias("profile_slug"),
        F.when(F.col("m").isin("2021-01-01", "2021-02-01"), 18).otherwise(20).alias("hour"),
        F.explode(F.sequence(F.lit(0), F.lit(24))).alias("d"), "m",
    ).select("profile_slug", "hour", F.date_add("m", F.col("d")).alias("full_date"),
             F.explode(F.array(*[F.lit(x) for x in (0, 30, 45, 50, 55, 59)])).alias("minute"))
    runs = ts.shift_runs(ts.monthly_phase(plays)).collect()
    assert len(runs) == 1
    assert (runs[0]["first_month"], runs[0]["last_month"]) == (date(2021, 1, 1), date(2021, 2, 1))
    assert runs[0]["months"] == 2 and runs[0]["mean_shift_hours"] < -1.5


@pytest.mark.parametrize(("raw", "family"), [
    ("Windows 10 (10.0.19045; x64)", "Windows"), ("Android OS 13", "Android"), ("iOS 17.1", "iOS"),
    ("OS X 10.15 [x86 8]", "other"), ("osx", "macOS"), ("Partner amazon_echo", "connected device"),
    ("not_applicable", "not recorded"), (None, "not recorded"), ("  ", "not recorded"),
])
def test_platform_family(rows, raw, family):
    assert rows([(raw,)], "p string").select(platform_family(F.col("p"))).first()[0] == family


def test_bucket_shares_are_scale_free(rows):
    schema = "profile_slug string, bucket_name string, allocated_ms double, allocated_plays double"
    for factor in (1, 50):
        given = rows([("p", "pop", 1000.0, 1.0), ("p", "rock", 3000.0, 2.0)] * factor, schema)
        got = al.bucket_shares(given, ["rock", "pop", "classical", "other"]).orderBy("bucket_order").collect()
        assert [r["share_pct"] for r in got] == [75.0, 25.0, 0.0, 0.0]
        assert got[2]["allocated_ms"] is None


def test_sunburst_parents_are_sums(rows):
    hour = 3_600_000.0
    given = rows(
        [("p", "t", "rock", "indie", "A", hour), ("p", "t", "rock", "indie", "B", hour / 2),
         ("p", "t", "rock", "indie", "C", hour / 4), ("p", "t", "rock", "metal", "D", hour),
         ("p", "t", "pop", "synth", "E", hour)],
        "profile_slug string, period string, bucket_name string, genre_name string, artist_name string, allocated_ms double",
    )
    nodes = {r["id"]: r for r in li.sunburst_nodes(given, top=2).collect()}
    assert nodes["t|rock"]["value"] == pytest.approx(2.75) and nodes["t|rock"]["parent"] == ""
    leaves = {r["label"] for r in nodes.values() if r["parent"] == "t|rock|indie"}
    assert leaves == {"A", "B", "1 other artist"}
    for parent in {r["parent"] for r in nodes.values()} - {""}:
        kids = sum(r["value"] for r in nodes.values() if r["parent"] == parent)
        assert kids == pytest.approx(nodes[parent]["value"])


def test_every_report_survives_no_data(spark):
    from catalog import world as w

    plays = w.plays(spark, "/root/testdata/sf0.001").filter(F.lit(False))
    windows = w.windows(spark, "/root/testdata/sf0.001").filter(F.lit(False))
    for report in (
        li.coverage_facts, li.yearly_table, li.monthly_totals, li.longest_tail, li.one_hit_wonders,
        li.most_offline_months, li.months_away, li.phase_signal, li.phase_runs,
    ):
        assert report(plays, windows).count() == 0, report.__name__
    for report in (
        li.podcast_leaderboard, li.podcast_by_daypart, li.ranked_artists, li.recurring_artists,
        li.leaders_by_year, li.artist_coverage_by_year, li.platform_mix, li.country_table,
        li.hour_profile, li.category_totals, li.yearly_category_share,
    ):
        assert report(plays).count() == 0, report.__name__


def test_completion_leaves_out_unknown_and_zero_lengths(rows):
    plays = rows(
        [("p", "export", "podcast", "s", 1, 30, 60), ("p", "export", "podcast", "s", 2, 30, None),
         ("p", "export", "podcast", "s", 3, 30, 0), ("p", "export", "podcast", "s", 4, None, 60)],
        "profile_slug string, source_system string, category string, parent_name string, content_key int, "
        "ms_played bigint, duration_ms bigint",
    )
    got = li.podcast_leaderboard(plays).first()
    assert got["mean_completion_pct"] == 50 and got["episodes"] == 4
