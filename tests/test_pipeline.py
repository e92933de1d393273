"""The whole build from raw JSON, and its invariants."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalog import world as w
from catalog.queries_events import _item_pages, _me, _poll_rows, _token_rows, raw_export
from playmart.plans import checks as ck
from playmart.plans.pipeline import Raw, build

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark):
    responses = w.captured_pages(spark, D)
    for more in (w.raw_tracks, w.raw_artists, w.raw_playlists, _item_pages, _me):
        responses = responses.unionByName(more(spark, D))
    raw = Raw(
        responses, w.raw_external(spark, D), raw_export(spark, D), w.registry(spark),
        _poll_rows(spark, D), _token_rows(spark, D), w.buckets(spark).drop("genre_bucket_key"),
        w.genre_seed(spark),
    )
    return build(spark, raw, "2026-12-31")


def test_facts_and_dimensions_agree(built):
    fact = built["fct_play_event"]
    assert fact.count() == built["plays"].count() > 0
    assert ck.fact_grain(fact).isEmpty()
    assert ck.dedupe_rules(built["plays"]).isEmpty()
    links = [
        ("content", fact, "content_key", built["dim_content"], "content_key"),
        ("profile", fact, "profile_key", built["dim_profile"], "profile_key"),
        ("time", fact, "time_of_day_key", built["dim_time_of_day"], "time_of_day_key"),
        ("playlist", built["fct_playlist_membership"], "playlist_key", built["dim_playlist"], "playlist_key"),
        ("album", built["dim_track_detail"], "album_key", built["dim_album"], "album_key"),
        ("artist", built["br_content_artist"], "artist_key", built["dim_artist"], "artist_key"),
        ("genre", built["br_artist_genre"], "genre_key", built["dim_genre"], "genre_key"),
    ]
    assert ck.star_orphans(links).isEmpty()


def test_keys_are_dense(built):
    for name, key in (("dim_content", "content_key"), ("dim_artist", "artist_key"), ("dim_playlist", "playlist_key")):
        got = built[name].filter(F.col(key) > 0).agg(F.count(F.lit(1)), F.max(key), F.count_distinct(key)).first()
        assert len(set(got)) == 1, name


def test_allocation_adds_up(built):
    steps = built["allocation_reconciliation"]
    assert ck.chain_breaks(steps).isEmpty()
    assert ck.first_step_mismatch(steps, built["fct_play_event"], built["dim_profile"]).isEmpty()
    assert ck.weights_off(built["br_artist_genre"]).isEmpty()
    assert ck.not_one_current(built["dim_artist"].filter("artist_key > 0"), "artist_id").isEmpty()
