from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from playmart.plans import playlists as pl

SCHEMA = "artist string, title string, album string, content_uri string, isrc string, content_match_key string"


@pytest.fixture
def tracks(rows):
    def make(*items):
        data = [(a, t, f"album of {u}", u, i, f"{t.lower()}|{k.lower()}") for t, a, u, i, k in items]
        return rows(data, SCHEMA)

    return make


def uris(df):
    return sorted(r["content_uri"] for r in df.collect())


def test_direction_matters(tracks):
    left = tracks(("Respect", "A", "aaa", "USA111", "a"), ("The Weight", "B", "bbb", "USB222", "b"), ("Cupid", "C", "ccc", None, "c"))
    right = tracks(("The Weight", "B", "bbb", "USB222", "b"), ("Try", "D", "ddd", "USD444", "d"))
    assert uris(pl.misses(left, right, "isrc").rows) == ["aaa", "ccc"]
    assert uris(pl.misses(right, left, "isrc").rows) == ["ddd"]
    one, other = pl.misses(left, right, "isrc", "L", "R"), pl.misses(right, left, "isrc", "R", "L")
    assert one.label != other.label
    sizes = one.sizes().first()
    assert (sizes["misses"], sizes["of"], sizes["with_key"]) == (2, 3, 2)
    with pytest.raises(ValueError):
        pl.misses(left, right, "mood")


def test_split_is_a_partition(tracks):
    left = tracks(("Heaven", "X", "aaa", "USSM10315916", "x"), ("Respect", "A", "bbb", "USA111", "a"), ("Otis", "JAY-Z", "ccc", "USUM71111634", "JAY-Z"))
    right = tracks(("Heaven", "X", "zzz", "USSM10315916", "x"), ("Otis", "JAŸ-Z", "yyy", "USUM71111634", "JAŸ-Z"))
    split = {r["content_uri"]: r for r in pl.split_misses(left, right).collect()}
    assert {u for u, r in split.items() if r["is_absent"]} == {"bbb"}
    assert split["aaa"]["matched_tier"] == "isrc + name" and split["aaa"]["album_other_side"] == "album of zzz"
    assert split["ccc"]["matched_tier"] == "isrc" and split["ccc"]["uri_other_side"] == "yyy"
    assert sorted(split) == uris(pl.misses(left, right, "content_uri").rows)


def test_strict_misses_equal_absent(tracks):
    left = tracks(("Forever", "D", "g1", "USUM70985104", "d"), ("Respect", "A", "g2", "USA111", "a"), ("Heaven", "X", "g3", "I3", "x"))
    right = tracks(("Forever", "D", "g8", "USUM70920707", "d"), ("Heaven", "X", "g9", "I3", "x"))
    found = pl.identifier_misses(left, right)
    assert uris(found) == ["g1", "g2"] and uris(found.filter("cleared_by_name")) == ["g1"]
    assert uris(pl.strict_misses(left, right)) == uris(pl.split_misses(left, right).filter("is_absent")) == ["g2"]


def test_nothing_on_the_left(tracks):
    right = tracks(("Heaven", "X", "g9", "I3", "x"))
    left = right.filter(F.lit(False))
    assert pl.split_misses(left, right).count() == 0 and pl.misses(left, right, "isrc").rows.count() == 0
    assert pl.identifier_misses(left, right).count() == 0


def test_names(rows):
    names = rows([("Connor’s Playlist",), ("College Days",), ("College Days Again",)], "playlist_name string")
    assert pl.resolve_name(names, "connor's playlist") == ("Connor’s Playlist", True)
    assert pl.resolve_name(names, "College Days") == ("College Days", True)
    assert pl.resolve_name(names, "again") == ("College Days Again", False)
    for needle in ("college", "nothing"):
        with pytest.raises(pl.PlaylistNameError):
            pl.resolve_name(names, needle)


def test_many_names_resolve_like_one_at_a_time(rows):
    held = ["Connor’s Playlist", "College Days", "College Days Again", "a", "ab", "Été à deux", "COLLEGE DAYS AGAIN", ""]
    typed = ["connor's playlist", "College Days", "again", "college", "nothing", "", "a", "ab", "b", "été", "à d", "zz", "days ag", "aaaa"]
    names = rows([(n,) for n in [*held, "a", None]], "playlist_name string")
    asked = rows([(n,) for n in [*typed, "again", None]], "needle string")
    got = {r["needle"]: r.asDict() for r in pl.resolve_names(names, asked).collect()}
    assert sorted(got) == sorted(typed)

    def folded(text):
        return text.replace("’", "'").lower()

    for needle in typed:
        equal = sorted(n for n in held if folded(n) == folded(needle))
        near = sorted(n for n in held if folded(needle) in folded(n))
        row = got[needle]
        assert (row["exact_names"], row["loose_names"]) == (len(equal), len(near)), needle
        want = equal[0] if len(equal) == 1 else near[0] if not equal and len(near) == 1 else None
        assert row["resolved"] == want
        if len(equal) == 1:
            assert row["outcome"] == "exact"
        else:
            assert row["outcome"] == ("only" if want is not None else "several" if near else "none")
    nobody = pl.resolve_names(names.filter("false"), asked).collect()
    assert {r["outcome"] for r in nobody} == {"none"} and pl.resolve_names(names, asked.filter("false")).count() == 0


def test_sheet_coverage_counts_blank_as_unfilled(rows):
    sheet = rows([("a", "", "n"), ("b", None, "n")], "song string, genre string, notes string")
    got = {r["column"]: r["populated"] for r in pl.sheet_coverage(sheet).collect()}
    assert got == {"song": 2, "genre": 0}
