from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from playmart.plans.stored import StoredStar, genre_months, play_cube

FACT = "profile_key int, content_key bigint, date_key int, ms_played bigint, is_qualified_play boolean"


@pytest.fixture
def star(spark, rows, tmp_path):
    fact = rows(PLAYS, FACT)
    content = rows([(n, "track" if n % 5 else "episode") for n in range(1, 41)], "content_key bigint, content_type string")
    credits = rows([(n, n % 7, True) for n in range(1, 41)] + [(n, 99, False) for n in range(1, 41)],
                   "content_key bigint, artist_key bigint, is_primary boolean")
    genres = rows([(a, g, "genre", 0.5) for a in range(7) for g in (a % 3, 3)] + [(0, 0, "tag", 1.0)],
                  "artist_key bigint, genre_key bigint, tag_type string, weight_factor double")
    names = rows([(g, f"bucket {g}") for g in range(4)], "genre_key bigint, bucket_name string")
    made = StoredStar(spark, str(tmp_path), f"star_{tmp_path.name.replace('-', '_')}", 4)
    made.store(fact.filter("date_key < 20240300"), content, credits, br_artist_genre=genres, genre_bucket_map=names)
    return made, fact


# one content has a third of all plays; some have no time
PLAYS = [(n % 3 + 1, 7 if n % 3 == 0 else n % 40 + 1, 20240101 + n % 4 * 100 + n % 28, None if n % 6 == 0 else n, n % 2 == 0) for n in range(900)]


def cube(df):
    return sorted(map(tuple, df.select("month_key", "profile_key", "date_key", "content_key", "play_count", "rows_with_duration", "ms_played").collect()))


def test_months_are_refreshed_alone(star, tmp_path):
    stored, fact = star
    assert cube(stored.table("play_cube")) == cube(play_cube(fact.filter("date_key < 20240300")))
    old = {p: p.stat().st_mtime_ns for p in (tmp_path / "play_cube" / "month_key=202401").glob("*.parquet")}
    stored.refresh_months(fact.filter("date_key > 20240200"))  # two new months and one again
    stored.spark.catalog.refreshTable(f"{stored.prefix}_play_cube")
    assert cube(stored.table("play_cube")) == cube(play_cube(fact))
    assert old and old == {p: p.stat().st_mtime_ns for p in (tmp_path / "play_cube" / "month_key=202401").glob("*.parquet")}


def test_plays_meet_content_without_a_shuffle(spark, star):
    stored, _ = star
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stored.primary_plays()._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_report_equals_plain_sums(star):
    stored, fact = star
    stored.refresh_months(fact.filter("date_key > 20240300"))
    want = {}
    for who, item, date, ms, _ in PLAYS:
        if item % 5:
            for genre in {item % 7 % 3, 3}:
                row = want.setdefault((who, date // 100, f"bucket {genre}"), [0, 0.0, None])
                row[0], row[1] = row[0] + 1, row[1] + 0.5
                row[2] = row[2] if ms is None else (row[2] or 0) + ms * 0.5
    got = {(r.profile_key, r.month_key, r.bucket_name): [r.play_rows, r.allocated_plays, r.allocated_ms] for r in genre_months(stored, "genre").collect()}
    assert got == want
    assert play_cube(fact).agg(F.max("play_count")).first()[0] < 40
