from __future__ import annotations

import json
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from playmart.plans import checks as ck
from playmart.sources import readers as rd
from playmart.sources import staging
from playmart.sources import writers as wr
from playmart.sources.scrub import scrub_payload


def record(n: int) -> dict:
    return {"ts": f"2024-01-01T00:00:{n:02d}Z", "ms_played": n, "spotify_track_uri": f"u{n}",
            "spotify_episode_uri": None, "ip_addr": "1.2.3.4", "user_agent_decrypted": "agent"}


@pytest.fixture
def export(tmp_path):
    folder = tmp_path / "export"
    folder.mkdir()
    name = "Streaming_History_Audio_2024_0.json"
    (folder / name).write_text(json.dumps([record(n) for n in range(5)]))
    (folder / "ReadMe.txt").write_text("x")
    return folder


def test_loading_twice_adds_nothing(spark, export, tmp_path):
    target = str(tmp_path / "raw")
    assert rd.load_export_records(spark, str(export), "alpha", target) == 5
    assert rd.load_export_records(spark, str(export), "alpha", target) == 0
    stored = spark.read.parquet(target)
    assert ck.personal_keys(stored).isEmpty()
    plays = staging.export_play_record(stored).orderBy("record_index").collect()
    assert [p["ms_played"] for p in plays] == [0, 1, 2, 3, 4]
    assert plays[0]["content_type"] == "track" and plays[3]["ended_at_utc"].second == 3
    assert [c for c in json.loads(stored.first()["payload"]) if c.startswith(("ip", "user"))] == []


def test_files_stored_whole_are_not_read_again(spark, export, tmp_path):
    target = str(tmp_path / "raw")
    rd.load_export_records(spark, str(export), "alpha", target)
    (export / "Streaming_History_Audio_2025_0.json").write_text(json.dumps([record(n) for n in range(3)]))
    stored = spark.read.parquet(target)
    again = rd.read_export_records(spark, str(export), "alpha", stored).collect()
    assert {r["source_file"] for r in again} == {"Streaming_History_Audio_2025_0.json"} and len(again) == 3
    assert rd.read_export_records(spark, str(export), "beta", stored).count() == 8
    # a file that has grown is read, and only its new places are added
    (export / "Streaming_History_Audio_2024_0.json").write_text(json.dumps([record(n) for n in range(7)]))
    assert rd.load_export_records(spark, str(export), "alpha", target) == 5
    assert spark.read.parquet(target).filter("source_file like '%2024%'").count() == 7


def test_a_file_whose_first_places_are_missing_is_read(spark, export, tmp_path):
    target = str(tmp_path / "raw")
    rd.read_export_records(spark, str(export), "alpha").filter("record_index > 1").write.partitionBy("profile_slug").parquet(target)
    assert rd.load_export_records(spark, str(export), "alpha", target) == 2


def test_wrong_package_and_duplicate_names(spark, export, tmp_path):
    (export / "more").mkdir()
    (export / "more" / "Streaming_History_Audio_2024_0.json").write_text("[]")
    with pytest.raises(rd.SourceError, match="twice"):
        rd.select_export_files(spark, str(export))
    other = tmp_path / "other"
    other.mkdir()
    (other / "StreamingHistory_music_0.json").write_text("[]")
    with pytest.raises(rd.SourceError, match="one-year"):
        rd.select_export_files(spark, str(other))


def test_registry(spark, tmp_path):
    path = tmp_path / "profiles.csv"
    path.write_text("profile_slug,household_role,home_timezone\n# a comment\n\nalpha,self,America/Los_Angeles\nbeta,child,UTC\n")
    good = rd.read_profile_registry(spark, str(path))
    assert good.count() == 2 and rd.registry_errors(good).count() == 0
    path.write_text(
        "profile_slug,household_role,home_timezone\nBad Slug,self,UTC\nbeta,boss,UTC\n"
        "gamma,self,Mars/Base\ndelta,self,UTC\ndelta,child,UTC\n"
    )
    wrong = {(r["profile_slug"], r["rule"]) for r in rd.registry_errors(rd.read_profile_registry(spark, str(path))).collect()}
    assert wrong == {("Bad Slug", "profile_slug"), ("beta", "household_role"),
                     ("gamma", "home_timezone"), ("delta", "duplicate profile_slug")}


def test_guarded_append_refuses_the_batch(spark, rows, tmp_path):
    good = rows([(1, "me", "{}")], "id bigint, feed string, payload string")
    wr.append_responses(good, str(tmp_path / "raw"), wr.response_rules())
    with pytest.raises(PySparkException):
        bad = rows([(2, "Bad Feed", "{}")], "id bigint, feed string, payload string")
        wr.append_responses(bad, str(tmp_path / "raw"), wr.response_rules())
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 1
    gaps = rows([("2024-01-02", "2024-01-01")], "gap_start timestamp, gap_end timestamp")
    assert wr.broken_rules(gaps, wr.gap_rules()).first()["broken"] == ["gap has a length"]


def test_observed_append_counts_every_rule_and_publishes_whole_batches(spark, rows, tmp_path):
    path = str(tmp_path / "observed")
    good = rows([(1, "me", "{}"), (2, "me", "{}"), (3, "you", "{}")], "id bigint, feed string, payload string")
    bad = rows([(4, "Bad Feed", "{}"), (5, "me", None), (6, None, None)], "id bigint, feed string, payload string")
    assert wr.append_observed(good, path, wr.response_rules(), "b1") == 3
    with pytest.raises(wr.BatchRefused) as refused:
        wr.append_observed(good.unionByName(bad), path, wr.response_rules(), "b2")
    assert refused.value.broken == {"feed name": 2, "payload": 2}
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    # the mended batch takes the refused one's place; a published one is not written twice
    assert wr.append_observed(bad.filter("id = 5").fillna("{}"), path, wr.response_rules(), "b2") == 1
    for batch in ("b1", "not/a/name"):
        with pytest.raises(rd.SourceError):
            wr.append_observed(good, path, wr.response_rules(), batch)
    assert wr.append_observed(good.filter("id > 9"), path, wr.response_rules(), "none") == 0
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3, 5]


def test_owner_is_answered_then_removed(spark):
    doc = json.dumps({"items": [
        {"id": "a", "owner": {"id": "me", "display_name": "x", "type": "user"}, "images": [1]},
        {"id": "b", "owner": {"id": "you", "display_name": "y", "type": "user"}, "images": []},
        {"id": "c", "owner": {"id": None, "display_name": None, "type": "user"}, "images": []},
    ]})
    schema = "struct<items:array<struct<id:string,owner:struct<id:string,display_name:string,type:string>,images:array<int>>>>"
    df = spark.range(1).select(F.from_json(F.lit(doc), schema).alias("doc"))
    clean, removed = scrub_payload(df, "doc", "playlist", F.lit("me"))
    got = json.loads(clean.select(F.to_json("doc")).first()[0])["items"]
    assert [p["is_owned_by_profile"] for p in got] == [True, False, False]
    assert all(set(p["owner"]) == {"type"} and "images" not in p for p in got)
    assert removed == ["items[].images", "items[].owner.display_name", "items[].owner.id"]
    plain, _ = scrub_payload(df, "doc", "playlist")
    assert "is_owned_by_profile" not in plain.select(F.to_json("doc")).first()[0]


def test_rebuild_needs_an_unchanged_control(spark, rows, tmp_path):
    schema = "profile_slug string, ts string, uri string"
    rows([("a", "1", "u"), ("b", "1", "u")], schema).write.partitionBy("profile_slug").parquet(str(tmp_path / "now"))
    same = rows([("b", "2", "v"), ("a", "1", "u")], schema)
    args = (["profile_slug"], ["ts", "uri"])
    assert wr.rebuild_with_control(spark, str(tmp_path / "now"), same, str(tmp_path / "s1"), "a", *args)
    with pytest.raises(rd.SourceError):
        wr.rebuild_with_control(spark, str(tmp_path / "now"), same.withColumn("uri", F.lit("w")), str(tmp_path / "s2"), "a", *args)


def test_backfill_refuses_unknown_files(rows):
    raw = rows([("me/1.json",), ("tracks/2.json",)], "source_file string")
    got = wr.backfill_feed(raw, {"me": "me/%", "track": "tracks/%"}).collect()
    assert sorted(r["feed"] for r in got) == ["me", "track"]
    with pytest.raises(PySparkException):
        wr.backfill_feed(raw, {"me": "me/%"}).collect()


def test_identical_archives_and_overlap(spark, rows, tmp_path):
    for name, text in (("a.zip", "same"), ("b.zip", "same"), ("c.zip", "other")):
        (tmp_path / name).write_text(text)
    twins = ck.identical_files(spark.read.format("binaryFile").load(str(tmp_path / "*.zip")))
    assert twins.count() == 1 and twins.first()["files"] == 2
    plays = [("x", i) for i in range(50)] + [("y", i) for i in range(49, 99)] + [("z", i) for i in range(50)]
    pairs = rows([("x", "y"), ("x", "z")], "left_id string, right_id string")
    got = {r["right_profile"]: (r["share"], r["refused"]) for r in
           ck.profile_overlaps(rows(plays, "profile_slug string, k int"), ["k"], pairs).collect()}
    assert got == {"y": (0.02, False), "z": (1.0, True)}


def test_both_entry_shapes_are_read(rows):
    track = {"uri": "u", "name": "n", "artists": [{"name": "A"}]}
    page = {"href": "https://x/playlists/abc/items", "offset": 100,
            "items": [{"item": track}, {"track": track}, {"track": None}]}
    raw = rows([(1, "playlist_item", "p", "f", "2024-01-01", json.dumps(page))],
               "id bigint, feed string, profile_slug string, source_file string, ingested_at timestamp, payload string")
    got = staging.playlist_item(raw).orderBy("position").collect()
    assert [(r["playlist_id"], r["position"], r["primary_creator_name"]) for r in got] == [
        ("abc", 101, "A"), ("abc", 102, "A")]


def test_records_at(rows):
    docs = rows([(1, '{"artists":{"items":[{"id":1},2,{"id":3}]}}'), (2, '{"id":9}')], "id int, payload string")
    assert staging.records_at(docs, "artists.items").count() == 2
    assert staging.records_at(docs, "self").count() == 2


def test_sheet_is_written_under_a_safe_name(spark, rows, tmp_path):
    sheet = rows([(2, "b"), (1, "a"), (3, "c")], "order_number int, song string")
    path = wr.write_sheet(sheet, str(tmp_path), "Rock & Roll / 1")
    assert path.endswith("playlist_Rock___Roll___1.csv")
    back = spark.read.schema("order_number int, song string").csv(path, header=True)
    assert sorted(r["song"] for r in back.collect()) == ["a", "b", "c"]


def test_comparison_of_records_keeps_all_partitions(spark, rows):
    schema = "profile_slug string, source_file string, record_index bigint"
    incoming = rows([("p", "f", n) for n in range(50)] + [("q", "f", 1), ("p", "f", 3), ("p", None, 2)], schema)
    stored = rows([("p", "f", n) for n in range(0, 50, 2)] * 2 + [("p", "other", 1), ("p", None, 2)], schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = rd.new_export_records(incoming, stored)
        assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert sorted(r["record_index"] for r in found.filter("profile_slug = 'p' and source_file = 'f'").collect()) == sorted([*range(1, 50, 2), 3])
        assert found.count() == 28
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


ODD = [
    {"a": 'x}{"[]\\', "ip_addr": "1"}, {}, 1, None, "},{", [1, {"b": [2]}], {"c": {"d": {"e": "\\\"}"}}, "f": [{}, {"g": "ä}"}]},
    [], {"h": 1.50}, "]", {"i": None}, {"j": "[{"}, 7,
]
BROKEN = ['[{"a":1},{"b":2', '[{"a":1} {"b":2}]', '[{"a":1},]', '[{"a":1}', '[{"a":1},5', '{"a":1}', '[{"a":1},{"b":}]', '[{"a":"x},{"}',
          '[{"a":1},{"a":1,"a":2}]', '[{"a":1}\n']
ODDLY_ENDED = ['[{"a":1}] x', '[{"a":1},{"b":2}]\n[{"c":3}]', '[{"a":1}]{"b":2}', '[{"a":1},2] {} 3', ' [\n {"a":1}\n ,\t{"b":{}} , 3\r\n]\n', "[]", "[1]"]


@pytest.mark.parametrize("at_once, split", [(1, "64b"), (3, "128m"), (16, "64b")])  # a file in many splits too
def test_large_files_have_the_records_they_have_when_parsed_whole(spark, tmp_path, monkeypatch, at_once, split):
    monkeypatch.setattr(rd, "AT_ONCE", at_once)
    texts = [json.dumps(ODD), json.dumps(ODD, indent=1, ensure_ascii=False), json.dumps([record(n) for n in range(50)]), *BROKEN, *ODDLY_ENDED]
    for n, text in enumerate(texts):
        (tmp_path / f"Streaming_History_Audio_{n}.json").write_text(text)
    (tmp_path / "other.json").write_text('[{"a":1}]')
    read = lambda whole: rd.read_export_records(spark, str(tmp_path), "alpha", whole=whole)
    told = lambda df: sorted((r.source_file, r.record_index, str(r.payload)) for r in df.collect())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = told(read(0))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == told(read(1 << 20)) == told(read(60))
    counts = Counter(name for name, *_ in got)
    assert [counts.get(f"Streaming_History_Audio_{n}.json", 0) for n in range(len(texts))] == (
        [len(ODD), len(ODD), 50] + [0] * len(BROKEN) + [1, 2, 1, 2, 3, 0, 1])


def test_no_task_holds_a_large_file(spark, tmp_path):
    (tmp_path / "Streaming_History_Audio_1.json").write_text(json.dumps([record(n % 60) for n in range(3000)]))
    found = rd.read_export_records(spark, str(tmp_path), "alpha", whole=10_000)
    assert found.count() == 3000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "posexplode(elements" in plan and "file_size" in plan
    found.write.partitionBy("profile_slug").parquet(str(tmp_path / "raw"))
    stored = spark.read.parquet(str(tmp_path / "raw"))
    assert rd.read_export_records(spark, str(tmp_path), "alpha", stored, whole=10_000).isEmpty()
    assert rd.read_export_records(spark, str(tmp_path), "alpha", stored.filter("record_index <> 5"), whole=10_000).count() == 3000


def test_export_files_are_written_record_by_record(spark, rows, tmp_path):
    from catalog import queries_checks as qc

    lines = [(n // 3, n % 7, n % 4, n % 7 + 1, n % 50, "RAN"[n % 3], "OF"[n % 2], f"1996-0{n % 9 + 1}-01 00:00:00") for n in range(300)]
    rows([*lines, lines[0], (None, *lines[1][1:])],
         "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string, "
         "l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows([(n, None if n % 11 == 0 else n % 10, "1-URGENT") for n in range(100)],
         "o_orderkey bigint, o_custkey bigint, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    want = qc.raw_export(spark, str(tmp_path)).filter("profile_slug is not null").groupBy("profile_slug").count().collect()
    folders, _ = qc._export_folders(spark, str(tmp_path))
    for profile, n in want:
        texts = [p.read_text() for p in Path(folders[profile].removeprefix("file:")).glob("*.json")]
        files = [json.loads(t) for t in texts]
        assert sum(map(len, files)) == n and all(f[0]["ip_addr"] == "1.2.3.4" for f in files)
        # a record a line: what a task holds is a record
        assert all(len(t.splitlines()) == len(f) for t, f in zip(texts, files, strict=True))
