from __future__ import annotations

from pyspark.sql import functions as F

from playmart.plans import history_profile as hp
from playmart.plans import profiling as pr


def test_durations_are_never_merged(rows):
    got = hp.duration_profile(rows([("p", x) for x in (1000, 0, 0, None, 5)], "profile_slug string, ms_played int")).first()
    assert (got["rows"], got["zero"], got["null"], got["positive"]) == (5, 2, 1, 2)


def test_long_tail(rows):
    plays = rows([("p", u) for u in "aaaaabbc"], "profile_slug string, content_uri string")
    got = {r["played_at_least"]: r for r in hp.long_tail(plays, (1, 2, 5)).collect()}
    assert [got[e]["distinct_items"] for e in (1, 2, 5)] == [3, 2, 1]
    assert got[5]["share_of_plays"] == 62.5


def test_longest_silence(rows):
    plays = rows([("p", f"2020-{x}") for x in ("01-01", "01-02", "06-01", "06-02")],
                 "profile_slug string, ended_at_utc timestamp")
    first = hp.silent_stretches(plays).filter("rank = 1").first()
    assert first["gap_days"] == 151.0
    assert (first["from"].day, first["to"].month) == (2, 6)


def test_oddities_only_when_they_fire(rows):
    schema = ("profile_slug string, ms_played bigint, conn_country string, was_incognito boolean, "
              "was_skipped boolean, reason_end string")
    clean = [("p", 1000, "US", False, False, "trackdone")]
    assert hp.other_oddities(rows(clean, schema)).count() == 0
    odd = clean + [("p", 3 * 3_600_000, "US", False, False, "trackdone"),
                   ("p", 1, "US", True, False, "trackdone"), ("p", 1, "US", False, False, "unknown")]
    found = {r["what"] for r in hp.other_oddities(rows(odd, schema)).collect()}
    assert found == {"plays longer than 2 hours", "played in incognito mode", "reason_end = 'unknown'"}


def test_redaction_keeps_nulls_and_sees_dotted_names(rows):
    df = rows([("x", None, "y", "z", "w", "v")], "email string, account_id string, `external_urls.site` string, title string, platform string, artist_mbid string")
    got = pr.redact(df).first().asDict()
    assert got == {"email": "<redacted>", "account_id": None, "external_urls.site": "<redacted>",
                   "title": "z", "platform": "<redacted>", "artist_mbid": "<redacted>"}
    for name in ("content_uri", "artist_id", "request_key", "id", "display_name"):
        assert pr.must_redact(name)


def test_schema_frame_reports_absent_fields(rows):
    docs = rows([('{"a":1,"b":null}',), ('{"a":"x","o":{"k":[1,{"deep":true}]}}',)], "payload string")
    got = {r["field"]: r for r in pr.schema_frame(docs, ["a", "b", "missing"]).collect()}
    assert got["a"]["types"] == "number|string" and got["a"]["on_every_record"]
    assert got["b"]["null_rate"] == 1.0 and got["b"]["present"] == 1
    assert got["missing"]["types"] == "ABSENT" and got["o"]["documented"] == "no"
    assert got["o.k"]["types"] == "array"
    shape = {r["path"]: r["types"] for r in pr.describe_shape(docs).collect()}
    assert shape["$.o.k[]"] == "number|object" and shape["$.o.k[].deep"] == "boolean"


def test_null_rate_is_over_all_records(rows):
    docs = rows([('{"a":1,"b":2}',), ('{"a":1}',), ('{"a":null,"b":null}',), ('{"a":1}',)], "payload string")
    got = {r["field"]: r["null_rate"] for r in pr.schema_frame(docs, ["a", "b"]).collect()}
    assert got == {"a": 0.25, "b": 0.75}


def test_shape_has_no_depth_limit(rows):
    deep = '{"a":' * 7 + '"}]{"' + "}" * 7
    paths = [r["path"] for r in pr.describe_shape(rows([(deep,)], "payload string")).collect()]
    assert max(p.count(".a") for p in paths) == 7


def test_field_presence(rows):
    docs = rows([('{"a":1}',), ('{"a":2,"b":1}',)], "payload string")
    got = {r["field"]: r["state"] for r in pr.field_presence(docs, ["a", "b", "c"]).collect()}
    assert got == {"a": "present", "b": "partly present", "c": "absent"}
    none = pr.field_presence(docs.filter(F.lit(False)), ["a"]).first()
    assert none["state"] == "not examined"


def test_summaries(rows):
    df = rows([("t" * 80,)], "title string").withColumns(
        {"tags": F.array(F.lit(1), F.lit(2)), "o": F.struct(F.lit(1).alias("x"))}
    )
    got = pr.summarised(df).first()
    assert len(got["title"]) == 60 and got["tags"] == "list[2]" and got["o"] == "object(1 keys)"
