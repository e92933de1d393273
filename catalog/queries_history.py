"""Profiles of the export, of tables and of payloads; dimensions and bridges of the catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import oracle as o
from catalog import world as w
from catalog.base import day, query, r, stamp, table, utc
from catalog.queries_events import _me, _token_rows, raw_export
from catalog.queries_listening import CUR
from playmart.functions.text import (
    content_match_key, duration_text, endpoint_template, fold_text, is_mbid, normalise_name,
    normalize_isrc, platform_family, track_id_from_uri,
)
from playmart.operators.ordered import keep_first
from playmart.plans import content, history_profile as hp, profiling as pr, star
from playmart.sources import staging

P = "profile_slug"
HX = f"{o.HIST}, {o.CATALOGUE}, hx AS (SELECT h.*, c.content_name, c.creator, year(ended) AS uy FROM hist h JOIN cat c USING (part) WHERE source_system = 'export')"


def export(spark, d, spread=False):
    """Exported history with the names an export record carries."""
    names = w.catalogue(spark, d).select(
        "content_uri", F.col("content_name").alias("track_name"),
        F.col("primary_creator_name").alias("album_artist_name"), "content_key", "is_resolved",
    )
    plays = w.spread_history(spark, d) if spread else w.history(spark, d)
    return plays.filter("source_system = 'export'").join(names, "content_uri")


def _only_export(spark, d):
    return w.history(spark, d).filter("source_system = 'export'")


@query("l1_export_calendar", f"""WITH {o.HIST} SELECT profile_slug, CAST(CAST(date_trunc('month', ended) AS DATE) AS VARCHAR) AS month, year(ended) AS year, count(*) AS n,
 count(DISTINCT CAST(ended AS DATE)) AS days FROM hist WHERE source_system = 'export' GROUP BY 1, 2, 3""")
def l1(spark, d):
    return hp.with_calendar(_only_export(spark, d)).groupBy(P, "month", "year").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("day").alias("days")
    ).select(P, day("month"), "year", "n", "days")


@query("l2_duration_profile", f"""WITH {o.HIST} SELECT profile_slug, count(*) AS rows, count(*) FILTER (ms = 0) AS zero, count(*) FILTER (ms IS NULL) AS "null",
 count(*) FILTER (ms > 0) AS positive FROM hist GROUP BY 1""")
def l2(spark, d):
    return hp.duration_profile(w.history(spark, d))


@query("l3_coverage_facts", f"""WITH {o.HIST} SELECT profile_slug, count(*) AS records, count(DISTINCT source_file) AS files, strftime(min(ended), '%Y-%m-%d %H:%M:%S') AS first_play,
 strftime(max(ended), '%Y-%m-%d %H:%M:%S') AS last_play, round(CAST(sum(ms) AS DOUBLE) / 3600000, 4) AS hours FROM hist WHERE source_system = 'export' GROUP BY 1""")
def l3(spark, d):
    return hp.coverage_facts(_only_export(spark, d)).select(
        P, "records", "files", stamp("first_play"), stamp("last_play"), r("hours")
    )


def _cells(cols, source):
    return " UNION ALL ".join(f"SELECT profile_slug, '{c}' AS field, CAST({c} AS VARCHAR) AS value FROM {source}" for c in cols)


_PROFILED = {"content_type": "string", "reason_end": "string", "was_skipped": "boolean", "platform": "string",
             "conn_country": "string", "source_file": "string", "ms_played": "bigint"}
_PSQL = [c if c != "ms_played" else "ms" for c in _PROFILED]
_KINDS = ", ".join(f"('{c}', '{kind}')" for c, kind in zip(_PSQL, _PROFILED.values()))
_FAMILY = o.FAMILY.replace("platform", "value")


@query("l4_field_profile", f"""WITH {o.HIST}, kinds(field, type) AS (VALUES {_KINDS}), cl AS ({_cells(_PSQL, "hist")}), ct AS (SELECT profile_slug, field, value, count(*) AS n FROM cl GROUP BY 1, 2, 3),
 s AS (SELECT profile_slug, field, CAST(sum(n) AS BIGINT) AS rows, CAST(coalesce(sum(n) FILTER (value IS NULL), 0) AS BIGINT) AS nulls, count(value) AS distinct_values, min(value) AS low, max(value) AS high FROM ct GROUP BY 1, 2),
 sh AS (SELECT profile_slug, field, CASE WHEN field = 'platform' THEN {_FAMILY} ELSE value END AS value, CAST(sum(n) AS BIGINT) AS n FROM ct WHERE value IS NOT NULL GROUP BY 1, 2, 3),
 t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY profile_slug, field ORDER BY n DESC, value) AS rk FROM sh) WHERE rk = 1)
 SELECT profile_slug, CASE s.field WHEN 'ms' THEN 'ms_played' ELSE s.field END AS field, type, rows, nulls, distinct_values, CASE WHEN s.field = 'platform' THEN '<redacted>' ELSE low END AS low,
  CASE WHEN s.field = 'platform' THEN '<redacted>' ELSE high END AS high, t.value AS top_value, t.n AS top_count FROM s JOIN kinds USING (field) LEFT JOIN t USING (profile_slug, field)""")
def l4(spark, d):
    return pr.field_profile(w.history(spark, d), list(_PROFILED), [P])


@query("l5_records_per_month", f"""WITH {o.HIST} SELECT profile_slug, CAST(CAST(date_trunc('month', ended) AS DATE) AS VARCHAR) AS month, count(*) AS records, {o.HOURS} FROM hist WHERE source_system = 'export' GROUP BY 1, 2""")
def l5(spark, d):
    return hp.records_per_month(_only_export(spark, d)).select(P, day("month"), "records", r("hours"))


@query("l5_month_extremes", f"""WITH {o.HIST}, m AS (SELECT profile_slug, CAST(date_trunc('month', ended) AS DATE) AS month, count(*) AS n FROM hist WHERE source_system = 'export' GROUP BY 1, 2),
 k AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY n DESC, month) AS up, row_number() OVER (PARTITION BY profile_slug ORDER BY n, month) AS dn FROM m)
 SELECT profile_slug, count(*) AS months, CAST(max(month) FILTER (up = 1) AS VARCHAR) AS densest, CAST(max(month) FILTER (dn = 1) AS VARCHAR) AS thinnest,
 date_diff('month', min(month), max(month)) + 1 - count(*) AS missing_months FROM k GROUP BY 1""")
def l5_extremes(spark, d):
    return hp.month_extremes(hp.records_per_month(_only_export(spark, d))).select(
        P, "months", day("densest"), day("thinnest"), "missing_months"
    )


@query("l6_silent_stretches", f"""WITH {o.HIST}, g AS (SELECT profile_slug, lag(ended) OVER (PARTITION BY profile_slug ORDER BY ended) AS f, ended AS t FROM (SELECT DISTINCT profile_slug, ended FROM hist WHERE source_system = 'export')),
 x AS (SELECT profile_slug, round((epoch_us(t) - epoch_us(f)) / 86400000000.0, 1) AS gap_days, f, t FROM g WHERE f IS NOT NULL), y AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY gap_days DESC, f) AS rank FROM x)
 SELECT profile_slug, gap_days, strftime(f, '%Y-%m-%d %H:%M:%S') AS "from", strftime(t, '%Y-%m-%d %H:%M:%S') AS "to", rank FROM y WHERE rank <= 10""")
def l6(spark, d):
    return hp.silent_stretches(_only_export(spark, d)).select(
        P, "gap_days", stamp("from"), stamp("to"), "rank"
    )


@query("l7_heaviest_days", f"""WITH {o.HIST}, x AS (SELECT profile_slug, CAST(ended AS DATE) AS day, count(*) AS records, sum(ms) AS ms FROM hist WHERE source_system = 'export' GROUP BY 1, 2),
 y AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY ms DESC NULLS LAST, day) AS rank FROM x)
 SELECT profile_slug, CAST(day AS VARCHAR) AS day, records, round(CAST(ms AS DOUBLE) / 3600000, 4) AS hours, rank FROM y WHERE rank <= 10""")
def l7(spark, d):
    return hp.heaviest_days(_only_export(spark, d)).select(
        P, day("day"), "records", r("hours"), "rank"
    )


@query("l7_heaviest_day_tracks", f"""WITH {HX}, x AS (SELECT profile_slug, CAST(ended AS DATE) AS day, sum(ms) AS ms FROM hx GROUP BY 1, 2),
 p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY ms DESC NULLS LAST, day) AS rk FROM x) WHERE rk = 1),
 t AS (SELECT hx.profile_slug, creator, content_name, count(*) AS plays FROM hx JOIN p ON p.profile_slug = hx.profile_slug AND CAST(ended AS DATE) = day WHERE creator IS NOT NULL GROUP BY 1, 2, 3),
 y AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY plays DESC, creator, content_name) AS rank FROM t)
 SELECT profile_slug, creator AS artist, content_name AS track, plays, rank FROM y WHERE rank <= 5""")
def l7_tracks(spark, d):
    return hp.heaviest_day_tracks(export(spark, d)).select(
        P, F.col("album_artist_name").alias("artist"), F.col("track_name").alias("track"), "plays",
        "rank",
    )


@query("l8_file_coverage", f"""WITH {o.HIST}, f AS (SELECT profile_slug, source_file, count(*) AS records, CAST(min(ended) AS DATE) AS first_play, CAST(max(ended) AS DATE) AS last_play FROM hist WHERE source_system = 'export' GROUP BY 1, 2)
 SELECT profile_slug, source_file, records, CAST(first_play AS VARCHAR) AS first_play, CAST(last_play AS VARCHAR) AS last_play,
 coalesce(first_play <= lag(last_play) OVER (PARTITION BY profile_slug ORDER BY first_play, source_file), FALSE) AS overlaps_previous FROM f""")
def l8(spark, d):
    return hp.file_coverage(_only_export(spark, d)).select(
        P, "source_file", "records", day("first_play"), day("last_play"), "overlaps_previous"
    )


@query("l9_content_type_shares", f"""WITH {o.HIST}, x AS (SELECT profile_slug, content_type, count(*) AS records, sum(ms) AS ms FROM hist WHERE source_system = 'export' GROUP BY 1, 2)
 SELECT profile_slug, content_type, records, round(100.0 * records / sum(records) OVER w, 4) AS pct_records, round(100.0 * ms / sum(ms) OVER w, 4) AS pct_hours FROM x WINDOW w AS (PARTITION BY profile_slug)""")
def l9(spark, d):
    return hp.content_type_shares(_only_export(spark, d)).select(
        P, "content_type", "records", r("pct_records"), r("pct_hours")
    )


@query("l10_long_tail", f"""WITH {o.HIST}, c AS (SELECT profile_slug, content_uri, count(*) AS n FROM hist WHERE source_system = 'export' GROUP BY 1, 2), t AS (SELECT profile_slug, count(*) AS i, sum(n) AS p FROM c GROUP BY 1)
 SELECT c.profile_slug, e AS played_at_least, count(*) FILTER (n >= e) AS distinct_items, round(100.0 * count(*) FILTER (n >= e) / any_value(i), 2) AS share_of_items,
 round(100.0 * coalesce(sum(n) FILTER (n >= e), 0) / any_value(p), 2) AS share_of_plays FROM c JOIN t USING (profile_slug), (VALUES (1),(2),(3),(5),(10),(25),(50),(100)) v(e) GROUP BY 1, 2""")
def l10(spark, d):
    return hp.long_tail(_only_export(spark, d))


@query("l10_tail_histogram", f"""WITH {o.HIST}, c AS (SELECT profile_slug, content_uri, count(*) AS n FROM hist WHERE source_system = 'export' GROUP BY 1, 2) SELECT profile_slug, least(n, 50) AS plays, count(*) AS items FROM c GROUP BY 1, 2""")
def l10_hist(spark, d):
    return hp.tail_histogram(_only_export(spark, d))


@query("l10_tail_summary", f"""WITH {o.HIST}, c AS (SELECT profile_slug, content_uri, count(*) AS n FROM hist WHERE source_system = 'export' GROUP BY 1, 2) SELECT profile_slug, count(*) AS items, count(*) FILTER (n = 1) AS played_once,
 median(n) AS median_plays, max(n) AS max_plays FROM c GROUP BY 1""")
def l10_summary(spark, d):
    return hp.tail_summary(_only_export(spark, d))


@query("l11_resolution", f"""WITH {o.PLAYS} SELECT profile_slug, is_resolved, count(*) AS plays, count(DISTINCT content_key) AS items FROM pl GROUP BY 1, 2""")
def l11(spark, d):
    return hp.resolution(w.plays(spark, d))


@query("l11_unresolved_by_type", f"""WITH {o.PLAYS} SELECT profile_slug, content_type, count(*) AS plays, count(DISTINCT content_key) AS items FROM pl WHERE NOT is_resolved GROUP BY 1, 2""")
def l11_types(spark, d):
    return hp.unresolved_by_type(w.plays(spark, d))


_PT = f"""{HX}, pt AS (SELECT profile_slug, creator, content_name, count(*) AS plays, round(CAST(sum(ms) AS DOUBLE) / 3600000, 1) AS hours,
  round(datesub('day', min(ended), max(ended)) / 365.25, 1) AS span_years FROM hx WHERE content_type = 'track' AND creator IS NOT NULL GROUP BY 1, 2, 3)"""


@query("l12_most_replayed", f"""WITH {_PT}, y AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY plays DESC, creator, content_name) AS rank FROM pt)
 SELECT profile_slug, creator AS artist, content_name AS track, plays, span_years, rank FROM y WHERE rank <= 10""")
def l12(spark, d):
    return hp.most_replayed(export(spark, d)).select(
        P, F.col("album_artist_name").alias("artist"), F.col("track_name").alias("track"), "plays",
        "span_years", "rank",
    )


@query("l12_repeat_summary", f"""WITH {_PT} SELECT profile_slug, count(*) AS tracks, count(*) FILTER (plays = 1) AS once_only, round(100.0 * count(*) FILTER (plays = 1) / count(*), 2) AS pct_once_only,
 median(span_years) FILTER (plays > 1) AS median_span_of_repeats FROM pt GROUP BY 1""")
def l12_summary(spark, d):
    return hp.repeat_summary(export(spark, d))


@query("l13_zero_by_reason", f"""WITH {o.HIST}, x AS (SELECT profile_slug, reason_end, count(*) AS records FROM hist WHERE source_system = 'export' AND ms = 0 AND reason_end IS NOT NULL GROUP BY 1, 2),
 y AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY records DESC, reason_end) AS rank FROM x) SELECT * FROM y WHERE rank <= 5""")
def l13_zero(spark, d):
    return hp.zero_by_reason(_only_export(spark, d))


@query("l13_empty_reasons", f"""WITH {o.HIST}, c AS (SELECT profile_slug, 'reason_start' AS col, reason_start AS v FROM hist WHERE source_system = 'export' UNION ALL SELECT profile_slug, 'reason_end', reason_end FROM hist WHERE source_system = 'export'),
 g AS (SELECT profile_slug, col, v, count(*) AS n FROM c GROUP BY 1, 2, 3), m AS (SELECT *, row_number() OVER (PARTITION BY profile_slug, col ORDER BY n DESC, v) AS rk FROM g WHERE v IS NOT NULL)
 SELECT g.profile_slug, g.col AS "column", CAST(coalesce(sum(g.n) FILTER (g.v IS NULL), 0) AS BIGINT) AS null_records, count(g.v) AS distinct_values, any_value(m.v) AS most_common, any_value(m.n) AS most_common_count
 FROM g JOIN m ON m.profile_slug = g.profile_slug AND m.col = g.col AND rk = 1 GROUP BY 1, 2""")
def l13_reasons(spark, d):
    return hp.empty_reasons(_only_export(spark, d)).drop("share_of_records")


@query("l13_offline_timestamp_units", f"""WITH {o.HIST}, x AS (SELECT profile_slug, CASE WHEN line = 3 THEN epoch_ms(ended) WHEN line < 3 THEN CAST(epoch(ended) AS BIGINT) END AS t FROM hist WHERE source_system = 'export')
 SELECT profile_slug, count(t) AS non_null, count(*) FILTER (t > 100000000000) AS milliseconds, min(t) AS smallest, max(t) AS largest FROM x GROUP BY 1""")
def l13_units(spark, d):
    return hp.offline_timestamp_units(_only_export(spark, d))


@query("l13_duplicate_keys", f"""WITH {o.EVENTS}, k AS (SELECT profile_slug, content_uri, ended, count(*) AS n FROM ep WHERE source_system = 'export' GROUP BY 1, 2, 3)
 SELECT profile_slug, count(*) FILTER (n > 1) AS keys, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS rows_involved, CAST(coalesce(sum(n - 1) FILTER (n > 1), 0) AS BIGINT) AS rows_collapsed FROM k GROUP BY 1""")
def l13_duplicates(spark, d):
    return hp.duplicate_keys(w.event_plays(spark, d).filter("source_system = 'export'"))


@query("l13_track_errors", f"""WITH {o.HIST} SELECT profile_slug, year(ended) AS year, count(*) AS records, count(*) FILTER (ms = 0) AS zero_ms FROM hist WHERE source_system = 'export' AND reason_end = 'trackerror' GROUP BY 1, 2""")
def l13_errors(spark, d):
    return hp.track_errors(_only_export(spark, d))


@query("l14_other_oddities", f"""WITH {o.HIST}, e AS (SELECT * FROM hist WHERE source_system = 'export'), x AS (
 SELECT profile_slug, 'plays longer than 2 hours' AS what, count(*) AS records FROM e WHERE ms > 7200000 GROUP BY 1 UNION ALL
 SELECT profile_slug, 'records with no conn_country', count(*) FROM e WHERE coalesce(conn_country, '') = '' GROUP BY 1 UNION ALL
 SELECT profile_slug, 'played in incognito mode', count(*) FROM e WHERE was_incognito GROUP BY 1 UNION ALL
 SELECT profile_slug, 'flagged skipped with no reason_end', count(*) FROM e WHERE was_skipped AND reason_end IS NULL GROUP BY 1 UNION ALL
 SELECT profile_slug, 'reason_end = ''unknown''', count(*) FROM e WHERE reason_end = 'unknown' GROUP BY 1) SELECT * FROM x WHERE records > 0""")
def l14(spark, d):
    return hp.other_oddities(_only_export(spark, d))


@query("l15_platforms_by_year", f"""WITH {o.HIST}, x AS (SELECT profile_slug, year(ended) AS year, {o.FAMILY} AS family, count(*) AS records FROM hist WHERE source_system = 'export' GROUP BY 1, 2, 3)
 SELECT *, round(100.0 * records / sum(records) OVER (PARTITION BY profile_slug, year), 4) AS share FROM x""")
def l15(spark, d):
    return hp.platforms_by_year(_only_export(spark, d)).withColumn("share", r("share"))


@query("l15_countries", f"""WITH {o.HIST} SELECT profile_slug, coalesce(conn_country, '(none)') AS country, count(*) AS records, CAST(CAST(min(ended) AS DATE) AS VARCHAR) AS first_play, CAST(CAST(max(ended) AS DATE) AS VARCHAR) AS last_play
 FROM hist WHERE source_system = 'export' GROUP BY 1, 2""")
def l15_countries(spark, d):
    return hp.countries(_only_export(spark, d)).select(
        P, "country", "records", day("first_play"), day("last_play")
    )


@query("l15_behaviour", f"""WITH {o.HIST} SELECT profile_slug, year(ended) AS year, round(100.0 * count(*) FILTER (was_skipped) / count(*), 2) AS skipped, round(100.0 * count(*) FILTER (was_shuffled) / count(*), 2) AS shuffled,
 round(100.0 * count(*) FILTER (was_offline) / count(*), 2) AS offline, round(100.0 * count(*) FILTER (was_incognito) / count(*), 2) AS incognito, count(*) AS records FROM hist WHERE source_system = 'export' GROUP BY 1, 2""")
def l15_behaviour(spark, d):
    return hp.behaviour_by_year(_only_export(spark, d))


# --- tables and payloads --------------------------------------------------------------------------

_LEAST = "min(CAST(b AS VARCHAR))"
_CUST = {
    "c_custkey": ("bigint", _LEAST), "c_name": ("string", _LEAST), "c_nationkey": ("int", _LEAST),
    "c_acctbal": ("double", _LEAST), "c_mktsegment": ("string", _LEAST),
}


@query("l16_column_schema", " UNION ALL ".join(
    f"SELECT '{c}' AS field, '{kind}' AS type, count(b) AS non_null, count(*) AS total, round(1 - count(b) * 1.0 / count(*), 4) AS null_rate, {shown} AS example FROM (SELECT CASE WHEN c_custkey % {n} <> 0 THEN {c} END AS b FROM customer)"
    for n, (c, (kind, shown)) in enumerate(_CUST.items(), start=2)))
def l16(spark, d):
    df = table(spark, d, "customer").select(
        *[F.when(F.col("c_custkey") % n != 0, F.col(c)).alias(c) for n, c in enumerate(_CUST, start=2)]
    )
    return pr.column_schema(df)


def _props(spark, d):
    """Event properties as documents with a missing key, a JSON null and a mixed type."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    n = F.col("event_id")
    return e.select(
        n.alias("id"), F.lit("f").alias("feed"), F.lit("p0").alias(P), F.lit("x").alias("source_file"),
        utc("ts").alias("ingested_at"),
        F.concat(
            F.lit('{"k":'), F.when(n % 3 == 0, F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k),
            F.when(n % 4 == 0, F.lit(',"note":null')).when(n % 4 == 1, F.lit(',"note":"x"')).otherwise(F.lit("")),
            F.lit(',"tags":[{"name":"a"},{"name":1}],"owner":{"id":"u'), w.text("user_id"), F.lit('"}}'),
        ).alias("payload"),
    )


@query("l17_payload_key_schema", """SELECT 'k' AS key, 'number|string' AS types, count(*) AS present, count(*) AS non_null, 1.0 AS non_null_share FROM events
 UNION ALL SELECT 'note', 'null|string', count(*) FILTER (event_id % 4 <= 1), count(*) FILTER (event_id % 4 = 1), round(count(*) FILTER (event_id % 4 = 1) * 1.0 / count(*), 4) FROM events
 UNION ALL SELECT 'tags', 'array', count(*), count(*), 1.0 FROM events UNION ALL SELECT 'owner', 'object', count(*), count(*), 1.0 FROM events""")
def l17(spark, d):
    return pr.payload_key_schema(_props(spark, d))


@query("l18_describe_shape", """WITH d AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'string' ELSE 'number' END AS k,
  CASE event_id % 4 WHEN 0 THEN 'null' WHEN 1 THEN 'string' END AS note FROM events),
 p AS (SELECT '$' AS path, 'object' AS kind FROM d UNION SELECT '$.k', k FROM d UNION SELECT '$.note', note FROM d WHERE note IS NOT NULL
  UNION SELECT '$.tags', 'array' FROM d UNION SELECT '$.tags[]', 'object' FROM d UNION SELECT '$.tags[].name', unnest(['string', 'number']) FROM d
  UNION SELECT '$.owner', 'object' FROM d UNION SELECT '$.owner.id', 'string' FROM d)
 SELECT path, string_agg(kind, '|' ORDER BY kind) AS types FROM p GROUP BY 1""")
def l18(spark, d):
    return pr.describe_shape(_props(spark, d))


@query("l19_schema_frame", """WITH e AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events)
 SELECT 'k' AS field, 'number|string' AS types, count(*) AS present, 0.0 AS null_rate, 'yes' AS documented, TRUE AS on_every_record, min(k) AS example FROM e
 UNION ALL SELECT 'note', 'null|string', count(*) FILTER (event_id % 4 <= 1), round(1 - count(*) FILTER (event_id % 4 = 1) * 1.0 / count(*), 4), 'yes', FALSE, min(CASE WHEN event_id % 4 = 1 THEN 'x' END) FROM e
 UNION ALL SELECT 'tags', 'array', count(*), 0.0, 'no', TRUE, NULL FROM e UNION ALL SELECT 'owner', 'object', count(*), 0.0, 'no', TRUE, NULL FROM e UNION ALL SELECT 'owner.id', 'string', count(*), 0.0, 'no', TRUE, '<redacted>' FROM e
 UNION ALL SELECT 'popularity', 'ABSENT', 0, 1.0, 'yes', FALSE, NULL UNION ALL SELECT 'genres', 'ABSENT', 0, 1.0, 'yes (conditional)', FALSE, NULL""")
def l19(spark, d):
    return pr.schema_frame(_props(spark, d), ["k", "note", "popularity", "genres"], conditional=["genres"])


@query("l20_field_presence", """SELECT 'k' AS field, count(*) AS present, count(*) AS examined, 'present' AS state FROM events UNION ALL SELECT 'note', count(*) FILTER (event_id % 4 <= 1), count(*), 'partly present' FROM events
 UNION ALL SELECT 'popularity', 0, count(*), 'absent' FROM events""")
def l20(spark, d):
    return pr.field_presence(_props(spark, d), ["k", "note", "popularity"])


@query("l20_presence_by_kind", """WITH e AS (SELECT event_type, event_id % 4 <= 1 AS noted FROM events), n AS (SELECT event_type, count(*) AS examined, count(*) FILTER (noted) AS noted FROM e GROUP BY 1)
 SELECT event_type AS object, 'k' AS field, examined AS present, examined, 'present' AS state FROM n WHERE event_type IN ('view', 'click')
 UNION ALL SELECT 'view', 'note', noted, examined, CASE WHEN noted = 0 THEN 'absent' WHEN noted < examined THEN 'partly present' ELSE 'present' END FROM n WHERE event_type = 'view'
 UNION ALL SELECT 'click', 'popularity', 0, examined, 'absent' FROM n WHERE event_type = 'click' UNION ALL SELECT 'album', 'k', 0, 0, 'not examined' """)
def l20_kinds(spark, d):
    kinds = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))
    watched = [("view", "k"), ("click", "k"), ("view", "note"), ("click", "popularity"), ("album", "k")]
    return pr.presence_by_kind(_props(spark, d).join(kinds, "id"), watched)


@query("l21_redact", """SELECT c_custkey AS customer, '<redacted>' AS display_name, CASE WHEN c_nationkey % 2 = 0 THEN '<redacted>' END AS country_id, c_mktsegment AS segment, '<redacted>' AS platform FROM customer""")
def l21(spark, d):
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("customer"), F.col("c_name").alias("display_name"),
        F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey")).alias("country_id"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("platform"),
    )
    return pr.redact(c)


@query("l22_export_section", f"""WITH {o.HIST} SELECT profile_slug, count(DISTINCT source_file) AS files, count(*) AS records, CAST(CAST(min(ended) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(ended) AS DATE) AS VARCHAR) AS last_day,
 count(*) FILTER (content_type = 'track') AS track, count(*) FILTER (content_type = 'episode') AS episode, count(*) FILTER (content_type = 'audiobook_chapter') AS audiobook_chapter FROM hist WHERE source_system = 'export' GROUP BY 1""")
def l22(spark, d):
    return pr.export_section(_only_export(spark, d)).withColumns(
        {"first_day": day("first_day"), "last_day": day("last_day")}
    )


@query("l22_lookup_section", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT count(*) AS looked_up, count(*) FILTER (is_found) AS found, count(mbid) AS resolved, round(100.0 * count(*) FILTER (is_found) / count(*), 2) AS pct_found FROM ia""")
def l22_lookup(spark, d):
    return pr.lookup_section(w.isrc_artists(spark, d))


@query("l22_vocabulary_section", f"""WITH {o.CATALOGUE}, {o.STAR}, {CUR}, s AS (SELECT tag_type, tag_name, count(*) AS artists FROM cur GROUP BY 1, 2)
 SELECT tag_type, count(*) AS strings, CAST(sum(artists) AS BIGINT) AS uses, count(*) FILTER (artists = 1) AS used_once, max(artists) AS most_used FROM s GROUP BY 1""")
def l22_vocabulary(spark, d):
    return pr.vocabulary_section(w.current_genres(spark, d))


@query("l22_fact_section", f"""WITH {o.PLAYS} SELECT source_system, count(*) AS plays, count(ms) AS rows_with_duration, count(*) FILTER (qualified) AS qualified, 0 AS unknown_content FROM pl GROUP BY 1""")
def l22_fact(spark, d):
    return pr.fact_section(w.fact(spark, d))


@query("l22_content_section", f"""WITH {o.CATALOGUE} SELECT content_type, is_resolved, count(*) AS items, count(duration_ms) AS with_duration, count(creator) AS with_creator FROM cat GROUP BY 1, 2""")
def l22_content(spark, d):
    return pr.content_section(w.catalogue(spark, d))


@query("l22_artist_section", f"""WITH {o.CATALOGUE}, {o.STAR}, p AS (SELECT artist_id, count(*) AS versions, bool_or(genre_source IS NOT NULL) AS s FROM da GROUP BY 1) SELECT versions, count(*) AS artists, count(*) FILTER (s) AS with_genre_source FROM p GROUP BY 1""")
def l22_artist(spark, d):
    return pr.artist_section(w.dim_artist(spark, d))


@query("l22_weights_hold", f"""WITH {o.CATALOGUE}, {o.STAR}, s AS (SELECT tag_type, artist_key, sum(w) AS w FROM bag GROUP BY 1, 2) SELECT tag_type, count(*) AS artists, bool_and(abs(w - 1) < 1e-6) AS weights_sum_to_one FROM s GROUP BY 1""")
def l22_weights(spark, d):
    return pr.weights_hold(w.br_artist_genre(spark, d))


@query("l22_reconciliation_holds", "SELECT DISTINCT 'p' || (o_custkey % 5) AS profile_slug, TRUE AS holds FROM orders")
def l22_holds(spark, d):
    from catalog.queries_listening import steps

    return pr.reconciliation_holds(steps(spark, d), w.history(spark, d))


ALL_TABLES = ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem",
              "nation", "orders", "pages", "part", "region", "supplier")


@query("l26_table_columns", " UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS columns, string_agg(column_name, ', ' ORDER BY ordinal_position) AS fields FROM information_schema.columns WHERE table_name = '{t}'" for t in ALL_TABLES))
def l26_columns(spark, d):
    return pr.table_catalog(spark, {t: table(spark, d, t) for t in ALL_TABLES}).select(
        "name", F.col("columns").cast("bigint").alias("columns"), "fields")


@query("l26_table_catalog", " UNION ALL ".join(
    f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in ALL_TABLES))
def l26(spark, d):
    names = ALL_TABLES
    return pr.table_catalog(spark, {t: table(spark, d, t) for t in names}).select("name", "rows")


# --- text functions -------------------------------------------------------------------------------


@query("n1_fold_text", f"""SELECT doc_id, md5({o.fold("lower(text)")}) AS folded FROM documents""")
def n1(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.md5(fold_text(F.col("text"))).alias("folded")
    )


@query("n2_content_match_key", f"""SELECT p_partkey, {o.fold("p_name")} || '|' || {o.fold("CASE WHEN p_partkey % 37 <> 0 THEN p_brand END")} AS match_key FROM part""")
def n2(spark, d):
    creator = F.when(F.col("p_partkey") % 37 != 0, F.col("p_brand"))
    return table(spark, d, "part").select(
        "p_partkey", content_match_key(F.col("p_name"), creator).alias("match_key")
    )


@query("n4_platform_family", f"""WITH {o.HIST} SELECT {o.FAMILY} AS family, count(*) AS plays FROM hist GROUP BY 1""")
def n4(spark, d):
    return w.history(spark, d).groupBy(platform_family(F.col("platform")).alias("family")).agg(
        F.count(F.lit(1)).alias("plays")
    )


@query("n5_normalize_isrc", """WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'us-abc-' WHEN p_partkey % 3 = 1 THEN ' USABC' ELSE 'bad' END || lpad(CAST(p_partkey % 10000000 AS VARCHAR), 7, '0') AS raw FROM part)
 SELECT p_partkey, CASE WHEN regexp_full_match(upper(replace(trim(raw), '-', '')), '[A-Z]{2}[A-Z0-9]{3}[0-9]{7}') THEN upper(replace(trim(raw), '-', '')) END AS isrc, length(raw) > 12 AND p_partkey % 2 = 0 AS well_formed_id FROM x""")
def n5(spark, d):
    n = F.col("p_partkey")
    raw = F.concat(
        F.when(n % 3 == 0, "us-abc-").when(n % 3 == 1, " USABC").otherwise("bad"),
        F.lpad((n % 10_000_000).cast("string"), 7, "0"),
    )
    ident = F.when((F.length(raw) > 12) & (n % 2 == 0), w.mbid(n)).otherwise(raw)
    return table(spark, d, "part").select(
        n, normalize_isrc(raw).alias("isrc"), is_mbid(ident).alias("well_formed_id")
    )


@query("n6_circular_mean_hour", """SELECT user_id, round((atan2(sum(value * sin(hour(ts) * pi() / 12)), sum(value * cos(hour(ts) * pi() / 12))) * 12 / pi() + 24) % 24, 4) AS mean_hour FROM events GROUP BY 1""")
def n6(spark, d):
    from playmart.functions.clock import circular_mean_hour

    return table(spark, d, "events").groupBy("user_id").agg(
        F.round(circular_mean_hour(F.hour("ts"), F.col("value")), 4).alias("mean_hour")
    )


@query("n7_hour_difference", """SELECT event_id, CAST((hour(ts) - user_id % 24 + 36) % 24 - 12 AS DOUBLE) AS diff FROM events""")
def n7(spark, d):
    from playmart.functions.clock import hour_difference

    return table(spark, d, "events").select(
        "event_id", hour_difference(F.hour("ts"), F.col("user_id") % 24).alias("diff")
    )


@query("n8_duration_text", """SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN '' ELSE ((p_size * 12345) // 60000) || ':' || lpad(CAST(((p_size * 12345) // 1000) % 60 AS VARCHAR), 2, '0') END AS duration FROM part""")
def n8(spark, d):
    ms = F.when(F.col("p_size") % 7 != 0, F.col("p_size") * 12345)
    return table(spark, d, "part").select("p_partkey", duration_text(ms).alias("duration"))


@query("n9_ids_and_names", """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN substr(md5(CAST(p_partkey AS VARCHAR)), 1, 22) END AS track_id, '/artists/{id}' AS endpoint, lower(trim(p_name)) || '''s' AS name FROM part""")
def n9(spark, d):
    n = F.col("p_partkey")
    ident = F.substring(F.md5(n.cast("string")), 1, 22)
    uri = F.concat(F.when(n % 2 == 0, "media:track:").otherwise("media:episode:"), ident)
    path = F.concat(F.lit("/artists/"), ident, F.lit("?limit=1"))
    title = F.concat(F.lit(" "), F.upper("p_name"), F.lit("’S "))
    return table(spark, d, "part").select(
        n, track_id_from_uri(uri).alias("track_id"), endpoint_template(path).alias("endpoint"),
        normalise_name(title).alias("name"),
    )


# --- dimensions and bridges -----------------------------------------------------------------------


@query("g6_artists_latest", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT artist_id, artist_name, artist_uri, is_fetched, has_genres_key FROM arts""")
def g6(spark, d):
    return w.artists(spark, d)


@query("g7_content_artists", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT content_uri, artist_id, artist_ordinal, is_primary FROM cred""")
def g7(spark, d):
    return w.credits(spark, d)


@query("g8_isrc_artist", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT isrc, is_found, recording_count, recording_count AS recordings_with_credit, n_mbids AS distinct_primary_mbids, mbid AS primary_artist_mbid FROM ia""")
def g8(spark, d):
    return w.isrc_artists(spark, d)


@query("g9_artist_external_map", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT * FROM amap""")
def g9(spark, d):
    return w.artist_map(spark, d)


@query("g10_artist_tags", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT raw_response_id, artist_mbid, strftime(ingested_at, '%Y-%m-%d') AS ingested, tag_type, tag_name, vote_count FROM tg""")
def g10(spark, d):
    return w.tags(spark, d).select(
        "raw_response_id", "artist_mbid", day("ingested_at", "ingested"), "tag_type", "tag_name",
        "vote_count",
    )


@query("g11_artist_genres_current", f"""WITH {o.CATALOGUE}, {o.STAR}, {CUR} SELECT * FROM cur""")
def g11(spark, d):
    return w.current_genres(spark, d)


def _export_rows(spark, d):
    """Export records whose names vary over the years."""
    live = F.when(F.year("ended_at_utc") == 1997, F.lit(" LIVÉ")).otherwise("")
    return export(spark, d, spread=True).select(
        "content_uri", "content_type", "ended_at_utc", F.col("raw_response_id").alias("raw_record_id"),
        F.concat("track_name", live).alias("track_name"), "album_artist_name",
        F.lit(None).cast("string").alias("episode_name"),
        F.lit(None).cast("string").alias("audiobook_chapter_title"),
        F.lit("album").alias("album_name"), F.lit(None).cast("string").alias("episode_show_name"),
        F.lit(None).cast("string").alias("audiobook_title"),
    )


@query("g12_export_content", f"""WITH {HX}, n AS (SELECT *, content_name || CASE WHEN year(ended) = 1997 THEN ' LIVÉ' ELSE '' END AS nm FROM hx),
 k AS (SELECT content_uri, min({o.fold("nm")} || '|' || {o.fold("creator")}) AS content_match_key FROM n GROUP BY 1),
 l AS (SELECT content_uri, nm, creator FROM (SELECT *, row_number() OVER (PARTITION BY content_uri ORDER BY ended DESC, raw_id DESC) AS rn FROM n) WHERE rn = 1)
 SELECT content_uri, nm AS content_name, creator AS primary_creator_name, content_match_key FROM l JOIN k USING (content_uri)""")
def g12(spark, d):
    return content.export_content(_export_rows(spark, d)).select(
        "content_uri", "content_name", "primary_creator_name", "content_match_key"
    )


def _item_rows(spark, d):
    m = w.membership(spark, d)
    return m.select(
        "content_uri", w.type_of(F.col("part")).alias("content_type"),
        F.col("title").alias("content_name"), F.col("album").alias("parent_name"),
        F.col("artist").alias("primary_creator_name"), F.lit(1000).alias("duration_ms"), "isrc",
        F.col("snapshot_date").cast("timestamp").alias("ingested_at"),
        F.col("position").alias("item_ordinal"), F.lit(1).alias("raw_response_id"),
    )


@query("g13_playlist_content", f"""WITH {o.MEMBERS} SELECT DISTINCT content_uri, title AS content_name, artist AS primary_creator_name, isrc, content_match_key FROM mem""")
def g13(spark, d):
    return content.playlist_content(_item_rows(spark, d)).select(
        "content_uri", "content_name", "primary_creator_name", "isrc", "content_match_key"
    )


@query("g14_tracks_latest", f"""WITH {o.CATALOGUE} SELECT content_uri, content_name || CASE WHEN part % 4 = 0 THEN ' (Live)' ELSE '' END AS content_name,
 {o.fold("content_name")} || CASE WHEN part % 4 = 0 THEN ' (live)' ELSE '' END || '|artist ' || bn AS content_match_key, 'al' || (part % 200) AS album_id FROM cat WHERE is_resolved AND part % 10 > 1""")
def g14(spark, d):
    return w.tracks(spark, d).select("content_uri", "content_name", "content_match_key", "album_id")


@query("g14_tracks_latest_both_feeds", f"""WITH {o.EVENTS}, p AS (SELECT k, min(ts) AS f, max(ts) AS l FROM ev WHERE api AND k % 13 <> 0 GROUP BY 1)
 SELECT 'media:track:t' || k AS content_uri, CASE WHEN k % 3 = 0 THEN 'Looked up ' ELSE 'Title ' END || k AS content_name,
  strftime(f, '%Y-%m-%d %H:%M:%S') AS first_seen_at, strftime(l, '%Y-%m-%d %H:%M:%S') AS last_seen_at FROM p
 UNION ALL SELECT 'media:track:never' || k, 'Looked up ' || k, NULL, NULL FROM p WHERE k % 3 = 0""")
def g14_both(spark, d):
    """Captured plays and lookups: one newer than all plays, one older, one of a track never played."""
    plays = staging.recently_played(w.captured_pages(spark, d))
    k = F.substring("content_uri", 14, 20).cast("int")
    one = keep_first(plays, ["content_uri"], [F.asc("raw_response_id"), F.asc("item_ordinal")]).drop(
        "played_at_utc"
    ).withColumn("content_name", F.concat(F.lit("Looked up "), w.text(k)))
    lookups = one.withColumn(
        "ingested_at", F.when(k % 3 == 0, F.to_timestamp(F.lit("2100-01-01"))).otherwise(F.to_timestamp(F.lit("1900-01-01")))
    )
    never = one.filter(k % 3 == 0).withColumn("content_uri", F.concat(F.lit("media:track:never"), w.text(k)))
    return content.tracks_latest(plays, lookups.unionByName(never)).select(
        "content_uri", "content_name", stamp("first_seen_at"), stamp("last_seen_at")
    )


_ALB = """alb AS (SELECT row_number() OVER (ORDER BY album_id) AS album_key, album_id, 'Album ' || substr(album_id, 3) AS album_name,
  (1990 + arg_max(part, CASE WHEN part % 4 = 0 THEN 1000 ELSE part % 28 END * 1000000000 + part) % 30) || '-01' AS release_date FROM (SELECT part, 'al' || (part % 200) AS album_id FROM cat WHERE is_resolved AND part % 10 > 1) GROUP BY 2)"""


@query("g6_artists_both_feeds", f"""WITH {o.CATALOGUE}, {o.STAR}, {o.EVENTS}, pa AS (SELECT DISTINCT k FROM ev WHERE api AND k % 13 <> 0)
 SELECT artist_id, artist_name, artist_uri, is_fetched, has_genres_key FROM arts
 UNION ALL SELECT 'ev' || k % 40, 'Played ' || k % 40, 'media:artist:ev' || k % 40, FALSE, FALSE FROM pa GROUP BY ALL""")
def g6_both(spark, d):
    """Artists that only captured plays credit, beside those of lookups and their own."""
    return content.artists_latest(
        _credited_plays(spark, d), staging.track(w.raw_tracks(spark, d)), staging.artist(w.raw_artists(spark, d))
    ).select("artist_id", "artist_name", "artist_uri", "is_fetched", "has_genres_key")


def _credited_plays(spark, d):
    """Captured plays whose tracks name an album and an artist by their number."""
    plays = staging.recently_played(w.captured_pages(spark, d))
    k = F.substring("content_uri", 14, 20).cast("int")
    ident = F.concat(F.lit("ev"), w.text(k % 40))
    artist = F.struct(ident.alias("id"), F.concat(F.lit("media:artist:"), ident).alias("uri"),
                      F.concat(F.lit("Played "), w.text(k % 40)).alias("name"))
    album = F.concat(F.lit("ea"), w.text(k % 30))
    kinds = {f.name: f.dataType for f in plays.schema.fields}
    return plays.withColumns({
        "track_artists": F.array(artist).cast(kinds["track_artists"]), "album_id": album,
        "album_uri": F.concat(F.lit("media:album:"), album),
        "album_name": F.concat_ws(" ", F.lit("Taken from"), w.text("raw_response_id"), w.text("item_ordinal")),
        "album_release_date": F.lit("2001"),
    })


@query("g16_dim_album_both_feeds", f"""WITH {o.CATALOGUE}, {_ALB}, {o.EVENTS}, pg AS (SELECT *, event_id // 2000 * 100000000 + user_id AS page,
  row_number() OVER (PARTITION BY event_id // 2000, user_id ORDER BY event_id) AS ordinal, max(ts) OVER (PARTITION BY event_id // 2000, user_id) AS ingested FROM ev WHERE api),
 pl_ AS (SELECT 'ea' || k % 30 AS album_id, 'Taken from ' || page || ' ' || ordinal AS album_name, row_number() OVER (PARTITION BY k % 30 ORDER BY ingested DESC, ts DESC, page DESC, ordinal) AS rn FROM pg WHERE k % 13 <> 0)
 SELECT album_id, album_name, release_date FROM alb UNION ALL SELECT album_id, album_name, '2001' FROM pl_ WHERE rn = 1 UNION ALL SELECT '(unknown)', 'Unknown album', NULL""")
def g16_both(spark, d):
    """Albums of both feeds, the newest capture of each."""
    both = content.albums_latest(_credited_plays(spark, d), staging.track(w.raw_tracks(spark, d)))
    return star.dim_album(both).select("album_id", "album_name", "release_date")


_DC = f"""{o.HIST}, {o.CATALOGUE}, seen AS (SELECT content_uri, min(ended) AS f, max(ended) AS l FROM hist GROUP BY 1),
dc AS (SELECT row_number() OVER (ORDER BY f ASC NULLS LAST, content_uri) AS content_key, * FROM (
 SELECT c.content_uri, c.content_type, is_resolved AND part % 10 > 1 AS is_resolved, f, l,
  c.content_name || CASE WHEN is_resolved AND part % 10 > 1 AND part % 4 = 0 THEN ' (Live)' ELSE '' END AS content_name,
  least({o.fold("c.content_name")} || '|' || CASE WHEN is_resolved AND part % 10 > 1 THEN 'artist ' || bn END,
        {o.fold("c.content_name")} || ' (live)|' || CASE WHEN is_resolved AND part % 10 > 1 AND part % 4 = 0 THEN 'artist ' || bn END,
        CASE WHEN part % 2 = 0 THEN {o.fold("c.content_name")} || '|' || {o.fold("creator")} END) AS content_match_key FROM cat c LEFT JOIN seen USING (content_uri)
 WHERE (is_resolved AND part % 10 > 1) OR part % 2 = 0))"""


def _dim_content(spark, d, items=None):
    """Resolved tracks from lookups; even parts are also known from the export; `items` of playlists."""
    known = w.catalogue(spark, d).filter("(content_key - 1) % 2 = 0").select(
        "content_uri", "content_type", F.col("content_name").alias("track_name"),
        F.col("primary_creator_name").alias("album_artist_name"), F.col("parent_name").alias("album_name"),
        F.to_timestamp(F.lit("2001-01-01")).alias("ended_at_utc"), F.col("content_key").alias("raw_record_id"),
        *[F.lit(None).cast("string").alias(c) for c in
          ("episode_name", "audiobook_chapter_title", "episode_show_name", "audiobook_title")],
    )
    if items is None:
        items = _item_rows(spark, d).filter(F.lit(False))
    return star.dim_content(
        w.tracks(spark, d), content.export_content(known), content.playlist_content(items),
        w.history(spark, d),
    )


@query("g15_dim_content", f"""WITH {_DC} SELECT content_key, content_uri, content_type, content_name, is_resolved, strftime(f, '%Y-%m-%d %H:%M:%S') AS first_seen_at, content_match_key FROM dc
 UNION ALL SELECT -1, '(absent)', 'unknown', 'Unknown content', FALSE, NULL, NULL UNION ALL SELECT -2, '(pending)', 'unknown', 'Pending resolution', FALSE, NULL, NULL""")
def g15(spark, d):
    return _dim_content(spark, d).select(
        "content_key", "content_uri", "content_type", "content_name", "is_resolved",
        stamp("first_seen_at"), "content_match_key",
    )


@query("g15_dim_content_three_sources", f"""WITH {o.CATALOGUE}, {o.MEMBERS}, own AS (SELECT DISTINCT part AS p FROM mem), src AS (
  SELECT cat.*, is_resolved AND part % 10 > 1 AS api, part % 2 = 0 AS exported, p IS NOT NULL AS listed FROM cat LEFT JOIN own ON p = part)
 SELECT content_uri, api AS is_resolved, CASE WHEN api AND part % 4 = 0 THEN content_name || ' (Live)' WHEN api OR exported THEN content_name ELSE 'Listed ' || content_name END AS content_name,
  CASE WHEN api THEN 'Artist ' || bn WHEN exported THEN creator ELSE 'Owner of the list' END AS primary_creator_name,
  CASE WHEN api THEN p_size * 10000 WHEN NOT exported THEN 1000 END AS duration_ms FROM src WHERE api OR exported OR listed
 UNION ALL SELECT '(absent)', FALSE, 'Unknown content', NULL, NULL UNION ALL SELECT '(pending)', FALSE, 'Pending resolution', NULL, NULL""")
def g15_three(spark, d):
    """A playlist's own description counts only where neither of the better sources has the uri."""
    items = _item_rows(spark, d).withColumns(
        {"content_name": F.concat(F.lit("Listed "), "content_name"), "primary_creator_name": F.lit("Owner of the list")}
    )
    return _dim_content(spark, d, items).select(
        "content_uri", "is_resolved", "content_name", "primary_creator_name", "duration_ms"
    )


def _dim_album(spark, d):
    return star.dim_album(content.albums_latest(
        w.stg_no_plays(spark, d), staging.track(w.raw_tracks(spark, d))
    ))


@query("g16_dim_album", f"""WITH {o.CATALOGUE}, {_ALB} SELECT * FROM alb UNION ALL SELECT -1, '(unknown)', 'Unknown album', NULL""")
def g16(spark, d):
    return _dim_album(spark, d).select("album_key", "album_id", "album_name", "release_date")


@query("g16_dim_track_detail", f"""WITH {o.CATALOGUE}, {_ALB} SELECT content_key, album_key, CASE WHEN part % 17 <> 0 THEN CASE WHEN part % 2 = 0 THEN 'USABC' ELSE 'US-ABC-' END || lpad(CAST(part % 10000000 AS VARCHAR), 7, '0') END AS isrc,
 p_size % 2 = 0 AS is_explicit, p_size AS track_number FROM cat JOIN alb ON album_id = 'al' || (part % 200) WHERE is_resolved AND part % 10 > 1""")
def g16_detail(spark, d):
    return star.dim_track_detail(
        w.tracks(spark, d), w.catalogue(spark, d), _dim_album(spark, d)
    ).select("content_key", "album_key", "isrc", "is_explicit", "track_number")


@query("g17_dim_profile", f"""WITH {o.HIST}, {o.ZONES}, me AS (SELECT 'p' || (c_custkey % 5) AS profile_slug, arg_max(c_name, c_custkey) AS display_name FROM customer GROUP BY 1),
 tok AS (SELECT 'p' || (o_custkey % 5) AS profile_slug, arg_max(o_orderkey % 3 <> 0, (o_orderdate, o_orderkey)) AS t FROM orders GROUP BY 1), ok AS (SELECT 'p' || (o_custkey % 5) AS profile_slug, min(o_orderdate) + INTERVAL 2 SECOND AS a FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1),
 sp AS (SELECT profile_slug, min(ended) AS f, max(ended) AS l FROM hist WHERE source_system = 'export' GROUP BY 1)
 SELECT profile_key, profile_slug, display_name, t AND a IS NOT NULL AS has_api_access, strftime(f, '%Y-%m-%d %H:%M:%S') AS export_coverage_start, strftime(l, '%Y-%m-%d %H:%M:%S') AS export_coverage_end, strftime(a, '%Y-%m-%d %H:%M:%S') AS api_coverage_start
 FROM zones LEFT JOIN me USING (profile_slug) LEFT JOIN tok USING (profile_slug) LEFT JOIN ok USING (profile_slug) LEFT JOIN sp USING (profile_slug)
 UNION ALL SELECT -1, '(unknown)', 'Unknown profile', FALSE, NULL, NULL, NULL""")
def g17(spark, d):
    return dim_profile(spark, d).select(
        "profile_key", P, "display_name", "has_api_access", stamp("export_coverage_start"),
        stamp("export_coverage_end"), stamp("api_coverage_start"),
    )


def dim_profile(spark, d):
    from catalog.queries_events import _poll_rows

    return star.dim_profile(
        w.registry(spark), staging.me(_me(spark, d)),
        staging.api_access_observation(_token_rows(spark, d)),
        staging.poll_run(_poll_rows(spark, d)), _only_export(spark, d),
    )


@query("g20_dim_genre", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT genre_key, genre_name, tag_type FROM dg UNION ALL SELECT -1, '(unknown)', 'unknown'""")
def g20(spark, d):
    return w.dim_genre(spark, d).select("genre_key", "genre_name", "tag_type")


@query("g4_dim_artist", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT artist_key, artist_id, artist_name, genre_source, artist_mbid AS musicbrainz_artist_id, raw_response_id AS genre_raw_response_id, strftime(vf, '%Y-%m-%d') AS valid_from,
 strftime(valid_to, '%Y-%m-%d') AS valid_to, is_current FROM da UNION ALL SELECT -1, '(unknown)', 'Unknown artist', NULL, NULL, NULL, '1990-01-01', NULL, TRUE""")
def g4_artist(spark, d):
    return w.dim_artist(spark, d).select(
        "artist_key", "artist_id", "artist_name", "genre_source", "musicbrainz_artist_id",
        "genre_raw_response_id", day("valid_from"), day("valid_to"), "is_current",
    )


@query("g22_fct_playlist_membership", f"""WITH {o.MEMBERS}, pk AS (SELECT row_number() OVER (ORDER BY playlist_id) AS playlist_key, playlist_id FROM (SELECT DISTINCT playlist_id FROM item))
 SELECT CAST(snapshot_date AS VARCHAR) AS snapshot_date, CASE WHEN playlist_key % 10 = 0 THEN -1 ELSE playlist_key END AS playlist_key, CASE WHEN part % 9 <> 0 THEN part + 1 END AS content_key, content_uri, position, isrc FROM mem JOIN pk USING (playlist_id)""")
def g22(spark, d):
    return fct_membership(spark, d).select(
        day("snapshot_date"), "playlist_key", "content_key", "content_uri", "position", "isrc"
    )


def current_playlists(spark, d):
    """Suppliers as current playlists; every tenth is missing, so its members point at -1."""
    from playmart.operators.ordered import dense_surrogate

    ids = w.playlist_items(spark, d).select("playlist_id").distinct()
    return dense_surrogate(ids, [F.asc("playlist_id")], "playlist_key").withColumn(
        "is_current", F.col("playlist_key") % 10 != 0
    )


def fct_membership(spark, d):
    names = table(spark, d, "part").select(
        F.col("p_partkey").alias("part"),
        F.concat_ws(" ", "p_name", w.text(F.col("p_partkey") % 50)).alias("content_name"),
        F.col("p_brand").alias("primary_creator_name"), F.lit(False).alias("is_local"),
    )
    items = w.playlist_items(spark, d).join(names, "part")
    known = w.catalogue(spark, d).filter("(content_key - 1) % 9 <> 0")
    return star.fct_playlist_membership(items, current_playlists(spark, d), known)


@query("g23_br_content_artist", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT content_key, artist_key, is_primary, CAST(w AS DOUBLE) AS weight_factor, artist_ordinal FROM bca""")
def g23(spark, d):
    return w.br_content_artist(spark, d)


@query("g24_br_artist_genre", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT artist_key, genre_key, tag_type, vote_count, round(w, 6) AS weight_factor FROM bag""")
def g24(spark, d):
    return w.br_artist_genre(spark, d).withColumn("weight_factor", r("weight_factor", 6))


@query("e8_count_weight", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT tag_type, count(*) AS n, round(sum(w), 6) AS total FROM bag GROUP BY 1""")
def e8(spark, d):
    return w.br_artist_genre(spark, d).groupBy("tag_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("weight_factor"), 6).alias("total")
    )


@query("g20_dim_genre_bucket", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT bucket_name, count(genre_key) AS genres FROM bkt LEFT JOIN gmap USING (bucket_name) GROUP BY 1""")
def g20_bucket(spark, d):
    seed = w.buckets(spark).select("bucket_order", "bucket_name")
    known = w.bucket_map(spark, d).select("bucket_name", "genre_key")
    return star.dim_genre_bucket(seed).join(known, "bucket_name", "left").groupBy("bucket_name").agg(
        F.count("genre_key").alias("genres")
    )


@query("b7_export_fields", f"""WITH {o.HIST} SELECT content_type, count(*) AS n, count(*) FILTER (was_offline) AS offline FROM hist WHERE source_system = 'export' GROUP BY 1""")
def b7_fields(spark, d):
    return staging.export_play_record(raw_export(spark, d)).groupBy("content_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("was_offline").alias("offline")
    )
