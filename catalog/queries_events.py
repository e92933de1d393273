"""Play events: union, dedupe, fact keys, local dates, staged captures, latest, versions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import oracle as o
from catalog import world as w
from catalog.base import day, query, r, stamp, table, utc
from playmart.functions.clock import daypart
from playmart.functions.periods import period_start
from playmart.operators.ordered import (
    dense_surrogate, keep_first, latest_observation, ranked, split_scan,
)
from playmart.operators.version_store import VersionStore
from playmart.operators.versions import overlapping_versions, version_starts, with_epoch
from playmart.plans import star
from playmart.plans.events import coverage_windows, dedupe_play_events, union_play_events
from playmart.plans.timeseries import with_coverage
from playmart.session import pinned, shared_dir
from playmart.sources import staging


@query("monthly_coverage", f"""WITH {o.EVENT_FACT}
SELECT profile_slug, CAST(CAST(date_trunc('month', local_ts) AS DATE) AS VARCHAR) AS month,
  count(*) AS play_count, count(ms) AS rows_with_duration, CAST(sum(ms) AS BIGINT) AS ms_played,
  count(*) FILTER (qualified) AS qualified_play_count,
  count(*) FILTER (source_system = 'export' AND event_type = 'error') AS skipped_count,
  count(*) FILTER (source_system = 'export' AND user_id % 2 = 0) AS shuffled_count,
  count(*) FILTER (source_system = 'export' AND user_id % 3 = 0) AS offline_count, {o.HOURS}, {o.PCT}
FROM ef GROUP BY 1, 2""")
def monthly_coverage(spark, d):
    fact = w.event_fact(spark, d)
    dated = fact.join(
        F.broadcast(w.dim_date(spark).select("date_key", "month_start")), "date_key", "left"
    ).join(w.profiles(spark).select("profile_key", "profile_slug"), "profile_key")
    out = with_coverage(dated, ["profile_slug", "month_start"])
    return out.select(
        "profile_slug", day("month_start", "month"), "play_count", "rows_with_duration",
        "ms_played", "qualified_play_count", "skipped_count", "shuffled_count", "offline_count",
        r("hours"), r("pct_rows_with_duration"),
    )


@query("g1_union_play_events", f"""WITH {o.EVENTS} SELECT source_system, profile_slug, content_type, count(*) AS n,
 count(ms) AS timed, CAST(sum(ms) AS BIGINT) AS ms, CAST(sum(raw_id) AS BIGINT) AS ids FROM ep GROUP BY ALL""")
def g1(spark, d):
    """The two sources with their own columns; export records of a type nobody knows drop out."""
    plays = w.event_plays(spark, d)
    api = plays.filter("source_system = 'api'").withColumnRenamed("ended_at_utc", "played_at_utc")
    export = plays.filter("source_system = 'export'").withColumnsRenamed(
        {"raw_response_id": "raw_record_id", "item_ordinal": "record_index"}
    )
    odd = export.withColumn("content_type", F.when(F.col("raw_record_id") % 2 == 0, F.lit("video")))
    both = union_play_events(api, export.unionByName(odd))
    return both.groupBy("source_system", "profile_slug", "content_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("ms_played").alias("timed"),
        F.sum("ms_played").alias("ms"), F.sum("raw_response_id").alias("ids"),
    )


@query("g2_dedupe_play_events", f"""WITH {o.EVENTS} SELECT profile_slug, content_uri,
 strftime(ended, '%Y-%m-%d %H:%M:%S') AS ended_at, source_system, raw_id AS raw_response_id, CAST(ms AS BIGINT) AS ms_played FROM dd""")
def g2(spark, d):
    return dedupe_play_events(w.event_plays(spark, d)).select(
        "profile_slug", "content_uri", stamp("ended_at_utc", "ended_at"), "source_system",
        "raw_response_id", "ms_played",
    )


@query("g21_fct_play_event", f"""WITH {o.EVENT_FACT} SELECT play_event_key, profile_key, content_key,
 CAST(strftime(local_ts, '%Y%m%d') AS INT) AS date_key, hour(local_ts) * 100 + minute(local_ts) AS time_of_day_key,
 strftime(ended, '%Y-%m-%d %H:%M:%S') AS ended_at, ms AS ms_played, qualified AS is_qualified_play, source_system FROM ef""")
def g21(spark, d):
    return w.event_fact(spark, d).select(
        "play_event_key", "profile_key", "content_key", "date_key", "time_of_day_key",
        stamp("ended_at_utc", "ended_at"), "ms_played", "is_qualified_play", "source_system",
    )


@query("n3_play_event_key", f"""WITH {o.EVENT_FACT} SELECT count(*) AS n, count(DISTINCT play_event_key) AS keys,
 min(play_event_key) AS low, max(play_event_key) AS high FROM ef""")
def n3(spark, d):
    k = "play_event_key"
    return w.event_fact(spark, d).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(k).alias("keys"), F.min(k).alias("low"),
        F.max(k).alias("high"),
    )


@query("l23_local_vs_utc_date", f"""WITH {o.EVENT_FACT} SELECT profile_slug, CAST(CAST(local_ts AS DATE) AS VARCHAR) AS local_date,
 count(*) AS plays, count(*) FILTER (CAST(local_ts AS DATE) <> CAST(ended AS DATE)) AS other_utc_date FROM ef GROUP BY ALL""")
def l23(spark, d):
    rows = dedupe_play_events(w.event_plays(spark, d)).join(
        w.profiles(spark).select("profile_slug", "home_timezone"), "profile_slug"
    )
    local = F.to_date(F.from_utc_timestamp("ended_at_utc", F.col("home_timezone")))
    return rows.withColumn("ld", local).groupBy("profile_slug", "ld").agg(
        F.count(F.lit(1)).alias("plays"),
        F.count_if(F.col("ld") != F.to_date("ended_at_utc")).alias("other_utc_date"),
    ).select("profile_slug", day("ld", "local_date"), "plays", "other_utc_date")


@query("l24_api_window_facts", f"""WITH {o.EVENTS}, f AS (SELECT profile_slug, min(ingested) AS first_poll FROM dd
 WHERE source_system = 'api' GROUP BY 1)
 SELECT profile_slug, source_system, strftime(min(ended), '%Y-%m-%d %H:%M:%S') AS first_play,
 strftime(max(ended), '%Y-%m-%d %H:%M:%S') AS last_play, count(*) AS plays,
 count(*) FILTER (ended < first_poll) AS before_first_poll FROM dd JOIN f USING (profile_slug) GROUP BY ALL""")
def l24(spark, d):
    from playmart.plans.profiling import api_window_facts

    plays = dedupe_play_events(w.event_plays(spark, d))
    polls = plays.filter("source_system = 'api'").select(
        "profile_slug", F.lit("ok").alias("status"), F.col("ingested_at").alias("finished_at")
    )
    return api_window_facts(plays, polls).select(
        "profile_slug", "source_system", stamp("first_play"), stamp("last_play"), "plays",
        "before_first_poll",
    )


@query("l25_gap_evidence", f"""WITH {o.EVENTS} SELECT source_system, content_type, count(*) AS plays, count(*) - count(ms) AS null_durations
 FROM ep GROUP BY ALL""")
def l25(spark, d):
    from playmart.plans.profiling import gap_evidence

    return gap_evidence(w.event_plays(spark, d))


@query("l25_captured_item_types", f"""WITH {o.EVENTS} SELECT content_type AS type, count(*) AS items FROM (SELECT {o.kind('k')} AS content_type FROM ev WHERE api) GROUP BY 1""")
def l25_types(spark, d):
    from playmart.plans.profiling import captured_item_types

    return captured_item_types(w.captured_pages(spark, d))


@query("j1_coverage_window", f"""WITH {o.EVENTS}, {o.ZONES} SELECT profile_slug,
 CAST(CAST(timezone(tz, timezone('UTC', min(ended))) AS DATE) AS VARCHAR) AS window_start,
 CAST(CAST(timezone(tz, timezone('UTC', max(ended))) AS DATE) AS VARCHAR) AS window_end
 FROM dd JOIN zones USING (profile_slug) WHERE source_system = 'export' GROUP BY profile_slug, tz""")
def j1(spark, d):
    return coverage_windows(dedupe_play_events(w.event_plays(spark, d)), w.profiles(spark)).select(
        "profile_slug", day("window_start"), day("window_end")
    )


# --- staged captures ------------------------------------------------------------------------------

_PAGE = f"""{o.EVENTS}, pg AS (SELECT e.*, event_id // 2000 AS page, 'p' || (user_id % 5) AS profile_slug,
  row_number() OVER (PARTITION BY user_id, event_id // 2000 ORDER BY event_id) AS item_ordinal FROM ev e WHERE api)"""


@query("b1_stg_recently_played", f"""WITH {_PAGE} SELECT page * 100000000 + user_id AS raw_response_id, profile_slug, item_ordinal,
 strftime(ts, '%Y-%m-%d %H:%M:%S') AS played_at, 'media:track:t' || k AS content_uri, {o.kind('k')} AS content_type,
 'Title ' || k AS content_name, k * 1000 AS duration_ms, k % 2 = 0 AS is_explicit,
 CASE WHEN k % 4 <> 0 THEN 'isrc' || k END AS isrc, 'Album ' || (k % 9) AS album_name,
 CASE WHEN k % 6 <> 0 THEN 2 ELSE 0 END AS n_artists FROM pg WHERE k % 13 <> 0""")
def b1(spark, d):
    return staging.recently_played(w.captured_pages(spark, d)).select(
        "raw_response_id", "profile_slug", "item_ordinal", stamp("played_at_utc", "played_at"),
        "content_uri", "content_type", "content_name", "duration_ms", "is_explicit", "isrc",
        "album_name", F.size("track_artists").alias("n_artists"),
    )


@query("b2_stg_track", f"""WITH {o.CATALOGUE} SELECT content_uri, 't' || part AS content_id, look AS again,
 content_name || CASE look WHEN 1 THEN ' (Live)' ELSE '' END AS content_name, duration_ms,
 CASE WHEN part % 17 <> 0 THEN CASE WHEN part % 2 = 0 THEN 'USABC' ELSE 'US-ABC-' END || lpad(CAST(part % 10000000 AS VARCHAR), 7, '0') END AS isrc,
 'al' || (part % 200) AS album_id, (1990 + part % 30) || '-01' AS album_release_date,
 CASE WHEN part % 15 = 0 THEN 3 WHEN part % 5 = 0 THEN 2 ELSE 1 END AS n_artists
 FROM cat, (VALUES (0), (1)) l(look) WHERE is_resolved AND part % 10 > 1 AND (look = 0 OR part % 4 = 0)""")
def b2(spark, d):
    return staging.track(w.raw_tracks(spark, d)).select(
        "content_uri", "content_id",
        F.when(F.col("raw_response_id") >= 10_000_000_000, 1).otherwise(0).alias("again"),
        "content_name", "duration_ms", "isrc", "album_id", "album_release_date",
        F.size("track_artists").alias("n_artists"),
    )


@query("b3_stg_artist", f"""WITH {o.CATALOGUE} SELECT DISTINCT 'a' || bn AS artist_id, 'Artist No. ' || bn AS artist_name,
 bn % 2 = 0 AS has_genres_key FROM cat WHERE bn % 3 = 0""")
def b3(spark, d):
    return staging.artist(w.raw_artists(spark, d)).select(
        "artist_id", "artist_name", "has_genres_key"
    )


def _me(spark, d):
    c = table(spark, d, "customer")
    doc = F.struct(
        F.concat(F.lit("user"), w.text("c_custkey")).alias("id"),
        F.col("c_name").alias("display_name"), F.lit("premium").alias("product"),
        F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("N"), w.text("c_nationkey"))).alias("country"),
    )
    return c.select(
        F.col("c_custkey").alias("id"), F.lit("me").alias("feed"),
        F.concat(F.lit("p"), w.text(F.col("c_custkey") % 5)).alias("profile_slug"),
        F.lit("me.json").alias("source_file"),
        F.timestamp_seconds(F.col("c_custkey") * 60).alias("ingested_at"),
        F.to_json(doc).alias("payload"),
    )


@query("b4_stg_me", """SELECT 'p' || (c_custkey % 5) AS profile_slug, 'user' || c_custkey AS user_id, c_name AS display_name,
 CASE WHEN c_nationkey % 2 = 0 THEN 'N' || c_nationkey END AS country, 'premium' AS product FROM customer""")
def b4(spark, d):
    return staging.me(_me(spark, d)).select(
        "profile_slug", "user_id", "display_name", "country", "product"
    )


_PLQ = """plq AS (SELECT l_suppkey AS s, date_trunc('quarter', l_shipdate) AS q, count(*) // 10 AS total FROM lineitem GROUP BY 1, 2)"""


@query("b5_stg_playlist", f"""WITH {_PLQ} SELECT 'pl' || s AS playlist_id, CAST(CAST(q AS DATE) AS VARCHAR) AS snapshot_date,
 CASE WHEN s % 3 <> 0 THEN 'mixed' END AS description, s % 2 = 0 AS is_owned_by_profile, s % 5 = 0 AS is_public,
 CAST(total AS BIGINT) AS track_total FROM plq""")
def b5(spark, d):
    return staging.playlist(w.raw_playlists(spark, d)).select(
        "playlist_id", day("snapshot_date"), "description", "is_owned_by_profile", "is_public",
        "track_total",
    )


def _item_pages(spark, d):
    """Playlist pages: one supplier's lines of 2,000 consecutive orders, offset by that block."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", utc("l_shipdate").alias("at"),
        "l_extendedprice",
    )
    n = F.col("l_partkey")
    block = F.floor(F.col("l_orderkey") / 2000)
    info = F.struct(
        F.when(n % 19 != 0, w.uri_of(n)).alias("uri"),
        F.concat(F.lit("Part "), w.text(n)).alias("name"),
        F.struct(F.when(n % 17 != 0, w.isrc_of(n)).alias("isrc")).alias("external_ids"),
        F.array(F.struct(F.concat(F.lit("Maker "), w.text(n % 40)).alias("name"))).alias("artists"),
    )
    entry = F.struct(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.when(n % 3 != 0, F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("").alias("added_at"),
        F.when(n % 2 == 0, info).alias("item"), F.when(n % 2 == 1, info).alias("track"),
    )
    pages = li.groupBy("l_suppkey", block.alias("block")).agg(
        F.array_sort(F.collect_list(entry)).alias("items")
    )
    href = F.concat(F.lit("https://host/v1/playlists/pl"), w.text("l_suppkey"), F.lit("/items?x=1"))
    doc = F.struct(
        href.alias("href"), (F.col("block") * 20_000).cast("int").alias("offset"), "items"
    )
    return pages.select(
        (F.col("block") * 1_000_000 + F.col("l_suppkey")).alias("id"),
        F.lit("playlist_item").alias("feed"), F.lit("p0").alias("profile_slug"),
        F.lit("items.json").alias("source_file"),
        F.to_timestamp(F.lit("2002-01-01")).alias("ingested_at"), F.to_json(doc).alias("payload"),
    )


@query("b6_stg_playlist_item", f"""WITH x AS (SELECT *, l_orderkey // 2000 AS block, row_number() OVER (PARTITION BY l_suppkey, l_orderkey // 2000
  ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS ord FROM lineitem)
 SELECT 'pl' || l_suppkey AS playlist_id, block * 20000 + ord AS position, ord AS item_ordinal, {o.uri('l_partkey')} AS content_uri,
 'Part ' || l_partkey AS content_name, 'Maker ' || (l_partkey % 40) AS primary_creator_name,
 CASE WHEN l_partkey % 17 <> 0 THEN 'USABC' || lpad(CAST(l_partkey % 10000000 AS VARCHAR), 7, '0') END AS isrc,
 CASE WHEN l_partkey % 3 <> 0 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS added_at FROM x WHERE l_partkey % 19 <> 0""")
def b6(spark, d):
    return staging.playlist_item(_item_pages(spark, d)).select(
        "playlist_id", "position", "item_ordinal", "content_uri", "content_name",
        "primary_creator_name", "isrc", stamp("added_at"),
    )


def raw_export(spark, d):
    """The exported part of the history as the JSON records of an export file."""
    h = w.history(spark, d).filter("source_system = 'export'")
    is_ = lambda k: F.col("content_type") == k
    name = F.concat(F.lit("Title "), w.text("part"))
    doc = F.struct(
        F.date_format("ended_at_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"), "ms_played",
        F.when(is_("track"), F.col("content_uri")).alias("spotify_track_uri"),
        F.when(is_("episode"), F.col("content_uri")).alias("spotify_episode_uri"),
        F.when(is_("audiobook_chapter"), F.col("content_uri")).alias("audiobook_chapter_uri"),
        F.when(is_("track"), name).alias("master_metadata_track_name"),
        F.when(is_("episode"), name).alias("episode_name"),
        F.coalesce("reason_start", F.lit("")).alias("reason_start"),
        F.coalesce("reason_end", F.lit("")).alias("reason_end"),
        F.col("was_skipped").alias("skipped"), F.col("was_shuffled").alias("shuffle"),
        F.col("was_offline").alias("offline"), F.col("was_incognito").alias("incognito_mode"),
        F.col("offline_timestamp_raw").alias("offline_timestamp"), "platform", "conn_country",
    )
    return h.select(
        "profile_slug", "source_file", F.col("raw_response_id").alias("record_index"),
        F.col("raw_response_id").alias("raw_record_id"), "ingested_at",
        F.to_json(doc).alias("payload"),
    )


@query("b7_stg_export_play_record", f"""WITH {o.HIST} SELECT profile_slug, content_type, reason_start, reason_end, count(*) AS plays,
 CAST(sum(ms) AS BIGINT) AS ms, count(*) FILTER (was_skipped) AS skipped, count(*) FILTER (was_incognito) AS incognito,
 count(DISTINCT content_uri) AS items, strftime(max(ended), '%Y-%m-%d %H:%M:%S') AS last_play,
 count(*) FILTER (content_type = 'track') AS track_names
 FROM hist WHERE source_system = 'export' GROUP BY ALL""")
def b7(spark, d):
    rec = staging.export_play_record(raw_export(spark, d))
    return rec.groupBy("profile_slug", "content_type", "reason_start", "reason_end").agg(
        F.count(F.lit(1)).alias("plays"), F.sum("ms_played").alias("ms"),
        F.count_if("was_skipped").alias("skipped"), F.count_if("was_incognito").alias("incognito"),
        F.count_distinct("content_uri").alias("items"),
        F.max("ended_at_utc").alias("last_play"), F.count("track_name").alias("track_names"),
    ).withColumn("last_play", stamp("last_play"))


@query("b8_stg_isrc_lookup", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT isrc, is_found, CASE WHEN is_found THEN 2 END AS n_recordings FROM lk""")
def b8(spark, d):
    rows = staging.isrc_lookup(w.raw_external(spark, d))
    n = F.when(F.col("recordings").isNotNull(), F.size("recordings"))
    return rows.select("isrc", "is_found", n.alias("n_recordings"))


@query("b9_stg_external_artist", f"""WITH {o.CATALOGUE}, {o.STAR} SELECT r.raw_response_id, r.artist_mbid, NOT (r.bn % 11 = 0 AND look = 0) AS is_found,
 CASE WHEN NOT (r.bn % 11 = 0 AND look = 0) THEN coalesce((SELECT count(*) FROM tg WHERE tg.raw_response_id = r.raw_response_id AND tag_type = 'genre'), 0) END AS n_genres,
 CASE WHEN NOT (r.bn % 11 = 0 AND look = 0) THEN coalesce((SELECT count(*) FROM tg WHERE tg.raw_response_id = r.raw_response_id AND tag_type = 'tag'), 0) END AS n_tags FROM resp r""")
def b9(spark, d):
    rows = w.external_artists(spark, d)
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c)).alias(f"n_{c}")
    return rows.select("raw_response_id", "artist_mbid", "is_found", size("genres"), size("tags"))


def _poll_rows(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("p"), w.text(F.col("o_custkey") % 5)).alias("profile_slug"),
        utc("o_orderdate").alias("started_at"),
        (utc("o_orderdate") + F.expr("interval 2 second")).alias("finished_at"),
        F.when(F.col("o_orderstatus") == "F", "error").otherwise("ok").alias("status"),
        F.lit(50).alias("items_returned"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("raw_id"),
        F.when(F.col("o_orderstatus") == "F", "timeout").alias("error_message"),
    )


@query("b10_stg_poll_run", """SELECT o_orderkey AS poll_run_id, 'p' || (o_custkey % 5) AS profile_slug,
 CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'ok' END AS status, CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS raw_response_id FROM orders""")
def b10(spark, d):
    return staging.poll_run(_poll_rows(spark, d)).select(
        "poll_run_id", "profile_slug", "status", "raw_response_id"
    )


def _token_rows(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("p"), w.text(F.col("o_custkey") % 5)).alias("profile_slug"),
        (F.col("o_orderkey") % 3 != 0).alias("has_stored_token"),
        utc("o_orderdate").alias("observed_at"),
    )


@query("b11_stg_api_access_observation", """SELECT o_orderkey AS api_access_observation_id, 'p' || (o_custkey % 5) AS profile_slug,
 o_orderkey % 3 <> 0 AS has_stored_token FROM orders""")
def b11(spark, d):
    return staging.api_access_observation(_token_rows(spark, d)).drop("observed_at")


@query("b12_stg_profile_registry", f"""WITH {o.ZONES} SELECT DISTINCT 'p' || (o_custkey % 5) AS profile_slug, tz AS home_timezone
 FROM orders JOIN zones ON zones.profile_slug = 'p' || (o_custkey % 5)""")
def b12(spark, d):
    used = table(spark, d, "orders").select(
        F.concat(F.lit("p"), w.text(F.col("o_custkey") % 5)).alias("profile_slug")
    ).distinct()
    return staging.profile_registry(w.registry(spark)).join(used, "profile_slug", "left_semi").drop(
        "household_role"
    )


@query("b13_records_at", f"""WITH {_PAGE} SELECT page * 100000000 + user_id AS id, count(*) AS records, min(k) AS low, max(k) AS high FROM pg GROUP BY 1""")
def b13(spark, d):
    rec = staging.records_at(w.captured_pages(spark, d), "items")
    k = (F.variant_get("record", "$.track.duration_ms", "int") / 1000).cast("int")
    return rec.groupBy("id").agg(
        F.count(F.lit(1)).alias("records"), F.min(k).alias("low"), F.max(k).alias("high")
    )


# --- latest, versions, surrogates -----------------------------------------------------------------

_SCD = """c AS (SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus, lag(o_orderstatus) OVER w AS prev FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
v AS (SELECT o_custkey, o_orderkey, o_orderstatus, o_orderdate, row_number() OVER w AS vn, lead(o_orderdate) OVER w AS vt
  FROM c WHERE prev IS NULL OR prev <> o_orderstatus WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))"""


def _observed(spark, d):
    return table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", utc("o_orderdate").alias("seen"), "o_orderstatus"
    )


def _versions(spark, d):
    return with_epoch(
        version_starts(_observed(spark, d), "o_custkey", ["seen", "o_orderkey"], "o_orderstatus",
                       F.trunc("seen", "month")),
        "1990-01-01",
    )


@query("g4_scd2_from_signature", f"""WITH {_SCD} SELECT o_custkey, vn AS version_number, o_orderstatus,
 CASE WHEN vn = 1 THEN '1990-01-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS valid_from,
 strftime(vt, '%Y-%m-%d') AS valid_to, vt IS NULL AS is_current FROM v""")
def g4(spark, d):
    return _versions(spark, d).select(
        "o_custkey", "version_number", "o_orderstatus", day("valid_from"), day("valid_to"),
        "is_current",
    )


@query("g4_incremental_versions", f"""WITH {_SCD} SELECT o_custkey, vn AS version_number, o_orderstatus,
 CASE WHEN vn = 1 THEN '1990-01-01' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS valid_from,
 strftime(vt, '%Y-%m-%d') AS valid_to, vt IS NULL AS is_current FROM v""")
def g4_merged(spark, d):
    """The same history from observations that come in three mixed shares, the second one twice."""
    obs = _observed(spark, d)
    store = VersionStore(spark, f"{shared_dir(spark)}/versions-{uuid.uuid4().hex}", obs.schema, "o_custkey",
                         ["seen", "o_orderkey"], "o_orderstatus")
    table = None
    for number, share in enumerate((1, 0, 0, 2)):
        new = obs.filter(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == share)
        store.merge(new, number)
        table = store.versions(number) if table is None else store.refreshed(table, new.select("o_custkey").distinct(), number)
        # a table of its own each time, as a warehouse would hold it
        table = pinned(table)
    return with_epoch(table, "1990-01-01").select(
        "o_custkey", "version_number", "o_orderstatus", day("valid_from"), day("valid_to"), "is_current",
    )


@query("g5_dim_playlist", f"""WITH {_PLQ}, h AS (SELECT *, lag(total) OVER (PARTITION BY s ORDER BY q) AS prev FROM plq),
 v AS (SELECT 'pl' || s AS playlist_id, q, total, s % 2 = 0 AS own, lead(q) OVER (PARTITION BY s ORDER BY q) AS vt FROM h WHERE prev IS NULL OR prev <> total)
 SELECT row_number() OVER (ORDER BY playlist_id, q) AS playlist_key, playlist_id, CAST(total AS BIGINT) AS track_total, own AS is_owned_by_profile,
  strftime(q, '%Y-%m-%d') AS valid_from, strftime(vt, '%Y-%m-%d') AS valid_to, vt IS NULL AS is_current FROM v
 UNION ALL SELECT -1, '(unknown)', NULL, NULL, NULL, NULL, FALSE""")
def g5(spark, d):
    return star.dim_playlist(staging.playlist(w.raw_playlists(spark, d))).select(
        "playlist_key", "playlist_id", "track_total", "is_owned_by_profile", day("valid_from"),
        day("valid_to"), "is_current",
    )


@query("g3_latest_observation", """SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
 ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def g3(spark, d):
    return latest_observation(
        table(spark, d, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]
    ).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("o1_dense_surrogate", """SELECT row_number() OVER (ORDER BY CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END ASC NULLS LAST, o_orderkey) AS key,
 o_orderkey FROM orders""")
def o1(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")).alias("seen")
    )
    return dense_surrogate(
        orders, [F.asc_nulls_last("seen"), F.asc("o_orderkey")], "key"
    ).select("key", "o_orderkey")


@query("e1_row_number_keep_one", """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
 ORDER BY CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END DESC NULLS LAST, o_orderkey) rn FROM orders) WHERE rn = 1""")
def e1(spark, d):
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return keep_first(
        table(spark, d, "orders").withColumn("price", price), ["o_custkey"],
        [F.desc_nulls_last("price"), F.asc("o_orderkey")],
    ).select("o_custkey", "o_orderkey")


@query("e2_distinct_on", """SELECT DISTINCT ON (o_custkey, o_orderpriority) o_custkey, o_orderpriority, o_orderkey FROM orders
 ORDER BY o_custkey, o_orderpriority, o_orderdate, o_orderkey""")
def e2(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(
        F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("o_orderkey")
    )


@query("e3_global_row_number", """SELECT row_number() OVER (ORDER BY c_name, c_custkey) AS customer_key, c_custkey FROM customer""")
def e3(spark, d):
    return ranked(
        table(spark, d, "customer").select("c_name", "c_custkey"),
        [F.asc("c_name"), F.asc("c_custkey")], "customer_key",
    ).select("customer_key", "c_custkey")


def _orders(spark, d):
    return table(spark, d, "orders").select(
        "o_custkey", "o_orderkey", utc("o_orderdate").alias("seen"), "o_orderstatus",
        "o_totalprice",
    )


@query("e4_lag_change_flag", """SELECT o_custkey, o_orderkey, (prev IS NULL OR prev <> o_orderstatus) AS is_change FROM (SELECT *, lag(o_orderstatus)
 OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM orders)""")
def e4(spark, d):
    out = split_scan(_orders(spark, d), ["o_custkey"], ["seen", "o_orderkey"],
                     F.trunc("seen", "month"), lag={"prev": "o_orderstatus"})
    change = F.col("prev").isNull() | (F.col("prev") != F.col("o_orderstatus"))
    return out.select("o_custkey", "o_orderkey", change.alias("is_change"))


@query("e5_running_sum_islands", """SELECT o_custkey, o_orderkey, CAST(sum(chg) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS island FROM (
 SELECT *, CASE WHEN lag(o_orderstatus) OVER w IS NULL OR lag(o_orderstatus) OVER w <> o_orderstatus THEN 1 ELSE 0 END AS chg FROM orders
 WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))""")
def e5(spark, d):
    order, chunk = ["seen", "o_orderkey"], F.trunc("seen", "month")
    marked = split_scan(_orders(spark, d), ["o_custkey"], order, chunk,
                        lag={"prev": "o_orderstatus"})
    change = F.coalesce((F.col("prev") != F.col("o_orderstatus")).cast("int"), F.lit(1))
    out = split_scan(marked.withColumn("chg", change), ["o_custkey"], order, chunk,
                     running_sum={"island": "chg"})
    return out.select("o_custkey", "o_orderkey", "island")


@query("e6_lead_valid_to", """SELECT o_custkey, o_orderkey, strftime(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), '%Y-%m-%d') AS valid_to FROM orders""")
def e6(spark, d):
    out = split_scan(_orders(spark, d), ["o_custkey"], ["seen", "o_orderkey"],
                     F.trunc("seen", "month"), lead={"valid_to": "seen"})
    return out.select("o_custkey", "o_orderkey", day("valid_to"))


@query("e11_consecutive_difference", """SELECT o_custkey, o_orderkey, date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) AS days FROM orders""")
def e11(spark, d):
    out = split_scan(_orders(spark, d), ["o_custkey"], ["seen", "o_orderkey"],
                     F.trunc("seen", "month"), lag={"prev": "seen"})
    return out.select("o_custkey", "o_orderkey", F.date_diff("seen", "prev").alias("days"))


@query("c14_interval_overlap", """WITH b AS (SELECT o_custkey AS k, o_orderkey AS id, o_orderdate AS vf, CASE WHEN o_orderkey % 10 = 0 THEN NULL
   ELSE o_orderdate + INTERVAL 20 DAY END AS vt FROM orders)
 SELECT DISTINCT a.k AS o_custkey, a.id AS o_orderkey FROM b a JOIN b x ON a.k = x.k AND a.id <> x.id
  AND a.vf < coalesce(x.vt, TIMESTAMP '9999-12-31') AND x.vf < coalesce(a.vt, TIMESTAMP '9999-12-31')
  AND (x.vf, coalesce(x.vt, TIMESTAMP '9999-12-31'), x.id) < (a.vf, coalesce(a.vt, TIMESTAMP '9999-12-31'), a.id)""")
def c14(spark, d):
    seen = _orders(spark, d)
    spans = keep_spans(seen)
    return overlapping_versions(spans, "o_custkey", F.trunc("valid_from", "year")).select(
        "o_custkey", "o_orderkey"
    )


def keep_spans(seen):
    open_end = F.col("o_orderkey") % 10 == 0
    return seen.select(
        "o_custkey", "o_orderkey", F.col("seen").alias("valid_from"),
        F.when(~open_end, F.col("seen") + F.expr("interval 20 day")).alias("valid_to"),
    )


@query("m11_one_current_version", f"""WITH {_SCD} SELECT o_custkey, count(*) FILTER (vt IS NULL) AS current_versions FROM v
 WHERE o_orderkey % 7 <> 0 GROUP BY 1 HAVING count(*) FILTER (vt IS NULL) <> 1""")
def m11(spark, d):
    from playmart.plans.checks import not_one_current

    return not_one_current(_versions(spark, d).filter("o_orderkey % 7 <> 0"), "o_custkey")


# --- calendar -------------------------------------------------------------------------------------


@query("g18_dim_date", """WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
 x AS (SELECT CAST(unnest(generate_series(CAST(DATE '1994-01-01' AS TIMESTAMP), TIMESTAMP '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS f)
 SELECT CAST(strftime(f, '%Y%m%d') AS INT) AS date_key, CAST(f AS VARCHAR) AS full_date, year(f) AS year, quarter(f) AS quarter, monthname(f) AS month_name,
  isodow(f) AS day_of_week_iso, dayname(f) AS day_of_week_name, week(f) AS iso_week, isoyear(f) AS iso_year, isodow(f) >= 6 AS is_weekend
 FROM x JOIN b ON f BETWEEN lo AND hi""")
def g18(spark, d):
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    first, last = days.agg(F.min("day")).scalar(), days.agg(F.max("day")).scalar()
    dates = star.dim_date(spark, "2026-12-31", "1994-01-01").filter("date_key > 0")
    inside = dates.filter(F.col("full_date").between(first, last))
    return inside.select(
        "date_key", day("full_date"), "year", "quarter", "month_name", "day_of_week_iso",
        "day_of_week_name", "iso_week", "iso_year", "is_weekend",
    )


@query("g19_dim_time_of_day", f"""WITH {o.EVENT_FACT} SELECT {o.part_of_day('hour(local_ts)')} AS daypart, hour(local_ts) AS hour, count(*) AS plays,
 count(DISTINCT hour(local_ts) * 100 + minute(local_ts)) AS minutes_used FROM ef GROUP BY ALL""")
def g19(spark, d):
    times = star.dim_time_of_day(spark)
    return w.event_fact(spark, d).join(F.broadcast(times), "time_of_day_key").groupBy(
        "daypart", "hour"
    ).agg(F.count(F.lit(1)).alias("plays"),
          F.count_distinct("time_of_day_key").alias("minutes_used"))


@query("j4_period_start_end", """SELECT DISTINCT CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS week_start,
 CAST(CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS VARCHAR) AS week_end, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start,
 CAST(last_day(o_orderdate) AS VARCHAR) AS month_end, year(o_orderdate) || '-12-31' AS year_end FROM orders""")
def j4(spark, d):
    from playmart.functions.periods import period_end

    at = F.to_date("o_orderdate")
    cols = {}
    for grain in ("week", "month", "year"):
        cols[f"{grain}_start"] = period_start(at, grain)
        cols[f"{grain}_end"] = period_end(period_start(at, grain), grain)
    rows = table(spark, d, "orders").select(*[c.alias(n) for n, c in cols.items()]).distinct()
    return rows.select(day("week_start"), day("week_end"), day("month_start"), day("month_end"),
                       day("year_end")).distinct()


@query("e7_min_over_partition", """SELECT p_partkey, p_size = min(p_size) OVER (PARTITION BY p_brand) AS is_smallest FROM part""")
def e7(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    low = part.groupBy("p_brand").agg(F.min("p_size").alias("low"))
    return part.join(low, "p_brand").select(
        "p_partkey", (F.col("p_size") == F.col("low")).alias("is_smallest")
    )


@query("daypart_of_hour", f"""WITH h AS (SELECT DISTINCT hour(ts) AS hour FROM events) SELECT hour, {o.part_of_day('hour')} AS daypart FROM h""")
def daypart_of_hour(spark, d):
    hours = table(spark, d, "events").select(F.hour("ts").alias("hour")).distinct()
    return hours.withColumn("daypart", daypart(F.col("hour")))
