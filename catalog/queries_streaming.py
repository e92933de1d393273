"""Captures over time: high-water marks, gaps, pending work, and the same as streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import oracle as o
from catalog import world as w
from catalog.base import query, r, stamp, table
from catalog.queries_events import _poll_rows
from playmart.session import shared_dir
from playmart.sources import staging
from playmart.streaming import captures as cp
from playmart.streaming import gaps as gp
from playmart.streaming import marks as mk
from playmart.streaming import merge as mg
from playmart.streaming import pending as pd

P = "profile_slug"
_POLLS = """pr AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 AS batch FROM events),
po AS (SELECT 'u' || user_id AS profile_slug, batch, min(ts) AS oldest, max(ts) AS newest, count(*) AS items_returned, max(ts) + INTERVAL 1 MINUTE AS captured_at FROM pr GROUP BY user_id, batch HAVING batch % 4 <> 3),
gp AS (SELECT *, max(newest) OVER (PARTITION BY profile_slug ORDER BY captured_at, oldest, newest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap_start FROM po),
gaps AS (SELECT profile_slug, gap_start, oldest AS gap_end, items_returned, captured_at AS detected_at FROM gp WHERE oldest > gap_start)"""
_GAPSEL = """SELECT profile_slug, strftime(gap_start, '%Y-%m-%d %H:%M:%S') AS gap_start, strftime(gap_end, '%Y-%m-%d %H:%M:%S') AS gap_end, items_returned FROM gaps"""


def _gap_cols(df):
    return df.select(P, stamp("gap_start"), stamp("gap_end"), "items_returned")


@query("r1_high_water_mark", f"WITH {_POLLS} SELECT profile_slug, strftime(max(newest), '%Y-%m-%d %H:%M:%S') AS high_water_mark FROM po GROUP BY 1")
def r1(spark, d):
    return gp.high_water_mark(w.polls(spark, d)).withColumn("high_water_mark", stamp("high_water_mark"))


@query("r1_captures_of_pages", f"""WITH {o.EVENTS} SELECT event_id // 2000 * 100000000 + user_id AS raw_response_id, count(*) AS items_returned, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS oldest, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest
 FROM ev WHERE api AND k % 13 <> 0 GROUP BY 1""")
def r1_pages(spark, d):
    return gp.captures_of(staging.recently_played(w.captured_pages(spark, d))).select(
        "raw_response_id", "items_returned", stamp("oldest"), stamp("newest")
    )


@query("r2_detect_gaps", f"WITH {_POLLS} {_GAPSEL}")
def r2(spark, d):
    return _gap_cols(gp.detect_gaps(w.polls(spark, d)))


_LANDED = ("profile_slug string, batch bigint, oldest timestamp, newest timestamp, "
           "items_returned bigint, captured_at timestamp")


def _gap_run(spark, d, start):
    """Four stretches of every profile's polls, landed one after the other as many files each; after
    every one the stream is started again from its checkpoint and takes what is new."""
    base = f"{shared_dir(spark)}/gap-stream-{uuid.uuid4().hex}"
    polls = w.polls(spark, d)
    for part in ("< 1", "= 1", "= 2", "> 2"):
        polls.filter(f"batch div 10 {part}").write.mode("append").parquet(f"{base}/captures")
        start(spark.readStream.schema(_LANDED).parquet(f"{base}/captures"), base).awaitTermination()
    return base


@query("r2_streaming_gaps", f"WITH {_POLLS} {_GAPSEL}")
def r2_stream(spark, d):
    """Micro-batches that hand on their marks as files; the gaps are read back from the sink."""
    base = _gap_run(spark, d, lambda landed, base: gp.start_gap_stream(
        landed, f"{base}/gaps", f"{base}/marks", f"{base}/checkpoint"))
    return _gap_cols(spark.read.parquet(f"{base}/gaps/{gp.run_of(f'{base}/checkpoint')}"))


@query("r2_stateful_gaps", f"WITH {_POLLS} {_GAPSEL}")
def r2_state(spark, d):
    """The marks kept in the state store, recovered at every start."""
    base = _gap_run(spark, d, lambda landed, base: mk.start_stateful_gaps(
        landed, f"{base}/gaps", f"{base}/checkpoint"))
    return _gap_cols(spark.read.schema(mk.GAPS).parquet(f"{base}/gaps"))


@query("r3_poll_status", """WITH p AS (SELECT o_orderkey AS id, 'p' || (o_custkey % 5) AS profile_slug, o_orderdate + INTERVAL 2 SECOND AS f, CASE WHEN o_orderstatus = 'F' THEN 'error' ELSE 'ok' END AS s FROM orders)
 SELECT profile_slug, strftime(max(f), '%Y-%m-%d %H:%M:%S') AS last_poll_at, arg_max(s, (f, id)) AS last_poll_status, strftime(max(f) FILTER (s = 'ok'), '%Y-%m-%d %H:%M:%S') AS last_ok_at, count(*) FILTER (f >= TIMESTAMP '1998-06-01') AS polls_24h,
 count(*) FILTER (f >= TIMESTAMP '1998-06-01' AND s = 'error') AS errors_24h, count(*) FILTER (s = 'error') AS gap_count FROM p GROUP BY 1""")
def r3(spark, d):
    polls = staging.poll_run(_poll_rows(spark, d))
    gaps = polls.filter("status = 'error'").select(
        P, F.col("started_at").alias("gap_start"), F.col("finished_at").alias("gap_end"),
        "items_returned", F.col("finished_at").alias("detected_at"),
    )
    marks = polls.groupBy(P).agg(F.max("finished_at").alias("high_water_mark"))
    used = polls.select(P).distinct()
    return gp.poll_status(polls, gaps, marks, used, "1998-06-02 00:00:00").select(
        P, stamp("last_poll_at"), "last_poll_status", stamp("last_ok_at"), "polls_24h",
        "errors_24h", "gap_count",
    )


_TID = "substr(md5(CAST(l_partkey AS VARCHAR)), 1, 22)"


def _tracks(spark, d):
    """Exported plays under 22-character track ids, and the ids that are already settled."""
    ident = F.substring(F.md5(w.text("part")), 1, 22)
    exp = w.history(spark, d).filter("source_system = 'export'").withColumn(
        "content_uri", F.concat(F.lit("media:track:"), ident)
    )
    part = table(spark, d, "part").select(
        "p_partkey", F.substring(F.md5(w.text("p_partkey")), 1, 22).alias("content_id")
    )
    tried = part.filter("p_partkey % 7 = 0").select(
        F.col("content_id").alias("track_id"),
        F.when(F.col("p_partkey") % 2 == 0, "not_found").otherwise("error").alias("status"),
    )
    return pd.pending_tracks(
        pd.track_totals(exp), part.filter("p_partkey % 5 = 0"), part.filter("p_partkey % 11 = 0"), tried
    )


_PEND = f"""{o.HIST}, pe AS (SELECT substr(md5(CAST(part AS VARCHAR)), 1, 22) AS track_id, part, CAST(coalesce(sum(ms), 0) AS BIGINT) AS ms_played, count(*) AS plays FROM hist WHERE source_system = 'export' AND content_type = 'track'
  AND NOT (part % 5 = 0 OR part % 11 = 0 OR (part % 7 = 0 AND part % 2 = 0)) GROUP BY ALL),
od AS (SELECT row_number() OVER w AS position, track_id, ms_played, plays, CAST(sum(ms_played) OVER w AS BIGINT) AS cumulative_ms, CAST(sum(plays) OVER w AS BIGINT) AS cumulative_plays FROM pe WINDOW w AS (ORDER BY ms_played DESC, plays DESC, track_id))"""


@query("r4_pending_tracks", f"WITH {_PEND} SELECT track_id, ms_played, plays FROM pe")
def r4(spark, d):
    return _tracks(spark, d)


@query("r4_pending_isrcs", "SELECT DISTINCT 'USABC' || lpad(CAST(p_partkey % 10000000 AS VARCHAR), 7, '0') AS isrc FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 10 > 1 AND p_partkey % 17 <> 0 AND p_partkey % 4 <> 0")
def r4_isrcs(spark, d):
    done = staging.isrc_lookup(w.raw_external(spark, d)).filter("raw_response_id % 4 = 0")
    return pd.pending_isrcs(staging.track(w.raw_tracks(spark, d)), done)


@query("r4_pending_mbids", f"WITH {o.CATALOGUE}, {o.STAR} SELECT DISTINCT m AS artist_mbid FROM (SELECT m1 AS m FROM lk UNION SELECT m2 FROM lk) WHERE m IS NOT NULL AND m NOT IN (SELECT artist_mbid FROM resp)")
def r4_mbids(spark, d):
    return pd.pending_mbids(
        staging.isrc_lookup(w.raw_external(spark, d)), w.external_artists(spark, d)
    )


@query("r4_pending_artists", f"WITH {o.CATALOGUE}, {o.STAR} SELECT artist_id FROM alist WHERE artist_id NOT IN (SELECT artist_id FROM own)")
def r4_artists(spark, d):
    return pd.pending_artists(
        staging.track(w.raw_tracks(spark, d)), staging.artist(w.raw_artists(spark, d))
    )


@query("r5_order_for_resolution", f"WITH {_PEND} SELECT * FROM od")
def r5(spark, d):
    return pd.order_for_resolution(_tracks(spark, d))


@query("r5_coverage_table", f"""WITH {_PEND}, t AS (SELECT count(*) AS n, sum(ms_played) AS ms, sum(plays) AS p FROM pe), a AS (SELECT sum(ms) AS ms FROM hist WHERE source_system = 'export' AND content_type = 'track')
 SELECT position AS calls, round(100.0 * cumulative_ms / t.ms, 4) AS pct_unresolved_ms, round(100.0 * cumulative_plays / t.p, 4) AS pct_unresolved_plays, round(100.0 * cumulative_ms / a.ms, 4) AS pct_all_track_ms, round(position * 1.13 / 3600, 6) AS hours
 FROM od, t, a WHERE position IN (100, 500, 1000, 2500, 5000, 10000, 20000) OR position = n""")
def r5_table(spark, d):
    whole = w.history(spark, d).filter("source_system = 'export' and content_type = 'track'").agg(
        F.sum("ms_played")
    )
    return pd.coverage_table(pd.order_for_resolution(_tracks(spark, d)), whole).select(
        "calls", r("pct_unresolved_ms"), r("pct_unresolved_plays"), r("pct_all_track_ms"),
        r("hours", 6),
    )


@query("e13_cumulative_checkpoints", f"WITH {_PEND} SELECT position, cumulative_ms FROM od WHERE position IN (1, 2, 3, 10, 99)")
def e13(spark, d):
    return pd.order_for_resolution(_tracks(spark, d)).filter("position in (1, 2, 3, 10, 99)").select(
        "position", "cumulative_ms"
    )


@query("r6_api_access_observation", "SELECT DISTINCT 'p' || (o_custkey % 5) AS profile_slug, o_custkey % 5 <> 2 AS has_stored_token FROM orders")
def r6(spark, d):
    used = table(spark, d, "orders").select(F.concat(F.lit("p"), w.text(F.col("o_custkey") % 5)).alias(P))
    tokens = used.filter("profile_slug <> 'p2'")
    return gp.api_access(used.distinct(), tokens, "2024-01-01").drop("observed_at")


@query("r7_streaming_dedupe", f"""WITH {o.EVENTS}, pg AS (SELECT *, event_id // 2000 * 100000000 + user_id AS page,
  row_number() OVER (PARTITION BY event_id // 2000, user_id ORDER BY event_id) AS item_ordinal, max(ts) OVER (PARTITION BY event_id // 2000, user_id) + INTERVAL 1 MINUTE AS ingested FROM ev WHERE api),
 it AS (SELECT *, 'p' || (user_id % 5) AS profile_slug, 'media:track:t' || k AS content_uri, date_trunc('minute', ts) AS minute_ FROM pg WHERE k % 13 <> 0),
 x AS (SELECT *, row_number() OVER (PARTITION BY profile_slug, content_uri, minute_ ORDER BY ingested, page, item_ordinal) AS rn FROM it)
 SELECT profile_slug, content_uri, strftime(minute_, '%Y-%m-%d %H:%M:%S') AS minute, strftime(ingested, '%Y-%m-%d %H:%M:%S') AS ingested_at, page AS raw_response_id, item_ordinal FROM x WHERE rn = 1""")
def r7(spark, d):
    """Landed pages, the latest first, read as a stream of micro-batches, staged and deduplicated."""
    base = f"{shared_dir(spark)}/capture-stream-{uuid.uuid4().hex}"
    pages = w.captured_pages(spark, d)
    for part in (2, 0, 1):  # the same page again, and pages later than those of other profiles
        pages.filter(f"pmod(id, 3) in ({part}, 2)").write.mode("append").parquet(f"{base}/landed")
        items = staging.recently_played(cp.landed_responses(spark, f"{base}/landed"))
        cp.start_capture_dedupe(items, f"{base}/kept", f"{base}/checkpoint").awaitTermination()
    return cp.captured_plays(spark, f"{base}/kept").select(
        P, "content_uri", stamp("minute"), stamp("ingested_at"), "raw_response_id", "item_ordinal"
    )


@query("r7_merge_late_exports", f"""WITH {o.EVENTS} SELECT profile_slug, content_uri,
 strftime(ended, '%Y-%m-%d %H:%M:%S') AS ended_at, source_system, raw_id AS raw_response_id, CAST(ms AS BIGINT) AS ms_played FROM dd""")
def r7_exports(spark, d):
    """Captured plays first, in two stretches that overlap; then the exports, after all of them; then
    the first stretch once more. Merged by profile and month, the store equals one dedupe of everything."""
    base = f"{shared_dir(spark)}/play-merge-{uuid.uuid4().hex}"
    plays = w.event_plays(spark, d)
    first = "source_system = 'api' and pmod(raw_response_id, 3) < 2"
    for share in (first, "source_system = 'api' and pmod(raw_response_id, 3) > 0", "source_system = 'export'", first):
        plays.filter(share).write.mode("append").parquet(f"{base}/landed")
        landed = spark.readStream.schema(plays.schema).parquet(f"{base}/landed")
        mg.start_play_merge(landed, f"{base}/plays", f"{base}/checkpoint").awaitTermination()
    return mg.merged_plays(spark, f"{base}/plays", plays.schema).select(
        P, "content_uri", stamp("ended_at_utc", "ended_at"), "source_system", "raw_response_id", "ms_played"
    )
