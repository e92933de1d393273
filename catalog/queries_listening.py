"""Time series, listening reports and the allocation chain over the long history."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import oracle as o
from catalog import world as w
from catalog.base import day, query, r
from playmart.config import DAYPART_NAMES, GENRE_BUCKETS
from playmart.functions.periods import grain_for
from playmart.plans import allocation as al
from playmart.plans import listening as li
from playmart.plans import timeseries as ts
from playmart.plans.stored import StoredStar, genre_months
from playmart.session import shared_dir

P = "profile_slug"


def _series_cols(*more):
    return [P, day("period"), "play_count", "rows_with_duration", "ms_played", *more]


_SEL = "profile_slug, CAST(period AS VARCHAR) AS period, play_count, rows_with_duration, ms_played"


@query("j2_enriched_plays", f"""WITH {o.PLAYS} SELECT profile_slug, yr AS year, daypart, category, has_artist_id, count(*) AS plays,
 CAST(sum(content_key) AS BIGINT) AS keys, count(creator) AS named, CAST(sum(duration_ms) AS BIGINT) AS length FROM pl GROUP BY ALL""")
def j2(spark, d):
    return w.plays(spark, d).groupBy(P, "year", "daypart", "category", "has_artist_id").agg(
        F.count(F.lit(1)).alias("plays"), F.sum("content_key").alias("keys"),
        F.count("primary_creator_name").alias("named"), F.sum("duration_ms").alias("length"),
    )


@query("j3_grain_for_window", f"""WITH {o.PLAYS} SELECT profile_slug, CASE WHEN we - ws > 730 THEN 'week' ELSE 'day' END AS grain FROM win""")
def j3(spark, d):
    grain = grain_for(F.col("window_start"), F.col("window_end"))
    return w.windows(spark, d).select(P, grain.alias("grain"))


@query("j5_with_coverage", f"""WITH {o.PLAYS} SELECT profile_slug, category, source_system, {o.MEASURES}, {o.HOURS}, {o.PCT} FROM pl GROUP BY 1, 2, 3""")
def j5(spark, d):
    return ts.with_coverage(w.plays(spark, d), [P, "category", "source_system"]).withColumns(
        {"hours": r("hours"), "pct_rows_with_duration": r("pct_rows_with_duration")}
    )


@query("j6_clip_to_window", f"""WITH {o.PLAYS}, x AS (SELECT profile_slug, CAST(date_trunc('year', full_date) AS DATE) AS period, count(*) AS plays FROM pl GROUP BY 1, 2)
 SELECT profile_slug, CAST(period AS VARCHAR) AS period, plays, period < ws + 400 OR make_date(year(period), 12, 31) > we - 400 AS is_partial
 FROM x JOIN win USING (profile_slug) WHERE make_date(year(period), 12, 31) >= ws + 400 AND period <= we - 400""")
def j6(spark, d):
    narrow = w.windows(spark, d).withColumns(
        {"window_start": F.date_add("window_start", 400), "window_end": F.date_sub("window_end", 400)}
    )
    years = w.plays(spark, d).groupBy(P, F.trunc("full_date", "year").alias("period")).agg(
        F.count(F.lit(1)).alias("plays")
    )
    return ts.clip_to_window(years, narrow, "year").select(P, day("period"), "plays", "is_partial")


@query("j7_time_series_day", f"""WITH {o.PLAYS}, {o.series('day')} SELECT {_SEL}, is_partial FROM ser""")
def j7_day(spark, d):
    out = ts.time_series(ts.exported(w.plays(spark, d)), w.windows(spark, d), "day")
    return out.select(*_series_cols("is_partial"))


@query("j7_time_series_week", f"""WITH {o.PLAYS}, {o.series('week')} SELECT {_SEL}, skipped_count, is_partial FROM ser""")
def j7_week(spark, d):
    out = ts.time_series(ts.exported(w.plays(spark, d)), w.windows(spark, d), "week")
    return out.select(*_series_cols("skipped_count", "is_partial"))


@query("j7_time_series_by", f"""WITH {o.PLAYS} SELECT profile_slug, CAST(CAST(date_trunc('month', full_date) AS DATE) AS VARCHAR) AS period, category, count(*) AS play_count,
 CAST(sum(ms) AS BIGINT) AS ms_played FROM ex JOIN win USING (profile_slug) GROUP BY 1, 2, 3""")
def j7_by(spark, d):
    out = ts.time_series(ts.exported(w.plays(spark, d)), w.windows(spark, d), "month", by="category")
    return out.select(P, day("period"), "category", "play_count", "ms_played")


@query("j8_days_in_window", f"""WITH {o.PLAYS}, {o.series('month')} SELECT profile_slug, CAST(period AS VARCHAR) AS period,
 CAST(least(period_end, we) - greatest(period, ws) + 1 AS INT) AS days FROM ser""")
def j8(spark, d):
    win = w.windows(spark, d)
    series = ts.time_series(ts.exported(w.plays(spark, d)), win, "month")
    return ts.days_in_window(series, win, "month").select(P, day("period"), "days")


_PHASE = """ph0 AS (SELECT profile_slug, CAST(date_trunc('month', full_date) AS DATE) AS month, count(*) AS plays,
  sum(sin((hr + mi / 60.0) * 2 * pi() / 24)) AS s, sum(cos((hr + mi / 60.0) * 2 * pi() / 24)) AS c,
  year(min(full_date)) * 12 + month(min(full_date)) AS n FROM ex GROUP BY 1, 2),
ph1 AS (SELECT a.profile_slug, a.month, a.plays, a.n, any_value(a.s) AS s, any_value(a.c) AS c, sum(b.s) AS bs, sum(b.c) AS bc FROM ph0 a LEFT JOIN ph0 b
  ON a.profile_slug = b.profile_slug AND a.n <> b.n AND abs(a.n - b.n) <= 6 GROUP BY 1, 2, 3, 4),
ph2 AS (SELECT profile_slug, month, plays, n, (atan2(s, c) * 24 / (2 * pi()) + 24) % 24 AS mean_hour,
  (atan2(bs, bc) * 24 / (2 * pi()) + 24) % 24 AS baseline_hour FROM ph1),
ph AS (SELECT *, (mean_hour - baseline_hour + 36) % 24 - 12 AS shift FROM ph2)"""


@query("j9_monthly_phase", f"""WITH {o.PLAYS}, {_PHASE} SELECT profile_slug, CAST(month AS VARCHAR) AS month, plays, round(mean_hour, 4) AS mean_hour,
 round(baseline_hour, 4) AS baseline_hour, round(shift, 4) AS shift_hours FROM ph""")
def j9(spark, d):
    return ts.monthly_phase(ts.exported(w.plays(spark, d))).select(
        P, day("month"), "plays", r("mean_hour"), r("baseline_hour"), r("shift_hours")
    )


_RUNS = """fl AS (SELECT *, shift > 0 AS later FROM ph JOIN win USING (profile_slug) WHERE plays >= 20 AND abs(shift) >= 1
  AND month >= ws AND last_day(month) <= we),
isl AS (SELECT *, n - row_number() OVER (PARTITION BY profile_slug, later ORDER BY n) AS island FROM fl),
runs AS (SELECT profile_slug, min(month) AS first_month, max(month) AS last_month, count(*) AS months,
  sum(shift * plays) / sum(plays) AS mean_shift, CAST(sum(plays) AS BIGINT) AS plays FROM isl GROUP BY profile_slug, later, island)"""


def _runs(spark, d):
    phase = li.phase_signal(w.plays(spark, d), w.windows(spark, d)).filter("not is_partial")
    return ts.shift_runs(phase, min_plays=20)


@query("j10_shift_runs", f"""WITH {o.PLAYS}, {_PHASE}, {_RUNS} SELECT profile_slug, CAST(first_month AS VARCHAR) AS first_month, CAST(last_month AS VARCHAR) AS last_month,
 months, round(mean_shift, 4) AS mean_shift_hours, plays FROM runs""")
def j10(spark, d):
    return _runs(spark, d).select(
        P, day("first_month"), day("last_month"), "months", r("mean_shift_hours"), "plays"
    )


# --- reports --------------------------------------------------------------------------------------


@query("k1_coverage_facts", f"""WITH {o.PLAYS}, x AS (SELECT p.*, export_end FROM pl p LEFT JOIN win USING (profile_slug))
 SELECT profile_slug, count(*) AS plays, count(*) FILTER (source_system = 'export') AS export_plays, count(*) FILTER (source_system = 'api') AS api_plays,
 count(ms) AS rows_with_duration, count(*) FILTER (is_resolved) AS resolved_plays, count(DISTINCT content_key) AS items,
 count(DISTINCT content_key) FILTER (is_resolved) AS resolved_items, count(*) FILTER (source_system = 'api' AND ended > export_end) AS api_plays_after_export,
 round(100.0 * count(*) FILTER (is_resolved) / count(*), 4) AS pct_plays_resolved FROM x GROUP BY 1""")
def k1(spark, d):
    out = li.coverage_facts(w.plays(spark, d), w.windows(spark, d))
    return out.drop("pct_rows_with_duration", "pct_items_resolved").withColumn(
        "pct_plays_resolved", r("pct_plays_resolved")
    )


@query("k1_coverage_by_source", f"""WITH {o.PLAYS} SELECT profile_slug, source_system, {o.MEASURES}, {o.HOURS}, {o.PCT} FROM pl GROUP BY 1, 2""")
def k1_source(spark, d):
    return li.coverage_by(w.plays(spark, d), "source_system").withColumns(
        {"hours": r("hours"), "pct_rows_with_duration": r("pct_rows_with_duration")}
    )


@query("k2_minutes_per_day", f"""WITH {o.PLAYS}, {o.series('week')}, m AS (SELECT *, ms_played / 60000.0 / (least(period_end, we) - greatest(period, ws) + 1) AS mpd FROM ser)
 SELECT profile_slug, CAST(period AS VARCHAR) AS period, round(mpd, 4) AS minutes_per_day, is_partial,
 round(CASE WHEN count(mpd) OVER w >= 6 THEN avg(mpd) OVER w END, 3) AS rolling FROM m
 WINDOW w AS (PARTITION BY profile_slug ORDER BY period ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)""")
def k2(spark, d):
    out = li.minutes_per_day(w.plays(spark, d), w.windows(spark, d), "week")
    return out.select(P, day("period"), r("minutes_per_day"), "is_partial", r("rolling", 3))


@query("k2_yearly_table", f"""WITH {o.PLAYS} SELECT profile_slug, yr AS year, {o.HOURS}, count(*) AS play_count, count(ms) AS rows_with_duration, {o.PCT},
 make_date(yr, 1, 1) < any_value(ws) OR make_date(yr, 12, 31) > any_value(we) AS is_partial FROM ex JOIN win USING (profile_slug) GROUP BY 1, 2""")
def k2_year(spark, d):
    return li.yearly_table(w.plays(spark, d), w.windows(spark, d)).withColumns(
        {"hours": r("hours"), "pct_rows_with_duration": r("pct_rows_with_duration")}
    )


@query("k3_monthly_totals", f"""WITH {o.PLAYS}, {o.series('month')} SELECT {_SEL}, round(ms_played / 3600000.0, 4) AS hours, is_partial FROM ser""")
def k3(spark, d):
    out = li.monthly_totals(w.plays(spark, d), w.windows(spark, d))
    return out.select(*_series_cols(r("hours"), "is_partial"))


@query("k3_busiest_and_quietest", f"""WITH {o.PLAYS}, {o.series('month')}, f AS (SELECT * FROM ser WHERE NOT is_partial AND ms_played IS NOT NULL),
 a AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY ms_played DESC, period) AS up,
  row_number() OVER (PARTITION BY profile_slug ORDER BY ms_played, period) AS dn FROM f)
 SELECT x.profile_slug, CAST(x.period AS VARCHAR) AS busiest_period, x.play_count AS busiest_play_count, CAST(y.period AS VARCHAR) AS quietest_period,
 y.play_count AS quietest_play_count FROM a x JOIN a y ON x.profile_slug = y.profile_slug AND x.up = 1 AND y.dn = 1""")
def k3_busiest(spark, d):
    series = li.monthly_totals(w.plays(spark, d), w.windows(spark, d))
    return li.busiest_and_quietest(series).select(
        P, day("busiest_period"), "busiest_play_count", day("quietest_period"),
        "quietest_play_count",
    )


_DP = ", ".join(
    f"round(CAST(sum(ms) FILTER (daypart = '{x}') AS DOUBLE) / 3600000, 4) AS {x}" for x in DAYPART_NAMES
)


@query("k4_weekday_by_daypart", f"""WITH {o.PLAYS} SELECT profile_slug, dow AS day_of_week_name, {_DP} FROM ex GROUP BY 1, 2""")
def k4(spark, d):
    out = li.weekday_by_daypart(w.plays(spark, d), "hours")
    return out.select(P, "day_of_week_name", *[r(x) for x in DAYPART_NAMES])


@query("k5_qualified_gap", f"""WITH {o.PLAYS}, {o.series('week')} SELECT profile_slug, CAST(period AS VARCHAR) AS period, play_count, qualified_play_count,
 round(100.0 * (1 - qualified_play_count * 1.0 / nullif(play_count, 0)), 4) AS gap_pct FROM ser""")
def k5(spark, d):
    out = li.qualified_gap(w.plays(spark, d), w.windows(spark, d), "week")
    return out.select(P, day("period"), "play_count", "qualified_play_count", r("gap_pct"))


def _share_sql(value: str) -> str:
    return f"""WITH {o.PLAYS}, x AS (SELECT profile_slug, CAST(date_trunc('month', full_date) AS DATE) AS period, category, {value} AS v FROM ex GROUP BY 1, 2, 3),
 t AS (SELECT profile_slug, period, sum(v) AS total, coalesce(sum(v) FILTER (category = 'music'), 0) AS m, coalesce(sum(v) FILTER (category = 'podcast'), 0) AS p,
  coalesce(sum(v) FILTER (category = 'audiobook'), 0) AS a FROM x GROUP BY 1, 2)
 SELECT profile_slug, CAST(period AS VARCHAR) AS period, round(100.0 * m / nullif(total, 0), 4) AS music, round(100.0 * p / nullif(total, 0), 4) AS podcast,
 round(100.0 * a / nullif(total, 0), 4) AS audiobook FROM t"""


def _share(spark, d, value):
    out = li.category_share(w.plays(spark, d), w.windows(spark, d), value)
    return out.select(P, day("period"), r("music"), r("podcast"), r("audiobook"))


@query("k6_time_share", _share_sql("sum(ms)"))
def k6_time(spark, d):
    return _share(spark, d, "ms_played")


@query("k6_count_share", _share_sql("count(*)"))
def k6_count(spark, d):
    return _share(spark, d, "play_count")


@query("k6_yearly_category_share", f"""WITH {o.PLAYS}, x AS (SELECT profile_slug, yr AS year, category, sum(ms) AS ms, count(*) AS play_count FROM ex GROUP BY 1, 2, 3)
 SELECT profile_slug, year, category, round(100.0 * ms / sum(ms) OVER (PARTITION BY profile_slug, year), 4) AS share, play_count FROM x""")
def k6_year(spark, d):
    return li.yearly_category_share(w.plays(spark, d)).select(
        P, "year", "category", r("share"), "play_count"
    )


@query("k6_category_totals", f"""WITH {o.PLAYS}, x AS (SELECT profile_slug, category, sum(ms) AS ms, count(*) AS n FROM ex GROUP BY 1, 2)
 SELECT profile_slug, category, round(100.0 * ms / sum(ms) OVER (PARTITION BY profile_slug), 4) AS time_share,
 round(100.0 * n / sum(n) OVER (PARTITION BY profile_slug), 4) AS count_share FROM x""")
def k6_totals(spark, d):
    return li.category_totals(w.plays(spark, d)).select(
        P, "category", r("time_share"), r("count_share")
    )


@query("k7_podcast_leaderboard", f"""WITH {o.PLAYS}, b AS (SELECT profile_slug, parent_name AS "show", round(CAST(sum(ms) AS DOUBLE) / 3600000, 4) AS hours, sum(ms) AS ms,
  count(DISTINCT content_key) AS episodes, count(*) AS play_count, round(100.0 * avg(CASE WHEN duration_ms > 0 AND ms IS NOT NULL THEN least(1.0, CAST(ms AS DOUBLE) / duration_ms) END), 3) AS mean_completion_pct FROM ex
  WHERE category = 'podcast' GROUP BY 1, 2),
 x AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY ms DESC NULLS LAST, "show") AS rank FROM b)
 SELECT profile_slug, "show", hours, episodes, play_count, mean_completion_pct, rank FROM x WHERE rank <= 15""")
def k7(spark, d):
    return li.podcast_leaderboard(w.plays(spark, d)).select(
        P, "show", r("hours"), "episodes", "play_count", r("mean_completion_pct", 3), "rank"
    )


@query("k8_podcast_by_daypart", f"""WITH {o.PLAYS} SELECT profile_slug, daypart, {o.HOURS}, count(*) AS play_count, {o.PCT} FROM ex WHERE category = 'podcast' GROUP BY 1, 2""")
def k8(spark, d):
    return li.podcast_by_daypart(w.plays(spark, d)).withColumns(
        {"hours": r("hours"), "pct_rows_with_duration": r("pct_rows_with_duration")}
    )


_TOPA = """ra AS (SELECT *, row_number() OVER (PARTITION BY profile_slug, yr ORDER BY ms DESC NULLS LAST, creator) AS rank FROM (
  SELECT profile_slug, yr, creator, sum(ms) AS ms, count(*) AS play_count FROM ex WHERE category = 'music' AND creator IS NOT NULL GROUP BY 1, 2, 3)),
top10 AS (SELECT * FROM ra WHERE rank <= 10)"""


@query("k14_ranked_artists", f"""WITH {o.PLAYS}, {_TOPA} SELECT profile_slug, yr AS year, creator AS artist, round(CAST(ms AS DOUBLE) / 3600000, 4) AS hours, play_count, rank FROM top10""")
def k14(spark, d):
    return li.ranked_artists(w.plays(spark, d)).select(
        P, "year", F.col("primary_creator_name").alias("artist"), r("hours"), "play_count", "rank"
    )


@query("k14_recurring_artists", f"""WITH {o.PLAYS}, {_TOPA}, x AS (SELECT profile_slug, creator AS artist, count(*) AS years, CAST(sum(ms) AS DOUBLE) / 3600000 AS hours FROM top10 GROUP BY 1, 2 HAVING count(*) >= 2),
 y AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY hours DESC, artist) AS rank FROM x)
 SELECT profile_slug, artist, years, round(hours, 4) AS hours, rank FROM y WHERE rank <= 12""")
def k14_recurring(spark, d):
    return li.recurring_artists(w.plays(spark, d)).select(
        P, F.col("primary_creator_name").alias("artist"), "years", r("hours"), "rank"
    )


_PLACES = ", ".join(
    f"max(CASE WHEN rank = {n} THEN creator || ' (' || CAST(round(CAST(ms AS DOUBLE) / 3600000) AS BIGINT) || ' h)' END) AS place_{n}"
    for n in range(1, 6)
)


@query("k14_leaders_by_year", f"""WITH {o.PLAYS}, {_TOPA} SELECT profile_slug, yr AS year, {_PLACES} FROM top10 GROUP BY 1, 2""")
def k14_leaders(spark, d):
    return li.leaders_by_year(w.plays(spark, d))


@query("k14_artist_coverage", f"""WITH {o.PLAYS} SELECT profile_slug, yr AS year, {o.HOURS}, count(*) AS play_count, {o.PCT},
 round(100.0 * count(*) FILTER (has_artist_id) / count(*), 4) AS pct_plays_with_artist_id FROM ex WHERE category = 'music' GROUP BY 1, 2""")
def k14_coverage(spark, d):
    return li.artist_coverage_by_year(w.plays(spark, d)).select(
        P, "year", r("hours"), "play_count", r("pct_rows_with_duration"),
        r("pct_plays_with_artist_id"),
    )


@query("k15_longest_tail", f"""WITH {o.PLAYS}, t AS (SELECT profile_slug, content_key, min(content_name) AS track, min(creator) AS artist, min(full_date) AS f, max(full_date) AS l, count(*) AS n
  FROM ex WHERE category = 'music' GROUP BY 1, 2),
 x AS (SELECT t.*, (l - f) / 365.25 AS span FROM t JOIN win USING (profile_slug) WHERE n >= 10 AND l >= we - 90),
 y AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY span DESC, content_key) AS rank FROM x)
 SELECT profile_slug, content_key, track, artist, CAST(f AS VARCHAR) AS first_play, CAST(l AS VARCHAR) AS last_play, round(span, 4) AS span_years, n AS play_count, rank FROM y WHERE rank <= 15""")
def k15(spark, d):
    return li.longest_tail(w.plays(spark, d), w.windows(spark, d)).select(
        P, "content_key", "track", "artist", day("first_play"), day("last_play"), r("span_years"),
        "play_count", "rank",
    )


def _bursty(spark, d):
    """Plays with a rule that moves every seventh track's plays into one month."""
    born = F.add_months(F.lit("1996-03-01").cast("date"), (F.col("content_key") % 40).cast("int"))
    moved = F.date_add(born, F.dayofmonth("full_date") % 28)
    return w.plays(spark, d).withColumn(
        "full_date", F.when(F.col("content_key") % 7 == 0, moved).otherwise(F.col("full_date"))
    )


_BURSTY = """exk AS (SELECT * REPLACE (CASE WHEN content_key % 7 = 0 THEN CAST(DATE '1996-03-01' + to_months(CAST(content_key % 40 AS INT)) AS DATE) + CAST(day(full_date) % 28 AS INT)
  ELSE full_date END AS full_date) FROM ex)"""


@query("k16_one_hit_wonders", f"""WITH {o.PLAYS}, {_BURSTY}, m AS (SELECT profile_slug, content_key, CAST(date_trunc('month', full_date) AS DATE) AS month, count(*) AS n FROM exk WHERE category = 'music' GROUP BY 1, 2, 3),
 k AS (SELECT profile_slug, content_key, max(n) AS peak, CAST(sum(n) AS BIGINT) AS life, max(month) AS last_month, arg_max(month, n * 100000 - (year(month) * 12 + month(month))) AS pm FROM m GROUP BY 1, 2),
 x AS (SELECT k.* FROM k JOIN win USING (profile_slug) WHERE life >= 10 AND peak >= 0.8 * life AND last_month = pm AND pm <= CAST(we - INTERVAL 6 MONTH AS DATE)),
 y AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY peak DESC, content_key) AS rank FROM x)
 SELECT profile_slug, content_key, CAST(pm AS VARCHAR) AS peak_month, peak AS plays_in_peak_month, life AS lifetime_plays, rank FROM y WHERE rank <= 15""")
def k16(spark, d):
    return li.one_hit_wonders(_bursty(spark, d), w.windows(spark, d)).select(
        P, "content_key", day("peak_month"), "plays_in_peak_month", "lifetime_plays", "rank"
    )


@query("k16_track_peaks", f"""WITH {o.PLAYS}, m AS (SELECT profile_slug, content_key, CAST(date_trunc('month', full_date) AS DATE) AS month, count(*) AS n FROM ex GROUP BY 1, 2, 3)
 SELECT profile_slug, content_key, max(n) AS peak, CAST(arg_max(month, n * 100000 - (year(month) * 12 + month(month))) AS VARCHAR) AS peak_month FROM m GROUP BY 1, 2""")
def k16_peaks(spark, d):
    monthly = ts.exported(w.plays(spark, d)).groupBy(
        P, "content_key", F.trunc("full_date", "month").alias("month")
    ).agg(F.count(F.lit(1)).alias("n"))
    best = F.struct("n", -F.unix_date("month"))
    return monthly.groupBy(P, "content_key").agg(
        F.max("n").alias("peak"), F.max_by("month", best).alias("peak_month")
    ).withColumn("peak_month", day("peak_month"))


def _rate_sql(count: str, name: str) -> str:
    return f"""WITH {o.PLAYS}, {o.series('month')} SELECT profile_slug, CAST(period AS VARCHAR) AS period, play_count, {count},
 round(100.0 * {count} / nullif(play_count, 0), 4) AS {name} FROM ser"""


def _rate(spark, d, count, name):
    out = li.rate_series(w.plays(spark, d), w.windows(spark, d), count, name)
    return out.select(P, day("period"), "play_count", count, r(name))


def _reasons_sql(column: str) -> str:
    return f"""WITH {o.PLAYS}, v AS (SELECT profile_slug, yr, coalesce({column}, 'not recorded') AS value FROM ex),
 c AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY n DESC, value) AS rk FROM (SELECT profile_slug, value, count(*) AS n FROM v GROUP BY 1, 2)),
 g AS (SELECT v.profile_slug, yr AS year, CASE WHEN rk <= 6 THEN v.value ELSE 'other' END AS value, count(*) AS plays FROM v JOIN c ON v.profile_slug = c.profile_slug AND v.value = c.value GROUP BY 1, 2, 3)
 SELECT *, round(100.0 * plays / sum(plays) OVER (PARTITION BY profile_slug, year), 4) AS share FROM g"""


@query("k17_skip_rate", _rate_sql("skipped_count", "skip_rate"))
def k17(spark, d):
    return _rate(spark, d, "skipped_count", "skip_rate")


@query("k17_end_reasons", _reasons_sql("reason_end"))
def k17_reasons(spark, d):
    return li.yearly_shares(w.plays(spark, d), "reason_end").withColumn("share", r("share"))


@query("k18_shuffle_share", _rate_sql("shuffled_count", "shuffle_share"))
def k18(spark, d):
    return _rate(spark, d, "shuffled_count", "shuffle_share")


@query("k18_start_reasons", _reasons_sql("reason_start"))
def k18_reasons(spark, d):
    return li.yearly_shares(w.plays(spark, d), "reason_start").withColumn("share", r("share"))


@query("k19_offline_share", _rate_sql("offline_count", "offline_share"))
def k19(spark, d):
    return _rate(spark, d, "offline_count", "offline_share")


@query("k19_most_offline_months", f"""WITH {o.PLAYS}, {o.series('month')}, x AS (SELECT *, 100.0 * offline_count / play_count AS share FROM ser WHERE play_count >= 100),
 y AS (SELECT *, row_number() OVER (PARTITION BY profile_slug ORDER BY share DESC, period) AS rank FROM x)
 SELECT profile_slug, CAST(period AS VARCHAR) AS period, play_count, round(share, 4) AS offline_share, rank FROM y WHERE rank <= 10""")
def k19_top(spark, d):
    return li.most_offline_months(w.plays(spark, d), w.windows(spark, d)).select(
        P, day("period"), "play_count", r("offline_share"), "rank"
    )


@query("k20_platform_mix", f"""WITH {o.PLAYS}, x AS (SELECT profile_slug, yr AS year, {o.FAMILY} AS family, count(*) AS plays FROM ex GROUP BY 1, 2, 3)
 SELECT *, round(100.0 * plays / sum(plays) OVER (PARTITION BY profile_slug, year), 4) AS share FROM x""")
def k20(spark, d):
    return li.platform_mix(w.plays(spark, d)).withColumn("share", r("share"))


@query("k21_country_table", f"""WITH {o.PLAYS} SELECT profile_slug, coalesce(conn_country, 'not recorded') AS country, count(*) AS play_count, {o.HOURS}, {o.PCT},
 CAST(min(full_date) AS VARCHAR) AS first_play, CAST(max(full_date) AS VARCHAR) AS last_play FROM ex GROUP BY 1, 2""")
def k21(spark, d):
    return li.country_table(w.plays(spark, d)).select(
        P, "country", "play_count", r("hours"), r("pct_rows_with_duration"), day("first_play"),
        day("last_play"),
    )


@query("k21_months_away", f"""WITH {o.PLAYS}, c AS (SELECT profile_slug, coalesce(conn_country, 'not recorded') AS country, full_date FROM ex),
 h AS (SELECT profile_slug, country AS home FROM (SELECT profile_slug, country, row_number() OVER (PARTITION BY profile_slug ORDER BY count(*) DESC, country) AS rk FROM c GROUP BY 1, 2) WHERE rk = 1)
 SELECT profile_slug, CAST(CAST(date_trunc('month', full_date) AS DATE) AS VARCHAR) AS period, country, count(*) AS play_count,
 CAST(date_trunc('month', any_value(full_date)) AS DATE) < any_value(ws) OR last_day(any_value(full_date)) > any_value(we) AS is_partial
 FROM c JOIN h USING (profile_slug) JOIN win USING (profile_slug) WHERE country <> home GROUP BY 1, 2, 3""")
def k21_away(spark, d):
    out = li.months_away(w.plays(spark, d), w.windows(spark, d))
    return out.withColumn("period", day("period"))


@query("k22_phase_signal", f"""WITH {o.PLAYS}, {_PHASE} SELECT profile_slug, CAST(month AS VARCHAR) AS month, plays, round(shift, 4) AS shift_hours,
 month < ws OR last_day(month) > we AS is_partial FROM ph JOIN win USING (profile_slug) WHERE last_day(month) >= ws AND month <= we""")
def k22(spark, d):
    return li.phase_signal(w.plays(spark, d), w.windows(spark, d)).select(
        P, day("month"), "plays", r("shift_hours"), "is_partial"
    )


@query("k22_hour_profile", f"""WITH {o.PLAYS}, g AS (SELECT profile_slug, unnest(range(24)) AS hour FROM win), c AS (SELECT profile_slug, hr AS hour, count(*) AS n FROM ex GROUP BY 1, 2)
 SELECT profile_slug, hour, coalesce(n, 0) AS plays, round(100.0 * coalesce(n, 0) / sum(n) OVER (PARTITION BY profile_slug), 4) AS share FROM g LEFT JOIN c USING (profile_slug, hour)""")
def k22_hours(spark, d):
    return li.hour_profile(ts.exported(w.plays(spark, d))).withColumn("share", r("share"))


@query("k22_run_hour_profiles", f"""WITH {o.PLAYS}, {_PHASE}, {_RUNS}, i AS (SELECT profile_slug, first_month, hr FROM ex JOIN runs USING (profile_slug)
  WHERE date_trunc('month', full_date) BETWEEN first_month AND last_month),
 g AS (SELECT DISTINCT profile_slug, first_month, unnest(range(24)) AS hour FROM i), c AS (SELECT profile_slug, first_month, hr AS hour, count(*) AS n FROM i GROUP BY ALL)
 SELECT profile_slug, CAST(first_month AS VARCHAR) AS first_month, hour, coalesce(n, 0) AS plays FROM g LEFT JOIN c USING (profile_slug, first_month, hour)""")
def k22_runs(spark, d):
    out = li.run_hour_profiles(w.plays(spark, d), _runs(spark, d))
    return out.select(P, day("first_month"), "hour", "plays")


# --- allocation -----------------------------------------------------------------------------------

_REC = f"""rp AS (SELECT h.profile_slug, h.ms, CASE WHEN h.content_type <> 'track' THEN 1 WHEN c.artist_id IS NULL THEN 2
   WHEN g.artist_id IS NULL THEN 3 ELSE 4 END AS depth
  FROM hist h LEFT JOIN (SELECT part, artist_id FROM cred WHERE is_primary) c ON c.part = h.part
  LEFT JOIN (SELECT DISTINCT artist_id FROM cur WHERE tag_type = 'genre') g ON g.artist_id = c.artist_id),
st(step_number, step_name, residual_name) AS (VALUES (1, 'total_listening', NULL),
  (2, 'music', 'not_music (episodes, audiobook chapters and unknown content)'),
  (3, 'artist_identified', 'primary_artist_unidentified (track not yet resolved to a primary artist id)'),
  (4, 'genre_allocated', 'unclassified (primary artist has no MusicBrainz genre)')),
rec AS (SELECT profile_slug, step_number, step_name, residual_name, count(*) FILTER (depth >= step_number) AS play_count,
  CAST(sum(ms) FILTER (depth >= step_number) AS BIGINT) AS ms_played, count(ms) FILTER (depth >= step_number) AS rows_with_duration,
  round(100.0 * count(ms) FILTER (depth >= step_number) / nullif(count(*) FILTER (depth >= step_number), 0), 2) AS pct_rows_with_duration,
  count(*) FILTER (depth = step_number - 1) AS residual_play_count, CAST(sum(ms) FILTER (depth = step_number - 1) AS BIGINT) AS residual_ms_played
  FROM rp, st GROUP BY 1, 2, 3, 4)"""
CUR = """cur AS (SELECT a.artist_id, a.artist_mbid, tag_type, tag_name, vote_count FROM amap a JOIN (SELECT artist_mbid, max(raw_response_id) AS rid FROM resp GROUP BY 1) n USING (artist_mbid)
  JOIN tg ON tg.raw_response_id = n.rid)"""
REC = f"{o.HIST}, {o.CATALOGUE}, {o.STAR}, {CUR}, {_REC}"
ALL = f"{o.PLAYS}, {o.STAR}, {CUR}, {_REC}"


def steps(spark, d):
    with_genre = w.current_genres(spark, d).filter("tag_type = 'genre'").select("artist_id")
    return al.allocation_reconciliation(w.history(spark, d), w.primary_artists(spark, d), with_genre)


@query("i1_allocation_reconciliation", f"WITH {REC} SELECT * FROM rec")
def i1(spark, d):
    return steps(spark, d)


@query("i2_artist_enrichment_coverage", f"""WITH {REC}, m AS (SELECT h.profile_slug, c.artist_id, coalesce(a.is_fetched, FALSE) AS f FROM hist h
  LEFT JOIN (SELECT part, artist_id FROM cred WHERE is_primary) c ON c.part = h.part LEFT JOIN arts a ON a.artist_id = c.artist_id WHERE h.content_type = 'track')
 SELECT profile_slug, count(*) AS music_play_count, count(artist_id) AS artist_identified_play_count, count(*) FILTER (f) AS artist_object_play_count,
 count(DISTINCT artist_id) AS primary_artists_identified, count(DISTINCT artist_id) FILTER (f) AS primary_artists_with_object,
 round(100.0 * count(*) FILTER (f) / nullif(count(artist_id), 0), 2) AS pct_identified_plays_with_object FROM m GROUP BY 1""")
def i2(spark, d):
    return al.artist_enrichment_coverage(
        w.history(spark, d), w.primary_artists(spark, d), w.artists(spark, d)
    )


@query("i3_genre_bucket_map", f"WITH {o.CATALOGUE}, {o.STAR} SELECT genre_name, bucket_name, bucket_order, is_mapped, genre_key FROM gmap")
def i3(spark, d):
    return w.bucket_map(spark, d).drop("genre_bucket_key")


@query("i4_genre_bucket_allocation", f"""WITH {ALL} SELECT profile_slug, yr AS year, CAST(month_start AS VARCHAR) AS month_start, bucket_order, bucket_name, genre_name, artist_name, play_rows,
 round(allocated_plays, 4) AS allocated_plays, rows_with_duration, round(allocated_ms, 2) AS allocated_ms FROM alloc""")
def i4(spark, d):
    return w.bucket_allocation(spark, d).select(
        P, "year", day("month_start"), "bucket_order", "bucket_name", "genre_name", "artist_name",
        "play_rows", r("allocated_plays"), "rows_with_duration", r("allocated_ms", 2),
    )


_SHARES = """sh AS (SELECT profile_slug, bucket_name AS bucket, sum(allocated_ms) AS ms, sum(allocated_plays) AS ap FROM {src} GROUP BY 1, 2),
tt AS (SELECT profile_slug, sum(ms) AS total FROM sh GROUP BY 1)
SELECT t.profile_slug, b.bucket_order, b.bucket_name AS bucket, round(ms, 2) AS allocated_ms, round(100.0 * coalesce(ms, 0) / nullif(total, 0), 4) AS share_pct,
 round(coalesce(ap, 0), 4) AS allocated_plays FROM tt t CROSS JOIN bkt b LEFT JOIN sh ON sh.profile_slug = t.profile_slug AND sh.bucket = b.bucket_name"""


@query("i5_bucket_shares", f"WITH {ALL}, " + _SHARES.format(src="alloc"))
def i5(spark, d):
    return al.bucket_shares(w.bucket_allocation(spark, d), GENRE_BUCKETS).select(
        P, "bucket_order", "bucket", r("allocated_ms", 2), r("share_pct"), r("allocated_plays")
    )


@query("i6_trailing_months", f"""WITH {o.PLAYS} SELECT profile_slug, CAST(CAST(date_trunc('month', we) - INTERVAL 11 MONTH AS DATE) AS VARCHAR) AS first_month,
 CAST(CAST(date_trunc('month', we) AS DATE) AS VARCHAR) AS last_month FROM win""")
def i6(spark, d):
    return al.trailing_months(w.windows(spark, d)).select(P, day("first_month"), day("last_month"))


@query("k9_reconciliation_view", f"""WITH {REC}, h AS (SELECT *, ms_played / 3600000.0 AS hours FROM rec)
 SELECT profile_slug, step_number, round(hours, 4) AS hours, round(residual_ms_played / 3600000.0, 4) AS residual_hours,
 round(100.0 * hours / max(hours) FILTER (step_number = 1) OVER w, 4) AS pct_of_total_time,
 CASE WHEN step_number >= 2 THEN round(100.0 * hours / max(hours) FILTER (step_number = 2) OVER w, 4) END AS pct_of_music_time FROM h WINDOW w AS (PARTITION BY profile_slug)""")
def k9(spark, d):
    return li.reconciliation_view(steps(spark, d)).select(
        P, "step_number", r("hours"), r("residual_hours"), r("pct_of_total_time"),
        r("pct_of_music_time"),
    )


_TRAIL = """tr AS (SELECT a.* FROM alloc a JOIN win USING (profile_slug) WHERE month_start BETWEEN date_trunc('month', we) - INTERVAL 11 MONTH AND date_trunc('month', we))"""


@query("k10_bucket_radar", f"WITH {ALL}, {_TRAIL}, " + _SHARES.format(src="tr"))
def k10(spark, d):
    return li.bucket_radar(w.bucket_allocation(spark, d), w.windows(spark, d)).select(
        P, "bucket_order", "bucket", r("allocated_ms", 2), r("share_pct"), r("allocated_plays")
    )


@query("k10_period_music_share", f"""WITH {ALL}, {_TRAIL}, m AS (SELECT profile_slug, sum(ms) AS ms FROM ex JOIN win USING (profile_slug) WHERE category = 'music' AND date_trunc('month', full_date) >= date_trunc('month', we) - INTERVAL 11 MONTH
  AND date_trunc('month', full_date) <= date_trunc('month', we) GROUP BY 1),
 g AS (SELECT profile_slug, sum(allocated_ms) AS a FROM tr GROUP BY 1) SELECT profile_slug, CAST(ms AS BIGINT) AS music_ms, round(a, 2) AS allocated_ms, round(100.0 * a / ms, 4) AS pct_of_music_time FROM m LEFT JOIN g USING (profile_slug)""")
def k10_share(spark, d):
    out = li.period_music_share(w.plays(spark, d), w.bucket_allocation(spark, d), w.windows(spark, d))
    return out.select(P, "music_ms", r("allocated_ms", 2), r("pct_of_music_time"))


@query("k11_bucket_by_year", f"""WITH {ALL}, s AS (SELECT profile_slug, yr, bucket_name, sum(allocated_ms) AS ms FROM alloc GROUP BY 1, 2, 3), t AS (SELECT profile_slug, yr, sum(ms) AS total FROM s GROUP BY 1, 2)
 SELECT profile_slug, yr AS year, b.bucket_name AS bucket, round(100.0 * coalesce(ms, 0) / nullif(total, 0), 4) AS share_pct, make_date(yr, 1, 1) < ws OR make_date(yr, 12, 31) > we AS is_partial
 FROM t CROSS JOIN bkt b LEFT JOIN s USING (profile_slug, yr, bucket_name) JOIN win USING (profile_slug)""")
def k11(spark, d):
    return li.bucket_by_year(w.bucket_allocation(spark, d), w.windows(spark, d)).select(
        P, "year", "bucket", r("share_pct"), "is_partial"
    )


_DRILL = f"""{_TRAIL}, dr AS (SELECT *, 'trailing 12 months' AS period FROM tr UNION ALL SELECT *, 'all years' FROM alloc UNION ALL SELECT *, CAST(yr AS VARCHAR) FROM alloc)"""


@query("k12_period_list", f"WITH {ALL}, {_DRILL} SELECT profile_slug, period, round(sum(allocated_ms) / 3600000, 4) AS hours FROM dr GROUP BY 1, 2 HAVING sum(allocated_ms) > 0")
def k12(spark, d):
    return li.period_list(w.bucket_allocation(spark, d), w.windows(spark, d)).select(
        P, "period", r("hours")
    )


@query("k13_sunburst_nodes", f"""WITH {ALL}, {_DRILL}, a AS (SELECT profile_slug, period, bucket_name AS bucket, genre_name, artist_name, sum(coalesce(allocated_ms, 0)) / 3600000 AS h FROM dr GROUP BY ALL),
 n AS (SELECT *, row_number() OVER (PARTITION BY profile_slug, period, bucket, genre_name ORDER BY round(h, 9) DESC, artist_name) AS rk FROM a WHERE h > 0),
 lf AS (SELECT profile_slug, period, bucket, genre_name, CASE WHEN rk <= 5 THEN artist_name END AS leaf, sum(h) AS v, count(*) AS c FROM n GROUP BY ALL)
 SELECT profile_slug, period, period || '|' || bucket || '|' || genre_name || '|' || coalesce(leaf, '…rest') AS id, coalesce(leaf, c || CASE WHEN c = 1 THEN ' other artist' ELSE ' other artists' END) AS label,
  period || '|' || bucket || '|' || genre_name AS parent, round(v, 7) AS value, bucket FROM lf
 UNION ALL SELECT profile_slug, period, period || '|' || bucket || '|' || genre_name, genre_name, period || '|' || bucket, round(sum(v), 7), bucket FROM lf GROUP BY profile_slug, period, bucket, genre_name
 UNION ALL SELECT profile_slug, period, period || '|' || bucket, bucket, '', round(sum(v), 7), bucket FROM lf GROUP BY profile_slug, period, bucket""")
def k13(spark, d):
    tagged = li.drilldown_periods(w.bucket_allocation(spark, d), w.windows(spark, d))
    return li.sunburst_nodes(tagged).withColumn("value", r("value", 7))


@query("g21_bucketed_star", f"""WITH {o.PLAYS}, {o.STAR} SELECT profile_slug, CAST(month_start AS VARCHAR) AS month_start, bucket_name, CAST(sum(play_rows) AS BIGINT) AS play_rows,
 round(sum(allocated_plays), 4) AS allocated_plays, round(sum(allocated_ms), 2) AS allocated_ms FROM alloc GROUP BY 1, 2, 3""")
def g21_bucketed(spark, d):
    """Time and plays per genre bucket from stored tables; one year is stored late, by its months."""
    name = uuid.uuid4().hex
    star = StoredStar(spark, f"{shared_dir(spark)}/star-{name}", f"star_{name}", 16)
    fact = w.fact(spark, d)
    late = F.floor(F.col("date_key") / 10_000) == 1995
    star.store(fact.filter(~late), w.catalogue(spark, d), w.br_content_artist(spark, d),
               br_artist_genre=w.br_artist_genre(spark, d), genre_bucket_map=w.bucket_map(spark, d))
    star.refresh_months(fact.filter(late))
    month = F.make_date(F.floor(F.col("month_key") / 100).cast("int"), F.col("month_key") % 100, F.lit(1))
    return genre_months(star, "genre").join(w.profiles(spark).select("profile_key", "profile_slug"), "profile_key").select(
        "profile_slug", F.date_format(month, "yyyy-MM-dd").alias("month_start"), "bucket_name", "play_rows",
        r("allocated_plays"), r("allocated_ms", 2))
