"""The tables behind the listening report, for every profile at once.

Reports over time use exported plays only: a captured play has no duration.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmart.config import (
    CATEGORIES, DAYPART_NAMES, GENRE_BUCKETS, MS_PER_HOUR, SETTINGS, WEEKDAY_NAMES,
)
from playmart.functions.periods import period_start
from playmart.functions.text import platform_family
from playmart.operators.ordered import top_per_group
from playmart.operators.sets import lump_rest, with_share
from playmart.plans.allocation import bucket_shares, in_months, trailing_months
from playmart.plans.timeseries import (
    PROFILE, clip_to_window, days_in_window, exported, monthly_phase, rolling_mean, shift_runs,
    time_series, with_coverage,
)


def _pct(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def _music(plays: DataFrame) -> DataFrame:
    return exported(plays).filter("category = 'music'")


# --- Coverage and volume --------------------------------------------------------------------------


def coverage_facts(plays: DataFrame, windows: DataFrame) -> DataFrame:
    """Totals by source, resolution by play and by item, and API plays past the export's end."""
    is_api = F.col("source_system") == "api"
    resolved = F.coalesce("is_resolved", F.lit(False))
    per_item = plays.join(windows.select(PROFILE, "export_end"), PROFILE, "left").groupBy(
        PROFILE, "content_key"
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_api).alias("api"),
        F.count("ms_played").alias("timed"),
        F.bool_or(resolved).alias("resolved"),
        F.count_if(is_api & (F.col("ended_at_utc") > F.col("export_end"))).alias("after"),
    )
    out = per_item.groupBy(PROFILE).agg(
        F.sum("n").alias("plays"),
        F.sum(F.col("n") - F.col("api")).alias("export_plays"),
        F.sum("api").alias("api_plays"),
        F.sum("timed").alias("rows_with_duration"),
        F.coalesce(F.sum(F.when(F.col("resolved"), F.col("n"))), F.lit(0)).alias("resolved_plays"),
        F.count(F.lit(1)).alias("items"),
        F.count_if("resolved").alias("resolved_items"),
        F.sum("after").alias("api_plays_after_export"),
    )
    return out.withColumns(
        {
            "pct_rows_with_duration": _pct(F.col("rows_with_duration"), F.col("plays")),
            "pct_plays_resolved": _pct(F.col("resolved_plays"), F.col("plays")),
            "pct_items_resolved": _pct(F.col("resolved_items"), F.col("items")),
        }
    )


def coverage_by(plays: DataFrame, column: str) -> DataFrame:
    return with_coverage(plays, [PROFILE, column])


def minutes_per_day(plays: DataFrame, windows: DataFrame, grain: str) -> DataFrame:
    """Average minutes a day per period, with a trailing mean of 7 days or 13 weeks."""
    series = days_in_window(time_series(exported(plays), windows, grain), windows, grain)
    series = series.withColumn("minutes_per_day", F.col("hours") * 60 / F.col("days"))
    return rolling_mean(series, "minutes_per_day", 7 if grain == "day" else 13, "rolling")


def yearly_table(plays: DataFrame, windows: DataFrame) -> DataFrame:
    dated = exported(plays).withColumn("period", period_start(F.col("full_date"), "year"))
    table = clip_to_window(with_coverage(dated, [PROFILE, "period"]), windows, "year")
    return table.select(
        PROFILE, F.year("period").alias("year"), "hours", "play_count", "rows_with_duration",
        "pct_rows_with_duration", "is_partial",
    )


def monthly_totals(plays: DataFrame, windows: DataFrame) -> DataFrame:
    return time_series(exported(plays), windows, "month")


def busiest_and_quietest(series: DataFrame) -> DataFrame:
    """Over the full periods of a series; the earliest wins a tie."""
    full = series.filter("not is_partial and hours is not null")
    early = -F.unix_date("period")
    at = F.struct("period", "hours", "play_count")
    out = full.groupBy(PROFILE).agg(
        F.max_by(at, F.struct("hours", early)).alias("busiest"),
        F.min_by(at, F.struct("hours", "period")).alias("quietest"),
    )
    return out.select(
        PROFILE,
        *[
            F.col(f"{side}.{field}").alias(f"{side}_{field}")
            for side in ("busiest", "quietest") for field in ("period", "hours", "play_count")
        ],
    )


def weekday_by_daypart(plays: DataFrame, value: str) -> DataFrame:
    """Seven rows by six columns per profile for one measure, in calendar order."""
    cells = with_coverage(exported(plays), [PROFILE, "day_of_week_name", "daypart"])
    wide = cells.groupBy(PROFILE, "day_of_week_name").pivot("daypart", list(DAYPART_NAMES)).agg(
        F.first(value)
    )
    order = F.array_position(F.array(*[F.lit(d) for d in WEEKDAY_NAMES]), F.col("day_of_week_name"))
    return wide.withColumn("weekday_order", order.cast("int"))


def qualified_gap(plays: DataFrame, windows: DataFrame, grain: str) -> DataFrame:
    series = time_series(exported(plays), windows, grain)
    share = F.col("qualified_play_count") / F.nullif(F.col("play_count"), F.lit(0))
    return series.withColumn("gap_pct", F.lit(100.0) * (1 - share))


# --- Music, podcasts, audiobooks ------------------------------------------------------------------


def category_share(plays: DataFrame, windows: DataFrame, value: str) -> DataFrame:
    """Monthly share of each category, in fixed columns that sum to 100."""
    series = time_series(exported(plays), windows, "month", by="category")
    wide = series.groupBy(PROFILE, "period").pivot("category", list(CATEGORIES)).agg(F.sum(value))
    parts = [F.coalesce(F.col(c), F.lit(0)) for c in CATEGORIES]
    whole = F.nullif(sum(parts[1:], parts[0]), F.lit(0))
    return wide.select(
        PROFILE, "period",
        *[(F.lit(100.0) * p / whole).alias(c) for p, c in zip(parts, CATEGORIES, strict=True)],
    )


def yearly_category_share(plays: DataFrame) -> DataFrame:
    table = with_coverage(exported(plays), [PROFILE, "year", "category"])
    return with_share(table, "ms_played", [PROFILE, "year"], "share").select(
        PROFILE, "year", "category", "hours", "share", "play_count", "pct_rows_with_duration"
    )


def category_totals(plays: DataFrame) -> DataFrame:
    table = with_coverage(exported(plays), [PROFILE, "category"])
    table = with_share(table, "ms_played", [PROFILE], "time_share")
    return with_share(table, "play_count", [PROFILE], "count_share")


def podcast_leaderboard(plays: DataFrame, top: int = 15) -> DataFrame:
    """Shows by listening time; completion is averaged over plays of episodes of known length."""
    episodes = exported(plays).filter("category = 'podcast'")
    # `least` skips NULL, so a play of unknown length or time must be kept out by hand
    known = (F.col("duration_ms") > 0) & F.col("ms_played").isNotNull()
    done = F.when(known, F.least(F.lit(1.0), F.try_divide("ms_played", "duration_ms")))
    per_episode = episodes.groupBy(PROFILE, F.col("parent_name").alias("show"), "content_key").agg(
        F.count(F.lit(1)).alias("n"), F.count("ms_played").alias("timed"),
        F.sum("ms_played").alias("ms"), F.sum(done).alias("done"), F.count(done).alias("measured"),
    )
    board = per_episode.groupBy(PROFILE, "show").agg(
        (F.sum("ms") / MS_PER_HOUR).alias("hours"),
        F.count("content_key").alias("episodes"),
        F.sum("n").alias("play_count"),
        _pct(F.sum("timed"), F.sum("n")).alias("pct_rows_with_duration"),
        _pct(F.sum("done"), F.sum("measured")).alias("mean_completion_pct"),
    )
    return top_per_group(board, [PROFILE], [F.desc_nulls_last("hours"), F.asc("show")], top)


def podcast_by_daypart(plays: DataFrame) -> DataFrame:
    episodes = exported(plays).filter("category = 'podcast'")
    return with_coverage(episodes, [PROFILE, "daypart"]).select(
        PROFILE, "daypart", "hours", "play_count", "pct_rows_with_duration"
    )


# --- Allocation -----------------------------------------------------------------------------------


def reconciliation_view(steps: DataFrame) -> DataFrame:
    """The four steps in hours, as shares of all time and of music time."""
    chain = Window.partitionBy(PROFILE)  # four rows per profile
    hours = F.col("ms_played") / MS_PER_HOUR
    at = lambda n: F.max(F.when(F.col("step_number") == n, F.col("hours"))).over(chain)
    framed = steps.withColumns(
        {"hours": hours, "residual_hours": F.col("residual_ms_played") / MS_PER_HOUR}
    )
    return framed.withColumns(
        {
            "pct_of_total_time": _pct(F.col("hours"), at(1)),
            "pct_of_music_time": F.when(F.col("step_number") >= 2, _pct(F.col("hours"), at(2))),
        }
    )


def bucket_radar(
    allocation: DataFrame, windows: DataFrame, buckets: Sequence[str] = GENRE_BUCKETS,
    months: int = 12,
) -> DataFrame:
    return bucket_shares(in_months(allocation, trailing_months(windows, months)), buckets)


def period_music_share(
    plays: DataFrame, allocation: DataFrame, windows: DataFrame, months: int = 12
) -> DataFrame:
    """How much of the trailing months' music time reached a bucket at all."""
    span = trailing_months(windows, months)
    music = _music(plays).withColumn("month_start", period_start(F.col("full_date"), "month"))
    heard = in_months(music, span).groupBy(PROFILE).agg(F.sum("ms_played").alias("music_ms"))
    given = in_months(allocation, span).groupBy(PROFILE).agg(
        F.sum("allocated_ms").alias("allocated_ms")
    )
    return heard.join(given, PROFILE, "left").withColumn(
        "pct_of_music_time", _pct(F.col("allocated_ms"), F.col("music_ms"))
    )


def bucket_by_year(
    allocation: DataFrame, windows: DataFrame, buckets: Sequence[str] = GENRE_BUCKETS
) -> DataFrame:
    shares = bucket_shares(allocation, buckets, [PROFILE, "year"])
    span = windows.select(PROFILE, "window_start", "window_end")
    first, last = F.make_date("year", F.lit(1), F.lit(1)), F.make_date("year", F.lit(12), F.lit(31))
    return (
        shares.join(span, PROFILE)
        .withColumn("is_partial", (first < F.col("window_start")) | (last > F.col("window_end")))
        .drop("window_start", "window_end")
    )


def drilldown_periods(allocation: DataFrame, windows: DataFrame) -> DataFrame:
    """Every allocation row under each period it belongs to: trailing year, all years, its year.

    One pass: a row is exploded into at most three tags instead of being scanned once per period.
    """
    span = trailing_months(windows)
    rows = allocation.join(span, PROFILE)
    recent = F.col("month_start").between(F.col("first_month"), F.col("last_month"))
    label = F.array_compact(
        F.array(
            F.when(recent, F.lit("trailing 12 months")), F.lit("all years"),
            F.col("year").cast("string"),
        )
    )
    return rows.withColumn("period", F.explode(label)).drop("first_month", "last_month")


def period_list(allocation: DataFrame, windows: DataFrame) -> DataFrame:
    tagged = drilldown_periods(allocation, windows)
    return tagged.groupBy(PROFILE, "period").agg(F.sum("allocated_ms").alias("ms")).filter(
        "ms > 0"
    ).select(PROFILE, "period", (F.col("ms") / MS_PER_HOUR).alias("hours"))


def sunburst_nodes(
    allocation: DataFrame, top: int = 5, keys: Sequence[str] = (PROFILE, "period")
) -> DataFrame:
    """bucket -> genre -> top artists, in hours; a parent is exactly the sum of its children."""
    named = allocation.withColumn(
        "artist_name", F.coalesce("artist_name", F.lit("(unnamed artist)"))
    )
    branch = [*keys, "bucket_name", "genre_name"]
    leaves = named.groupBy(*branch, "artist_name").agg(
        (F.sum(F.coalesce("allocated_ms", F.lit(0.0))) / MS_PER_HOUR).alias("hours")
    ).filter("hours > 0")
    head = top_per_group(leaves, branch, [F.desc("hours"), F.asc("artist_name")], top, "rank")
    shown = head.select(*branch, "artist_name", F.lit(True).alias("shown"))
    marked = leaves.join(shown, [*branch, "artist_name"], "left")
    kept = F.col("shown").isNotNull()
    folded = marked.groupBy(*branch, F.when(kept, F.col("artist_name")).alias("leaf")).agg(
        F.sum("hours").alias("value"), F.count(F.lit(1)).alias("n")
    )
    noun = F.when(F.col("n") == 1, " other artist").otherwise(" other artists")
    rest = F.concat(F.col("n").cast("string"), noun)
    leaf = folded.select(
        *branch, "value", F.coalesce("leaf", rest).alias("label"), F.coalesce("leaf", F.lit("…rest")).alias("tail")
    )
    tree = leaf.rollup(*keys, "bucket_name", "genre_name", "label", "tail").agg(
        F.sum("value").alias("value"), F.grouping_id().alias("g")
    )
    period = F.col(keys[-1])
    bucket_id = F.concat_ws("|", period, "bucket_name")
    genre_id = F.concat_ws("|", bucket_id, "genre_name")
    level = F.when(F.col("g") == 0, "artist").when(F.col("g") == 3, "genre").when(F.col("g") == 7, "bucket")
    return tree.withColumn("level", level).filter("level is not null").select(
        *keys,
        F.when(F.col("level") == "artist", F.concat_ws("|", genre_id, "tail"))
        .when(F.col("level") == "genre", genre_id).otherwise(bucket_id).alias("id"),
        F.when(F.col("level") == "artist", F.col("label"))
        .when(F.col("level") == "genre", F.col("genre_name"))
        .otherwise(F.col("bucket_name")).alias("label"),
        F.when(F.col("level") == "artist", genre_id)
        .when(F.col("level") == "genre", bucket_id).otherwise("").alias("parent"),
        "value", F.col("bucket_name").alias("bucket"),
    )


# --- Artists and tracks ---------------------------------------------------------------------------


def ranked_artists(plays: DataFrame) -> DataFrame:
    table = with_coverage(
        _music(plays).filter("primary_creator_name is not null"),
        [PROFILE, "year", "primary_creator_name"],
    )
    # one row per artist and year
    best = [F.desc_nulls_last("hours"), F.asc("primary_creator_name")]
    return top_per_group(table, [PROFILE, "year"], best, 10)


def recurring_artists(plays: DataFrame, top: int = 12) -> DataFrame:
    """Artists in the yearly top ten of two years or more, by their hours there."""
    repeat = ranked_artists(plays).groupBy(PROFILE, "primary_creator_name").agg(
        F.count(F.lit(1)).alias("years"), F.sum("hours").alias("hours")
    ).filter("years >= 2")
    return top_per_group(
        repeat, [PROFILE], [F.desc_nulls_last("hours"), F.asc("primary_creator_name")], top
    )


def leaders_by_year(plays: DataFrame, top: int = 5) -> DataFrame:
    hours = F.round("hours", 0).cast("bigint").cast("string")
    entry = F.concat("primary_creator_name", F.lit(" ("), hours, F.lit(" h)"))
    places = ranked_artists(plays).filter(F.col("rank") <= top)
    wide = places.groupBy(PROFILE, "year").pivot("rank", list(range(1, top + 1))).agg(F.first(entry))
    return wide.select(PROFILE, "year", *[F.col(str(n)).alias(f"place_{n}") for n in range(1, top + 1)])


def artist_coverage_by_year(plays: DataFrame) -> DataFrame:
    share = _pct(F.count_if("has_artist_id"), F.count(F.lit(1))).alias("pct_plays_with_artist_id")
    return with_coverage(_music(plays), [PROFILE, "year"], share).select(
        PROFILE, "year", "hours", "play_count", "pct_rows_with_duration",
        "pct_plays_with_artist_id",
    )


def longest_tail(plays: DataFrame, windows: DataFrame, top: int = 15) -> DataFrame:
    """Well-played tracks still heard at the end of the window, by first-to-last span."""
    tracks = _music(plays).groupBy(PROFILE, "content_key").agg(
        F.min("content_name").alias("track"), F.min("primary_creator_name").alias("artist"),
        F.min("full_date").alias("first_play"), F.max("full_date").alias("last_play"),
        F.count(F.lit(1)).alias("play_count"), (F.sum("ms_played") / MS_PER_HOUR).alias("hours"),
        _pct(F.count("ms_played"), F.count(F.lit(1))).alias("pct_rows_with_duration"),
    )
    since = F.date_sub("window_end", SETTINGS.active_within_days)
    active = tracks.join(windows.select(PROFILE, "window_end"), PROFILE).filter(
        (F.col("play_count") >= SETTINGS.min_track_plays) & (F.col("last_play") >= since)
    )
    spanned = active.withColumn("span_years", F.date_diff("last_play", "first_play") / 365.25)
    return top_per_group(
        spanned.drop("window_end"), [PROFILE], [F.desc("span_years"), F.asc("content_key")], top
    )


def one_hit_wonders(plays: DataFrame, windows: DataFrame, top: int = 15) -> DataFrame:
    """Tracks whose life is one month: most plays in it, none after it, and long enough ago."""
    monthly = _music(plays).groupBy(
        PROFILE, "content_key", period_start(F.col("full_date"), "month").alias("month")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.sum("ms_played").alias("ms"),
        F.count("ms_played").alias("timed"),
        F.min("content_name").alias("track"), F.min("primary_creator_name").alias("artist"),
    )
    early = -F.unix_date("month")
    lives = monthly.groupBy(PROFILE, "content_key").agg(
        F.max_by("month", F.struct("n", early)).alias("peak_month"),
        F.max("n").alias("plays_in_peak_month"), F.sum("n").alias("lifetime_plays"),
        F.max("month").alias("last_month"), (F.sum("ms") / MS_PER_HOUR).alias("hours"),
        _pct(F.sum("timed"), F.sum("n")).alias("pct_rows_with_duration"),
        F.min("track").alias("track"), F.min("artist").alias("artist"),
    )
    cutoff = F.add_months("window_end", -SETTINGS.one_hit_quiet_months)
    hits = lives.join(windows.select(PROFILE, "window_end"), PROFILE).filter(
        (F.col("lifetime_plays") >= SETTINGS.min_track_plays)
        & (F.col("plays_in_peak_month") >= SETTINGS.one_hit_share * F.col("lifetime_plays"))
        & (F.col("last_month") == F.col("peak_month"))
        & (F.col("peak_month") <= cutoff)
    )
    return top_per_group(
        hits.drop("window_end", "last_month"), [PROFILE],
        [F.desc("plays_in_peak_month"), F.asc("content_key")], top,
    )


# --- Behaviour ------------------------------------------------------------------------------------


def rate_series(plays: DataFrame, windows: DataFrame, count: str, name: str) -> DataFrame:
    series = time_series(exported(plays), windows, "month")
    return series.withColumn(name, _pct(F.col(count), F.col("play_count")))


def yearly_shares(plays: DataFrame, column: str, top: int = 6) -> DataFrame:
    """Share of plays per year of each of the most frequent values; the rest is `other`."""
    value = F.coalesce(column, F.lit("not recorded"))
    counts = exported(plays).groupBy(PROFILE, "year", value.alias("value")).agg(
        F.count(F.lit(1)).alias("plays")
    )
    lumped = lump_rest(counts, F.col("value"), [PROFILE], top, "value", weight="plays")
    table = lumped.groupBy(PROFILE, "year", "value").agg(F.sum("plays").alias("plays"))
    return with_share(table, "plays", [PROFILE, "year"], "share")


def most_offline_months(plays: DataFrame, windows: DataFrame, top: int = 10) -> DataFrame:
    series = rate_series(plays, windows, "offline_count", "offline_share")
    busy = series.filter(F.col("play_count") >= SETTINGS.phase_min_plays)
    return top_per_group(
        busy, [PROFILE], [F.desc_nulls_last("offline_share"), F.asc("period")], top
    )


def platform_mix(plays: DataFrame) -> DataFrame:
    """Plays per year and device family; raw device strings never leave this function."""
    raw = exported(plays).groupBy(PROFILE, "year", "platform").agg(F.count(F.lit(1)).alias("n"))
    table = raw.groupBy(PROFILE, "year", platform_family(F.col("platform")).alias("family")).agg(
        F.sum("n").alias("plays")
    )
    return with_share(table, "plays", [PROFILE, "year"], "share")


def country_table(plays: DataFrame) -> DataFrame:
    named = exported(plays).withColumn(
        "country", F.coalesce("conn_country", F.lit("not recorded"))
    )
    return with_coverage(
        named, [PROFILE, "country"],
        F.min("full_date").alias("first_play"), F.max("full_date").alias("last_play"),
    )


def months_away(plays: DataFrame, windows: DataFrame) -> DataFrame:
    """Monthly plays per country other than the profile's most frequent one."""
    named = exported(plays).withColumn(
        "country", F.coalesce("conn_country", F.lit("not recorded"))
    )
    counts = named.groupBy(PROFILE, "country").agg(F.count(F.lit(1)).alias("n"))
    home = top_per_group(counts, [PROFILE], [F.desc("n"), F.asc("country")], 1).select(
        PROFILE, F.col("country").alias("home")
    )
    series = time_series(named, windows, "month", by="country")
    return series.join(home, PROFILE).filter("country <> home").select(
        PROFILE, "period", "country", "play_count", "is_partial"
    )


def phase_signal(plays: DataFrame, windows: DataFrame) -> DataFrame:
    return clip_to_window(monthly_phase(exported(plays)), windows, "month", period="month")


def phase_runs(plays: DataFrame, windows: DataFrame) -> DataFrame:
    """Runs of shifted months; edge months are drawn but never flagged."""
    return shift_runs(phase_signal(plays, windows).filter("not is_partial"))


def hour_profile(plays: DataFrame, keys: Sequence[str] = (PROFILE,)) -> DataFrame:
    """Share of plays in each of the 24 hours; hours without plays are kept."""
    counts = plays.filter("hour is not null").groupBy(*keys, "hour").agg(
        F.count(F.lit(1)).alias("plays")
    )
    totals = counts.groupBy(*keys).agg(F.sum("plays").alias("__total"))
    grid = totals.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    n = F.coalesce("plays", F.lit(0))
    return grid.join(counts, [*keys, "hour"], "left").select(
        *keys, "hour", n.alias("plays"), _pct(n, F.col("__total")).alias("share")
    )


def run_hour_profiles(plays: DataFrame, runs: DataFrame) -> DataFrame:
    """The 24-hour profile inside each run; a month lies in one run of its profile at most."""
    months = runs.select(
        PROFILE, "first_month",
        F.explode(F.expr("sequence(first_month, last_month, interval 1 month)")).alias("month"),
    )
    inside = exported(plays).withColumn(
        "month", period_start(F.col("full_date"), "month")
    ).join(months, [PROFILE, "month"])
    return hour_profile(inside, (PROFILE, "first_month"))
