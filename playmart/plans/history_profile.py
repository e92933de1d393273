"""The profile of an export: coverage, gaps, shape of the tail, oddities. All profiles at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.config import LONG_TAIL_EDGES, MS_PER_HOUR, SETTINGS
from playmart.functions.text import platform_family
from playmart.operators.ordered import split_scan, top_per_group
from playmart.operators.sets import with_share
from playmart.plans.timeseries import PROFILE


def with_calendar(export: DataFrame) -> DataFrame:
    """UTC day, month and year beside every record."""
    at = F.col("ended_at_utc")
    return export.withColumns(
        {"day": F.to_date(at), "month": F.trunc(at, "month"), "year": F.year(at)}
    )


def duration_profile(rows: DataFrame, column: str = "ms_played", keys: Sequence[str] = (PROFILE,)) -> DataFrame:
    """Zero, NULL and positive durations, never merged."""
    c = F.col(column)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(c == 0).alias("zero"),
        F.count_if(c.isNull()).alias("null"), F.count_if(c > 0).alias("positive"),
    )


def coverage_facts(export: DataFrame) -> DataFrame:
    per_file = export.groupBy(PROFILE, "source_file").agg(
        F.count(F.lit(1)).alias("n"), F.min("ended_at_utc").alias("first"),
        F.max("ended_at_utc").alias("last"), F.sum("ms_played").alias("ms"),
    )
    out = per_file.groupBy(PROFILE).agg(
        F.sum("n").alias("records"), F.count(F.lit(1)).alias("files"),
        F.min("first").alias("first_play"), F.max("last").alias("last_play"),
        (F.sum("ms") / MS_PER_HOUR).alias("hours"),
    )
    return out.withColumn("years", F.floor(F.timestamp_diff("DAY", F.col("first_play"), F.col("last_play"))) / 365.25)


def _records_and_hours():
    return [F.count(F.lit(1)).alias("records"), (F.sum("ms_played") / MS_PER_HOUR).alias("hours")]


def records_per_month(export: DataFrame) -> DataFrame:
    return with_calendar(export).groupBy(PROFILE, "month").agg(*_records_and_hours())


def month_extremes(monthly: DataFrame) -> DataFrame:
    """Months with data, densest, thinnest, and how many months in between carry nothing."""
    early = -F.unix_date("month")
    out = monthly.groupBy(PROFILE).agg(
        F.count(F.lit(1)).alias("months"), F.max_by("month", F.struct("records", early)).alias("densest"),
        F.min_by("month", F.struct("records", "month")).alias("thinnest"),
        F.min("month").alias("__first"), F.max("month").alias("__last"),
    )
    span = F.round(F.months_between("__last", "__first")).cast("int") + 1
    return out.withColumn("missing_months", span - F.col("months")).drop("__first", "__last")


def silent_stretches(plays: DataFrame, top: int = 10) -> DataFrame:
    """The longest gaps between consecutive plays of a profile.

    Only distinct moments matter, so plays shrink to those first. Days are the chunks: a profile
    that owns a third of all plays is spread over as many tasks as it has days.
    """
    moments = plays.select(PROFILE, "ended_at_utc").distinct()
    scanned = split_scan(
        moments, [PROFILE], ["ended_at_utc"], F.to_date("ended_at_utc"),
        lag={"from": "ended_at_utc"},
    ).filter(F.col("from").isNotNull())
    seconds = F.unix_micros("ended_at_utc") - F.unix_micros("from")
    gaps = scanned.select(
        PROFILE, F.round(seconds / 86_400_000_000, 1).alias("gap_days"), "from",
        F.col("ended_at_utc").alias("to"),
    )
    return top_per_group(gaps, [PROFILE], [F.desc("gap_days"), F.asc("from")], top)


def heaviest_days(export: DataFrame, top: int = 10) -> DataFrame:
    daily = with_calendar(export).groupBy(PROFILE, "day").agg(*_records_and_hours())
    return top_per_group(daily, [PROFILE], [F.desc_nulls_last("hours"), F.asc("day")], top)


def heaviest_day_tracks(export: DataFrame, top: int = 5) -> DataFrame:
    """What was on, on the heaviest day of each profile."""
    peak = heaviest_days(export, 1).select(PROFILE, "day")
    that_day = with_calendar(export).join(peak, [PROFILE, "day"], "left_semi").filter(
        "album_artist_name is not null and track_name is not null"
    )
    names = that_day.groupBy(PROFILE, "album_artist_name", "track_name").agg(
        F.count(F.lit(1)).alias("plays"),
        F.round(F.sum("ms_played") / MS_PER_HOUR, 2).alias("hours"),
    )
    return top_per_group(
        names, [PROFILE], [F.desc("plays"), F.asc("album_artist_name"), F.asc("track_name")], top
    )


def file_coverage(export: DataFrame) -> DataFrame:
    """Span of every file and whether it starts before the previous one ends."""
    files = export.groupBy(PROFILE, "source_file").agg(
        F.count(F.lit(1)).alias("records"), F.to_date(F.min("ended_at_utc")).alias("first_play"),
        F.to_date(F.max("ended_at_utc")).alias("last_play"),
    )
    scanned = split_scan(
        files, [PROFILE], ["first_play", "source_file"], F.trunc("first_play", "year"),
        lag={"__before": "last_play"},
    )
    return scanned.withColumn(
        "overlaps_previous", F.coalesce(F.col("first_play") <= F.col("__before"), F.lit(False))
    ).drop("__before")


def content_type_shares(export: DataFrame) -> DataFrame:
    table = export.groupBy(PROFILE, "content_type").agg(*_records_and_hours())
    table = with_share(table, "records", [PROFILE], "pct_records")
    return with_share(table, "hours", [PROFILE], "pct_hours")


def _plays_per_item(export: DataFrame) -> DataFrame:
    return export.groupBy(PROFILE, "content_uri").agg(F.count(F.lit(1)).alias("n"))


def long_tail(export: DataFrame, edges: Sequence[int] = LONG_TAIL_EDGES) -> DataFrame:
    """Items played at least so often, with their share of items and of plays."""
    # distinct play counts per profile are few; thresholds are applied to them, not to items
    sizes = _plays_per_item(export).groupBy(PROFILE, "n").agg(F.count(F.lit(1)).alias("items"))
    totals = sizes.groupBy(PROFILE).agg(
        F.sum("items").alias("all_items"), F.sum(F.col("items") * F.col("n")).alias("all_plays")
    )
    listed = F.array(*[F.lit(e) for e in edges])
    reach = sizes.withColumn("played_at_least", F.explode(listed))
    inside = F.col("n") >= F.col("played_at_least")
    out = reach.groupBy(PROFILE, "played_at_least").agg(
        F.coalesce(F.sum(F.when(inside, F.col("items"))), F.lit(0)).alias("distinct_items"),
        F.coalesce(F.sum(F.when(inside, F.col("items") * F.col("n"))), F.lit(0)).alias("plays"),
    )
    return out.join(totals, PROFILE).select(
        PROFILE, "played_at_least", "distinct_items",
        F.round(F.lit(100.0) * F.col("distinct_items") / F.col("all_items"), 2).alias("share_of_items"),
        F.round(F.lit(100.0) * F.col("plays") / F.col("all_plays"), 2).alias("share_of_plays"),
    )


def tail_histogram(export: DataFrame, clip: int = 50) -> DataFrame:
    return _plays_per_item(export).groupBy(
        PROFILE, F.least("n", F.lit(clip)).alias("plays")
    ).agg(F.count(F.lit(1)).alias("items"))


def tail_summary(export: DataFrame) -> DataFrame:
    # items per number of plays: a median then weighs a few numbers instead of holding every item
    same = _plays_per_item(export).groupBy(PROFILE, "n").agg(F.count(F.lit(1)).alias("items"))
    return same.groupBy(PROFILE).agg(
        F.sum("items").alias("items"),
        F.coalesce(F.sum(F.when(F.col("n") == 1, F.col("items"))), F.lit(0)).alias("played_once"),
        F.percentile("n", 0.5, F.col("items")).alias("median_plays"), F.max("n").alias("max_plays"),
    )


def resolution(plays: DataFrame) -> DataFrame:
    """Plays and items by whether their content was ever resolved."""
    items = plays.groupBy(PROFILE, "content_key", "is_resolved").agg(F.count(F.lit(1)).alias("n"))
    return items.groupBy(PROFILE, "is_resolved").agg(
        F.sum("n").alias("plays"), F.count(F.lit(1)).alias("items")
    )


def unresolved_by_type(plays: DataFrame) -> DataFrame:
    items = plays.filter("not is_resolved").groupBy(PROFILE, "content_type", "content_key").agg(
        F.count(F.lit(1)).alias("n")
    )
    return items.groupBy(PROFILE, "content_type").agg(
        F.sum("n").alias("plays"), F.count(F.lit(1)).alias("items")
    )


def _per_track(export: DataFrame) -> DataFrame:
    named = export.filter(
        "content_type = 'track' and album_artist_name is not null and track_name is not null"
    )
    out = named.groupBy(PROFILE, "album_artist_name", "track_name").agg(
        F.count(F.lit(1)).alias("plays"),
        F.round(F.sum("ms_played") / MS_PER_HOUR, 1).alias("hours"),
        F.min("ended_at_utc").alias("first_play"), F.max("ended_at_utc").alias("last_play"),
    )
    days = F.timestamp_diff("DAY", F.col("first_play"), F.col("last_play"))
    return out.withColumn("span_years", F.round(days / 365.25, 1))


def most_replayed(export: DataFrame, top: int = 10) -> DataFrame:
    return top_per_group(
        _per_track(export), [PROFILE],
        [F.desc("plays"), F.asc("album_artist_name"), F.asc("track_name")], top,
    )


def repeat_summary(export: DataFrame) -> DataFrame:
    # spans are rounded to tenths of a year, so tracks per span are few
    once = F.col("plays") == 1
    same = _per_track(export).groupBy(
        PROFILE, once.alias("once"), F.when(~once, F.col("span_years")).alias("span")
    ).agg(F.count(F.lit(1)).alias("tracks"))
    single = F.coalesce(F.sum(F.when(F.col("once"), F.col("tracks"))), F.lit(0))
    return same.groupBy(PROFILE).agg(
        F.sum("tracks").alias("tracks"), single.alias("once_only"),
        F.round(F.lit(100.0) * single / F.sum("tracks"), 2).alias("pct_once_only"),
        F.percentile("span", 0.5, F.col("tracks")).alias("median_span_of_repeats"),
    )


def zero_by_reason(export: DataFrame, top: int = 5) -> DataFrame:
    counts = export.filter("ms_played = 0 and reason_end is not null").groupBy(
        PROFILE, "reason_end"
    ).agg(F.count(F.lit(1)).alias("records"))
    return top_per_group(counts, [PROFILE], [F.desc("records"), F.asc("reason_end")], top)


def empty_reasons(export: DataFrame) -> DataFrame:
    """Per reason column: blanks, their share, distinct values and the most common one."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))
          for c in ("reason_start", "reason_end")]
    )
    counts = export.select(PROFILE, F.explode(pairs).alias("p")).groupBy(
        PROFILE, "p.column", "p.value"
    ).agg(F.count(F.lit(1)).alias("n"))
    blank = F.col("value").isNull()
    # one row per distinct reason; min_by on the negated count keeps the first name on a tie
    return counts.groupBy(PROFILE, "column").agg(
        F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("null_records"),
        F.round(
            F.lit(100.0) * F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)) / F.sum("n"), 4
        ).alias("share_of_records"),
        F.count("value").alias("distinct_values"),
        F.min_by("value", F.when(~blank, F.struct(-F.col("n"), F.col("value")))).alias("most_common"),
        F.max(F.when(~blank, F.col("n"))).alias("most_common_count"),
    )


def offline_timestamp_units(export: DataFrame) -> DataFrame:
    """The offline clock comes in seconds and in milliseconds; its size tells which."""
    c = F.col("offline_timestamp_raw")
    return export.groupBy(PROFILE).agg(
        F.count(c).alias("non_null"),
        F.count_if(c > SETTINGS.millisecond_threshold).alias("milliseconds"),
        F.min(c).alias("smallest"), F.max(c).alias("largest"),
    )


def duplicate_keys(export: DataFrame) -> DataFrame:
    """Records that share content and second: keys, rows involved, rows a dedupe removes."""
    keys = export.groupBy(PROFILE, "content_uri", "ended_at_utc").agg(F.count(F.lit(1)).alias("n"))
    many = F.col("n") > 1
    return keys.groupBy(PROFILE).agg(
        F.count_if(many).alias("keys"),
        F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("rows_involved"),
        F.coalesce(F.sum(F.when(many, F.col("n") - 1)), F.lit(0)).alias("rows_collapsed"),
    )


def track_errors(export: DataFrame) -> DataFrame:
    return with_calendar(export.filter("reason_end = 'trackerror'")).groupBy(PROFILE, "year").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("ms_played") == 0).alias("zero_ms")
    )


def other_oddities(export: DataFrame) -> DataFrame:
    """Findings with at least one record; one aggregate, unpivoted."""
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    long = F.col("ms_played") > SETTINGS.long_play_hours * MS_PER_HOUR
    checks = {
        f"plays longer than {SETTINGS.long_play_hours} hours": long,
        "records with no conn_country": F.coalesce("conn_country", F.lit("")) == "",
        "played in incognito mode": flag("was_incognito"),
        "flagged skipped with no reason_end": flag("was_skipped") & F.col("reason_end").isNull(),
        "reason_end = 'unknown'": F.col("reason_end") == "unknown",
    }
    found = F.array(
        *[
            F.struct(F.lit(what).alias("what"), F.count_if(cond).alias("records"))
            for what, cond in checks.items()
        ]
    )
    return export.groupBy(PROFILE).agg(found.alias("f")).select(
        PROFILE, F.explode("f").alias("f")
    ).select(PROFILE, "f.*").filter("records > 0")


def platforms_by_year(export: DataFrame) -> DataFrame:
    raw = with_calendar(export).groupBy(PROFILE, "year", "platform").agg(F.count(F.lit(1)).alias("n"))
    table = raw.groupBy(PROFILE, "year", platform_family(F.col("platform")).alias("family")).agg(
        F.sum("n").alias("records")
    )
    return with_share(table, "records", [PROFILE, "year"], "share")


def countries(export: DataFrame) -> DataFrame:
    return export.groupBy(PROFILE, F.coalesce("conn_country", F.lit("(none)")).alias("country")).agg(
        F.count(F.lit(1)).alias("records"), F.to_date(F.min("ended_at_utc")).alias("first_play"),
        F.to_date(F.max("ended_at_utc")).alias("last_play"),
    )


def behaviour_by_year(export: DataFrame) -> DataFrame:
    rate = lambda c: F.round(F.lit(100.0) * F.count_if(F.col(c)) / F.count(F.lit(1)), 2)
    return with_calendar(export).groupBy(PROFILE, "year").agg(
        *[rate(f"was_{c}").alias(c) for c in ("skipped", "shuffled", "offline", "incognito")],
        F.count(F.lit(1)).alias("records"),
    )
