"""Coverage-aware time series.

Every function works on all profiles at once: `plays` carries `profile_slug`, and `windows` holds one
row per profile with the local dates its export spans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playmart.config import CATEGORY_OF_TYPE, MS_PER_HOUR, SETTINGS
from playmart.functions import clock
from playmart.functions.periods import (
    month_number, period_end, period_start, periods_between,
)
from playmart.operators.ordered import islands

PROFILE = "profile_slug"
COUNTS = ("play_count", "rows_with_duration", "qualified_play_count", "skipped_count",
          "shuffled_count", "offline_count")


def category(content_type: Column) -> Column:
    name = F.lit("unknown")
    for kind, label in CATEGORY_OF_TYPE.items():
        name = F.when(content_type == kind, label).otherwise(name)
    return name


def enriched_plays(
    fact: DataFrame, profiles: DataFrame, dates: DataFrame, times: DataFrame,
    content: DataFrame, credits: DataFrame,
) -> DataFrame:
    """The fact with the attributes reports group by; the calendar tables are of fixed size."""
    identified = credits.filter("is_primary").select("content_key").distinct().withColumn(
        "has_artist_id", F.lit(True)
    )
    return (
        fact.join(profiles.select("profile_key", PROFILE), "profile_key")
        .join(
            F.broadcast(dates.select("date_key", "full_date", "year", "day_of_week_name")),
            "date_key", "left",
        )
        .join(
            F.broadcast(times.select("time_of_day_key", "hour", "minute", "daypart")),
            "time_of_day_key", "left",
        )
        .join(
            content.select(
                "content_key", "content_type", "content_name", "parent_name",
                "primary_creator_name", "is_resolved", "duration_ms",
            ),
            "content_key", "left",
        )
        .join(identified, "content_key", "left")
        .withColumns(
            {
                "has_artist_id": F.coalesce("has_artist_id", F.lit(False)),
                "category": category(F.col("content_type")),
            }
        )
    )


def exported(plays: DataFrame) -> DataFrame:
    return plays.filter("source_system = 'export'")


def coverage_measures() -> list[Column]:
    """Time and counts; a sum stays NULL when no row carries a duration, a NULL flag is false."""
    flag = lambda name: F.count_if(F.col(name))
    return [
        F.count(F.lit(1)).alias("play_count"),
        F.count("ms_played").alias("rows_with_duration"),
        F.sum("ms_played").alias("ms_played"),
        flag("is_qualified_play").alias("qualified_play_count"),
        flag("was_skipped").alias("skipped_count"),
        flag("was_shuffled").alias("shuffled_count"),
        flag("was_offline").alias("offline_count"),
    ]


def _derived(df: DataFrame) -> DataFrame:
    share = F.lit(100.0) * F.col("rows_with_duration") / F.nullif(F.col("play_count"), F.lit(0))
    return df.withColumns(
        {"hours": F.col("ms_played") / MS_PER_HOUR, "pct_rows_with_duration": share}
    )


def with_coverage(plays: DataFrame, by: Sequence[str | Column], *more: Column) -> DataFrame:
    """Coverage measures per group; `more` aggregates ride in the same grouping."""
    return _derived(plays.groupBy(*by).agg(*coverage_measures(), *more))


def clip_to_window(
    frame: DataFrame, windows: DataFrame, grain: str, period: str = "period"
) -> DataFrame:
    """Periods that touch the window; those running past an edge are flagged, not dropped."""
    span = windows.select(PROFILE, "window_start", "window_end")
    first, last = F.col("window_start"), F.col("window_end")
    start, end = F.col(period), period_end(F.col(period), grain)
    return (
        frame.join(span, PROFILE)
        .filter((end >= first) & (start <= last))
        .withColumn("is_partial", (start < first) | (end > last))
        .drop("window_start", "window_end")
    )


def time_series(
    plays: DataFrame, windows: DataFrame, grain: str, by: str | None = None
) -> DataFrame:
    """Coverage per period. Without `by` every period of the window is there.

    No plays is zero listening; plays without any duration stay NULL.
    """
    dated = plays.withColumn("period", period_start(F.col("full_date"), grain))
    keys = [PROFILE, "period"]
    if by is not None:
        return clip_to_window(with_coverage(dated, [*keys, by]), windows, grain)
    grid = windows.select(
        PROFILE,
        F.explode(periods_between(F.col("window_start"), F.col("window_end"), grain)).alias("period"),
    )
    sums = dated.groupBy(*keys).agg(*coverage_measures())
    full = grid.join(sums, keys, "left").withColumns(
        {name: F.coalesce(name, F.lit(0)) for name in COUNTS}
    )
    silent = F.col("play_count") == 0
    full = full.withColumn("ms_played", F.when(silent, F.lit(0)).otherwise(F.col("ms_played")))
    return clip_to_window(_derived(full), windows, grain)


def days_in_window(series: DataFrame, windows: DataFrame, grain: str) -> DataFrame:
    """The series with the number of each period's days that lie inside the window."""
    span = windows.select(PROFILE, "window_start", "window_end")
    end = F.least(period_end(F.col("period"), grain), F.col("window_end"))
    start = F.greatest(F.col("period"), F.col("window_start"))
    return (
        series.join(span, PROFILE)
        .withColumn("days", F.date_diff(end, start) + 1)
        .drop("window_start", "window_end")
    )


def rolling_mean(
    series: DataFrame, value: str, span: int, name: str, keys: Sequence[str] = (PROFILE,)
) -> DataFrame:
    """Trailing mean over `span` periods, NULL until half of them carry a value."""
    frame = Window.partitionBy(*keys).orderBy("period").rowsBetween(1 - span, 0)
    enough = F.count(value).over(frame) >= span // 2
    return series.withColumn(name, F.when(enough, F.avg(value).over(frame)))


def monthly_phase(plays: DataFrame, months: int = SETTINGS.phase_months) -> DataFrame:
    """Each month's mean hour on the clock circle against the months around it, itself left out."""
    hour = F.col("hour") + F.coalesce("minute", F.lit(0)) / 60.0
    timed = plays.filter("hour is not null and full_date is not null")
    sums = timed.groupBy(PROFILE, period_start(F.col("full_date"), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("plays"),
        F.sum(clock.sine(hour)).alias("sine"), F.sum(clock.cosine(hour)).alias("cosine"),
    )
    numbered = sums.withColumn("__n", month_number(F.col("month")))
    # one row per profile and month
    near = Window.partitionBy(PROFILE).orderBy("__n").rangeBetween(-months, months)
    around = F.count(F.lit(1)).over(near) > 1
    base_sine = F.sum("sine").over(near) - F.col("sine")
    base_cosine = F.sum("cosine").over(near) - F.col("cosine")
    phase = numbered.withColumns(
        {
            "mean_hour": clock.mean_hour(F.col("sine"), F.col("cosine")),
            "baseline_hour": F.when(around, clock.mean_hour(base_sine, base_cosine)),
        }
    )
    return phase.withColumn(
        "shift_hours", clock.hour_difference(F.col("mean_hour"), F.col("baseline_hour"))
    ).select(PROFILE, "month", "plays", "mean_hour", "baseline_hour", "shift_hours")


def shift_runs(
    phase: DataFrame, threshold: float = SETTINGS.phase_threshold_hours,
    min_plays: int = SETTINGS.phase_min_plays,
) -> DataFrame:
    """Consecutive months shifted the same way, as one run each."""
    shift = F.col("shift_hours")
    flagged = phase.filter((F.col("plays") >= min_plays) & (F.abs(shift) >= threshold))
    marked = islands(
        flagged.withColumns({"later": shift > 0, "__n": month_number(F.col("month"))}),
        [PROFILE, "later"], "__n",
    )
    weighted = F.sum(shift * F.col("plays")) / F.sum("plays")
    return marked.groupBy(PROFILE, "later", "island").agg(
        F.min("month").alias("first_month"), F.max("month").alias("last_month"),
        F.count(F.lit(1)).alias("months"), weighted.alias("mean_shift_hours"),
        F.sum("plays").alias("plays"),
    ).drop("later", "island")
