"""Calendar periods: day, Monday week, month, year."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playmart.config import SETTINGS

GRAINS = ("day", "week", "month", "year")
_STEP = {"day": "interval 1 day", "week": "interval 7 day", "month": "interval 1 month",
         "year": "interval 1 year"}


def _known(grain: str) -> str:
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}")
    return grain


def grain_for(first: Column, last: Column) -> Column:
    """Weeks once a window is longer than two years, days before that."""
    return F.when(F.date_diff(last, first) > SETTINGS.weekly_after_days, "week").otherwise("day")


def period_start(day: Column, grain: str) -> Column:
    return F.to_date(F.date_trunc(_known(grain), day))


def period_end(start: Column, grain: str) -> Column:
    if _known(grain) == "day":
        return start
    if grain == "week":
        return F.date_add(start, 6)
    if grain == "month":
        return F.last_day(start)
    return F.last_day(F.add_months(F.date_trunc("year", start).cast("date"), 11))


def periods_between(first: Column, last: Column, grain: str) -> Column:
    """Every period start from the one holding `first` up to `last`."""
    return F.sequence(period_start(first, grain), last, F.expr(_STEP[_known(grain)]))


def month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)
