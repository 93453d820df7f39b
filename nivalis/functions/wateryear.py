"""Water years: a year named after its end that starts in `first_month` (10 north, 4 south)."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def water_year(date: Column, first_month: int = 10) -> Column:
    later = F.month(date) >= first_month if first_month > 1 else F.lit(False)
    return F.year(date) + later.cast("int")


def water_year_start(date: Column, first_month: int = 10) -> Column:
    year = water_year(date, first_month) - (1 if first_month > 1 else 0)
    return F.make_date(year, F.lit(first_month), F.lit(1))


def water_year_end(date: Column, first_month: int = 10) -> Column:
    return F.date_sub(F.add_months(water_year_start(date, first_month), 12), 1)


def day_of_water_year(date: Column, first_month: int = 10) -> Column:
    return F.datediff(date, water_year_start(date, first_month)) + 1


def days_in_water_year(date: Column, first_month: int = 10) -> Column:
    return F.datediff(water_year_end(date, first_month), water_year_start(date, first_month)) + 1


def processing_mode(date: Column, today: Column, months: int = 2) -> Column:
    """nrt for dates in the last months before today, else hist."""
    return F.when(date > F.add_months(today, -months), "nrt").otherwise("hist")


def first_month_of(hemisphere: Column) -> Column:
    return F.when(hemisphere == "S", 4).otherwise(10)


def _add_months(day: dt.date, n: int) -> dt.date:
    year, month = divmod(day.year * 12 + day.month - 1 + n, 12)
    return dt.date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def date_window(day: dt.date, months: int = 12, first_month: int = 10, today: dt.date | None = None, overlap: bool = False) -> tuple[dt.date, dt.date]:
    """First and last date of the window of `months` months up to `day`: capped at yesterday and, unless overlap, at the water year's start."""
    last = min(day, (today or dt.date.max) - dt.timedelta(1)) if today else day
    first = _add_months(last, -months) + dt.timedelta(1)
    if not overlap:
        start = dt.date(last.year - (last.month < first_month), first_month, 1) if first_month > 1 else dt.date(last.year, 1, 1)
        first = max(first, start)
    return first, last


def interpolation_window(first: dt.date, last: dt.date, before: int = 3, after: int = 0) -> tuple[dt.date, dt.date]:
    """The window widened by months before and after: trailing (after 0) or centred."""
    return _add_months(first, -before), _add_months(last, after)


def month_firsts(first: Column, last: Column) -> Column:
    """The first days of all months between two dates, as an array."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
