"""Dates and times: local parsing, spawn year, elapsed days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from reddwatch.params import SPAWN_YEAR_LAST_MONTH


def parse_obs_time(text: Column | str) -> Column:
    """12-hour clock text in the session zone; unreadable text is NULL."""
    return F.try_to_timestamp(text, F.lit("M/d/yyyy h:mm:ss a"))


def parse_month_day_year(text: Column | str) -> Column:
    return F.try_to_date(text, "M/d/yyyy")


def spawn_year(month: Column, year: Column) -> Column:
    """The year a fish spawns: observations after June belong to the next year."""
    return F.when(month > SPAWN_YEAR_LAST_MONTH, year + 1).otherwise(year)


def elapsed_days(start: Column | str, end: Column | str, zoned: bool = True) -> Column:
    """Physical time between two instants in days, so a clock change counts as 23 or 25 hours.

    Times without a zone (`zoned=False`) have no clock change and are subtracted as they stand.
    """
    start, end = (F.col(c) if isinstance(c, str) else c for c in (start, end))
    if zoned:
        return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(86400e6)
    seconds = (end - start).cast("interval second").cast("decimal(20, 6)")
    return seconds.cast("double") / 86400


def day(value: dt.date | Column | None) -> Column:
    """A date parameter as a column; None is the current date of the session zone."""
    if value is None:
        return F.current_date()
    return value if isinstance(value, Column) else F.lit(value)


def within(
    date: Column | str, one: dt.date | Column | None, other: dt.date | Column | None
) -> Column:
    """Closed date window; the two bounds may come in either order, None being today."""
    date = F.col(date) if isinstance(date, str) else date
    bounds = day(one), day(other)
    return date.between(F.least(*bounds), F.greatest(*bounds))
