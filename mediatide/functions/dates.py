"""Days, weeks and months.  Every result is a DATE, none depends on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_day(text: Column) -> Column:
    """First ten characters as a day; anything unreadable gives NULL.

    The cast is faster than a format; years beyond four digits, which it also reads, are refused.
    """
    day = F.substring(text, 1, 10).try_cast("date")
    first, last = (F.lit(d).cast("date") for d in ("0001-01-01", "9999-12-31"))
    return F.when(day.between(first, last), day)


def unix_day(seconds: Column) -> Column:
    """UTC day of seconds since 1970; NULL when out of the range of days."""
    return F.date_from_unix_date(F.floor(seconds / 86400).try_cast("int"))


def week_start(day: Column) -> Column:
    """Monday of the week."""
    return F.trunc(day, "week")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def as_of_day(as_of: dt.date | str | None) -> Column:
    """The given day, or today when none is given."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def months_back(as_of: Column, months: int) -> Column:
    """First day of the month `months` before `as_of`."""
    return F.trunc(F.add_months(as_of, -months), "month")
