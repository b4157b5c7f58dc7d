"""Column helpers on dates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Compact date layout, first plausible opening date, mean length of a year.
COMPACT = "yyyyMMdd"
FIRST_PLAUSIBLE = dt.date(1900, 1, 1)
DAYS_PER_YEAR = 365.25


def as_date(value: dt.date | str | Column | None) -> Column:
    """Reference date of a report: today unless one is given."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")


def is_compact_date(c: Column) -> Column:
    """Exactly eight digits."""
    return c.rlike(r"^[0-9]{8}\z")


def parse_compact(c: Column) -> Column:
    """Date from YYYYMMDD text, NULL where it is none."""
    return F.try_to_date(c, COMPACT)


def plausible_opening(c: Column, as_of: dt.date | str | None = None) -> Column:
    """True for YYYYMMDD text naming a date from 1900 up to the reference date, else false."""
    day = parse_compact(c)
    ok = is_compact_date(c) & day.between(F.lit(FIRST_PLAUSIBLE), as_date(as_of))
    return F.coalesce(ok, F.lit(False))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def years(days: Column) -> Column:
    """Days as fractional years."""
    return days / F.lit(DAYS_PER_YEAR)


def decade(c: Column) -> Column:
    return (F.floor(F.year(c) / F.lit(10)) * F.lit(10)).cast("int")


def date_key(c: Column) -> Column:
    return F.date_format(c, COMPACT)
