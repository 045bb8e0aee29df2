"""Date columns and date ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: Column | str) -> Column:
    """A date column from a column or a ``yyyy-MM-dd`` text."""
    return (F.lit(value) if isinstance(value, str) else value).cast("date")


def compact_date(col: Column) -> Column:
    """``yyyyMMdd`` text as a date, null when it is no date."""
    return F.try_to_timestamp(col, F.lit("yyyyMMdd")).cast("date")


def last_full_week_end(as_of: Column | str) -> Column:
    """The Sunday before the week of ``as_of``."""
    day = as_date(as_of)
    return F.date_sub(day, F.weekday(day) + 1)


def rolling_range(as_of: Column | str, back: int = 90, until: int = 1) -> tuple[Column, Column]:
    """First and last day of the range ending ``until`` days before ``as_of``."""
    day = as_date(as_of)
    return F.date_sub(day, back), F.date_sub(day, until)


def within_days(col: Column, as_of: Column | str, back: int, forward: int) -> Column:
    """``as_of - back <= col <= as_of + forward``; for a timestamp the end is that midnight."""
    day = as_date(as_of)
    return col.between(F.date_sub(day, back), F.date_add(day, forward))


def berlin_time(ts: Column) -> Column:
    """UTC time as local German time text, daylight saving included."""
    return F.date_format(F.from_utc_timestamp(ts, "Europe/Berlin"), "d.M.yyyy, HH:mm:ss")


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
