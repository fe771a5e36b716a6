"""Date and time parts (F3-F11, F23, F26). All are defined in the session time zone (UTC)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_timestamp(c: Column) -> Column:
    """ISO-8601 text (with or without 'Z' / offset) to TIMESTAMP; malformed -> null."""
    return c.try_cast("timestamp")


def to_day(ts: Column) -> Column:
    """F3."""
    return F.to_date(ts)


def year_of(c: Column) -> Column:
    return F.year(c)


def month_of(c: Column) -> Column:
    return F.month(c)


def day_of(c: Column) -> Column:
    return F.dayofmonth(c)


def day_of_week(c: Column) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(c)


def day_name(c: Column) -> Column:
    """English weekday name."""
    return F.date_format(c, "EEEE")


def hour_of(ts: Column) -> Column:
    """F8."""
    return F.hour(ts)


def iso_week(c: Column) -> Column:
    """ISO-8601 week number (week 1 can start in the previous December)."""
    return F.weekofyear(c)


def week_start(c: Column) -> Column:
    """Monday of the ISO week containing ``c`` (grouping key for weekly roll-ups)."""
    return F.to_date(F.date_trunc("week", c))


def execution_date(day: Column) -> Column:
    """a run's default date, the day before ``day``."""
    return F.date_sub(day, 1)


def format_day(c: Column) -> Column:
    """yyyy-MM-dd."""
    return F.date_format(c, "yyyy-MM-dd")


def format_day_path(c: Column) -> Column:
    """yyyy/MM/dd (archive folder layout)."""
    return F.date_format(c, "yyyy/MM/dd")


def now() -> Column:
    """F26."""
    return F.current_timestamp()


def today() -> Column:
    """F26."""
    return F.current_date()
