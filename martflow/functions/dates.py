"""Calendar expressions; each takes and returns native Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """``yyyymmdd`` as an int."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def month_key(time_key: Column) -> Column:
    """``yyyymm`` of a ``yyyymmdd`` key."""
    return F.floor(time_key / 100).cast("int")


def week_of_month(day: Column) -> Column:
    """1 for days 1-7, 2 for days 8-14, up to 5 for days 29-31."""
    return F.ceil(F.dayofmonth(day) / 7).cast("int")


def iso_week(day: Column) -> Column:
    """ISO-8601 week of the year; early January may be week 52 or 53."""
    return F.weekofyear(day)


def week_start(moment: Column) -> Column:
    """The Monday on or before a date or timestamp."""
    return F.trunc(F.to_date(moment), "week")
