"""Incremental date windows."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_window(
    df: DataFrame,
    column: str,
    since: date | datetime | None = None,
    as_of: date | datetime | None = None,
    after: date | datetime | None = None,
) -> DataFrame:
    """Keep rows with ``column >= since``, ``<= as_of`` and ``> after``.

    Bounds are literals of the column's own type, so the comparison reaches
    the scan as a pushed filter. A row without a value is in no window; with
    no bound at all every row is kept.
    """
    kind = df.schema[column].dataType

    def bound(value: date | datetime) -> Column:
        return F.lit(str(value)).cast(kind)

    if since is not None:
        df = df.filter(F.col(column) >= bound(since))
    if as_of is not None:
        df = df.filter(F.col(column) <= bound(as_of))
    if after is not None:
        df = df.filter(F.col(column) > bound(after))
    return df


def with_known(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows in which none of the columns is NULL.

    One plain condition per column, unlike ``dropna``, so that each can be
    pushed to the scan and turn an outer join into an inner one.
    """
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df
