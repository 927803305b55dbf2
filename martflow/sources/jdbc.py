"""Reads from a relational database, split over executors by key range.

Filters and column choices made on the returned frame are pushed into the
database by Spark, so callers write ``read_table(...).filter(...).select(...)``
rather than building SQL text.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    relation: str,
    split_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 64,
    **options: str,
) -> dict[str, str]:
    """Reader options; the split column and its bounds come together or not at all."""
    if (split_column is None) != (bounds is None):
        raise ValueError("split_column and bounds must be given together")
    merged = {"url": url, "dbtable": relation, "fetchsize": "10000", "pushDownAggregate": "true"}
    if split_column is not None:
        merged |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return merged | options


def key_range(spark: SparkSession, url: str, table: str, column: str, **options: str) -> tuple | None:
    """Smallest and largest value of a column, found by the database; None if there is none."""
    sql = f"SELECT min({column}) AS low, max({column}) AS high FROM {table}"
    low, high = read_query(spark, url, sql, **options).first()
    return None if low is None else (low, high)


def read_table(spark: SparkSession, url: str, table: str, **split) -> DataFrame:
    """A whole table."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **split)).load()


def literal(value: Any) -> str:
    """A bound as SQL text that means the same to any database."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"{value!r} bounds no range")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, bounds: list) -> list[str]:
    """Conditions that every row meets exactly one of: a range from each bound to the next.

    Values below the first bound and unknown ones are in the first range. Equal
    bounds, as a very frequent value makes them, give one range.
    """
    starts = sorted(set(bounds))[1:]
    if not starts:
        return ["1 = 1"]
    edges = [literal(b) for b in starts]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges, edges[1:], strict=False)]
    return [f"{column} < {edges[0]} OR {column} IS NULL", *inner, f"{column} >= {edges[-1]}"]


def quantiles(spark: SparkSession, url: str, table: str, column: str, parts: int, **options: str) -> list:
    """The smallest value of each of ``parts`` equally large parts of a table, found by the database."""
    tiles = f"SELECT {column} AS v, ntile({int(parts)}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL"
    sql = f"SELECT min(v) AS bound FROM ({tiles}) AS tiles GROUP BY part"
    return [r[0] for r in read_query(spark, url, sql, **options).collect()]


def read_evenly(spark: SparkSession, url: str, table: str, column: str, partitions: int = 64, **options: str) -> DataFrame:
    """A whole table, each task reading about as many rows as any other, whatever the gaps between keys.

    Equal key ranges are uneven where keys are; this asks the database for
    ``partitions`` quantiles, which costs it one sort of the column (an index has
    it already). Only rows of one value stay together, however many they are.
    """
    bounds = quantiles(spark, url, table, column, partitions, **options)
    properties = {k: v for k, v in jdbc_options(url, table, **options).items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(url, table, predicates=range_predicates(column, bounds), properties=properties)


def read_query(spark: SparkSession, url: str, sql: str, **split) -> DataFrame:
    """The result of a query the database runs."""
    return read_table(spark, url, f"({sql.strip().rstrip(';')}) AS q", **split)
