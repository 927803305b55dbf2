"""The six operational tables every plan starts from."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from martflow.schemas import SOURCE_TABLES, conform
from martflow.sources.jdbc import key_range, read_evenly, read_table


class RetailSource(Protocol):
    """Anything with frames that have the columns of ``schemas.SOURCE_TABLES``."""

    sales: DataFrame
    sale_product: DataFrame
    customer: DataFrame
    product: DataFrame
    locations: DataFrame
    web_visit: DataFrame


@dataclass(frozen=True)
class StoredSource:
    """A ``RetailSource`` whose tables exist as such."""

    sales: DataFrame
    sale_product: DataFrame
    customer: DataFrame
    product: DataFrame
    locations: DataFrame
    web_visit: DataFrame


def _conformed(**frames: DataFrame) -> RetailSource:
    """Frames with the library's columns and types, whatever types they are stored with."""
    return StoredSource(**{name: conform(frames[name], schema) for name, schema in SOURCE_TABLES.items()})


def parquet_source(spark: SparkSession, root: str) -> RetailSource:
    """The source tables as parquet folders ``{root}/{table}``, read with their own types."""
    return _conformed(**{name: spark.read.parquet(f"{root}/{name}") for name in SOURCE_TABLES})


def catalog_source(spark: SparkSession, database: str) -> RetailSource:
    """The source tables from the session catalogue."""
    return _conformed(**{name: spark.table(f"{database}.{name}") for name in SOURCE_TABLES})


# What splits each table evenly for parallel reads from a database. Visits go by
# time, because one customer may have very many.
SPLIT_COLUMNS = {
    "sales": "sales_id",
    "sale_product": "sales_id",
    "customer": "customer_id",
    "product": "product_id",
    "locations": "location_id",
    "web_visit": "time_visit",
}


def database_source(
    spark: SparkSession,
    url: str,
    partitions: int = 64,
    bounds: dict[str, tuple] | None = None,
    even: Collection[str] = (),
    **options: str,
) -> RetailSource:
    """The source tables from a relational database, each read by ``partitions`` tasks.

    ``bounds`` gives the range of the split column per table; the database is
    asked for the ones left out. Values outside the range are read too, by the
    first and last task. The tables in ``even`` are split by quantiles instead:
    for keys with large gaps, or visits that come in waves.
    """
    frames = {}
    for name in SOURCE_TABLES:
        column = SPLIT_COLUMNS[name]
        if name in even:
            frames[name] = read_evenly(spark, url, name, column, partitions, **options)
            continue
        span = (bounds or {}).get(name) or key_range(spark, url, name, column, **options)
        split = {"split_column": column, "bounds": span, "partitions": partitions} if span else {}
        frames[name] = read_table(spark, url, name, **split, **options)
    return _conformed(**frames)
