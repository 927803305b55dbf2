"""Additive totals kept by month: each window of the source is read once, ever.

A rollup is a table of keys and sums, one row per month and key. A window that is
loaded adds its months' rows to it; a replacement drops the months from its
start on and adds what they hold now. Totals over all time are sums of few rows
per key, so what a run reads of the source is its window, not its history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from martflow.operators import versions
from martflow.operators.tables import MONTH, outside_window, read_months, write_by_month
from martflow.operators.versions import Table, Version
from martflow.schemas import conform


def monthly(df: DataFrame, month: Column, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Rows folded to one per month and key. Rows without a month are of month 0."""
    return df.groupBy(F.coalesce(month, F.lit(0)).alias(MONTH), *keys).agg(*[c.alias(n) for n, c in sums.items()])


def add_window(window: DataFrame, path: str, schema: StructType, mark: str) -> bool:
    """Add a window's monthly rows, once per ``mark``; False if the rollup has them already.

    Two loads of one mark at once add it once.
    """
    spark = window.sparkSession
    store, own = versions.home(spark, path)
    if mark in versions.last(spark, store).marks:
        return False
    written = write_by_month(_typed(window, schema), path, F.col(MONTH))
    added = True

    def change(present: Version) -> dict[str, Table]:
        nonlocal added
        added = mark not in present.marks
        return {own: Table({**present.tables.get(own, Table()).folders, **(written if added else {})})}

    versions.publish(spark, store, change, mark=mark)
    return added


def replace_from(window: DataFrame, path: str, schema: StructType, first: int) -> None:
    """Make ``window`` the rollup's content from the month ``first`` on; repeating it changes nothing.

    Month 0, of rows without a date, stays as it is: such rows are in no window.
    """
    spark = window.sparkSession
    store, own = versions.home(spark, path)
    present = versions.last(spark, store)
    written = write_by_month(_typed(window.filter(F.col(MONTH) > 0), schema), path, F.col(MONTH), first)

    def change(latest: Version) -> dict[str, Table]:
        versions.unchanged(present, own)(latest)
        return {own: Table({**outside_window(latest.tables.get(own, Table()), first), **written})}

    versions.publish(spark, store, change)


def _typed(window: DataFrame, schema: StructType) -> DataFrame:
    return conform(window, StructType([*schema.fields]).add(MONTH, IntegerType()))


def totals(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """Sums per key over all months; empty if nothing was loaded yet."""
    store, own = versions.home(spark, path)
    rows = read_months(spark, path, versions.last(spark, store).tables.get(own, Table()), schema)
    sums = [f.name for f in schema if f.name not in keys]
    return rows.groupBy(*keys).agg(*[F.sum(c).cast(schema[c].dataType).alias(c) for c in sums])
