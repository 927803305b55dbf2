"""Read-through store: use a table that exists, else build and keep it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from martflow.operators.tables import current_version, publish, read_current
from martflow.schemas import conform


def read_or_build(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], schema: StructType
) -> DataFrame:
    """Read the parquet table at ``path``; build and write it first if absent.

    A table counts as present once it is published, so one that died half-way is
    built again. The store is never refreshed: use another path to get newer
    data.
    """
    if current_version(spark, path) is None:
        publish(conform(build(), schema), path)
    return read_current(spark, path, schema)
