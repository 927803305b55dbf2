"""Small hand-made frames with the columns of the source and mart tables."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql.types import StructField, StructType

from martflow.schemas import MART_TABLES, SOURCE_TABLES, VISITS


def source(spark, table, rows):
    """Rows as dicts; columns left out are NULL."""
    return _frame(spark, SOURCE_TABLES[table], rows)


def mart(spark, table, rows):
    return _frame(spark, VISITS if table == "visits" else MART_TABLES[table], rows)


def _frame(spark, schema, rows):
    nullable = StructType([StructField(f.name, f.dataType) for f in schema])
    return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], nullable)


def money(text):
    return Decimal(text)


def day(text):
    return date.fromisoformat(text)


def moment(text):
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """Content as a set-like sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
