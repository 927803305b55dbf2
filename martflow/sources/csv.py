"""CSV hand-off files with an explicit schema.

The dialect is the one databases and pandas share: comma, header, quotes
doubled inside quotes, an unquoted empty field is NULL and ``""`` is an empty
string. Columns are matched against the header by name; a mismatch or a value
that does not parse fails the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegerType, LongType, StringType, StructField, StructType

from martflow.schemas import conform

DIALECT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "dateFormat": "yyyy-MM-dd",
    # Spark trims text on writing unless told otherwise.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

WRITTEN_NUMBER = DecimalType(38, 10)

# Stands for a quoted empty field while reading: Spark would take it for NULL.
_EMPTY = "\u0001empty\u0001"

# Spark's name for a first column with a blank header, and the blank name that its
# header check compares.
INDEX_COLUMN = "_c0"
BLANK = ""


def write_csv(df: DataFrame, path: str, key: str | None = None, mode: str = "overwrite") -> None:
    """Write a folder of CSV files, the key column first."""
    if key is not None:
        df = df.select(key, *[c for c in df.columns if c != key])
    df.write.mode(mode).options(**DIALECT, emptyValue='""').csv(path)


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.options(**DIALECT).csv(path).columns


def _parse(spark: SparkSession, path: str, schema: StructType, multiline: bool) -> DataFrame:
    parsed = (
        spark.read.schema(schema)
        .options(**DIALECT, emptyValue=_EMPTY, mode="FAILFAST")
        .option("multiLine", multiline)
        .option("enforceSchema", False)
        .csv(path)
    )
    text = [f.name for f in schema if f.dataType == StringType()]
    return parsed.withColumns({c: F.when(F.col(c) == _EMPTY, "").otherwise(F.col(c)) for c in text})


def read_csv(spark: SparkSession, path: str, schema: StructType, multiline: bool = False) -> DataFrame:
    """Read CSV files whose header lists exactly the schema's columns, in order.

    Files are split over tasks. Only text fields with line breaks in them need
    ``multiline``; then the unit of parallelism is the file.
    """
    return _parse(spark, path, schema, multiline)


def read_indexed_csv(spark: SparkSession, path: str, schema: StructType, multiline: bool = False) -> DataFrame:
    """Read CSV files with an unnamed row-number column in front, and drop it."""
    header = _header(spark, path)
    if header != [INDEX_COLUMN, *schema.fieldNames()]:
        raise ValueError(f"{path} has columns {header}, expected an index and {schema.fieldNames()}")
    # Every file's header is checked, the blank name included.
    with_index = StructType([StructField(BLANK, StringType()), *schema.fields])
    return _parse(spark, path, with_index, multiline).select(*schema.fieldNames())


def _whole(column: str, kind: DataType) -> Column:
    """A whole number that may be written with a fraction of zero."""
    value = F.col(column)
    wrong = F.raise_error(F.concat(F.lit(f"{column} is not a whole number: "), value.cast("string")))
    return F.when(value != F.floor(value), wrong.cast(kind)).otherwise(value.cast(kind)).alias(column)


def bulk_load(
    spark: SparkSession,
    path: str,
    like: StructType,
    multiline: bool = False,
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Read CSV files into the shape of a table, whatever the file's column order.

    The header is read first to learn the order; rows are parsed with the
    table's types and returned with the table's columns. ``rename`` maps file
    columns to table columns. Whole numbers may be written as ``5.0``.
    """
    header = _header(spark, path)
    names = [(rename or {}).get(name, name) for name in header]
    if sorted(names) != sorted(like.fieldNames()):
        raise ValueError(f"{path} has columns {names}, the table has {like.fieldNames()}")
    whole = (IntegerType(), LongType())
    in_file_order = StructType(
        [
            StructField(own, WRITTEN_NUMBER if like[name].dataType in whole else like[name].dataType)
            for own, name in zip(header, names, strict=True)
        ]
    )
    parsed = _parse(spark, path, in_file_order, multiline).toDF(*names)
    typed = [_whole(f.name, f.dataType) if f.dataType in whole else F.col(f.name) for f in like]
    return conform(parsed.select(*typed), like)
