"""Typed catalogue: source tables, mart tables, primary and foreign keys.

Columns are bound by name everywhere. Keys are 64-bit because a source may
outgrow 32 bits; ``time_key`` is ``yyyymmdd`` and fits an int.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(18, 2)


def _struct(required: tuple[str, ...] = (), **columns: DataType) -> StructType:
    return StructType([StructField(n, t, n not in required) for n, t in columns.items()])


SOURCE_TABLES: dict[str, StructType] = {
    "sales": _struct(
        sales_id=LongType(), customer_id=LongType(), ship_to=LongType(), order_date=DateType(), total=MONEY
    ),
    "sale_product": _struct(
        sales_id=LongType(),
        product_id=LongType(),
        quantity=IntegerType(),
        subtotal=MONEY,
        ratings=DecimalType(4, 1),
    ),
    "customer": _struct(
        customer_id=LongType(),
        name=StringType(),
        segment=StringType(),
        registered=DateType(),
        sex=StringType(),
        points=IntegerType(),
    ),
    "product": _struct(
        product_id=LongType(),
        category=StringType(),
        subcategory=StringType(),
        product_name=StringType(),
        registered=DateType(),
    ),
    "locations": _struct(
        location_id=LongType(),
        country=StringType(),
        city=StringType(),
        state=StringType(),
        postal_code=StringType(),
        region=StringType(),
    ),
    "web_visit": _struct(customer_id=LongType(), time_visit=TimestampNTZType()),
}

MART_TABLES: dict[str, StructType] = {
    "dim_time": _struct(
        required=("time_key",),
        time_key=IntegerType(),
        day_of_month=IntegerType(),
        week_of_month=IntegerType(),
        month=IntegerType(),
        year=IntegerType(),
        quarter_of_year=IntegerType(),
        date=DateType(),
    ),
    "dim_customer": _struct(
        required=("customer_key",),
        customer_key=LongType(),
        name=StringType(),
        segment=StringType(),
        registered=DateType(),
        sex=StringType(),
        points=IntegerType(),
    ),
    "dim_product": _struct(
        required=("product_key",),
        product_key=LongType(),
        category=StringType(),
        subcategory=StringType(),
        product_name=StringType(),
        ratings=DoubleType(),
    ),
    "dim_location": _struct(
        required=("location_key",),
        location_key=LongType(),
        country=StringType(),
        city=StringType(),
        state=StringType(),
        postal_code=StringType(),
        region=StringType(),
    ),
    # Facts keep their dimension keys nullable: a date past the calendar and a
    # customer without orders are valid rows with an unknown key.
    "fct_sales": _struct(
        customer_key=LongType(),
        location_key=LongType(),
        product_key=LongType(),
        time_key=IntegerType(),
        quantity=LongType(),
        sales=MONEY,
    ),
    "fct_marketing": _struct(
        customer_key=LongType(),
        location_key=LongType(),
        time_key=IntegerType(),
        conversion_rate=DoubleType(),
        avg_purchase_value=DoubleType(),
    ),
}

VISITS = _struct(customer_key=LongType(), visits=LongType())

PRIMARY_KEYS: dict[str, str] = {
    "dim_time": "time_key",
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "dim_location": "location_key",
}

DIMENSIONS = tuple(PRIMARY_KEYS)
FACTS = ("fct_sales", "fct_marketing")


class ForeignKey(NamedTuple):
    fact: str
    column: str
    dimension: str


FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    ForeignKey("fct_sales", "customer_key", "dim_customer"),
    ForeignKey("fct_sales", "location_key", "dim_location"),
    ForeignKey("fct_sales", "product_key", "dim_product"),
    ForeignKey("fct_sales", "time_key", "dim_time"),
    ForeignKey("fct_marketing", "customer_key", "dim_customer"),
    ForeignKey("fct_marketing", "location_key", "dim_location"),
    ForeignKey("fct_marketing", "time_key", "dim_time"),
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns by name, in its order and types."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
