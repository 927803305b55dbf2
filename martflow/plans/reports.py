"""Reports on the finished mart.

Facts are reduced to one row per dimension key before they meet the dimension,
so a very busy customer or location is a single row by the time of the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.functions.dates import week_start
from martflow.operators.windows import with_known


def _sales_per(fct_sales: DataFrame, key: str) -> DataFrame:
    return fct_sales.groupBy(key).agg(F.sum("quantity").alias("quantity"), F.sum("sales").alias("sales"))


def sales_by_location(
    fct_sales: DataFrame, dim_location: DataFrame, by: Sequence[str] = ("region",)
) -> DataFrame:
    """Quantity and sales per region, or per any other location columns."""
    return (
        _sales_per(fct_sales, "location_key")
        .join(dim_location.select("location_key", *by), "location_key", "left")
        .groupBy(*by)
        .agg(F.sum("quantity").alias("quantity"), F.sum("sales").alias("sales"))
    )


def sales_by_segment(fct_sales: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Buying customers, quantity and sales per customer segment; an unknown customer is none."""
    return (
        _sales_per(fct_sales, "customer_key")
        .join(dim_customer.select("customer_key", "segment"), "customer_key", "left")
        .groupBy("segment")
        .agg(
            F.count("customer_key").alias("customers"),
            F.sum("quantity").alias("quantity"),
            F.sum("sales").alias("sales"),
        )
    )


def customers_by_sex(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.groupBy("sex").agg(F.count(F.lit(1)).alias("customers"))


def visit_retention(web_visit: DataFrame) -> DataFrame:
    """Visitors per weekly cohort and number of weeks since the first visit.

    ``retention`` is the share of the cohort that came back in that week. After
    the first aggregate a customer has at most one row per week, which bounds
    the window partitions, and counting rows counts customers.
    """
    active = (
        with_known(web_visit, "customer_id", "time_visit")
        .select("customer_id", week_start(F.col("time_visit")).alias("week"))
        .distinct()
    )
    first = F.min("week").over(Window.partitionBy("customer_id"))
    cohorts = active.select(first.alias("cohort_week"), "week").withColumn(
        "week_offset", F.floor(F.datediff("week", "cohort_week") / 7).cast("int")
    )
    counted = cohorts.groupBy("cohort_week", "week_offset").agg(F.count(F.lit(1)).alias("customers"))
    size = F.max(F.when(F.col("week_offset") == 0, F.col("customers"))).over(Window.partitionBy("cohort_week"))
    return counted.withColumn("retention", F.col("customers").cast("double") / size)
