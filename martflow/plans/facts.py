"""Fact builders.

Two families differ in how they treat gaps. ``fct_sales`` and
``orders_by_customer_day`` leave out rows with an unknown grouping key and sum
an all-NULL group to 0. The ``_all_lines`` variants keep unknown keys as a
group of their own, keep lines without an order, and sum all-NULL to NULL.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.functions.numbers import money_sum, or_zero, ratio
from martflow.operators.windows import in_window, with_known
from martflow.schemas import MONEY


def sales_window(sales: DataFrame, since: date | None = None, as_of: date | None = None) -> DataFrame:
    """Orders dated on or after ``since`` and on or before ``as_of``, times of day ignored."""
    return in_window(sales.withColumn("order_date", F.to_date("order_date")), "order_date", since=since, as_of=as_of)


def sale_product_window(
    sale_product: DataFrame, sales: DataFrame, since: date | None = None, as_of: date | None = None
) -> DataFrame:
    """Lines whose order is in the window.

    For extracting lines alone; ``fct_sales`` needs no such step, because its
    join with the window's orders keeps the same lines.
    """
    return sale_product.join(sales_window(sales, since, as_of).select("sales_id"), "sales_id", "left_semi")


def with_time_key(df: DataFrame, dim_time: DataFrame, day: str = "order_date") -> DataFrame:
    """Look up ``time_key``; NULL for a day outside the calendar."""
    lookup = dim_time.select(F.col("date").alias("_calendar_day"), "time_key")
    return df.join(lookup, F.col(day) == F.col("_calendar_day"), "left").drop("_calendar_day")


def fct_sales(
    sales: DataFrame,
    sale_product: DataFrame,
    dim_time: DataFrame,
    since: date | None = None,
    as_of: date | None = None,
) -> DataFrame:
    """Quantity and sales per customer, location, product and order day."""
    keys = ["customer_id", "ship_to", "product_id", "order_date"]
    orders = sales_window(sales, since, as_of).select("sales_id", "customer_id", "ship_to", "order_date")
    lines = sale_product.select("sales_id", "product_id", "quantity", "subtotal")
    daily = (
        with_known(lines, "product_id")
        .join(with_known(orders, "customer_id", "ship_to", "order_date"), "sales_id")
        .groupBy(keys)
        .agg(
            or_zero(F.sum("quantity")).alias("quantity"),
            or_zero(money_sum("subtotal")).cast(MONEY).alias("sales"),
        )
    )
    return with_time_key(daily, dim_time).select(
        F.col("customer_id").alias("customer_key"),
        F.col("ship_to").alias("location_key"),
        F.col("product_id").alias("product_key"),
        "time_key",
        "quantity",
        "sales",
    )


def fct_sales_all_lines(sales: DataFrame, sale_product: DataFrame, dim_time: DataFrame) -> DataFrame:
    """The sales fact over every line, lines without an order included.

    The time key is looked up per order, which are fewer than lines; month and
    year need no comparison of their own because the day implies them.
    """
    orders = with_time_key(
        sales.select("sales_id", "customer_id", "ship_to", F.to_date("order_date").alias("order_date")), dim_time
    )
    return _line_totals(sale_product, orders, time_key="time_key")


def sales_with_product(sales: DataFrame, sale_product: DataFrame) -> DataFrame:
    """Quantity and sales per customer, location and product over all time."""
    return _line_totals(sale_product, sales)


def _line_totals(sale_product: DataFrame, orders: DataFrame, **extra_keys: str) -> DataFrame:
    keys = {"customer_key": "customer_id", "location_key": "ship_to", "product_key": "product_id", **extra_keys}
    lines = sale_product.select("sales_id", "product_id", "quantity", "subtotal")
    orders = orders.select("sales_id", *[c for c in keys.values() if c != "product_id"])
    return (
        lines.join(orders, "sales_id", "left")
        .groupBy([F.col(column).alias(name) for name, column in keys.items()])
        .agg(F.sum("quantity").alias("quantity"), money_sum("subtotal").alias("sales"))
    )


DAY_KEYS = ["customer_id", "ship_to", "order_date"]


def _dated_orders(sales: DataFrame) -> DataFrame:
    return with_known(sales.withColumn("order_date", F.to_date("order_date")), *DAY_KEYS)


def orders_by_customer_day(sales: DataFrame) -> DataFrame:
    """Number of orders and their total per customer, location and order day."""
    return (
        _dated_orders(sales)
        .groupBy(*DAY_KEYS)
        .agg(F.count(F.lit(1)).alias("orders"), or_zero(money_sum("total")).cast(MONEY).alias("total"))
    )


def visits(web_visit: DataFrame, since: date | datetime | None = None, as_of: date | datetime | None = None) -> DataFrame:
    """Visits per customer. Bounds are instants: a date stands for its midnight.

    Visits without a customer form a group with the count 0.
    """
    return (
        in_window(web_visit, "time_visit", since=since, as_of=as_of)
        .groupBy(F.col("customer_id").alias("customer_key"))
        .agg(F.count("customer_id").alias("visits"))
    )


def fct_marketing(
    dim_customer: DataFrame,
    sales: DataFrame,
    customer_visits: DataFrame,
    dim_time: DataFrame,
    all_sales: DataFrame | None = None,
) -> DataFrame:
    """Conversion rate and average purchase value per customer, location and order day.

    ``sales`` is already limited to the window. The visits are the customer's
    total over the visit window, so ``conversion_rate`` is that day's orders
    over all visits. A customer without orders keeps one row without location,
    time and ratios; without visits the conversion rate is unknown. Orders of
    customers the dimension does not have are left out.

    Who has no orders is decided by ``all_sales``, by default the window alone.
    A window that is to replace a part of the fact must be decided by all
    orders. ``sales`` is read twice: give a stored table, or both reads may
    differ. A customer with very many order days is split by adaptive execution,
    because both joins below keep or drop order days, never multiply customers.
    """
    customers = dim_customer.select("customer_key")
    days = orders_by_customer_day(sales).join(customers, F.col("customer_id") == F.col("customer_key"))
    buyers = _dated_orders(sales if all_sales is None else all_sales).select("customer_id").distinct()
    quiet = customers.join(buyers, F.col("customer_key") == F.col("customer_id"), "left_anti")
    visitors = customer_visits.select(F.col("customer_key").alias("_visitor"), "visits")
    bought = with_time_key(
        days.join(visitors, F.col("customer_key") == F.col("_visitor"), "left"), dim_time
    ).select(
        "customer_key",
        F.col("ship_to").alias("location_key"),
        "time_key",
        ratio(F.col("orders"), F.col("visits")).alias("conversion_rate"),
        ratio(F.col("total"), F.col("orders")).alias("avg_purchase_value"),
    )
    return bought.unionByName(quiet, allowMissingColumns=True)
