"""Dimension builders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StructType

from martflow.functions import dates
from martflow.functions.numbers import rounded_mean
from martflow.operators import rollups
from martflow.operators.windows import in_window

# Ten years of 365 days and the first day itself.
CALENDAR_DAYS = 3651


def calendar(spark: SparkSession, first_day: Column, days: int = CALENDAR_DAYS) -> DataFrame:
    """One row per day from ``first_day``, which may be a literal or a scalar subquery.

    Built on a row range, so the optimizer knows its exact size and can decide
    by itself to broadcast it. One partition: the rows are few, however many
    cores the cluster has.
    """
    day = F.date_add(first_day, F.col("id").cast("int"))
    return spark.range(0, days, 1, numPartitions=1).select(day.alias("date")).filter("date is not null")


def dim_time(sales: DataFrame, days: int | None = CALENDAR_DAYS) -> DataFrame:
    """Calendar from the first order, ``days`` days long; empty if there is no order.

    Orders after it have no time key. Without ``days`` it reaches the last order.
    """
    span = sales.agg(F.min(F.to_date("order_date")).alias("first"), F.max(F.to_date("order_date")).alias("last"))
    if days is None:
        first, last = span.first()
        days = (last - first).days + 1 if first else 0
        return time_attributes(calendar(sales.sparkSession, F.lit(first), days))
    return time_attributes(calendar(sales.sparkSession, span.select("first").scalar(), days))


def time_attributes(days: DataFrame) -> DataFrame:
    day = F.col("date")
    return days.select(
        dates.date_key(day).alias("time_key"),
        F.dayofmonth(day).alias("day_of_month"),
        dates.week_of_month(day).alias("week_of_month"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter_of_year"),
        day,
    )


def calendar_iso_week(dim_time: DataFrame) -> DataFrame:
    """The calendar's days with their ISO week."""
    return dim_time.select("time_key", dates.iso_week(F.col("date")).alias("iso_week"), "date")


def dim_customer(customer: DataFrame, registered_after: date | None = None) -> DataFrame:
    """Customers; with a date only those registered strictly after that day."""
    typed = customer.withColumn("registered", F.to_date("registered"))
    return in_window(typed, "registered", after=registered_after).select(
        F.col("customer_id").alias("customer_key"), "name", "segment", "registered", "sex", "points"
    )


#: What means are made of, added up over any lines.
RATING_TOTALS = (
    StructType().add("product_id", LongType()).add("rating_sum", DecimalType(38, 10)).add("rating_count", LongType())
)


def _rating_sums(sale_product: DataFrame) -> dict[str, Column]:
    ratings = F.col("ratings")
    if not isinstance(sale_product.schema["ratings"].dataType, DecimalType):
        ratings = ratings.cast("decimal(18,10)")
    return {"rating_sum": F.sum(ratings), "rating_count": F.count(ratings)}


def rating_totals(sale_product: DataFrame) -> DataFrame:
    """Sum and number of ratings per product."""
    return sale_product.groupBy("product_id").agg(*[c.alias(n) for n, c in _rating_sums(sale_product).items()])


def rating_window(
    sale_product: DataFrame, sales: DataFrame, since: date | None = None, as_of: date | None = None
) -> DataFrame:
    """Rating totals per product and order month, of the lines whose order is in the window.

    Lines without an order or a day are in windows without a start, as month 0.
    """
    days = sales.select("sales_id", F.to_date("order_date").alias("_day"))
    if since is not None:
        lines = sale_product.join(in_window(days, "_day", since=since, as_of=as_of), "sales_id")
    else:
        lines = sale_product.join(days, "sales_id", "left")
        if as_of is not None:
            lines = lines.filter(F.col("_day").isNull() | (F.col("_day") <= F.lit(as_of)))
    month = F.year("_day") * 100 + F.month("_day")
    return rollups.monthly(lines, month, ["product_id"], _rating_sums(sale_product))


def load_ratings(
    store: str,
    sale_product: DataFrame,
    sales: DataFrame,
    since: date | None = None,
    as_of: date | None = None,
    replace: bool = False,
) -> DataFrame:
    """Bring a window's ratings into the rollup at ``store``; returns the totals of all it has then.

    A window is added once, however often it is loaded; with ``replace`` the
    totals from the start of its first month on become the window's, which is how
    lines that were changed or lost since are corrected. A line whose order came
    later than the window it was loaded in is corrected by neither.
    """
    window = rating_window(sale_product, sales, since, as_of)
    if not replace:
        rollups.add_window(window, store, RATING_TOTALS, mark=f"{since}..{as_of}")
    elif since is None:
        raise ValueError("a replacement needs the start of its window")
    elif since.day != 1:
        raise ValueError(f"the window must start with a month: use {since.replace(day=1)}")
    else:
        rollups.replace_from(window, store, RATING_TOTALS, since.year * 100 + since.month)
    return rollups.totals(sale_product.sparkSession, store, RATING_TOTALS, ["product_id"])


def product_ratings(totals: DataFrame) -> DataFrame:
    """Mean rating per product from ``rating_totals``, NULL where no line carries one."""
    mean = rounded_mean(F.col("rating_sum"), F.col("rating_count"))
    return totals.select(F.col("product_id").alias("rated_id"), mean.cast("double").alias("ratings"))


def dim_product(
    product: DataFrame,
    sale_product: DataFrame | None,
    registered_after: date | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Products with their mean rating, NULL where never rated.

    Lines are reduced to a row per product before the join, so a product with
    very many lines costs no more than any other. Give their ``totals`` instead
    where these are kept (``load_ratings``).
    """
    totals = rating_totals(sale_product) if totals is None else totals
    if registered_after is not None:
        product = in_window(
            product.withColumn("registered", F.to_date("registered")), "registered", after=registered_after
        )
    return product.join(
        product_ratings(totals), F.col("product_id") == F.col("rated_id"), "left"
    ).select(F.col("product_id").alias("product_key"), "category", "subcategory", "product_name", "ratings")


def dim_location(locations: DataFrame) -> DataFrame:
    return locations.select(
        F.col("location_id").alias("location_key"), "country", "city", "state", "postal_code", "region"
    )
