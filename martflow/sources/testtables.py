"""Adapter from the bundled order-processing test tables to ``RetailSource``.

Stand-ins for columns the test tables lack: an order ships to its customer's
nation; a customer registers with the first order, a product with the first
shipment; a rating is fifty times the line discount (0 to 5). Sex, city, state
and postal code are unknown. Visits are the rows of the event table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.schemas import SOURCE_TABLES, conform
from martflow.sources.model import RetailSource

# Columns used here, so that opening a table needs no schema inference job.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint",
}


def open_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


class TestTables:
    """A ``RetailSource`` over the test tables; each frame is put together on first use."""

    __test__ = False  # not a test class

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir

    def _open(self, name: str) -> DataFrame:
        return open_table(self._spark, self._sf_dir, name)

    # Left joins below: a row without its parent keeps an unknown value, and
    # Spark drops the join where no column of the parent is used.

    @cached_property
    def sales(self) -> DataFrame:
        nations = self._open("customer").select("c_custkey", F.col("c_nationkey").alias("ship_to"))
        orders = self._open("orders").select(
            F.col("o_orderkey").alias("sales_id"),
            F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("o_totalprice").alias("total"),
        )
        joined = orders.join(nations, F.col("customer_id") == F.col("c_custkey"), "left")
        return conform(joined, SOURCE_TABLES["sales"])

    @cached_property
    def sale_product(self) -> DataFrame:
        lines = self._open("lineitem").select(
            F.col("l_orderkey").alias("sales_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("subtotal"),
            F.round(F.col("l_discount") * 50, 1).alias("ratings"),
        )
        return conform(lines, SOURCE_TABLES["sale_product"])

    @cached_property
    def customer(self) -> DataFrame:
        first_order = (
            self._open("orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("registered"))
        )
        people = self._open("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.lit(None).alias("sex"),
            F.floor("c_acctbal").alias("points"),
        )
        joined = people.join(first_order, F.col("customer_id") == F.col("o_custkey"), "left")
        return conform(joined, SOURCE_TABLES["customer"])

    @cached_property
    def product(self) -> DataFrame:
        first_shipment = (
            self._open("lineitem").groupBy("l_partkey").agg(F.to_date(F.min("l_shipdate")).alias("registered"))
        )
        parts = self._open("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            F.col("p_name").alias("product_name"),
        )
        joined = parts.join(first_shipment, F.col("product_id") == F.col("l_partkey"), "left")
        return conform(joined, SOURCE_TABLES["product"])

    @cached_property
    def locations(self) -> DataFrame:
        unknown = [F.lit(None).alias(name) for name in ("city", "state", "postal_code")]
        nations = self._open("nation").join(
            self._open("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
        )
        places = nations.select(
            F.col("n_nationkey").alias("location_id"),
            F.col("n_name").alias("country"),
            F.col("r_name").alias("region"),
            *unknown,
        )
        return conform(places, SOURCE_TABLES["locations"])

    @cached_property
    def web_visit(self) -> DataFrame:
        visits = self._open("events").select(F.col("user_id").alias("customer_id"), F.col("ts").alias("time_visit"))
        return conform(visits, SOURCE_TABLES["web_visit"])


def retail_source(spark: SparkSession, sf_dir: str) -> RetailSource:
    return TestTables(spark, sf_dir)
