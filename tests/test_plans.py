"""Physical plans: what reaches the scan, what is shuffled, what is broadcast."""

import re

import pytest

from frames import day
from martflow.operators.upsert import scd1_changes
from martflow.plans import dims, facts
from martflow.registry.queries import QUERIES
from martflow.sources.model import catalog_source
from martflow.sources.testtables import retail_source

SF = "/root/testdata/sf0.001"

WRITING = {
    "fact_append_sales", "fact_append_marketing", "fact_replace_window", "csv_round_trip", "bulk_load",
    "indexed_csv_visits", "read_or_build", "check_fk", "check_suite",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_size_broadcast(spark):
    """Plans as for tables too large to broadcast; the calendar stays small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "65536")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("PythonUDF", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text, word


def test_scans_read_only_the_columns_needed(spark):
    source = retail_source(spark, SF)
    fact = facts.fct_sales(source.sales, source.sale_product, dims.dim_time(source.sales))
    schemas = set(re.findall(r"ReadSchema: struct<(.*?)>", plan(fact)))
    assert "l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double" in schemas
    assert not any("l_discount" in s or "l_linenumber" in s or "c_name" in s for s in schemas)
    assert set(re.findall(r"ReadSchema: struct<(.*?)>", plan(dims.dim_product(source.product, source.sale_product)))) == {
        "p_partkey:bigint,p_name:string,p_brand:string,p_type:string",
        "l_partkey:bigint,l_discount:double",
    }


def test_windows_reach_the_scan(spark):
    source = retail_source(spark, SF)
    text = plan(facts.sales_window(source.sales, since=day("1998-01-01")))
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in text
    text = plan(facts.sales_window(source.sales, as_of=day("1999-01-01")))
    assert "LessThan(o_orderdate,1999-01-02T00:00)" in text
    text = plan(facts.visits(source.web_visit, since=day("2024-01-15")))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in text


def test_first_day_needs_one_column_and_no_join(spark):
    text = plan(dims.dim_time(retail_source(spark, SF).sales))
    assert "Join" not in text
    assert set(re.findall(r"ReadSchema: struct<(.*?)>", text)) == {"o_orderdate:timestamp_ntz"}


def test_calendar_is_broadcast_by_its_known_size(spark, no_size_broadcast):
    source = retail_source(spark, SF)
    sales = source.sales.drop("ship_to").withColumn("ship_to", source.sales.customer_id)
    fact = plan(facts.fct_sales(sales, source.sale_product, dims.dim_time(sales)))
    assert "BroadcastHashJoin [order_date" in fact
    long = plan(facts.fct_sales(sales, source.sale_product, dims.dim_time(sales, days=100000)))
    assert "SortMergeJoin [order_date" in long


def test_ratings_are_folded_before_the_join(spark, no_size_broadcast):
    source = retail_source(spark, SF)
    text = plan(dims.dim_product(source.product, source.sale_product))
    assert text.index("Join") < text.index("HashAggregate(keys=[product_id") < text.index("partial_sum")


def test_an_upsert_shuffles_each_side_once(spark, no_size_broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    customers = spark.range(10).selectExpr("id as k", "id as v")
    merged = scd1_changes(customers, customers, "k")
    assert "FullOuter" in plan(merged)
    assert plan(merged).count("Exchange hashpartitioning(k#") == 2
    assert "SortAggregate(key=[k" not in plan(merged)
    merged.collect()
    assert "ReusedSubquery" in plan(merged)  # the keys are checked once


def test_bucketed_source_tables_join_without_a_shuffle(spark, tmp_path):
    source = retail_source(spark, SF)
    spark.sql(f"CREATE DATABASE shop LOCATION '{tmp_path}/shop'")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("sales", "sale_product", "customer", "product", "locations", "web_visit"):
            writer = getattr(source, name).write
            if name in ("sales", "sale_product"):
                writer = writer.bucketBy(8, "sales_id").sortBy("sales_id")
            writer.saveAsTable(f"shop.{name}")
        shop = catalog_source(spark, "shop")
        totals = facts.sales_with_product(shop.sales, shop.sale_product)
        assert plan(totals).count("Exchange") == 1  # the grouping alone
        assert totals.count() == facts.sales_with_product(source.sales, source.sale_product).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE shop CASCADE")
