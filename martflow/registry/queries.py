"""One named query per operator or plan, each a function of (session, table folder).

Every query reads whole tables. Money is exact inside the library and shown as
double here, so that results compare with other engines. Queries about writing
leave their tables in the scratch folder, because their result reads from it.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.functions.dates import iso_week
from martflow.operators import checks, daily, differences, repairs
from martflow.operators.tables import (
    append_fact,
    month_start,
    publish,
    read_current,
    read_dimension,
    read_fact,
    replace_window,
    upsert_dimension,
)
from martflow.operators.upsert import scd1_changes, scd1_counts
from martflow.operators.windows import in_window
from martflow.plans import dims, facts, reports
from martflow.plans.mart import AuditFailed, build_mart, load_mart, mart_tables, staged_tables
from martflow.schemas import MART_TABLES, SOURCE_TABLES, VISITS, conform
from martflow.session import scratch_dir
from martflow.sources.cache import read_or_build
from martflow.sources.csv import bulk_load, read_csv, read_indexed_csv, write_csv
from martflow.sources.model import StoredSource
from martflow.sources.testtables import open_table, retail_source

Query = Callable[[SparkSession, str], DataFrame]

# Window bounds used by the queries and their SQL.
SALES_DAY = date(1998, 1, 1)
SALES_DAY_BEFORE = date(1997, 12, 31)
VISIT_DAY = date(2024, 1, 15)
VISIT_NOON = datetime(2024, 1, 20, 12)
REGISTERED_AFTER = date(1995, 6, 30)
SNAPSHOT_DAY = date(1995, 12, 31)
PRODUCT_AFTER = date(1995, 2, 15)
PRODUCT_SNAPSHOT = date(1995, 3, 31)
REPLACED_FROM = date(2000, 6, 15)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function's name, less a closing underscore."""
    QUERIES[function.__name__.removesuffix("_")] = function
    return function


def _shown(df: DataFrame, *money: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in money})


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/martflow/{name}-{uuid4().hex}"


# --- dimensions ---------------------------------------------------------------


@query
def dim_time(spark, sf_dir):
    return dims.dim_time(retail_source(spark, sf_dir).sales)


@query
def calendar_iso_week(spark, sf_dir):
    return dims.calendar_iso_week(dim_time(spark, sf_dir))


@query
def dim_customer(spark, sf_dir):
    return dims.dim_customer(retail_source(spark, sf_dir).customer)


@query
def dim_customer_since(spark, sf_dir):
    return dims.dim_customer(retail_source(spark, sf_dir).customer, REGISTERED_AFTER)


@query
def dim_product(spark, sf_dir):
    source = retail_source(spark, sf_dir)
    return dims.dim_product(source.product, source.sale_product)


@query
def dim_product_incremental(spark, sf_dir):
    """Ratings from totals kept by month: two windows, one of them loaded twice, and the last months corrected twice."""
    source, store = retail_source(spark, sf_dir), _scratch(spark, "ratings")
    since = month_start(REPLACED_FROM)
    days = source.sales.select("sales_id", "order_date")
    wrong = F.when(F.col("order_date") >= F.lit(since), F.lit(1)).otherwise(F.col("ratings"))
    early = source.sale_product.join(days, "sales_id", "left").withColumn("ratings", wrong).drop("order_date")
    dims.load_ratings(store, early, source.sales, as_of=SALES_DAY_BEFORE)
    for _ in range(2):
        dims.load_ratings(store, early, source.sales, since=SALES_DAY)
    for _ in range(2):
        totals = dims.load_ratings(store, source.sale_product, source.sales, since=since, replace=True)
    return dims.dim_product(source.product, None, totals=totals)


@query
def dim_product_since(spark, sf_dir):
    source = retail_source(spark, sf_dir)
    return dims.dim_product(source.product, source.sale_product, PRODUCT_AFTER)


@query
def dim_location(spark, sf_dir):
    return dims.dim_location(retail_source(spark, sf_dir).locations)


# --- source scans -------------------------------------------------------------


@query
def sales_scan(spark, sf_dir):
    return _shown(retail_source(spark, sf_dir).sales, "total")


@query
def sale_product_scan(spark, sf_dir):
    return _shown(retail_source(spark, sf_dir).sale_product, "subtotal", "ratings")


@query
def sale_product_since(spark, sf_dir):
    source = retail_source(spark, sf_dir)
    lines = facts.sale_product_window(source.sale_product, source.sales, since=SALES_DAY)
    return _shown(lines, "subtotal", "ratings")


# --- facts --------------------------------------------------------------------


def _fct_sales(spark, sf_dir, **window) -> DataFrame:
    source = retail_source(spark, sf_dir)
    return facts.fct_sales(source.sales, source.sale_product, dims.dim_time(source.sales), **window)


def _fct_marketing(spark, sf_dir, all_sales: bool = False, **window) -> DataFrame:
    source = retail_source(spark, sf_dir)
    return facts.fct_marketing(
        dims.dim_customer(source.customer),
        facts.sales_window(source.sales, **window),
        facts.visits(source.web_visit),
        dims.dim_time(source.sales),
        all_sales=source.sales if all_sales else None,
    )


@query
def fct_sales(spark, sf_dir):
    return _shown(_fct_sales(spark, sf_dir), "sales")


@query
def fct_sales_since(spark, sf_dir):
    return _shown(_fct_sales(spark, sf_dir, since=SALES_DAY), "sales")


@query
def fct_sales_as_of(spark, sf_dir):
    return _shown(_fct_sales(spark, sf_dir, as_of=SALES_DAY), "sales")


@query
def fct_sales_sql(spark, sf_dir):
    source = retail_source(spark, sf_dir)
    return _shown(
        facts.fct_sales_all_lines(source.sales, source.sale_product, dims.dim_time(source.sales)), "sales"
    )


@query
def sales_with_product(spark, sf_dir):
    source = retail_source(spark, sf_dir)
    return _shown(facts.sales_with_product(source.sales, source.sale_product), "sales")


@query
def visits(spark, sf_dir):
    return facts.visits(retail_source(spark, sf_dir).web_visit)


@query
def visits_since(spark, sf_dir):
    return facts.visits(retail_source(spark, sf_dir).web_visit, since=VISIT_DAY)


@query
def visits_as_of(spark, sf_dir):
    return facts.visits(retail_source(spark, sf_dir).web_visit, as_of=VISIT_DAY)


@query
def visits_from_days(spark, sf_dir):
    """Visits of a window from counts kept by day, of which two earlier windows had counted some."""
    web_visit, store = retail_source(spark, sf_dir).web_visit, _scratch(spark, "visits")
    daily.visits_from_days(web_visit, store, since=VISIT_DAY, as_of=VISIT_DAY + timedelta(days=3))
    daily.visits_from_days(web_visit, store, since=VISIT_DAY + timedelta(days=7), as_of=VISIT_DAY + timedelta(days=9))
    return daily.visits_from_days(web_visit, store, since=VISIT_DAY)


@query
def visits_from_days_as_of(spark, sf_dir):
    """A window that ends inside a day, after one that had counted all days before."""
    web_visit, store = retail_source(spark, sf_dir).web_visit, _scratch(spark, "visits")
    daily.visits_from_days(web_visit, store, as_of=VISIT_DAY)
    return daily.visits_from_days(web_visit, store, as_of=VISIT_NOON)


@query
def orders_by_customer_day(spark, sf_dir):
    return _shown(facts.orders_by_customer_day(retail_source(spark, sf_dir).sales), "total")


@query
def fct_marketing(spark, sf_dir):
    return _fct_marketing(spark, sf_dir)


@query
def fct_marketing_since(spark, sf_dir):
    return _fct_marketing(spark, sf_dir, since=SALES_DAY)


# --- upserts --------------------------------------------------------------------
# The target is the dimension as it stood on an earlier day, the source a later
# incremental extract with changed and blanked values. The two overlap.


def _customer_snapshot(customer: DataFrame) -> DataFrame:
    return in_window(dims.dim_customer(customer), "registered", as_of=SNAPSHOT_DAY)


def _customer_extract(customer: DataFrame) -> DataFrame:
    return dims.dim_customer(customer, REGISTERED_AFTER).withColumns(
        {
            "name": F.upper("name"),
            "segment": F.nullif("segment", F.lit("BUILDING")),
            "points": F.col("points") + 100,
        }
    )


def _customer_change(spark, sf_dir) -> DataFrame:
    customer = retail_source(spark, sf_dir).customer
    return scd1_changes(_customer_snapshot(customer), _customer_extract(customer), "customer_key")


def _product_change(spark, sf_dir) -> DataFrame:
    source = retail_source(spark, sf_dir)
    known = in_window(source.product, "registered", as_of=PRODUCT_SNAPSHOT)
    target = dims.dim_product(known, source.sale_product)
    changed = dims.dim_product(source.product, source.sale_product, PRODUCT_AFTER).withColumns(
        {
            "product_name": F.upper("product_name"),
            "ratings": F.when(F.col("category") != "ECONOMY", F.col("ratings")),
        }
    )
    return scd1_changes(target, changed, "product_key")


def _location_change(spark, sf_dir) -> DataFrame:
    locations = dims.dim_location(retail_source(spark, sf_dir).locations)
    target = locations.filter(F.col("region") != "ASIA")
    source = locations.filter(F.col("region") != "AFRICA").withColumns(
        {"country": F.lower("country"), "region": F.nullif("region", F.lit("EUROPE"))}
    )
    return scd1_changes(target, source, "location_key")


def _time_change(spark, sf_dir) -> DataFrame:
    """The calendar rolled forward to start at the last order, with ISO weeks."""
    sales = retail_source(spark, sf_dir).sales
    last_order = sales.agg(F.max("order_date")).scalar()
    source = dims.time_attributes(dims.calendar(spark, last_order)).withColumn(
        "week_of_month", iso_week(F.col("date"))
    )
    return scd1_changes(dims.dim_time(sales), source, "time_key")


CHANGES: dict[str, Query] = {
    "dim_customer": _customer_change,
    "dim_product": _product_change,
    "dim_location": _location_change,
    "dim_time": _time_change,
}


@query
def scd1_customer(spark, sf_dir):
    return _customer_change(spark, sf_dir)


@query
def scd1_product(spark, sf_dir):
    return _product_change(spark, sf_dir)


@query
def scd1_location(spark, sf_dir):
    return _location_change(spark, sf_dir)


@query
def scd1_time(spark, sf_dir):
    return _time_change(spark, sf_dir)


@query
def scd1_counts_(spark, sf_dir):
    return checks.union_all(
        [
            scd1_counts(change(spark, sf_dir)).select(
                F.lit(name).alias("dimension"), "updated_count", "inserted_count", "kept_count"
            )
            for name, change in CHANGES.items()
        ]
    )


# --- writes -----------------------------------------------------------------------


@query
def fact_append_sales(spark, sf_dir):
    """The whole fact, appended in two windows that meet between two days."""
    path = _scratch(spark, "fct_sales")
    append_fact(_fct_sales(spark, sf_dir, as_of=SALES_DAY_BEFORE), path, "fct_sales")
    append_fact(_fct_sales(spark, sf_dir, since=SALES_DAY), path, "fct_sales")
    return _shown(read_fact(spark, path, "fct_sales"), "sales")


@query
def fact_append_marketing(spark, sf_dir):
    path = _scratch(spark, "fct_marketing")
    append_fact(_fct_marketing(spark, sf_dir, as_of=SALES_DAY_BEFORE), path, "fct_marketing")
    append_fact(_fct_marketing(spark, sf_dir, since=SALES_DAY), path, "fct_marketing")
    return read_fact(spark, path, "fct_marketing")


@query
def fact_replace_window(spark, sf_dir):
    """The whole fact after its last months were loaded again, twice."""
    path = _scratch(spark, "fct_sales")
    append_fact(_fct_sales(spark, sf_dir), path, "fct_sales")
    since = month_start(REPLACED_FROM)
    for _ in range(2):
        replace_window(_fct_sales(spark, sf_dir, since=since), path, "fct_sales", since)
    return _shown(read_fact(spark, path, "fct_sales"), "sales")


@query
def fact_replace_marketing(spark, sf_dir):
    """The whole fact after its last months were loaded again, twice."""
    path = _scratch(spark, "fct_marketing")
    append_fact(_fct_marketing(spark, sf_dir), path, "fct_marketing")
    since = month_start(REPLACED_FROM)
    for _ in range(2):
        replace_window(_fct_marketing(spark, sf_dir, all_sales=True, since=since), path, "fct_marketing", since)
    return read_fact(spark, path, "fct_marketing")


@query
def upsert_customer(spark, sf_dir):
    """A later extract with changed values, stored and merged into a published dimension."""
    mart, extract = _scratch(spark, "mart"), _scratch(spark, "extract")
    customer = retail_source(spark, sf_dir).customer
    publish(conform(_customer_snapshot(customer), MART_TABLES["dim_customer"]), f"{mart}/dim_customer")
    publish(_customer_extract(customer), extract)
    upsert_dimension(spark, mart, "dim_customer", read_current(spark, extract, MART_TABLES["dim_customer"]))
    return read_dimension(spark, mart, "dim_customer")


@query
def load_mart_(spark, sf_dir):
    """Rows and totals of all six tables after a full run, its load, and a weekly window."""
    source, staging, mart = retail_source(spark, sf_dir), _scratch(spark, "staging"), _scratch(spark, "mart")
    build_mart(source, staging)
    load_mart(spark, staging, mart)
    build_mart(source, staging, since=month_start(REPLACED_FROM), to_replace=True)
    load_mart(spark, staging, mart, replace_since=REPLACED_FROM)
    tables = mart_tables(spark, mart)
    totals = {
        "dim_time": F.sum("time_key"),
        "dim_customer": F.sum("points"),
        "dim_product": F.sum("product_key"),
        "dim_location": F.sum("location_key"),
        "fct_sales": F.sum("sales"),
        "fct_marketing": F.count("conversion_rate"),
    }
    return checks.union_all(
        [
            tables[name].agg(
                F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"), total.cast("double").alias("total")
            )
            for name, total in totals.items()
        ]
    )


@query
def load_mart_audited(spark, sf_dir):
    """What the audit of a window with unknown customers finds, and the facts that it leaves as they were."""
    source, staging, mart = retail_source(spark, sf_dir), _scratch(spark, "staging"), _scratch(spark, "mart")
    build_mart(source, staging)
    load_mart(spark, staging, mart)
    unknown = F.when(F.col("sales_id") % 100 == 0, -F.col("customer_id") - 1).otherwise(F.col("customer_id"))
    tables = {name: getattr(source, name) for name in SOURCE_TABLES}
    planted = StoredSource(**{**tables, "sales": source.sales.withColumn("customer_id", unknown)})
    build_mart(planted, staging, since=month_start(REPLACED_FROM), to_replace=True)
    try:
        load_mart(spark, staging, mart, replace_since=REPLACED_FROM)
    except AuditFailed as refused:
        found = spark.createDataFrame(refused.findings)
    else:
        raise AssertionError("unknown customers were published")
    kept = read_fact(spark, f"{mart}/fct_sales", "fct_sales").agg(
        F.lit("fct_sales").alias("table"),
        F.lit("rows").alias("check"),
        F.lit("sales").alias("column"),
        F.count(F.lit(1)).alias("checked_rows"),
        F.count_if(F.col("customer_key") < 0).alias("failed_rows"),
        F.sum("sales").cast("double").alias("total"),
    )
    return kept.unionByName(found.drop("passed").withColumn("total", F.lit(None).cast("double")))


@query
def handoff_sales(spark, sf_dir):
    """The sales fact from files that call the sales ``subtotal`` and write keys with a fraction."""
    path = _scratch(spark, "fct_sales_handoff")
    written = _fct_sales(spark, sf_dir).withColumnRenamed("sales", "subtotal")
    keys = {c: F.col(c).cast("decimal(20,1)") for c in ("location_key", "time_key")}
    write_csv(written.withColumns(keys), path, key="product_key")
    loaded = bulk_load(spark, path, MART_TABLES["fct_sales"], rename={"subtotal": "sales"})
    return _shown(loaded, "sales")


@query
def csv_round_trip(spark, sf_dir):
    path = _scratch(spark, "fct_sales_csv")
    write_csv(_fct_sales(spark, sf_dir), path, key="customer_key")
    return _shown(read_csv(spark, path, MART_TABLES["fct_sales"]), "sales")


@query
def bulk_load_(spark, sf_dir):
    """Files whose columns come in another order, with many empty fields."""
    path = _scratch(spark, "fct_marketing_csv")
    write_csv(_fct_marketing(spark, sf_dir), path, key="time_key")
    return bulk_load(spark, path, MART_TABLES["fct_marketing"])


@query
def indexed_csv_visits(spark, sf_dir):
    """Files with an unnamed row-number column in front."""
    path = _scratch(spark, "customer_visit_csv")
    counted = visits(spark, sf_dir)
    write_csv(counted.select(F.monotonically_increasing_id().alias(""), *counted.columns), path)
    return read_indexed_csv(spark, path, VISITS)


@query
def read_or_build_(spark, sf_dir):
    """The second call reads what the first one stored."""
    path = _scratch(spark, "customer_visit")
    read_or_build(spark, path, lambda: visits(spark, sf_dir), VISITS)

    def not_again() -> DataFrame:
        raise AssertionError("the store was not used")

    return read_or_build(spark, path, not_again, VISITS)


# --- checks -----------------------------------------------------------------------


@query
def check_duplicates(spark, sf_dir):
    """Order lines that agree in order, product and quantity."""
    lines = retail_source(spark, sf_dir).sale_product
    return checks.duplicate_rows(lines, ["sales_id", "product_id", "quantity"])


@query
def check_unique(spark, sf_dir):
    return checks.key_violations(open_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def check_missing(spark, sf_dir):
    return checks.missing_values(_fct_marketing(spark, sf_dir))


@query
def check_format(spark, sf_dir):
    return checks.format_violations(
        dim_product(spark, sf_dir), {"subcategory": "^Brand#[0-9]{2}$", "product_name": "^[a-z]+ [a-z]+$"}
    )


@query
def check_format_rows(spark, sf_dir):
    return checks.misformatted_rows(dim_product(spark, sf_dir), "subcategory", "^Brand#[0-9]{2}$")


@query
def check_completeness(spark, sf_dir):
    """Orders without lines, and customers who never visited."""
    orders, lineitem, customer, events = (
        open_table(spark, sf_dir, name) for name in ("orders", "lineitem", "customer", "events")
    )
    no_lines = checks.parents_without_children(orders, "o_orderkey", lineitem, "l_orderkey")
    no_visit = checks.parents_without_children(customer, "c_custkey", events, "user_id")
    return no_lines.select(F.lit("order without lines").alias("finding"), F.col("o_orderkey").alias("key")).union(
        no_visit.select(F.lit("customer without visits"), "c_custkey")
    )


@query
def check_reconciliation(spark, sf_dir):
    """Totals of the fact against the lines, and the rows each day had against those the fact has."""
    lines = retail_source(spark, sf_dir).sale_product
    totals = checks.reconciliation(lines, _fct_sales(spark, sf_dir), {"quantity": "quantity", "subtotal": "sales"})
    path = _scratch(spark, "fct_sales")
    append_fact(_fct_sales(spark, sf_dir), path, "fct_sales")
    built = _fct_sales(spark, sf_dir).withColumn("one", F.lit(1))
    stored = read_fact(spark, path, "fct_sales").withColumn("rows", F.lit(1))
    return totals.unionByName(checks.reconciliation(built, stored, {"one": "rows"}))


@query
def check_calendar(spark, sf_dir):
    """Days without an order between the first and the last one."""
    ordered = retail_source(spark, sf_dir).sales.select(F.col("order_date").alias("date")).distinct()
    return checks.calendar_gaps(ordered)


def _staged_mart(spark, sf_dir) -> dict[str, DataFrame]:
    """All mart tables, written once: the checks scan each of them several times."""
    staging = _scratch(spark, "staging")
    build_mart(retail_source(spark, sf_dir), staging)
    return staged_tables(spark, staging)


@query
def check_fk(spark, sf_dir):
    return checks.foreign_keys(_staged_mart(spark, sf_dir))


@query
def check_fk_orphans(spark, sf_dir):
    """Customers of the sales fact that an older customer dimension lacks."""
    older = in_window(dim_customer(spark, sf_dir), "registered", as_of=SNAPSHOT_DAY)
    return checks.orphan_keys(_fct_sales(spark, sf_dir), "customer_key", older, "customer_key")


@query
def check_suite(spark, sf_dir):
    lines = retail_source(spark, sf_dir).sale_product
    return checks.check_suite(_staged_mart(spark, sf_dir), lines=lines)


@query
def check_difference(spark, sf_dir):
    """What a copy of the sales fact has lost, doubled and changed, found by comparing checksums."""
    path, copy = _scratch(spark, "fct_sales"), _scratch(spark, "fct_sales")
    append_fact(_fct_sales(spark, sf_dir), path, "fct_sales")
    expected = read_fact(spark, path, "fct_sales")
    kind = F.col("customer_key") % 97
    changed = F.when(kind == 2, F.col("quantity") + 1).otherwise(F.col("quantity"))
    copies = F.explode(F.when(kind == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    planted = expected.filter(kind != 0).select("*", copies.alias("n")).drop("n").withColumn("quantity", changed)
    append_fact(planted, copy, "fct_sales")
    return differences.table_differences(
        expected,
        read_fact(spark, copy, "fct_sales"),
        ["customer_key", "location_key", "product_key", "time_key"],
        F.floor(F.col("time_key") / 100),
        _scratch(spark, "checksums"),
    )


def _judged_places(spark, sf_dir) -> repairs.Repaired:
    """A place for each customer: postal codes from keys, some without leading zeros, some no codes at all."""
    people, nations = open_table(spark, sf_dir, "customer"), dim_location(spark, sf_dir)
    key = F.col("c_custkey")
    digits = (key * 7919 % 100000).cast("string")
    places = people.join(nations, F.col("c_nationkey") == F.col("location_key"), "left").select(
        key.alias("location_key"),
        F.when(key % 50 != 9, F.col("country")).alias("country"),
        "city",
        "state",
        F.when(key % 50 == 7, F.concat(digits, F.lit("x")))
        .when(key % 50 == 8, F.lit(""))
        .when(key % 50 != 10, F.concat(F.lit(" "), digits))
        .alias("postal_code"),
        "region",
    )
    return repairs.split(conform(places, MART_TABLES["dim_location"]), repairs.LOCATION_RULES, _scratch(spark, "places"))


@query
def dim_location_repaired(spark, sf_dir):
    return _judged_places(spark, sf_dir).accepted


@query
def dim_location_rejected(spark, sf_dir):
    """Rejected rows by the rules they fail, and the rows that each rule repaired."""
    judged = _judged_places(spark, sf_dir)
    rejected = judged.rejected.select(F.lit("failed").alias("outcome"), F.explode("failed_rules").alias("rule"))
    counted = rejected.groupBy("outcome", "rule").agg(F.count(F.lit(1)).alias("rows"))
    repaired = [("repaired", rule, rows) for rule, rows in judged.repaired.items()]
    return counted.unionByName(spark.createDataFrame(repaired, "outcome string, rule string, rows long"))


# --- reports ------------------------------------------------------------------------


@query
def report_sales_by_region(spark, sf_dir):
    locations = dim_location(spark, sf_dir)
    return _shown(reports.sales_by_location(_fct_sales(spark, sf_dir), locations), "sales")


@query
def report_sales_by_country(spark, sf_dir):
    locations = dim_location(spark, sf_dir)
    return _shown(
        reports.sales_by_location(_fct_sales(spark, sf_dir), locations, by=("region", "country")), "sales"
    )


@query
def report_sales_by_segment(spark, sf_dir):
    return _shown(reports.sales_by_segment(_fct_sales(spark, sf_dir), dim_customer(spark, sf_dir)), "sales")


@query
def report_customers_by_sex(spark, sf_dir):
    """The test tables tell nobody's sex: one unknown group."""
    return reports.customers_by_sex(dim_customer(spark, sf_dir))


@query
def report_retention(spark, sf_dir):
    return reports.visit_retention(retail_source(spark, sf_dir).web_visit)
