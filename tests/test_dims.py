from datetime import date

import pytest
from pyspark.sql import functions as F

from frames import day, money, rows, source
from martflow.functions import dates
from martflow.functions.numbers import ratio, rounded_mean
from martflow.functions.text import repaired_postal_code
from martflow.plans import dims


def test_calendar_has_ten_years_from_the_first_order(spark):
    sales = source(
        spark, "sales", [{"sales_id": 1, "order_date": day("2019-03-05")}, {"sales_id": 2, "order_date": day("2018-02-27")}]
    )
    calendar = dims.dim_time(sales)
    assert calendar.columns == [
        "time_key", "day_of_month", "week_of_month", "month", "year", "quarter_of_year", "date",
    ]
    assert calendar.count() == 3651
    assert calendar.agg(F.min("date"), F.max("date"), F.countDistinct("time_key")).first() == (
        day("2018-02-27"), day("2028-02-25"), 3651,
    )
    assert rows(calendar.filter("time_key between 20200228 and 20200301")) == [
        (20200228, 28, 4, 2, 2020, 1, day("2020-02-28")),
        (20200229, 29, 5, 2, 2020, 1, day("2020-02-29")),
        (20200301, 1, 1, 3, 2020, 1, day("2020-03-01")),
    ]


def test_calendar_horizon_is_a_parameter(spark):
    sales = source(spark, "sales", [{"sales_id": 1, "order_date": day("2020-12-30")}])
    assert rows(dims.dim_time(sales, days=3), "time_key", "quarter_of_year") == [
        (20201230, 4), (20201231, 4), (20210101, 1),
    ]


def test_calendar_without_orders_has_no_days(spark):
    assert dims.dim_time(source(spark, "sales", [])).count() == 0


@pytest.mark.parametrize(
    "day_of_month, week", [(1, 1), (7, 1), (8, 2), (14, 2), (15, 3), (21, 3), (22, 4), (28, 4), (29, 5), (31, 5)]
)
def test_week_of_month(spark, day_of_month, week):
    d = F.lit(date(2021, 1, day_of_month))
    assert spark.range(1).select(dates.week_of_month(d)).first()[0] == week


@pytest.mark.parametrize(
    "text, week", [("2021-01-01", 53), ("2021-01-04", 1), ("2018-12-31", 1), ("2020-12-31", 53), ("2022-01-02", 52)]
)
def test_iso_week_differs_from_week_of_month(spark, text, week):
    frame = dims.calendar(spark, F.lit(day(text)), days=1)
    assert dims.calendar_iso_week(dims.time_attributes(frame)).first()["iso_week"] == week


def test_month_key_and_monday(spark):
    row = spark.range(1).select(
        dates.month_key(F.lit(20211231)),
        dates.month_key(F.lit(None).cast("int")),
        dates.week_start(F.lit(day("2024-01-21"))),
    )
    assert tuple(row.first()) == (202112, None, day("2024-01-15"))


def test_customer_window_is_strict(spark):
    customer = source(
        spark,
        "customer",
        [
            {"customer_id": 1, "name": "a", "registered": day("2020-01-01")},
            {"customer_id": 2, "name": "b", "registered": day("2020-01-02")},
            {"customer_id": 3, "name": "c"},
        ],
    )
    assert rows(dims.dim_customer(customer), "customer_key") == [(1,), (2,), (3,)]
    assert rows(dims.dim_customer(customer, day("2020-01-01")), "customer_key") == [(2,)]


def test_registered_loses_its_time_of_day(spark):
    customer = spark.sql(
        "select 1L customer_id, 'a' name, 's' segment, timestamp_ntz'2020-01-01 23:59:00' registered, 'F' sex, 1 points"
    )
    assert dims.dim_customer(customer).first()["registered"] == day("2020-01-01")
    assert dims.dim_customer(customer, day("2020-01-01")).count() == 0


def test_ratings(spark):
    product = source(
        spark, "product", [{"product_id": i, "category": "c", "registered": day(f"2020-01-0{i}")} for i in (1, 2, 3, 4)]
    )
    rated = {1: ["4.0", None, "3.0"], 2: ["4.1", "4.0", "4.0", "4.0"], 3: [None]}
    lines = source(
        spark,
        "sale_product",
        [{"sales_id": 1, "product_id": p, "ratings": r and money(r)} for p, rs in rated.items() for r in rs],
    )
    # 4.025 rounds away from zero although its double lies below it.
    assert rows(dims.dim_product(product, lines), "product_key", "ratings") == [
        (1, 3.5), (2, 4.03), (3, None), (4, None),
    ]
    assert rows(dims.dim_product(product, lines, day("2020-01-02")), "product_key") == [(3,), (4,)]


def test_ratings_of_double_type(spark):
    product = source(spark, "product", [{"product_id": 1}])
    lines = spark.createDataFrame([(1, 4.1), (1, 4.0), (1, 4.0), (1, 4.0)], "product_id long, ratings double")
    assert dims.dim_product(product, lines).first()["ratings"] == 4.03


def test_arithmetic_rules(spark):
    values = spark.range(1).select(
        ratio(F.lit(1), F.lit(0)),
        ratio(F.lit(1), F.lit(None).cast("int")),
        ratio(F.lit(1), F.lit(4)),
        rounded_mean(F.lit("-8.05").cast("decimal(18,2)"), F.lit(2)).cast("string"),
    )
    assert tuple(values.first()) == (None, None, 0.25, "-4.03")


def test_postal_code_repair(spark):
    codes = spark.createDataFrame([("8701",), ("90036",), ("",), (None,), ("ab12",), ("501",)], "c string")
    assert [r[0] for r in codes.select(repaired_postal_code(F.col("c"))).collect()] == [
        "08701", "90036", "", None, "ab12", "00501",
    ]
