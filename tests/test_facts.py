import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from frames import day, mart, moment, money, rows, source
from martflow.plans import dims, facts


@pytest.fixture(scope="module")
def calendar(spark):
    first = F.lit(day("2024-01-01"))
    return dims.time_attributes(dims.calendar(spark, first, days=31)).cache()


@pytest.fixture(scope="module")
def sales(spark):
    return source(
        spark,
        "sales",
        [
            {"sales_id": 1, "customer_id": 10, "ship_to": 100, "order_date": day("2024-01-02"), "total": money("5.00")},
            {"sales_id": 2, "customer_id": 10, "ship_to": 100, "order_date": day("2024-01-02"), "total": None},
            {"sales_id": 3, "customer_id": None, "ship_to": 100, "order_date": day("2024-01-03"), "total": money("1.00")},
            {"sales_id": 4, "customer_id": 11, "ship_to": None, "order_date": day("2024-01-03"), "total": money("1.00")},
            {"sales_id": 5, "customer_id": 12, "ship_to": 101, "order_date": day("2024-03-01"), "total": money("9.50")},
            {"sales_id": 6, "customer_id": 99, "ship_to": 101, "order_date": day("2024-01-04"), "total": money("2.00")},
        ],
    )


@pytest.fixture(scope="module")
def lines(spark):
    return source(
        spark,
        "sale_product",
        [
            {"sales_id": 1, "product_id": 7, "quantity": 2, "subtotal": money("1.10")},
            {"sales_id": 2, "product_id": 7, "quantity": 3, "subtotal": money("2.20")},
            {"sales_id": 1, "product_id": 8, "quantity": None, "subtotal": None},
            {"sales_id": 3, "product_id": 7, "quantity": 1, "subtotal": money("1.00")},
            {"sales_id": 4, "product_id": 7, "quantity": 1, "subtotal": money("1.00")},
            {"sales_id": 5, "product_id": 7, "quantity": 4, "subtotal": money("9.50")},
            {"sales_id": 1, "product_id": None, "quantity": 1, "subtotal": money("1.00")},
            {"sales_id": 77, "product_id": 7, "quantity": 6, "subtotal": money("6.00")},
        ],
    )


def test_fct_sales_drops_unknown_keys_and_orphans_and_sums_nothing_to_zero(sales, lines, calendar):
    assert rows(facts.fct_sales(sales, lines, calendar)) == [
        (10, 100, 7, 20240102, 5, money("3.30")),
        (10, 100, 8, 20240102, 0, money("0.00")),
        (12, 101, 7, None, 4, money("9.50")),  # past the calendar
    ]


def test_fct_sales_all_lines_keeps_them_as_unknown(sales, lines, calendar):
    assert rows(facts.fct_sales_all_lines(sales, lines, calendar)) == [
        (10, 100, 7, 20240102, 5, money("3.30")),
        (10, 100, 8, 20240102, None, None),
        (10, 100, None, 20240102, 1, money("1.00")),
        (11, None, 7, 20240103, 1, money("1.00")),
        (12, 101, 7, None, 4, money("9.50")),
        (None, 100, 7, 20240103, 1, money("1.00")),
        (None, None, 7, None, 6, money("6.00")),
    ]


def test_sales_with_product_is_the_all_lines_fact_rolled_up(sales, lines, calendar):
    keys = ["customer_key", "location_key", "product_key"]
    rolled = facts.fct_sales_all_lines(sales, lines, calendar).groupBy(*keys).agg(
        F.sum("quantity").alias("quantity"), F.sum("sales").cast("decimal(18,2)").alias("sales")
    )
    assert rows(facts.sales_with_product(sales, lines)) == rows(rolled)


def test_sales_windows_include_both_ends(sales, lines, calendar):
    def sold(**window):
        return rows(facts.fct_sales(sales, lines, calendar, **window), "customer_key", "product_key")

    assert sold(since=day("2024-01-02")) == [(10, 7), (10, 8), (12, 7)]
    assert sold(since=day("2024-01-03")) == [(12, 7)]
    assert sold(as_of=day("2024-01-02")) == [(10, 7), (10, 8)]
    assert sold(as_of=day("2024-01-01")) == []
    assert rows(facts.sale_product_window(lines, sales, since=day("2024-01-04")), "sales_id") == [(5,)]


def test_an_order_with_a_time_of_day_belongs_to_its_day(spark, lines, calendar):
    timed = spark.sql(
        "select 1L sales_id, 10L customer_id, 100L ship_to, timestamp_ntz'2024-01-02 18:30:00' order_date, "
        "cast(5 as decimal(18,2)) total"
    )
    assert rows(facts.fct_sales(timed, lines, calendar, as_of=day("2024-01-02")), "time_key") == [
        (20240102,), (20240102,),
    ]
    assert rows(facts.orders_by_customer_day(timed), "order_date") == [(day("2024-01-02"),)]


def test_money_of_double_type_is_summed_exactly(spark, sales, calendar):
    lines = spark.createDataFrame(
        [(1, 7, 1, 0.1)] * 3 + [(1, 7, 1, 0.2)] * 7,
        "sales_id long, product_id long, quantity int, subtotal double",
    )
    assert rows(facts.fct_sales(sales, lines, calendar), "sales") == [(money("1.70"),)]
    assert rows(facts.sales_with_product(sales, lines), "quantity", "sales") == [(10, money("1.70"))]


def test_orders_are_counted_as_rows(sales):
    assert rows(facts.orders_by_customer_day(sales)) == [
        (10, 100, day("2024-01-02"), 2, money("5.00")),
        (12, 101, day("2024-03-01"), 1, money("9.50")),
        (99, 101, day("2024-01-04"), 1, money("2.00")),
    ]


def test_visits(spark):
    web = source(
        spark,
        "web_visit",
        [
            {"customer_id": 1, "time_visit": moment("2024-01-15 00:00:00")},
            {"customer_id": 1, "time_visit": moment("2024-01-15 00:00:01")},
            {"customer_id": 2, "time_visit": moment("2024-01-14 23:59:59")},
            {"customer_id": None, "time_visit": moment("2024-01-15 00:00:00")},
        ],
    )
    assert rows(facts.visits(web)) == [(1, 2), (2, 1), (None, 0)]
    assert rows(facts.visits(web, since=day("2024-01-15"))) == [(1, 2), (None, 0)]
    assert rows(facts.visits(web, as_of=day("2024-01-15"))) == [(1, 1), (2, 1), (None, 0)]
    assert rows(facts.visits(web, as_of=moment("2024-01-15 00:00:01"))) == [(1, 2), (2, 1), (None, 0)]


def test_fct_marketing(spark, sales, calendar):
    customers = mart(spark, "dim_customer", [{"customer_key": k} for k in (10, 11, 12, 13)])
    visits = mart(spark, "visits", [{"customer_key": 10, "visits": 8}, {"customer_key": 13, "visits": 0}])
    assert rows(facts.fct_marketing(customers, sales, visits, calendar)) == [
        (10, 100, 20240102, 0.25, 2.5),
        (11, None, None, None, None),  # its only order has no location
        (12, 101, None, None, 9.5),  # order past the calendar, no visits
        (13, None, None, None, None),
    ]  # the order of customer 99 is left out


def test_a_customer_with_orders_and_zero_visits_has_no_conversion(spark, sales, calendar):
    customers = mart(spark, "dim_customer", [{"customer_key": 10}])
    visits = mart(spark, "visits", [{"customer_key": 10, "visits": 0}])
    assert rows(facts.fct_marketing(customers, sales, visits, calendar)) == [(10, 100, 20240102, None, 2.5)]


def _maybe(rng, value, missing=0.1):
    return None if rng.random() < missing else value


@pytest.mark.parametrize("seed", range(4))
def test_facts_equal_a_single_process_computation(spark, calendar, seed):
    """Brute force with pandas merges and groupings, which drop NULL keys."""
    rng = random.Random(seed)
    orders = [
        {
            "sales_id": i,
            "customer_id": _maybe(rng, rng.randrange(6)),
            "ship_to": _maybe(rng, rng.randrange(3)),
            "order_date": day(f"2024-01-{rng.randrange(1, 32):02d}"),
            "total": money(f"{rng.randrange(10000) / 100:.2f}"),
        }
        for i in range(60)
    ]
    lines = [
        {
            "sales_id": rng.randrange(70),
            "product_id": rng.randrange(4),
            "quantity": _maybe(rng, rng.randrange(9)),
            "subtotal": money(f"{rng.randrange(10000) / 100:.2f}"),
        }
        for _ in range(200)
    ]
    visits = [{"customer_key": c, "visits": rng.randrange(1, 9)} for c in range(0, 8, 2)]
    sales_df, lines_df = source(spark, "sales", orders), source(spark, "sale_product", lines)

    o, ln = pd.DataFrame(orders), pd.DataFrame(lines)
    key = o["order_date"].map(lambda d: int(d.strftime("%Y%m%d")))
    o = o.assign(time_key=key, total=o["total"].astype(float))
    ln = ln.assign(subtotal=ln["subtotal"].astype(float))
    merged = ln.merge(o, on="sales_id")
    expected = (
        merged.groupby(["customer_id", "ship_to", "product_id", "time_key"])[["quantity", "subtotal"]]
        .sum()
        .reset_index()
    )
    actual = facts.fct_sales(sales_df, lines_df, calendar)
    assert sorted((r[0], r[1], r[2], r[3], r[4], round(float(r[5]), 2)) for r in actual.collect()) == sorted(
        (int(a), int(b), int(c), int(d), int(q), round(s, 2)) for a, b, c, d, q, s in expected.itertuples(index=False)
    )

    daily = o.groupby(["customer_id", "ship_to", "time_key"]).agg(orders=("sales_id", "size"), total=("total", "sum"))
    wide = (
        pd.DataFrame({"customer_id": range(8)})
        .merge(pd.DataFrame(visits).rename(columns={"customer_key": "customer_id"}), how="left", on="customer_id")
        .merge(daily.reset_index(), how="left", on="customer_id")
    )

    def known(v):
        return None if pd.isna(v) else v

    expected = [
        (
            r.customer_id,
            known(r.ship_to),
            known(r.time_key),
            known(r.orders / r.visits),
            known(round(r.total / r.orders, 6)),
        )
        for r in wide.itertuples()
    ]
    customers = mart(spark, "dim_customer", [{"customer_key": c} for c in range(8)])
    actual = facts.fct_marketing(customers, sales_df, mart(spark, "visits", visits), calendar)
    actual = [(*r[:4], None if r[4] is None else round(r[4], 6)) for r in actual.collect()]
    order = lambda r: [(v is None, v or 0) for v in r]
    assert sorted(actual, key=order) == sorted(expected, key=order)
