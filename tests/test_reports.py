from frames import day, mart, moment, money, rows, source
from martflow.plans import reports


def sale(customer, location, quantity, amount):
    return {"customer_key": customer, "location_key": location, "quantity": quantity, "sales": money(amount)}


def test_sales_reports_keep_rows_without_a_dimension(spark):
    sold = [sale(1, 1, 1, "1.00"), sale(1, 2, 2, "2.00"), sale(2, 2, 3, "4.00"), sale(9, 9, 4, "8.00")]
    fact = mart(spark, "fct_sales", sold)
    places = mart(
        spark,
        "dim_location",
        [{"location_key": 1, "region": "West", "state": "A"}, {"location_key": 2, "region": "West", "state": "B"}],
    )
    people = mart(spark, "dim_customer", [{"customer_key": 1, "segment": "S"}, {"customer_key": 2, "segment": "S"}])
    assert rows(reports.sales_by_location(fact, places)) == [
        ("West", 6, money("7.00")), (None, 4, money("8.00")),
    ]
    assert rows(reports.sales_by_location(fact, places, by=("region", "state")), "state", "quantity") == [
        ("A", 1), ("B", 5), (None, 4),
    ]
    assert rows(reports.sales_by_segment(fact, people)) == [
        ("S", 2, 6, money("7.00")), (None, 1, 4, money("8.00")),
    ]


def test_customers_by_sex(spark):
    people = mart(spark, "dim_customer", [{"customer_key": i, "sex": s} for i, s in enumerate(["F", "M", "F", None])])
    assert rows(reports.customers_by_sex(people)) == [("F", 2), ("M", 1), (None, 1)]


def test_retention_by_weekly_cohort(spark):
    seen = [
        (1, "2024-01-01 00:00:00"),  # a Monday
        (1, "2024-01-07 23:59:59"),  # same week
        (1, "2024-01-08 00:00:00"),
        (2, "2024-01-03 10:00:00"),
        (2, "2024-01-17 10:00:00"),
        (3, "2024-01-10 10:00:00"),  # second cohort
        (None, "2024-01-01 00:00:00"),
    ]
    web = source(spark, "web_visit", [{"customer_id": c, "time_visit": moment(t)} for c, t in seen])
    assert rows(reports.visit_retention(web)) == [
        (day("2024-01-01"), 0, 2, 1.0),
        (day("2024-01-01"), 1, 1, 0.5),
        (day("2024-01-01"), 2, 1, 0.5),
        (day("2024-01-08"), 0, 1, 1.0),
    ]
