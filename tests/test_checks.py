import pytest

from frames import day, mart, money, rows
from martflow.functions.text import POSTAL_CODE
from martflow.operators import checks
from martflow.schemas import FOREIGN_KEYS


@pytest.fixture(scope="module")
def tables(spark):
    """A sound mart of one row per table."""
    sale = {"customer_key": 1, "location_key": 2, "product_key": 3, "time_key": 20240101}
    return {
        "dim_time": mart(spark, "dim_time", [{"time_key": 20240101, "date": day("2024-01-01")}]),
        "dim_customer": mart(spark, "dim_customer", [{"customer_key": 1, "name": "n", "segment": "s"}]),
        "dim_location": mart(
            spark, "dim_location", [{"location_key": 2, "country": "c", "region": "r", "postal_code": "08701"}]
        ),
        "dim_product": mart(spark, "dim_product", [{"product_key": 3, "product_name": "p"}]),
        "fct_sales": mart(spark, "fct_sales", [sale | {"quantity": 1, "sales": money("1.00")}]),
        "fct_marketing": mart(
            spark, "fct_marketing", [{k: v for k, v in sale.items() if k != "product_key"} | {"conversion_rate": 0.1}]
        ),
    }


def failures(suite):
    return rows(suite.filter("not passed"), "table", "check", "column", "failed_rows")


def test_a_sound_mart_passes_everything(tables):
    suite = checks.check_suite(tables)
    assert failures(suite) == []
    assert suite.count() == 2 + 4 + 19 + 3 + 1 + 7
    assert suite.columns == ["table", "check", "column", "checked_rows", "failed_rows", "passed"]


@pytest.mark.parametrize("fk", FOREIGN_KEYS, ids=lambda fk: f"{fk.fact}.{fk.column}")
def test_each_foreign_key_is_checked(tables, fk):
    fact = tables[fk.fact]
    stray = fact.withColumn(fk.column, fact[fk.column] + 1)
    broken = tables | {fk.fact: fact.union(stray).union(stray)}
    assert (fk.fact, "foreign_key", fk.column, 2) in failures(checks.check_suite(broken))
    assert rows(checks.foreign_keys(broken).filter("orphan_rows > 0")) == [
        (fk.fact, fk.column, fk.dimension, 3, 2)
    ]


def test_unknown_keys_are_missing_not_orphaned(spark, tables):
    broken = tables | {"fct_marketing": tables["fct_marketing"].union(mart(spark, "fct_marketing", [{"customer_key": 1}]))}
    assert failures(checks.check_suite(broken)) == [
        ("fct_marketing", "missing", "location_key", 1),
        ("fct_marketing", "missing", "time_key", 1),
    ]


def test_duplicates_and_keys(spark, tables):
    broken = tables | {
        "fct_sales": tables["fct_sales"].union(tables["fct_sales"]).union(tables["fct_sales"]),
        "dim_product": tables["dim_product"].union(
            mart(spark, "dim_product", [{"product_key": 3, "product_name": "q"}, {"product_name": "r"}])
        ),
    }
    assert failures(checks.check_suite(broken)) == [
        ("dim_product", "missing", "product_key", 1),
        ("dim_product", "unique", "product_key", 2),
        ("fct_sales", "duplicates", "*", 2),
    ]
    assert rows(checks.key_violations(broken["dim_product"], "product_key")) == [(3, 2), (None, 1)]
    assert rows(checks.duplicate_rows(broken["fct_sales"]), "customer_key", "copies") == [(1, 3)]


def test_an_empty_mart_passes(spark, tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert failures(checks.check_suite(empty)) == []


def test_format(spark, tables):
    codes = ["08701", "8701", "ABCDE", "123456", None]
    broken = mart(
        spark,
        "dim_location",
        [{"location_key": i, "country": "c", "region": "r", "postal_code": c} for i, c in enumerate(codes)],
    )
    suite = checks.check_suite(tables | {"dim_location": broken})
    assert ("dim_location", "format", "postal_code", 3) in failures(suite)
    assert rows(checks.misformatted_rows(broken, "postal_code", "^[0-9]{5}$"), "location_key") == [(1,), (2,), (4 - 1,)]


def test_missing_values_in_one_pass(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (None, None)], "a int, b string")
    assert rows(checks.missing_values(df)) == [("a", 3, 1), ("b", 3, 2)]


def test_completeness(spark, tables):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    children = spark.createDataFrame([(1,), (1,), (None,)], "parent int")
    assert rows(checks.parents_without_children(parents, "id", children, "parent")) == [(2,), (3,)]

    days = mart(spark, "dim_time", [{"time_key": k, "date": day(d)} for k, d in [(1, "2024-02-27"), (2, "2024-03-01")]])
    assert rows(checks.calendar_gaps(days)) == [(day("2024-02-28"),), (day("2024-02-29"),)]
    assert ("dim_time", "complete", "date", 2) in failures(checks.check_suite(tables | {"dim_time": days}))


def test_reconciliation(spark):
    before = spark.createDataFrame([(1, 2.0), (2, 3.0)], "q int, s double")
    after = spark.createDataFrame([(3, 4.0)], "quantity int, sales double")
    assert rows(checks.reconciliation(before, after, {"q": "quantity", "s": "sales"})) == [
        ("quantity", 3.0, 3.0, 0.0),
        ("sales", 5.0, 4.0, -1.0),
    ]


def test_orphan_keys(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,)], "c int")
    dim = spark.createDataFrame([(1,)], "k int")
    assert rows(checks.orphan_keys(fact, "c", dim, "k")) == [(2, 2)]


def test_reconciliation_is_exact_for_large_totals(spark):
    lines = spark.sql("select cast(9.1e15 as decimal(18,2)) subtotal union all select cast(0.01 as decimal(18,2))")
    sales = spark.sql("select cast(9.1e15 as decimal(18,2)) sales")
    (row,) = checks.reconciliation(lines, sales, {"subtotal": "sales"}).collect()
    assert row["difference"] == -0.01


def test_postal_codes_end_with_their_digits(spark):
    codes = spark.createDataFrame([("12345",), ("12345\n",), ("1234",)], "code string")
    assert checks.misformatted_rows(codes, "code", POSTAL_CODE).count() == 2
