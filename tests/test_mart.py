"""Both runs end to end on the small test tables."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F

from frames import rows
from martflow.operators import checks, versions
from martflow.operators.repairs import LOCATION_RULES
from martflow.operators.tables import read_dimension, read_fact
from martflow.plans import dims, facts, mart
from martflow.schemas import SOURCE_TABLES
from martflow.sources.csv import write_csv
from martflow.sources.model import StoredSource, parquet_source
from martflow.sources.testtables import retail_source

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """The test tables as stored source tables."""
    root = str(tmp_path_factory.mktemp("source"))
    adapted = retail_source(spark, SF)
    for name in SOURCE_TABLES:
        getattr(adapted, name).write.parquet(f"{root}/{name}")
    return parquet_source(spark, root)


@pytest.fixture(scope="module")
def staged(spark, source, tmp_path_factory):
    staging = str(tmp_path_factory.mktemp("staging"))
    return staging, mart.build_mart(source, staging)


def test_staging_counts_what_it_wrote(spark, staged):
    staging, report = staged
    assert report.rows["dim_time"] == 3651
    assert report.rows["sales_data"] == 1500
    for name, df in mart.staged_tables(spark, staging).items():
        assert df.count() == report.rows[name], name


def test_loading_is_refused_while_an_input_is_absent(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no complete run"):
        mart.load_mart(spark, str(tmp_path), str(tmp_path / "mart"))
    assert not (tmp_path / "mart").exists()


def test_load_then_check(spark, source, staged, tmp_path):
    staging, report = staged
    root = str(tmp_path / "mart")
    loaded = mart.load_mart(spark, staging, root)
    assert loaded.changes["dim_customer"] == {"updated_count": 0, "inserted_count": 150, "kept_count": 0}
    tables = mart.mart_tables(spark, root)
    assert rows(tables["fct_sales"]) == rows(
        facts.fct_sales(source.sales, source.sale_product, dims.dim_time(source.sales))
    )
    suite = checks.check_suite(tables)
    failed = {r[0] for r in suite.filter("not passed").select("table").collect()}
    assert failed <= {"fct_marketing"}  # customers without orders have no place and day
    totals = checks.reconciliation(source.sale_product, tables["fct_sales"], {"quantity": "quantity", "subtotal": "sales"})
    assert {r["difference"] for r in totals.collect()} == {0.0}

    # The same run again is refused and changes nothing; a run for the same week is another run.
    with pytest.raises(ValueError, match="appended already"):
        mart.load_mart(spark, staging, root)
    assert read_dimension(spark, root, "dim_customer").count() == 150
    assert read_fact(spark, f"{root}/fct_sales", "fct_sales").count() == report.rows["fct_sales"]


def test_a_build_that_dies_leaves_no_run(spark, source, tmp_path, monkeypatch):
    staging, root = str(tmp_path / "staging"), str(tmp_path / "mart")
    mart.build_mart(source, staging)
    rows_before = mart.load_mart(spark, staging, root).rows["fct_sales"]
    monkeypatch.setattr(mart.facts, "fct_marketing", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        mart.build_mart(source, staging)
    # The last complete run is the one that is loaded already.
    with pytest.raises(ValueError, match="appended already"):
        mart.load_mart(spark, staging, root)
    assert read_fact(spark, f"{root}/fct_sales", "fct_sales").count() == rows_before


def test_weekly_replacement_equals_one_full_run(spark, source, staged, tmp_path):
    staging, report = staged
    root, weekly = str(tmp_path / "mart"), str(tmp_path / "weekly")
    mart.load_mart(spark, staging, root)
    since = mart.month_start(date(2000, 6, 15))
    mart.build_mart(source, weekly, since=since)
    with pytest.raises(ValueError, match="not staged to replace"):
        mart.load_mart(spark, weekly, root, replace_since=date(2000, 6, 15))
    part = mart.build_mart(source, weekly, since=since, to_replace=True)
    assert part.rows["sales_data"] == source.sales.filter(F.col("order_date") >= since).count()
    for _ in range(2):
        mart.load_mart(spark, weekly, root, replace_since=date(2000, 6, 15))
    for name in ("fct_sales", "fct_marketing"):
        stored = read_fact(spark, f"{root}/{name}", name)
        assert rows(stored) == rows(mart.staged_table(spark, staging, name))


def test_a_window_past_the_calendar_is_refused(spark, source, tmp_path):
    staging = str(tmp_path / "staging")
    mart.build_mart(source, staging, calendar_days=30)
    with pytest.raises(ValueError, match="before the window"):
        mart.load_mart(spark, staging, str(tmp_path / "mart"), replace_since=date(2000, 6, 15))
    assert not (tmp_path / "mart").exists()


def test_visits_and_ratings_are_kept_if_asked_for(spark, source, tmp_path):
    staging, visits, ratings = (str(tmp_path / name) for name in ("staging", "visits", "ratings"))
    without = StoredSource(**{**source.__dict__, "web_visit": source.web_visit.limit(0)})
    table = lambda report, name="fct_marketing": rows(mart.staged_table(spark, staging, name, report.run))
    plain = mart.build_mart(source, staging, visits_as_of=date(2024, 1, 20))
    kept = mart.build_mart(source, staging, visits_as_of=date(2024, 1, 20), visits_store=visits, ratings_store=ratings)
    assert table(kept) == table(plain) and table(kept, "dim_product") == table(plain, "dim_product")
    # The days are in the store now; without it the visits are gone.
    again = mart.build_mart(without, staging, visits_as_of=date(2024, 1, 20), visits_store=visits, ratings_store=ratings)
    assert table(again) == table(plain) and table(again, "dim_product") == table(plain, "dim_product")
    assert table(mart.build_mart(without, staging)) != table(plain)
    # A later run counts the days since, and a window that is replaced corrects the ratings.
    later = mart.build_mart(
        source, staging, since=date(2000, 6, 1), to_replace=True, visits_store=visits, ratings_store=ratings
    )
    whole = mart.build_mart(source, staging, since=date(2000, 6, 1), to_replace=True)
    assert table(later) == table(whole) and table(later, "dim_product") == table(plain, "dim_product")


def test_rules_set_rows_of_a_dimension_aside(spark, source, tmp_path):
    staging = str(tmp_path)
    codes = F.when(F.col("location_id") == 3, "x1").when(F.col("location_id") == 4, "123").otherwise("00001")
    places = StoredSource(**{**source.__dict__, "locations": source.locations.withColumn("postal_code", codes)})
    report = mart.build_mart(places, staging, rules={"dim_location": LOCATION_RULES})
    assert report.failed_rules["dim_location"]["postal_code format"] == 1
    assert report.repaired_rules["dim_location"] == {"postal_code format": 1}
    staged = mart.staged_table(spark, staging, "dim_location")
    assert rows(staged.filter("location_key in (3, 4)"), "location_key", "postal_code") == [(4, "00123")]
    rejected = spark.read.parquet(f"{staging}/{report.run}/rejected/dim_location")
    assert rows(rejected, "location_key", "failed_rules") == [(3, ["postal_code format"])]


def test_a_calendar_to_the_last_order(spark, source, tmp_path):
    short = mart.build_mart(source, str(tmp_path / "short"), calendar_days=30)
    assert short.orders_outside_calendar > 0
    full = mart.build_mart(source, str(tmp_path / "full"), calendar_days=None, registered_after=date(1995, 6, 30))
    assert full.orders_outside_calendar == 0
    first, last = source.sales.agg(F.min("order_date"), F.max("order_date")).first()
    assert full.rows["dim_time"] == (last - first).days + 1
    # Dimensions are the new ones only, facts have all customers.
    assert full.rows["dim_customer"] < short.rows["dim_customer"]
    assert full.rows["fct_marketing"] == short.rows["fct_marketing"]


def test_handoffs_load_like_a_run(spark, staged, tmp_path):
    staging, report = staged
    for name, df in mart.staged_tables(spark, staging).items():
        write_csv(df.withColumnRenamed("sales", "subtotal"), f"{tmp_path}/csv/{name}")
    loaded = mart.stage_handoffs(
        spark, f"{tmp_path}/csv", f"{tmp_path}/staging", renames={"fct_sales": {"subtotal": "sales"}}
    )
    assert loaded.rows == {n: report.rows[n] for n in loaded.rows}
    mart.load_mart(spark, f"{tmp_path}/staging", f"{tmp_path}/mart")
    for name, df in mart.mart_tables(spark, f"{tmp_path}/mart").items():
        assert rows(df) == rows(mart.staged_table(spark, staging, name))


# --- audit before publish -----------------------------------------------------


def unknown_customers(source):
    odd = F.when(F.col("sales_id") % 7 == 0, -F.col("customer_id")).otherwise(F.col("customer_id"))
    return StoredSource(**{**source.__dict__, "sales": source.sales.withColumn("customer_id", odd)})


def state(spark, root):
    return {name: rows(df) for name, df in mart.mart_tables(spark, root).items()}


def test_a_load_that_fails_its_audit_changes_nothing(spark, source, staged, tmp_path):
    staging, _ = staged
    root, weekly = str(tmp_path / "mart"), str(tmp_path / "weekly")
    mart.load_mart(spark, staging, root)
    before, number = state(spark, root), versions.last(spark, root).number
    since = mart.month_start(date(2000, 6, 15))
    part = mart.build_mart(unknown_customers(source), weekly, since=since, to_replace=True)
    with pytest.raises(mart.AuditFailed, match="fct_sales.customer_key foreign_key") as refused:
        mart.load_mart(spark, weekly, root, replace_since=since)
    assert refused.value.run == part.run
    (finding,) = refused.value.findings
    wrong = mart.staged_table(spark, weekly, "fct_sales").filter("customer_key < 0").count()
    assert (finding.failed_rows, finding.checked_rows) == (wrong, part.rows["fct_sales"])
    assert versions.last(spark, root).number == number and state(spark, root) == before
    # Without the audit it would have come in; a sound run replaces it.
    mart.load_mart(spark, weekly, root, replace_since=since, audit=None)
    assert state(spark, root) != before
    mart.build_mart(source, weekly, since=since, to_replace=True)
    mart.load_mart(spark, weekly, root, replace_since=since)
    assert state(spark, root) == before


def test_a_load_that_dies_is_not_seen_and_can_be_run_again(spark, staged, tmp_path, monkeypatch):
    staging, report = staged
    root = str(tmp_path / "mart")
    write = mart.write_months

    def dies(df, path, name, first=None):
        written = write(df, path, name, first)
        if name == "fct_marketing":
            raise OSError("lost")
        return written

    monkeypatch.setattr(mart, "write_months", dies)
    with pytest.raises(OSError, match="lost"):
        mart.load_mart(spark, staging, root)
    assert all(not found for found in state(spark, root).values())
    monkeypatch.undo()
    mart.load_mart(spark, staging, root)
    for name, df in mart.mart_tables(spark, root).items():
        assert df.count() == report.rows[name]


def test_racing_loads_of_one_run_append_it_once(spark, staged, tmp_path):
    staging, report = staged
    root = str(tmp_path / "mart")

    def load(_):
        try:
            return mart.load_mart(spark, staging, root)
        except (ValueError, versions.Conflict) as lost:
            return lost

    with ThreadPoolExecutor(2) as pool:
        ends = list(pool.map(load, range(2)))
    assert sum(isinstance(e, mart.RunReport) for e in ends) == 1
    assert read_fact(spark, f"{root}/fct_sales", "fct_sales").count() == report.rows["fct_sales"]


def test_racing_runs_get_numbers_of_their_own(spark, tmp_path):
    staging = str(tmp_path)
    reports = [mart.RunReport(run=f"run-{k}") for k in range(6)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda r: mart._write_manifest(spark, staging, r, None, False), reports))
    found = mart._runs(spark, staging)
    assert [m["number"] for m in found] == [1, 2, 3, 4, 5, 6]
    assert {m["run"] for m in found} == {r.run for r in reports}
    assert mart.manifest(spark, staging) == found[-1]
