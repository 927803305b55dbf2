"""State that is kept between runs, against computing everything anew."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from frames import day, moment, money, rows, source
from martflow.operators import daily, versions
from martflow.operators.daily import covered, forget, missing
from martflow.plans import dims, facts

# --- visits by day ------------------------------------------------------------


def visits_frame(spark, *entries):
    return source(spark, "web_visit", [{"customer_id": c, "time_visit": t and moment(t)} for c, t in entries])


def test_missing_spans():
    d = lambda n: date(2024, 1, n)
    assert missing([], d(1), d(3)) == [(d(1), d(3))]
    assert missing([(d(2), d(4)), (d(6), d(6))], d(1), d(9)) == [(d(1), d(1)), (d(5), d(5)), (d(7), d(9))]
    assert missing([(d(1), d(9))], d(2), d(5)) == [] == missing([], d(5), d(4))
    assert missing([(d(8), d(9))], d(1), d(2)) == [(d(1), d(2))]
    assert missing([(date.min, d(4))], date.min, d(6)) == [(d(5), d(6))]


BOUNDS = [
    (None, None), (None, date(2024, 1, 5)), (date(2024, 1, 3), None), (date(2024, 1, 3), date(2024, 1, 6)),
    (datetime(2024, 1, 3, 12), datetime(2024, 1, 6, 9, 30)), (datetime(2024, 1, 3, 6), datetime(2024, 1, 3, 18)),
    (date(2024, 1, 3), date(2024, 1, 3)), (date(2024, 1, 6), date(2024, 1, 3)), (datetime(2024, 1, 3, 23), date(2024, 1, 4)),
    (date(2024, 3, 1), None), (None, date(2023, 1, 1)),
]


def test_any_window_equals_counting_anew(spark, tmp_path):
    pick = random.Random(2)
    start = datetime(2024, 1, 1)
    entries = [
        (pick.choice([None, 1, 2, 3]), str(start + timedelta(hours=pick.choice([0, 6, 12, pick.randrange(200)])))) for _ in range(120)
    ]
    entries += [(k, f"2024-01-0{d} 00:00:00") for k in (1, None) for d in (1, 3, 4, 5, 6)] + [(7, None), (None, None), (8, None)]
    visits = visits_frame(spark, *entries).cache()
    order = BOUNDS + BOUNDS[::-1]
    for since, as_of in order:
        found = daily.visits_from_days(visits, str(tmp_path / "store"), since, as_of)
        assert rows(found) == rows(facts.visits(visits, since, as_of)), (since, as_of)
    # No day is covered twice.
    spans = covered(spark, str(tmp_path / "store"))
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_a_second_week_reads_only_its_days(spark, tmp_path):
    store = str(tmp_path / "store")
    first = visits_frame(spark, (1, "2024-01-01 08:00:00"), (2, "2024-01-03 08:00:00"))
    assert rows(daily.visits_from_days(first, store, as_of=date(2024, 1, 8))) == [(1, 1), (2, 1)]
    assert covered(spark, store) == [(date.min, date(2024, 1, 7))]
    # The first week's visits are not there to be read again.
    second = visits_frame(spark, (1, "2024-01-09 08:00:00"))
    found = daily.visits_from_days(second, store, as_of=date(2024, 1, 15))
    assert rows(found) == [(1, 2), (2, 1)]
    assert covered(spark, store) == [(date.min, date(2024, 1, 7)), (date(2024, 1, 8), date(2024, 1, 14))]
    # What is scanned has a filter that the files can be asked.
    second.write.parquet(f"{tmp_path}/visits")
    scan = daily._between(spark.read.parquet(f"{tmp_path}/visits"), date(2024, 1, 8), date(2024, 1, 14))
    assert "GreaterThanOrEqual(time_visit,2024" in scan._jdf.queryExecution().toString()
    # A recount is asked for by forgetting.
    forget(spark, store, date(2024, 1, 8))
    assert covered(spark, store) == [(date.min, date(2024, 1, 7))]
    more = visits_frame(spark, (1, "2024-01-09 08:00:00"), (3, "2024-01-10 08:00:00"))
    assert rows(daily.visits_from_days(more, store, as_of=date(2024, 1, 15))) == [(1, 2), (2, 1), (3, 1)]


def test_racing_counters_of_a_day_count_it_once(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    visits = visits_frame(spark, (1, "2024-01-01 08:00:00"))
    real = versions.publish

    def late(*args, **kwargs):
        monkeypatch.setattr(versions, "publish", real)
        daily.cover(visits, store, date(2024, 1, 1), date(2024, 1, 1))
        return real(*args, **kwargs)

    monkeypatch.setattr(versions, "publish", late)
    with pytest.raises(versions.Conflict):
        daily.cover(visits, store, date(2024, 1, 1), date(2024, 1, 2))
    assert rows(daily.visits_from_days(visits, store, as_of=date(2024, 1, 3))) == [(1, 1)]


# --- ratings by deltas ----------------------------------------------------------


def orders(spark, seed, n=60):
    pick = random.Random(seed)
    days = [day("2024-01-30") + timedelta(days=pick.randrange(70)) for _ in range(n)]
    sales = [{"sales_id": k, "order_date": None if k % 13 == 0 else d} for k, d in enumerate(days)]
    lines = [
        {"sales_id": pick.randrange(n + 5), "product_id": pick.choice([None, 1, 2, 3]), "ratings": pick.choice([None, money("4.5"), money("0.1")])}
        for _ in range(4 * n)
    ]
    return source(spark, "sales", sales), source(spark, "sale_product", lines)


def means(totals):
    return rows(dims.product_ratings(totals))


def test_windows_add_up_to_all_lines(spark, tmp_path):
    sales, lines = orders(spark, 1)
    store, whole = str(tmp_path / "ratings"), means(dims.rating_totals(lines))
    dims.load_ratings(store, lines, sales, as_of=day("2024-02-14"))
    once = dims.load_ratings(store, lines, sales, since=day("2024-02-15"))
    assert means(once) == whole
    # Loading a window again adds nothing.
    assert means(dims.load_ratings(store, lines, sales, since=day("2024-02-15"))) == whole
    # Corrected lines come in by replacement, once or twice, and lost ones go.
    changed = lines.withColumn("ratings", F.when(F.col("ratings") == 0.1, F.lit(3)).otherwise(F.col("ratings")))
    dated = changed.join(sales.filter("order_date >= '2024-03-01'"), "sales_id", "left_semi")
    mixed = dated.unionByName(lines.join(sales.filter("order_date >= '2024-03-01'"), "sales_id", "left_anti"))
    for _ in range(2):
        replaced = dims.load_ratings(store, changed, sales, since=day("2024-03-01"), replace=True)
        assert means(replaced) == means(dims.rating_totals(mixed)) != whole
    assert means(dims.load_ratings(store, lines, sales, since=day("2024-03-01"), replace=True)) == whole


def test_windows_that_cannot_be_replaced(spark, tmp_path):
    sales, lines = orders(spark, 2, 10)
    with pytest.raises(ValueError, match="2024-02-01"):
        dims.load_ratings(str(tmp_path), lines, sales, since=day("2024-02-15"), replace=True)
    with pytest.raises(ValueError, match="start"):
        dims.load_ratings(str(tmp_path), lines, sales, replace=True)


def test_nothing_to_rate(spark, tmp_path):
    sales, lines = orders(spark, 3, 5)
    assert means(dims.load_ratings(str(tmp_path / "r"), lines.limit(0), sales)) == []
