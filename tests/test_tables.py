import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from frames import day, mart, money, rows
from martflow.operators import files, tables, versions
from martflow.schemas import MART_TABLES, PRIMARY_KEYS


def fact(spark, *entries):
    """Sales fact rows from (customer, time_key, quantity)."""
    return mart(
        spark,
        "fct_sales",
        [
            {"customer_key": c, "location_key": 1, "product_key": 1, "time_key": t, "quantity": q, "sales": money("1.50")}
            for c, t, q in entries
        ],
    )


def content(spark, path, **options):
    return rows(tables.read_fact(spark, path, "fct_sales", **options), "customer_key", "time_key", "quantity")


def month_folders(spark, path):
    store, name = versions.home(spark, path)
    return sorted({f.rpartition("/")[2] for f in versions.last(spark, store).tables[name].folders})


# --- versions ---------------------------------------------------------------


def test_a_version_is_readable_while_the_next_is_made_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = MART_TABLES["dim_location"]
    assert tables.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        tables.read_current(spark, path, schema)
    assert tables.publish(mart(spark, "dim_location", [{"location_key": 1}]), path) == 1
    first = tables.read_current(spark, path, schema)
    assert tables.publish(first.withColumn("country", F.lit("x")), path) == 2
    assert rows(tables.read_current(spark, path, schema), "location_key", "country") == [(1, "x")]
    assert rows(first, "location_key", "country") == [(1, None)]


def test_a_failed_write_is_not_the_current_version(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish(mart(spark, "dim_location", [{"location_key": 1}]), path)
    bad = spark.range(1).select(F.raise_error(F.lit("lost")).cast("long").alias("location_key"))
    with pytest.raises(PySparkException):
        tables.publish(bad, path)
    assert tables.current_version(spark, path) == 1
    assert tables.publish(mart(spark, "dim_location", []), path) == 2


def test_a_version_needs_no_marker_of_the_committer(spark, tmp_path):
    path = str(tmp_path / "t")
    name = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    spark._jsc.hadoopConfiguration().set(name, "false")
    try:
        tables.publish(mart(spark, "dim_location", [{"location_key": 1}]), path)
    finally:
        spark._jsc.hadoopConfiguration().unset(name)
    assert not list(tmp_path.rglob("_SUCCESS"))
    assert tables.read_current(spark, path, MART_TABLES["dim_location"]).count() == 1


def test_of_racing_writers_one_fails_and_nothing_mixes(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    for trial in range(3):
        path = f"{tmp_path}/race{trial}"
        tables.publish(spark.range(0), path)

        def write(k, path=path):
            try:
                return tables.publish(spark.range(10).selectExpr(f"{k} * 10 + id as id"), path, after=1)
            except RuntimeError:
                return None

        with ThreadPoolExecutor(3) as pool:
            numbers = list(pool.map(write, range(3)))
        assert sorted(n for n in numbers if n) == [2]
        kept = {r.id for r in tables.read_current(spark, path, spark.range(1).schema).collect()}
        won = numbers.index(2)
        assert kept == set(range(10 * won, 10 * won + 10))


def test_expired_versions_are_removed_except_the_last(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(4):
        tables.publish(spark.range(1), path)
    assert tables.expire_versions(spark, path, keep=2) == [1, 2]
    assert versions.numbers(spark, path) == [3, 4]
    assert len([f for f in files.folders(spark, path) if f.startswith("data_part=")]) == 2
    assert tables.expire_versions(spark, path, keep=0) == [3]
    assert tables.expire_versions(spark, str(tmp_path / "none")) == []


# --- dimensions -------------------------------------------------------------


def test_create_mart_makes_empty_typed_tables_once(spark, tmp_path):
    root = str(tmp_path)
    assert tables.create_mart(spark, root) == list(MART_TABLES)
    assert tables.create_mart(spark, root) == []
    for name in PRIMARY_KEYS:
        df = tables.read_dimension(spark, root, name)
        assert df.count() == 0
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in MART_TABLES[name]]
    assert tables.read_fact(spark, f"{root}/fct_marketing", "fct_marketing").count() == 0


def test_upsert_dimension_reports_its_counts(spark, tmp_path):
    root = str(tmp_path)
    tables.create_mart(spark, root)
    first = mart(spark, "dim_location", [{"location_key": k, "country": "a"} for k in (1, 2, 3)])
    second = mart(spark, "dim_location", [{"location_key": k, "country": "b"} for k in (3, 4)])
    assert tables.upsert_dimension(spark, root, "dim_location", first) == {
        "updated_count": 0, "inserted_count": 3, "kept_count": 0,
    }
    assert tables.upsert_dimension(spark, root, "dim_location", second) == {
        "updated_count": 1, "inserted_count": 1, "kept_count": 2,
    }
    assert rows(tables.read_dimension(spark, root, "dim_location"), "location_key", "country") == [
        (1, "a"), (2, "a"), (3, "b"), (4, "b"),
    ]
    nothing = mart(spark, "dim_location", [])
    assert tables.upsert_dimension(spark, root, "dim_location", nothing)["kept_count"] == 4


def test_upsert_of_nothing_into_nothing(spark, tmp_path):
    root = str(tmp_path)
    tables.create_mart(spark, root)
    counts = tables.upsert_dimension(spark, root, "dim_time", mart(spark, "dim_time", []))
    assert set(counts.values()) == {0}


def test_bad_keys_leave_the_dimension_as_it_was(spark, tmp_path):
    root = str(tmp_path)
    tables.create_mart(spark, root)
    tables.upsert_dimension(spark, root, "dim_location", mart(spark, "dim_location", [{"location_key": 1}]))
    twice = mart(spark, "dim_location", [{"location_key": 5}, {"location_key": 5}])
    with pytest.raises(PySparkException, match="repeats location_key 5"):
        tables.upsert_dimension(spark, root, "dim_location", twice)
    assert rows(tables.read_dimension(spark, root, "dim_location"), "location_key") == [(1,)]


# --- facts ------------------------------------------------------------------


def test_append_adds_and_partitions_by_month(spark, tmp_path):
    path = str(tmp_path / "f")
    tables.append_fact(fact(spark, (1, 20240131, 1), (2, 20240201, 2), (3, None, 3)), path, "fct_sales")
    tables.append_fact(fact(spark, (1, 20240131, 1)), path, "fct_sales")
    assert month_folders(spark, path) == [
        "month_key=202401", "month_key=202402", f"month_key={tables.NO_MONTH}",
    ]
    assert content(spark, path) == [(1, 20240131, 1), (1, 20240131, 1), (2, 20240201, 2), (3, None, 3)]
    assert tables.read_fact(spark, path, "fct_sales").dtypes == [
        (f.name, f.dataType.simpleString()) for f in MART_TABLES["fct_sales"]
    ]


def test_reading_since_a_day_skips_earlier_months(spark, tmp_path):
    path = str(tmp_path / "f")
    tables.append_fact(fact(spark, (1, 20231231, 1), (2, 20240110, 2), (3, 20240201, 3)), path, "fct_sales")
    recent = tables.read_fact(spark, path, "fct_sales", since=day("2024-01-10"))
    assert rows(recent, "customer_key") == [(2,), (3,)]
    assert "PartitionFilters: [isnotnull(month_key" in recent._jdf.queryExecution().toString()


def test_replacing_a_window_twice_equals_once(spark, tmp_path):
    path = str(tmp_path / "f")
    tables.append_fact(
        fact(spark, (1, 20231231, 1), (1, 20240105, 2), (1, 20240301, 3), (9, None, 9)), path, "fct_sales"
    )
    # February is new, March is gone, the row without a day is gone.
    window = fact(spark, (1, 20240105, 20), (2, 20240106, 21), (1, 20240201, 22))
    for _ in range(2):
        tables.replace_window(window, path, "fct_sales", day("2024-01-01"))
        assert content(spark, path) == [(1, 20231231, 1), (1, 20240105, 20), (1, 20240201, 22), (2, 20240106, 21)]


def test_replacing_keeps_rows_without_a_day_that_are_still_there(spark, tmp_path):
    path = str(tmp_path / "f")
    tables.append_fact(fact(spark, (9, None, 9)), path, "fct_sales")
    tables.replace_window(fact(spark, (9, None, 8), (1, 20240201, 1)), path, "fct_sales", day("2024-02-01"))
    assert content(spark, path) == [(1, 20240201, 1), (9, None, 8)]


def test_replacing_with_nothing_empties_the_window(spark, tmp_path):
    path = str(tmp_path / "f")
    tables.append_fact(fact(spark, (1, 20231231, 1), (1, 20240105, 2)), path, "fct_sales")
    tables.replace_window(fact(spark), path, "fct_sales", day("2024-01-01"))
    assert content(spark, path) == [(1, 20231231, 1)]


def test_a_window_that_starts_inside_a_month_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="2024-01-01"):
        tables.replace_window(fact(spark), str(tmp_path / "f"), "fct_sales", day("2024-01-15"))


def test_rows_before_the_window_are_refused_and_nothing_changes(spark, tmp_path):
    path = str(tmp_path / "f")
    tables.append_fact(fact(spark, (1, 20231231, 1), (1, 20240105, 2)), path, "fct_sales")
    with pytest.raises(PySparkException, match="time_key 20231230"):
        tables.replace_window(fact(spark, (1, 20231230, 1)), path, "fct_sales", day("2024-01-01"))
    assert content(spark, path) == [(1, 20231231, 1), (1, 20240105, 2)]


def many_rows(spark, n, time_key):
    return spark.range(0, n, 1, 16).select(
        F.col("id").alias("customer_key"),
        F.lit(1).alias("location_key"),
        F.lit(1).alias("product_key"),
        time_key.alias("time_key"),
        F.lit(1).alias("quantity"),
        F.lit(1).alias("sales"),
    )


def test_a_month_becomes_few_files_whatever_the_task_count(spark, tmp_path):
    df = many_rows(spark, 2000, F.when(F.col("id") % 2 == 0, 20240101).otherwise(20240201))
    tables.append_fact(df, str(tmp_path / "a"), "fct_sales")
    tables.replace_window(df, str(tmp_path / "r"), "fct_sales", day("2024-01-01"))
    for folder in "ar":
        assert len(list((tmp_path / folder).glob("data_part=*/month_key=*/*.parquet"))) == 2


def test_a_month_too_large_for_one_task_is_split(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "50KB")
    try:
        df = many_rows(spark, 40000, F.when(F.col("id") % 100 == 0, 20240101).otherwise(20240201))
        tables.append_fact(df, str(tmp_path / "a"), "fct_sales")
        tables.replace_window(df, str(tmp_path / "r"), "fct_sales", day("2024-01-01"))
    finally:
        spark.conf.set(size, before)
    for folder in "ar":
        assert len(list((tmp_path / folder).glob("data_part=*/month_key=202402/*.parquet"))) > 3
        assert tables.read_fact(spark, str(tmp_path / folder), "fct_sales").count() == 40000
