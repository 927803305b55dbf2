import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from frames import mart, rows
from martflow.operators.upsert import scd1_changes, scd1_counts, scd1_upsert

SCHEMA = "k long, name string, points int"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "one", 1), (2, "two", 2), (3, "three", 3), (4, "four", 4)], SCHEMA)


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(2, "TWO", 22), (3, "three", 3), (4, None, None), (9, "nine", None)], SCHEMA)


def test_matched_overwritten_new_added_rest_kept(target, source):
    assert rows(scd1_changes(target, source, "k")) == [
        (1, "one", 1, "kept"),
        (2, "TWO", 22, "updated"),
        (3, "three", 3, "updated"),  # counts as updated though nothing differs
        (4, None, None, "updated"),  # NULL overwrites
        (9, "nine", None, "inserted"),
    ]


def test_counts(target, source):
    assert scd1_counts(scd1_changes(target, source, "k")).first().asDict() == {
        "updated_count": 3,
        "inserted_count": 1,
        "kept_count": 1,
    }


def test_running_twice_changes_nothing(target, source):
    once = scd1_upsert(target, source, "k")
    assert rows(scd1_upsert(once, source, "k")) == rows(once)
    assert once.count() == target.count() + 1


def test_listed_columns_only(target, source):
    assert rows(scd1_upsert(target, source.select("points", "k"), "k", columns=["points"])) == [
        (1, "one", 1),
        (2, "two", 22),
        (3, "three", 3),
        (4, "four", None),
        (9, None, None),
    ]


def test_source_columns_bind_by_name_and_take_the_target_type(spark, target):
    source = spark.createDataFrame([("5", 2, "II")], "points string, k int, name string")
    merged = scd1_upsert(target, source, "k")
    assert merged.dtypes == target.dtypes
    assert rows(merged.filter("k = 2")) == [(2, "II", 5)]


def test_repeated_key_fails_and_names_it(spark, target):
    source = spark.createDataFrame([(2, "a", 1), (2, "b", 2), (5, "c", 3)], SCHEMA)
    for use in (scd1_upsert, scd1_changes):
        with pytest.raises(PySparkException, match="repeats k 2, copies: 2"):
            use(target, source, "k").collect()
    with pytest.raises(PySparkException, match="repeats k 2"):
        scd1_counts(scd1_changes(target, source, "k")).collect()
    with pytest.raises(PySparkException, match="repeats k 2"):
        scd1_upsert(target, source, "k").select("points").filter("points > 100").collect()


def test_null_key_fails_with_a_count(spark, target):
    source = spark.createDataFrame([(None, "a", 1), (None, "b", 2), (5, "c", 3)], SCHEMA)
    with pytest.raises(PySparkException, match="NULL k in rows: 2"):
        scd1_upsert(target, source, "k").collect()
    with pytest.raises(PySparkException, match="NULL k in rows: 2"):
        scd1_upsert(target, source, "k", latest_by=["points"]).count()


def test_latest_row_per_key_is_reproducible(spark, target):
    source = spark.createDataFrame(
        [(2, "old", 9, 1), (2, "new", 5, 2), (2, "newest-b", 4, 3), (2, "newest-a", 7, 3)], SCHEMA + ", seen int"
    )
    for frame in (source, source.orderBy(F.desc("name")), source.repartition(3)):
        merged = scd1_upsert(target, frame, "k", latest_by=["seen"])
        assert rows(merged.filter("k = 2")) == [(2, "newest-b", 4)]


def test_empty_sides(spark, target):
    empty = target.limit(0)
    assert rows(scd1_changes(target, empty, "k"), "change").count(("kept",)) == 4
    assert rows(scd1_changes(empty, target, "k"), "change").count(("inserted",)) == 4
    assert scd1_counts(scd1_changes(empty, empty, "k")).first()["inserted_count"] == 0


def test_key_column_name_may_equal_internal_ones(spark):
    target = mart(spark, "dim_location", [{"location_key": 1, "country": "x"}])
    assert scd1_upsert(target, target, "location_key").count() == 1
