from datetime import date

import pytest
from py4j.protocol import Py4JJavaError

from frames import mart, rows
from martflow.schemas import MART_TABLES, VISITS
from martflow.sources.cache import read_or_build
from martflow.sources.csv import bulk_load, read_csv, read_indexed_csv, write_csv

LOCATION = MART_TABLES["dim_location"]


@pytest.fixture
def locations(spark):
    return mart(
        spark,
        "dim_location",
        [
            {"location_key": 1, "country": "a, b", "city": 'the "big" one', "state": "", "postal_code": "08701"},
            {"location_key": 2, "country": " padded ", "city": "Zürich", "region": "back\\slash"},
        ],
    )


def test_round_trip_keeps_text_as_it_was(spark, tmp_path, locations):
    path = str(tmp_path / "csv")
    write_csv(locations, path)
    assert rows(read_csv(spark, path, LOCATION)) == rows(locations)


def test_key_comes_first(spark, tmp_path, locations):
    path = tmp_path / "csv"
    write_csv(locations.coalesce(1), str(path), key="postal_code")
    text = next(path.glob("*.csv")).read_text()
    assert text.startswith("postal_code,location_key,country,city,state,region\n")
    assert '08701,1,"a, b","the ""big"" one","",\n' in text


def test_line_breaks_inside_text(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = mart(spark, "dim_location", [{"location_key": 1, "country": "two\nlines", "region": "x"}])
    write_csv(df, path)
    assert rows(read_csv(spark, path, LOCATION, multiline=True)) == rows(df)
    with pytest.raises(Py4JJavaError):
        read_csv(spark, path, LOCATION).collect()


def test_bulk_load_binds_by_name(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("visits,customer_key\n5,1\n,2\n")
    assert rows(bulk_load(spark, str(path), VISITS)) == [(1, 5), (2, None)]
    with pytest.raises(Py4JJavaError):
        read_csv(spark, str(path), VISITS).collect()


def test_bulk_load_refuses_other_columns(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("customer_key,hits\n1,5\n")
    with pytest.raises(ValueError, match="hits"):
        bulk_load(spark, str(path), VISITS)


def test_a_value_that_does_not_parse_fails(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("customer_key,visits\n1,many\n")
    with pytest.raises(Py4JJavaError):
        bulk_load(spark, str(path), VISITS).collect()


def test_dates(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = mart(spark, "dim_customer", [{"customer_key": 1, "registered": date(2024, 2, 29)}, {"customer_key": 2}])
    write_csv(df, path)
    assert rows(read_csv(spark, path, MART_TABLES["dim_customer"])) == rows(df)


def test_unnamed_index_column_is_dropped(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(",customer_key,visits\n0,184,112\n1,87,114\n")
    assert rows(read_indexed_csv(spark, str(path), VISITS)) == [(184, 112), (87, 114)]
    with pytest.raises(ValueError, match="index"):
        read_indexed_csv(spark, str(path), LOCATION)


def test_a_second_file_with_other_columns_fails(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(",customer_key,visits\n0,184,112\n")
    (tmp_path / "in" / "b.csv").write_text(",visits,customer_key\n0,100,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_indexed_csv(spark, str(tmp_path / "in"), VISITS).collect()


def test_bulk_load_renames_and_reads_whole_numbers_with_a_fraction(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("time_key,customer_key,location_key,product_key,quantity,subtotal\n20240101.0,5.0,,7,2.00,9.50\n")
    loaded = bulk_load(spark, str(path), MART_TABLES["fct_sales"], rename={"subtotal": "sales"})
    assert loaded.schema.simpleString() == MART_TABLES["fct_sales"].simpleString()
    assert [tuple(map(str, r)) for r in loaded.collect()] == [("5", "None", "7", "20240101", "2", "9.50")]
    path.write_text("time_key,customer_key,location_key,product_key,quantity,subtotal\n20240101,5.5,1,7,2,9.50\n")
    with pytest.raises(Exception, match="whole number"):
        bulk_load(spark, str(path), MART_TABLES["fct_sales"], rename={"subtotal": "sales"}).collect()


def test_read_or_build_builds_once(spark, tmp_path):
    path = str(tmp_path / "store")
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(1, 10 * len(calls))], "customer_key long, visits int")

    assert rows(read_or_build(spark, path, build, VISITS)) == [(1, 10)]
    assert rows(read_or_build(spark, path, build, VISITS)) == [(1, 10)]
    assert len(calls) == 1
    spark.createDataFrame([(1, 5)], VISITS).write.parquet(f"{tmp_path}/dead/data-1")  # a write that died
    assert rows(read_or_build(spark, f"{tmp_path}/dead", build, VISITS)) == [(1, 20)]
