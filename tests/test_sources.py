from types import SimpleNamespace

import pytest

from martflow.operators import files
from martflow.schemas import SOURCE_TABLES
from martflow.session import prepare, scratch_dir
from martflow.sources import jdbc, model
from martflow.sources.csv import read_csv, write_csv


def test_split_reads_name_their_bounds():
    options = jdbc.jdbc_options("jdbc:x", "sales", "sales_id", (1, 900), partitions=9, user="me")
    assert options["partitionColumn"] == "sales_id"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("1", "900", "9")
    assert options["user"] == "me"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "sales", "sales_id")


class Reader:
    """Stands in for a session: records what would be read."""

    def __init__(self, answer=(1, 10)):
        self.seen = []
        self.read = self
        self.answer = answer

    def format(self, name):
        assert name == "jdbc"
        return self

    def select(self, *columns):
        return self

    def options(self, **options):
        self.seen.append(options)
        return self

    def load(self):
        return self

    def first(self):
        return self.answer


def test_query_becomes_a_derived_table():
    reader = Reader()
    jdbc.read_query(reader, "jdbc:x", " select 1;\n")
    assert reader.seen[0]["dbtable"] == "(select 1) AS q"


def test_every_database_table_is_split(spark):
    reader = Reader()
    model.database_source(reader, "jdbc:x", partitions=4, bounds={"sales": (5, 6)}, password="p")
    tables = {o["dbtable"]: o for o in reader.seen if not o["dbtable"].startswith("(")}
    assert set(tables) == set(SOURCE_TABLES)
    assert {t: o["partitionColumn"] for t, o in tables.items()} == model.SPLIT_COLUMNS
    assert (tables["sales"]["lowerBound"], tables["sales"]["upperBound"]) == ("5", "6")
    assert (tables["product"]["lowerBound"], tables["product"]["upperBound"]) == ("1", "10")
    asked = [o["dbtable"] for o in reader.seen if o["dbtable"].startswith("(")]
    assert "(SELECT min(time_visit) AS low, max(time_visit) AS high FROM web_visit) AS q" in asked
    assert len(asked) == 5
    assert all(o["password"] == "p" for o in reader.seen)


def test_an_empty_database_table_needs_no_split(spark):
    reader = Reader(answer=(None, None))
    model.database_source(reader, "jdbc:x")
    assert all("partitionColumn" not in o for o in reader.seen)


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_scratch_folder_may_be_given_and_is_shared(spark, monkeypatch):
    assert scratch_dir(spark, "hdfs://x/y/") == "hdfs://x/y"
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.raises(ValueError, match="one machine"):
        scratch_dir(spark, "file:///tmp/x")
    assert scratch_dir(spark, "s3a://bucket/x") == "s3a://bucket/x"


def test_folders_that_the_session_names_are_shared_by_its_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    conf = {"spark.sql.warehouse.dir": "file:/mounted/warehouse/"}
    assert scratch_dir(SimpleNamespace(conf=conf, sparkContext=context)) == "file:/mounted/warehouse/scratch"
    path = f"{scratch_dir(spark)}/shared-by-a-cluster"
    write_csv(spark.range(3), path)
    assert read_csv(spark, path, spark.range(3).schema).count() == 3


def test_prepare_fits_a_session_to_large_inputs(spark, monkeypatch):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    monkeypatch.setattr(files, "size", lambda spark, path: 50 * 1024**4)
    try:
        prepare(spark, "lines", "orders", most_partitions=20_000)
        assert spark.conf.get(name) == "20000"
        prepare(spark, "lines", "orders")
        assert spark.conf.get(name) == str(100 * 8192)
        spark.conf.set(name, before)
        # Without files the caller says what is shuffled.
        prepare(spark, shuffled_bytes=10 * 1024**3)
        assert spark.conf.get(name) == "80"
    finally:
        spark.conf.set(name, before)


def test_sources_with_other_types(spark, tmp_path):
    """Timestamps for days and floats for money and ratings, as some databases have them."""
    spark.sql(
        "select 1 sales_id, 2 customer_id, 3 ship_to, timestamp'2024-01-02 03:04:05' order_date, 9.99D total, 'x' more"
    ).write.parquet(f"{tmp_path}/sales")
    spark.sql("select 1 sales_id, 5 product_id, 2L quantity, 19.98D subtotal, 4.5D ratings").write.parquet(
        f"{tmp_path}/sale_product"
    )
    for name in set(SOURCE_TABLES) - {"sales", "sale_product"}:
        spark.createDataFrame([], SOURCE_TABLES[name]).write.parquet(f"{tmp_path}/{name}")
    source = model.parquet_source(spark, str(tmp_path))
    assert source.sales.schema.simpleString() == SOURCE_TABLES["sales"].simpleString()
    assert [tuple(map(str, r)) for r in source.sales.collect()] == [("1", "2", "3", "2024-01-02", "9.99")]
    assert str(source.sale_product.first()["ratings"]) == "4.5"


def test_prepare_keeps_a_session_that_is_large_enough(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    prepare(spark, "/root/testdata/sf0.001/orders.parquet", "/no/such/folder")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


# --- even splits ------------------------------------------------------------------


def test_bounds_are_written_as_any_database_reads_them():
    from datetime import date, datetime
    from decimal import Decimal

    assert [jdbc.literal(v) for v in (5, Decimal("1.50"), date(2024, 1, 2), "o'x")] == ["5", "1.50", "DATE '2024-01-02'", "'o''x'"]
    assert jdbc.literal(datetime(2024, 1, 2, 3, 4, 5)) == "TIMESTAMP '2024-01-02 03:04:05'"
    for value in (None, True):
        with pytest.raises(TypeError):
            jdbc.literal(value)


@pytest.mark.parametrize("column, kind", [("id", "bigint"), ("t", "timestamp_ntz")])
def test_every_row_is_in_one_even_part(spark, column, kind):
    """The database's part is played by Spark's own SQL on a temporary view."""
    keys = spark.range(1000).selectExpr("if(id < 500, id, if(id < 700, 500, id * id * 1000)) as id")
    table = keys.selectExpr("id", "cast(timestamp_seconds(id) as timestamp_ntz) as t").union(
        spark.sql("select cast(null as bigint), cast(null as timestamp_ntz)")
    )
    table.createOrReplaceTempView("uneven")
    tiles = f"select {column} as v, ntile(8) over (order by {column}) as part from uneven where {column} is not null"
    bounds = [r[0] for r in spark.sql(f"select min(v) from ({tiles}) group by part").collect()]
    predicates = jdbc.range_predicates(column, bounds)
    sizes = [table.filter(p).count() for p in predicates]
    assert sum(sizes) == 1001
    # Only the frequent value makes a part larger than an eighth.
    assert sorted(sizes)[-1] <= 125 + 200 + 1 and sorted(sizes)[-2] <= 127
    assert jdbc.range_predicates(column, bounds[:1]) == jdbc.range_predicates(column, []) == ["1 = 1"]


def test_tables_may_be_split_by_quantiles(spark, monkeypatch):
    asked, read = [], []
    monkeypatch.setattr(
        jdbc, "read_query", lambda spark, url, sql, **o: asked.append(sql) or spark.createDataFrame([(k,) for k in (7, 1, 4, 4)], "b long")
    )

    class Jdbc:
        def jdbc(self, url, table, predicates, properties):
            read.append((url, table, predicates, properties))
            return "rows"

    session = type("Session", (), {"read": Jdbc(), "createDataFrame": spark.createDataFrame})()
    assert jdbc.read_evenly(session, "jdbc:x", "sales", "sales_id", 4, user="me") == "rows"
    assert "ntile(4) OVER (ORDER BY sales_id)" in asked[0]
    ((url, table, predicates, properties),) = read
    assert (url, table, properties["user"], properties["fetchsize"]) == ("jdbc:x", "sales", "me", "10000")
    assert predicates == ["sales_id < 4 OR sales_id IS NULL", "sales_id >= 4 AND sales_id < 7", "sales_id >= 7"]
