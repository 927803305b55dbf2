"""The queries that SQL can express, against DuckDB on the same tables."""

from __future__ import annotations

import duckdb
import pytest

from martflow.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found = QUERIES[name](spark, sf_dir)
    wanted = con.execute(ORACLE[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(columns) == sorted(found.columns)
    rows = sorted((tuple(r) for r in found.select(*columns).collect()), key=repr)
    assert rows == sorted(wanted.fetchall(), key=repr) and rows
