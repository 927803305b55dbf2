"""Url rules against the SQL and a plain computation."""

from __future__ import annotations

import re

import duckdb
from samples import rows_of

from martflow.llm.queries import ORACLE, URL_RULES, op5_url_rules
from martflow.llm.urls import judge_urls

COLUMNS = ["page_id", "host", "path", "rule", "verdict"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(page_id, url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOWER)
    fits = [
        (len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    _, rule, verdict = max(fits, default=(0, None, default))
    return (page_id, host, path, rule, verdict)


def frame(spark, rules):
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def test_table_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    found = con.sql(ORACLE["op5_url_rules"])
    assert found.columns == COLUMNS
    wanted = found.fetchall()
    assert rows_of(op5_url_rules(spark, sf_dir), *COLUMNS) == sorted(map(tuple, wanted), key=repr)


def test_nested_rules_and_awkward_urls(spark):
    rules = [
        *URL_RULES,
        ("block", "example.net", "/en/a"),
        ("allow", "example.net", "/en/a/b"),
        ("block", "a.example.net", ""),
        ("allow", "net", "/en/a/b/c"),
        ("block", "dup.org", "/"),
        ("allow", "dup.org", "/"),
    ]
    hosts = ["net", "example.net", "a.example.net", "b.a.example.net", "xexample.net", "EXAMPLE.com", "org", "dup.org", "", "net.", ".net"]
    paths = ["", "/", "/en", "/en/", "/en/a", "/en/ab", "/en/a/b", "/en/a/b/c", "/de/x?y#z", "/fr/#q", "/é", "?a=/en/", "#/en/"]
    urls = [f"{s}{h}{p}" for s in ("http://", "x://y://", "", "://") for h in hosts for p in paths] + [None, "", "no scheme", "http://"]
    pages = spark.createDataFrame(
        [(k % 50 or None, u, "<html>", "h", "r", 1) for k, u in enumerate(urls)],
        "page_id long, url string, html string, host string, rule string, row int",
    )
    got = judge_urls(pages, frame(spark, [*rules, (None, "net", "/"), ("block", None, "/")]))
    kept = [r for r in rules if r != ("allow", "dup.org", "/")]
    assert rows_of(got, *COLUMNS) == sorted((expected(k % 50 or None, u, kept) for k, u in enumerate(urls)), key=repr)


def test_without_rules_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/")], "page_id long, url string")
    assert rows_of(judge_urls(pages, frame(spark, []), default="block"), "rule", "verdict") == [(None, "block")] * 2
    assert judge_urls(pages.limit(0), frame(spark, URL_RULES)).count() == 0
