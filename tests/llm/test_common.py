"""Numbering of rows when scans change between two reads."""

from __future__ import annotations

import martflow.llm.common as common
from martflow.llm.common import numbered, only_rows, stored, without_rows


def test_numbers_stay_gapless_when_scans_are_packed_anew(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("id % 3 as k", "cast(id % 7 as int) as o").repartition(9)
    rows = stored(rows, "rows")
    store, reads = common.stored, []

    def changing(df, name, *args):
        out = store(df, name, *args)
        # Every scan planned from here on is packed otherwise than the one before.
        spark.conf.set("spark.sql.files.maxPartitionBytes", f"{1 + len(reads)}k")
        reads.append(name)
        return out

    monkeypatch.setattr(common, "stored", changing)
    try:
        found = numbered(rows, ["k"], ["o"], "n")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        got = found.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert reads == ["blocks"]
    for k in range(3):
        assert sorted(r.n for r in got if r.k == k) == list(range(1000))


def test_row_numbers_are_sent_or_shuffled(spark, monkeypatch):
    rows = stored(spark.range(50).selectExpr("id as row", "id * 2 as v"), "rows")
    ids = stored(spark.range(0, 50, 5).selectExpr("id as row"), "ids")
    for most in (1 << 20, 3):
        monkeypatch.setattr(common, "BROADCAST_ROWS", most)
        assert sorted(r.row for r in without_rows(rows, ids).collect()) == [k for k in range(50) if k % 5]
    # Too many to be sent: left to the join that follows.
    assert only_rows(rows, ids).count() == 50
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1 << 20)
    assert sorted(r.row for r in only_rows(rows, ids).collect()) == list(range(0, 50, 5))
