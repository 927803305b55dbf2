"""Versions: one step for readers, one winner among writers, nothing lost or half seen."""

from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from frames import day, mart, money, rows
from martflow.operators import files, tables, versions


def fact(spark, *entries):
    return mart(
        spark,
        "fct_sales",
        [
            {"customer_key": c, "location_key": 1, "product_key": 1, "time_key": t, "quantity": q, "sales": money("1.50")}
            for c, t, q in entries
        ],
    )


def content(spark, path):
    return rows(tables.read_fact(spark, path, "fct_sales"), "customer_key", "time_key", "quantity")


class Dies(Exception):
    pass


def dying(*args, **kwargs):
    raise Dies


# --- exclusive creation -------------------------------------------------------


def test_one_of_many_creates_the_file(spark, tmp_path):
    for trial in range(5):
        path = f"{tmp_path}/{trial}/file"
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda k, path=path: files.create(spark, path, f"writer {k}"), range(8)))
        assert won.count(True) == 1
        assert files.read_text(spark, path) == f"writer {won.index(True)}"
    assert files.names(spark, f"{tmp_path}/0") == ["file"]


class Store:
    """A file system of an object store: a rename onto a folder merges, a look before is no lock."""

    def __init__(self, scheme, conditional=False, late=None):
        self.scheme, self.conditional, self.late, self.held, self.lock = scheme, conditional, late, {}, threading.Lock()
        self.asked = []

    def getUri(self):
        return type("Uri", (), {"getScheme": lambda _: self.scheme})()

    def exists(self, handle):
        return handle.path in self.held

    def mkdirs(self, handle):
        return True

    def rename(self, source, target):
        raise AssertionError("a rename decides nothing here")

    def hasPathCapability(self, handle, name):
        return self.conditional and name == files.CONDITIONAL_CREATE

    def createFile(self, handle):
        store = self

        class Builder:
            def overwrite(self, allowed):
                assert allowed is False
                return self

            def must(self, name, value):
                store.asked.append(name)
                return self

            def build(self):
                return Out()

        class Out:
            def write(self, data):
                self.data = bytes(data)

            def close(self):
                with store.lock:
                    if store.late is not None or handle.path in store.held:
                        raise OSError("precondition failed")
                    store.held[handle.path] = self.data

        return Builder()


class Handle:
    def __init__(self, path):
        self.path = path

    def getParent(self):
        return Handle(self.path.rpartition("/")[0])


def opened(monkeypatch, store):
    monkeypatch.setattr(files, "_open", lambda spark, path: (store, Handle(path)))
    return store


@pytest.mark.parametrize("scheme, conditional", [("hdfs", False), ("s3a", True)])
def test_the_server_decides_where_renames_merge(spark, monkeypatch, scheme, conditional):
    store = opened(monkeypatch, Store(scheme, conditional))
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: files.create(spark, "s/v", str(k)), range(8)))
    assert won.count(True) == 1 and store.held["s/v"] == str(won.index(True)).encode()
    assert bool(store.asked) == conditional


def test_a_file_system_that_cannot_decide_is_refused(spark, monkeypatch):
    store = opened(monkeypatch, Store("s3a"))
    with pytest.raises(ValueError, match="one writer only"):
        files.create(spark, "s/v", "x")
    assert not store.held


def test_other_trouble_is_no_second_writer(spark, monkeypatch):
    opened(monkeypatch, Store("hdfs", late="quota"))
    with pytest.raises(OSError):
        files.create(spark, "s/v", "x")


# --- readers and writers -------------------------------------------------------


@pytest.mark.parametrize("write", ["append", "replace"])
def test_a_writer_that_dies_before_publishing_changes_nothing(spark, tmp_path, monkeypatch, write):
    path = str(tmp_path / "f")
    tables.append_fact(fact(spark, (1, 20231231, 1), (1, 20240105, 2)), path, "fct_sales")
    before, reader = content(spark, path), tables.read_fact(spark, path, "fct_sales")
    change = {
        "append": lambda: tables.append_fact(fact(spark, (7, 20240105, 7)), path, "fct_sales"),
        "replace": lambda: tables.replace_window(fact(spark, (7, 20240105, 7)), path, "fct_sales", day("2024-01-01")),
    }[write]
    monkeypatch.setattr(versions, "publish", dying)
    with pytest.raises(Dies):
        change()
    assert content(spark, path) == before
    monkeypatch.undo()
    change()
    assert content(spark, path) != before
    # Who has begun to read goes on with what was there then.
    assert rows(reader, "customer_key", "time_key", "quantity") == before
    # What the dead writer left goes, after some time only.
    assert versions.sweep(spark, path) == []
    assert len(versions.sweep(spark, path, older_than=-5)) == 1
    assert content(spark, path) != before


def test_a_writer_that_dies_while_writing_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "f")
    tables.append_fact(fact(spark, (1, 20240105, 2)), path, "fct_sales")
    broken = fact(spark, (1, 20240105, 3)).selectExpr("*", "1 as one").selectExpr(
        "customer_key", "location_key", "product_key", "time_key", "quantity", "raise_error('lost') as sales"
    )
    for change in (
        lambda: tables.append_fact(broken, path, "fct_sales"),
        lambda: tables.replace_window(broken, path, "fct_sales", day("2024-01-01")),
    ):
        with pytest.raises(Exception, match="lost"):
            change()
        assert content(spark, path) == [(1, 20240105, 2)]


def test_racing_appends_all_arrive(spark, tmp_path):
    path = str(tmp_path / "f")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: tables.append_fact(fact(spark, (k, 20240105, k)), path, "fct_sales"), range(4)))
    assert content(spark, path) == [(k, 20240105, k) for k in range(4)]


def test_a_replacement_that_would_lose_an_append_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "f")
    tables.append_fact(fact(spark, (1, 20240105, 1)), path, "fct_sales")
    write = tables.write_months

    def meanwhile(*args):
        written = write(*args)
        monkeypatch.setattr(tables, "write_months", write)
        tables.append_fact(fact(spark, (2, 20240106, 2)), path, "fct_sales")
        return written

    monkeypatch.setattr(tables, "write_months", meanwhile)
    with pytest.raises(versions.Conflict):
        tables.replace_window(fact(spark, (1, 20240105, 9)), path, "fct_sales", day("2024-01-01"))
    assert content(spark, path) == [(1, 20240105, 1), (2, 20240106, 2)]


def test_scattered_months_are_joined(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "f")
    for k in range(3):
        tables.append_fact(fact(spark, (k, 20240105, k), (k, None, k)), path, "fct_sales")
    tables.append_fact(fact(spark, (9, 20240305, 9)), path, "fct_sales")
    before, store = content(spark, path), versions.last
    march = [f for f in store(spark, path).tables["f"].folders if f.endswith("=202403")]
    write = tables.write_months

    def meanwhile(*args):
        written = write(*args)
        monkeypatch.setattr(tables, "write_months", write)
        tables.append_fact(fact(spark, (7, 20240107, 7)), path, "fct_sales")
        return written

    monkeypatch.setattr(tables, "write_months", meanwhile)
    assert tables.compact_fact(spark, path, "fct_sales") == ["month_key=202401", f"month_key={tables.NO_MONTH}"]
    assert content(spark, path) == sorted([*before, (7, 20240107, 7)], key=lambda r: [(v is None, str(v)) for v in r])
    folders = list(store(spark, path).tables["f"].folders)
    assert march[0] in folders and len(folders) == 4
    assert tables.compact_fact(spark, path, "fct_sales") == ["month_key=202401"]
    assert tables.compact_fact(spark, path, "fct_sales") == []


def test_an_unfinished_version_is_no_version_and_is_not_passed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "f")
    monkeypatch.setattr(versions, "PAUSE", 0.01)
    tables.append_fact(fact(spark, (1, 20240105, 1)), path, "fct_sales")
    assert files.create(spark, versions._file(path, 2), '{"tables"')
    assert content(spark, path) == [(1, 20240105, 1)]
    with pytest.raises(versions.Conflict, match="unfinished"):
        tables.append_fact(fact(spark, (2, 20240105, 1)), path, "fct_sales")


def test_tables_of_a_mart_share_versions(spark, tmp_path):
    root = str(tmp_path / "mart")
    tables.create_mart(spark, root)
    places = mart(spark, "dim_location", [{"location_key": k} for k in range(3)])
    with ThreadPoolExecutor(2) as pool:
        one = pool.submit(tables.upsert_dimension, spark, root, "dim_location", places)
        other = pool.submit(tables.append_fact, fact(spark, (1, 20240105, 1)), f"{root}/fct_sales", "fct_sales")
        one.result(), other.result()
    assert versions.last(spark, root).number == 3
    assert tables.read_dimension(spark, root, "dim_location").count() == 3
    assert content(spark, f"{root}/fct_sales") == [(1, 20240105, 1)]
    # Old versions go, with what only they name.
    assert tables.expire_versions(spark, f"{root}/fct_sales", keep=1) == [1, 2]
    assert content(spark, f"{root}/fct_sales") == [(1, 20240105, 1)]


# --- buckets -------------------------------------------------------------------


def people(spark, keys, name):
    return mart(spark, "dim_customer", [{"customer_key": k, "name": name} for k in keys])


def bucket_files(tmp_path):
    found = {}
    for f in (tmp_path / "dim_customer").glob("data_part=*/bucket=*/*.parquet"):
        found.setdefault(f.parent.name, set()).add(f)
    return found


def test_an_upsert_leaves_the_buckets_it_does_not_touch(spark, tmp_path):
    root = str(tmp_path)
    tables.create_mart(spark, root)
    first = tables.upsert_dimension(spark, root, "dim_customer", people(spark, range(100), "a"), bucket_rows=8)
    assert first == {"updated_count": 0, "inserted_count": 100, "kept_count": 0}
    before = bucket_files(tmp_path)
    assert len(before) == 16
    state = versions.last(spark, root).tables["dim_customer"]
    assert state.buckets == 16 and sum(state.folders.values()) == 100
    second = tables.upsert_dimension(spark, root, "dim_customer", people(spark, [3, 4, 1000], "b"), bucket_rows=8)
    assert second == {"updated_count": 2, "inserted_count": 1, "kept_count": 98}
    after, now = bucket_files(tmp_path), versions.last(spark, root).tables["dim_customer"]
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 3
    untouched = set(state.folders) & set(now.folders)
    assert len(untouched) == len(now.folders) - len(changed)
    assert all(before[f.rpartition("/")[2]] <= after[f.rpartition("/")[2]] for f in untouched)
    wanted = sorted((k, "b" if k in (3, 4, 1000) else "a") for k in [*range(100), 1000])
    assert sorted(rows(tables.read_dimension(spark, root, "dim_customer"), "customer_key", "name")) == wanted
    # Growth doubles the buckets and writes all of them.
    third = tables.upsert_dimension(spark, root, "dim_customer", people(spark, range(90, 200), "c"), bucket_rows=8)
    assert third == {"updated_count": 10, "inserted_count": 100, "kept_count": 91}
    assert versions.last(spark, root).tables["dim_customer"].buckets == 32
    assert tables.read_dimension(spark, root, "dim_customer").count() == 201


def test_an_upsert_into_a_plain_table_and_of_nothing(spark, tmp_path):
    root = str(tmp_path)
    tables.publish(people(spark, range(5), "a"), f"{root}/dim_customer")
    nothing = people(spark, [], "a")
    assert tables.upsert_dimension(spark, root, "dim_customer", nothing)["kept_count"] == 5
    before = versions.last(spark, f"{root}/dim_customer").tables["dim_customer"]
    assert before.buckets == 1
    assert tables.upsert_dimension(spark, root, "dim_customer", nothing)["kept_count"] == 5
    assert versions.last(spark, f"{root}/dim_customer").tables["dim_customer"] == before
    # A mart made around it takes it over.
    assert "dim_customer" not in tables.create_mart(spark, root)
    assert tables.read_dimension(spark, root, "dim_customer").count() == 5
