"""Repeated strings against a table of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
from samples import awkward_texts, documents, rows_of
from test_near_duplicates import in_files, saved, scans_change_after

import martflow.llm.repeats as repeats_module
from martflow.llm.queries import op7_repeats
from martflow.llm.repeats import anchors, find_repeats, remove_repeats

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def expected(rows, length):
    texts = [(r.text or "").encode() for r in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((r.doc_id, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    wanted = expected(rows, 400)
    assert rows_of(op7_repeats(spark, sf_dir), *COLUMNS) == wanted
    assert any(0 < gone < n for _, n, gone, _, _ in wanted)


def mixtures(seed: int) -> list[str]:
    """Texts put together from common passages, so that repeats overlap and lie in many texts."""
    pick = random.Random(seed)
    passages = ["".join(pick.choices("abcdé ", k=pick.randint(20, 90))) for _ in range(6)]
    fresh = lambda n: "".join(pick.choices("abcdefgh ü\n", k=n))
    texts = [fresh(10) + pick.choice(passages)[pick.randint(0, 9) :] + fresh(30) + pick.choice(passages) for _ in range(60)]
    texts += [passages[0]] * 25 + ["ab" * 100, "ab" * 70, fresh(200) * 2]
    return texts + [passages[1] + fresh(3) for _ in range(40)]


def test_small_shards_and_awkward_texts(spark, tmp_path):
    docs = saved(spark, documents(spark, awkward_texts() + mixtures(1)), tmp_path)
    rows = docs.collect()
    wanted = expected(rows, 40)
    assert rows_of(find_repeats(docs, length=40), *COLUMNS) == wanted
    # Many shards, one passage in several of them.
    assert rows_of(find_repeats(docs, length=40, shard_bytes=500), *COLUMNS) == wanted


def test_removal(spark, tmp_path):
    docs = saved(spark, documents(spark, ["only here", None, "x" * 39 + "y", "", *mixtures(2)]), tmp_path)
    kept = remove_repeats(docs, length=40)
    assert kept.columns == docs.columns
    wanted = {r.doc_id: r for r in find_repeats(docs, length=40).collect()}
    for r in kept.collect():
        row = wanted[r.doc_id] if r.doc_id not in (2, None) else None
        if row is not None:
            assert len((r.text or "").encode()) <= row.n_bytes - row.n_removed
    assert kept.filter("text = 'only here'").count() == 1 and kept.filter("text is null").count() == 1
    assert kept.count() == sum(not (r.n_removed and not r.kept_text.strip(" ")) for r in find_repeats(docs, length=40).collect())


def test_scans_that_are_packed_anew(spark, tmp_path, monkeypatch):
    docs = in_files(spark, awkward_texts() + mixtures(1), tmp_path)
    wanted = expected(docs.collect(), 40)
    scans_change_after(spark, monkeypatch, repeats_module, "anchors")
    try:
        assert rows_of(find_repeats(docs, length=40), *COLUMNS) == wanted
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def long_text(n: int) -> tuple[str, str]:
    """A text of ``n`` bytes that repeats nothing, and a passage of 400 bytes at its end."""
    pick = np.random.default_rng(8)
    whole = pick.integers(97, 123, n, dtype=np.uint8).tobytes().decode()
    return whole, whole[-500:-100]


def test_anchors_behind_16_mib():
    whole, passage = long_text((1 << 24) + 5000)
    data, alone = (np.frombuffer(t.encode(), dtype=np.uint8) for t in (whole, passage))
    (wanted,) = anchors(alone, np.array([0, 400]), 400)[1]
    owner, hashes, first, last = anchors(data, np.array([0, len(data)]), 400)
    assert hashes[(first <= len(data) - 500) & (last >= len(data) - 500)].tolist() == [wanted]
    # Every window has one anchor, and no anchor is counted twice.
    assert first[0] == 0 and last[-1] == len(data) - 400 and (first[1:] == last[:-1] + 1).all()
    assert not owner.any() and len(np.unique(hashes)) == len(hashes)
    # Short texts beside a long one.
    both = anchors(np.concatenate([alone, data]), np.array([0, 400, 400, 400 + len(data)]), 400)
    assert both[1].tolist() == [wanted, *hashes.tolist()] and both[2].tolist() == [0, *first.tolist()]


def test_repeat_behind_16_mib(spark, tmp_path):
    whole, passage = long_text((1 << 24) + 5000)
    docs = saved(spark, documents(spark, [whole, "before " + passage + " behind"]), tmp_path)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in find_repeats(docs).drop("kept_text").collect()}
    assert got == {0: (len(whole), 400, 1), 1: (414, 400, 1)}


def test_a_repeated_passage_takes_eight_bytes(spark, tmp_path, monkeypatch):
    whole, _ = long_text(30_000)
    docs = saved(spark, documents(spark, ["A" + whole, "B" + whole + "C", whole[:9_000] + "D" + whole[9_000:]]), tmp_path)
    kept, write = {}, repeats_module.stored
    monkeypatch.setattr(repeats_module, "stored", lambda df, name, *how: kept.setdefault(name, write(df, name, *how)))
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in find_repeats(docs).collect()}
    assert got == {0: (30_000, 1), 1: (30_000, 1), 2: (30_000, 2)}
    spans = [r.spans for r in kept["found"].filter("bucket is null").orderBy("row").collect()]
    assert [np.frombuffer(s, dtype="<i4").tolist() for s in spans] == [[1, 29_601], [1, 29_601], [0, 9_001, 8_600, 29_601]]


def test_copies_go_without_an_exchange_of_anchors_by_text(spark, tmp_path, monkeypatch):
    docs = saved(spark, documents(spark, mixtures(3)), tmp_path)
    wanted = expected(docs.collect(), 40)
    plans, write = {}, repeats_module.stored

    def seen(df, name, *how):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, *how)

    monkeypatch.setattr(repeats_module, "stored", seen)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows_of(find_repeats(docs, length=40), *COLUMNS) == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for name in ("common", "repeated-anchors"):
        assert "hashpartitioning(anchor" in plans[name] and "hashpartitioning(row" not in plans[name]


def test_empty_table(spark, tmp_path):
    docs = saved(spark, documents(spark, []), tmp_path)
    assert find_repeats(docs).count() == 0 and remove_repeats(docs).count() == 0
