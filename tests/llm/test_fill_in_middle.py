"""Fill-in-the-middle forms against plain slicing, and an exact round trip."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from samples import awkward_texts, documents, rows_of

from martflow.llm.fill_in_middle import fill_in_middle, restored, with_digests
from martflow.llm.queries import op12_skip_list
from martflow.llm.skip_list import SkipList

COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(row, rate=100, spm=50):
    text = row.text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = sha(f"7:{'' if row.doc_id is None else row.doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted(h % (len(lines) + 1) for h in (h1, h2))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return row.doc_id, len(lines), "plain", None, None, sha(text), sha(text)
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < spm:
        return row.doc_id, len(lines), "spm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}"), sha(text)
    return row.doc_id, len(lines), "psm", len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}"), sha(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=300))
def test_every_rank_is_reached(widths):
    lines = SkipList(np.array(widths))
    assert [lines.seek(k) for k in range(len(widths) + 1)] == [sum(widths[:k]) for k in range(len(widths) + 1)]
    with pytest.raises(IndexError):
        lines.seek(len(widths) + 1)


def test_express_lanes_shorten_the_way():
    lines = SkipList(np.ones(100_000, dtype=np.int64))
    assert len(lines.lanes) > 5 and lines.seek(99_999) == 99_999
    assert all(sum(units) <= 100_000 and sum(chars) == sum(units) for units, chars, _ in lines.lanes)
    assert len(lines.lanes[3][0]) < 100_000 / 4**3 * 1.5


def test_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = rows_of(op12_skip_list(spark, sf_dir), *COLUMNS)
    assert found == sorted((expected(r) for r in rows), key=repr)
    assert {"psm", "spm"} <= {f[2] for f in found}


def test_awkward_texts(spark):
    marked = ["<P>", "a<S>b\nc", "<M", "<\n<\nP>\n<", "a <\nM>\n", "<S\n<S\n<", "é\n日本\n\U0001f600\n" * 4000, "\n" * 20_000, "x" * 2_000_000]
    docs = documents(spark, awkward_texts() + marked)
    wanted = sorted((expected(r) for r in docs.collect()), key=repr)
    assert rows_of(with_digests(fill_in_middle(docs)), *COLUMNS) == wanted
    assert any(w[2] == "plain" and w[1] for w in wanted)
    # Names that clash are kept apart, and the text comes back.
    out = fill_in_middle(docs, rate=30, suffix_first=100).withColumn("back", restored())
    assert {r.form for r in out.collect()} == {"plain", "spm"}
    assert sorted(r.back for r in out.collect()) == sorted(r.text or "" for r in docs.collect())
    assert {r._kept.score for r in out.collect()} == {0.5}


def test_empty_table(spark):
    assert with_digests(fill_in_middle(documents(spark, []))).count() == 0
