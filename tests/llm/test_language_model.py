"""Scores against a dictionary of counts."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pytest
from samples import awkward_texts, documents

from martflow.llm.language_model import STRENGTH, score_texts
from martflow.llm.queries import op8_language_model

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = object()


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), END]


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def check(rows, got):
    count, pair = Counter(), Counter()
    for r in rows:
        if not is_held(r.doc_id):
            own = tokens(r.text)
            count.update(own)
            pair.update(zip([END, *own], own, strict=False))
    n, v = sum(count.values()), len(count)
    wanted = []
    for r in rows:
        own = tokens(r.text)
        p1 = [(count[w] + 0.5) / (n + 0.5 * (v + 1)) for w in own]
        p2 = [(pair[b, w] + STRENGTH * p) / (count[b] + STRENGTH) for b, w, p in zip([END, *own], own, p1, strict=False)]
        base, score = sum(map(math.log10, p1)), sum(map(math.log10, p2))
        wanted.append((r.doc_id, is_held(r.doc_id), len(own), sum(count[w] > 0 for w in own), n, base, score))
    assert len(got) == len(wanted)
    key = lambda t: (repr(t[:5]), t[5])
    for a, b in zip(sorted(wanted, key=key), sorted(map(tuple, got), key=key), strict=True):
        assert a[:5] == b[:5]
        assert b[5] == pytest.approx(a[5], rel=1e-9, abs=1e-9)
        # A step of the quantised values is 0.047.
        assert abs(a[6] - b[6]) <= 0.025 * a[2] + 1e-6
    return wanted


def test_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    wanted = check(rows, op8_language_model(spark, sf_dir).collect())
    held = [w for w in wanted if w[1]]
    assert sum(w[6] for w in held) > sum(w[5] for w in held)


def test_awkward_texts_and_many_parts(spark):
    docs = documents(spark, awkward_texts() + ["the of the of the of"] * 20)
    rows = docs.select("doc_id", "text").collect()
    check(rows, score_texts(docs).collect())
    # Many parts and shards, frequent words in several of them.
    check(rows, score_texts(docs.repartition(3), part_bytes=400).collect())


def test_empty_tables(spark):
    assert score_texts(documents(spark, [])).count() == 0
    held = documents(spark, ["a b", "c", "d", "a"]).filter("doc_id = 0")
    only = score_texts(held, held_bucket=zlib.crc32(b"0") % 5).collect()
    assert only[0].held_out and only[0].n_known == 0 and only[0].score == only[0].base_score == 0
