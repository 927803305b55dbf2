"""Packing against the tokenizer and its own contract."""

from __future__ import annotations

import random
import struct
import zlib
from collections import Counter, defaultdict

from samples import awkward_texts, documents
from test_tokens import wanted  # noqa: F401

from martflow.llm.packing import best_fit, pack_documents
from martflow.llm.queries import PACKING_VOCABULARY, op4_best_fit, vocabulary


def check(rows, docs, wanted, sequence=1024):  # noqa: F811
    expected = Counter()
    for doc in docs:
        ids = [*wanted(doc.text), 2]
        cuts = [0, *range(len(ids) % sequence or sequence, len(ids) + 1, sequence)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            expected[(doc.doc_id, piece, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b])))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= sequence
    return held


def test_table(spark, sf_dir, wanted):  # noqa: F811
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = op4_best_fit(spark, sf_dir).collect()
    held = check(rows, docs, wanted)
    assert len(held) <= 1.02 * sum(r.length for r in rows) / 1024 + 1
    assert sorted(held) == list(range(len(held)))


def test_awkward_texts(spark, wanted):  # noqa: F811
    docs = documents(spark, awkward_texts())
    packed = pack_documents(docs, *vocabulary(PACKING_VOCABULARY), sequence=16, with_ids=True)
    rows = packed.collect()
    check(rows, docs.collect(), wanted, sequence=16)
    assert all(len(r.ids) == r.length for r in rows)


def test_ranges_equal_best_fit_one_by_one():
    pick = random.Random(2)
    for _ in range(30):
        lengths = sorted((pick.randint(1, 50) for _ in range(300)), reverse=True)
        gaps = []
        for n in lengths:
            fits = [g for g in gaps if g >= n]
            if fits:
                gaps.remove(min(fits))
                gaps.append(min(fits) - n)
            else:
                gaps.append(50 - n)
        ranges = best_fit(dict(Counter(lengths)), 50)
        assert len({first + k for _, _, many, first, _ in ranges for k in range(many)}) == len(gaps)


def test_empty_table(spark):
    assert pack_documents(documents(spark, []), *vocabulary(PACKING_VOCABULARY)).count() == 0
