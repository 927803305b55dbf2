"""Decontamination against a plain computation."""

from __future__ import annotations

import hashlib
import re

from samples import awkward_texts, documents, rows_of

from martflow.llm.decontaminate import decontaminate, find_leaks
from martflow.llm.queries import op3_decontaminate

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def windows_of(items):
    found = {}
    for item, text in items:
        own = words(text)
        n = min(10, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            found.setdefault(tuple(own[i : i + n]), set()).add(item)
    return found


def expected(doc_id, text, windows):
    own, hit, items = words(text), set(), set()
    lengths = {len(w) for w in windows}
    for i in range(len(own)):
        for n in lengths:
            w = tuple(own[i : i + n])
            if len(w) == n and w in windows:
                hit.update(range(i, i + n))
                items |= windows[w]
    items = sorted(str(i) for i in items if i is not None)
    return (doc_id, len(own), len(hit), len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), bool(hit))


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_awkward_texts(spark):
    texts = awkward_texts()
    long = texts[-4]
    items = [(1, None), (2, ""), (3, "ZETA eta"), (4, long[100:400]), (5, long[100:400]), (12, "of the of"), (4, "日本 42"), (None, "one")]
    docs = documents(spark, texts)
    windows = windows_of(items)
    wanted = sorted((expected(r.doc_id, r.text, windows) for r in docs.collect()), key=repr)
    assert rows_of(find_leaks(docs, bench(spark, items)), *COLUMNS) == wanted
    # Several blocks of items give the same.
    assert rows_of(find_leaks(docs, bench(spark, items), block_bytes=64), *COLUMNS) == wanted


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    windows = windows_of([tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()])
    wanted = sorted((expected(r.doc_id, r.text, windows) for r in docs.collect()), key=repr)
    assert rows_of(op3_decontaminate(spark, sf_dir), *COLUMNS) == wanted
    assert any(w[-1] for w in wanted)


def test_removal(spark):
    passage = "the quick brown fox jumps over the lazy dog again and again"
    texts = [f"Before it: {passage.upper()}! After it.", "clean text", None, f"{passage}", "clean text"]
    docs = documents(spark, texts)
    items = bench(spark, [(1, passage)])
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert rows_of(kept, "text") == rows_of(docs.filter("text is null or text = 'clean text'"), "text")
    cut = decontaminate(docs, items, remove="spans")
    assert rows_of(cut, "text") == sorted([("Before it: \n! After it.",), ("clean text",), (None,), ("\n",), ("clean text",)], key=repr)


def test_empty_tables(spark):
    docs, none = documents(spark, []), bench(spark, [])
    assert find_leaks(docs, bench(spark, [(1, "a b")])).count() == 0
    full = documents(spark, awkward_texts())
    assert find_leaks(full, none).filter("contaminated or n_items > 0").count() == 0
    assert decontaminate(full, none).count() == full.count()


def test_index_is_small(monkeypatch):
    import pickle
    import random
    import tracemalloc

    import pyarrow as pa

    from martflow.llm.decontaminate import INDEX_TIMES, WindowIndex

    pick = random.Random(1)
    texts = [" ".join(f"w{int(pick.paretovariate(0.7)) % 50_000}" for _ in range(100)) for _ in range(8000)]
    items = pa.table({"item_id": [str(k) for k in range(len(texts))], "text": texts})
    size = sum(map(len, texts))
    tracemalloc.start()
    index = WindowIndex(items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    print(f"{size} bytes of text, peak {peak / size:.1f} times, sent {len(pickle.dumps(index)) / size:.1f} times")
    assert len(pickle.dumps(index)) < INDEX_TIMES / 4 * size and peak < INDEX_TIMES * size
