"""The pipeline stage by stage against the plain versions of its operators."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
from samples import awkward_texts, documents
from test_decontaminate import expected as leaks
from test_decontaminate import windows_of
from test_near_duplicates import expected as classes
from test_packing import check as check_packing
from test_repeats import expected as repeats
from test_rules import expected as figures
from test_tokens import wanted  # noqa: F401

from martflow.llm.common import stored


def test_stages(spark, sf_dir, wanted):  # noqa: F811
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, schema = docs.columns, docs.dtypes
    outputs = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == columns and docs.dtypes == schema
        outputs.append(docs.collect())
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()

    # In so small a table no line is frequent: the base rules decide, and texts stay.
    kept = Counter((r.doc_id, r.text) for r in source if not figures(r.doc_id, r.text)[-1])
    assert Counter((r.doc_id, r.text) for r in outputs[0]) == kept

    by_class = classes(outputs[0])
    assert sorted(r.doc_id for r in outputs[1]) == sorted({c for _, c, _ in by_class})

    left = {doc_id: (size, gone) for doc_id, size, gone, _, _ in repeats(outputs[1], corpus_pipeline.REPEATED_BYTES)}
    before = {r.doc_id: r.text for r in outputs[1]}
    for r in outputs[2]:
        size, gone = left.pop(r.doc_id)
        assert len(r.text.encode()) <= size - gone and (gone or r.text == before[r.doc_id])
    assert all(gone for _, gone in left.values())

    windows = windows_of([tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()])
    clean = [r.doc_id for r in outputs[2] if not leaks(r.doc_id, r.text, windows)[-1]]
    assert sorted(r.doc_id for r in outputs[3]) == sorted(clean) and len(clean) < len(outputs[2])

    name, packing = corpus_pipeline.STAGES[-1]
    rows = packing(spark, docs, sf_dir).collect()
    check_packing(rows, outputs[3], wanted)
    whole = corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "ids_crc32").collect()
    assert sorted(whole) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)


def folder(spark, tmp_path, texts, items=("one two three four five six seven eight nine ten eleven", None, "")):
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(k, t) for k, t in enumerate(items)]
    spark.createDataFrame(rows, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def prose(k, n=80):
    return " ".join(f"w{k}x{j}" for j in range(n))


def staged(spark, sf_dir):
    docs, outputs = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns, kinds = docs.columns, docs.dtypes
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == columns and docs.dtypes == kinds
        outputs.append(docs.collect())
    return outputs


def test_awkward_rows_and_clashing_columns(spark, tmp_path):
    leak = prose(900) + " One, two three four five six seven eight nine ten eleven " + prose(901)
    long = " ".join(f"long{j}" for j in range(60_000))
    texts = awkward_texts() + [prose(1), prose(2), prose(2), prose(2) + " end", leak, long, "", None]
    sf_dir = folder(spark, tmp_path, texts)
    quality, near, repeated, clean = staged(spark, sf_dir)
    ids = lambda rows: sorted(r.doc_id for r in rows)
    n = len(awkward_texts())
    assert set(ids(quality)) >= {n, n + 1, n + 2, n + 3, n + 4, n + 5} and not {n + 6, n + 7} & set(ids(quality))
    # One of the three like texts is left, by the smallest id.
    assert {n + 1, n + 2, n + 3} & set(ids(near)) == {n + 1}
    assert n + 4 in ids(repeated) and n + 4 not in ids(clean) and {n, n + 1, n + 5} <= set(ids(clean))
    assert {r.kept for r in clean} == {"k"} and {r.score for r in clean} == {0.5}
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in packed} == set(ids(clean))


def test_lines_that_are_frequent_go(spark, tmp_path):
    footer = "All rights reserved by the people of this page"
    texts = [f"{prose(k)}\n{footer}" for k in range(30)]
    quality = staged(spark, folder(spark, tmp_path, texts))[0]
    assert len(quality) == 30
    # Two of the three sources have no null id in this sample; each keeps the line once.
    assert 1 <= sum(footer in r.text for r in quality) <= 3
    assert all(prose(k) in {r.text.removesuffix(footer).strip() for r in quality} for k in range(30))


@pytest.mark.parametrize("items", [("a b c",), ()])
def test_empty_tables(spark, tmp_path, items):
    sf_dir = folder(spark, tmp_path, [], items)
    assert [len(rows) for rows in staged(spark, sf_dir)] == [0, 0, 0, 0]
    assert corpus_pipeline.run(spark, sf_dir).count() == 0
