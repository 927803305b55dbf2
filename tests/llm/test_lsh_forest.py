"""The forest's components against all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from samples import awkward_texts, documents, rows_of

import martflow.llm.lsh_forest as forest
from martflow.llm.lsh_forest import missed, near_dedup, without_near_copies
from martflow.llm.queries import op11_lsh_forest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "n_shingles", "component_id", "kept"]


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    n = min(3, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else frozenset()


def expected(rows):
    sets = [shingle_set(r.text) for r in rows]
    having = {}
    for k, own in enumerate(sets):
        for s in own:
            having.setdefault(s, []).append(k)
    label = list(range(len(rows)))

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for k, own in enumerate(sets):
        for o, both in Counter(o for s in own for o in having[s] if o > k).items():
            if 100 * both >= 85 * (len(own) + len(sets[o]) - both):
                label[root(o)] = root(k)
    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault(root(k), []).append(r.doc_id)
    out = []
    for k, r in enumerate(rows):
        least = min((i for i in groups[root(k)] if i is not None), default=None)
        out.append((r.doc_id, len(sets[k]), least, least is None or r.doc_id == least))
    return sorted([(i, n, c, bool(k)) for i, n, c, k in out], key=repr)


def copies(seed, number, words=100, changes=3, base=None):
    pick = random.Random(seed)
    base = base or [f"w{pick.randint(0, 5000)}" for _ in range(words)]
    out = []
    for _ in range(number):
        own = list(base)
        for _ in range(pick.randint(0, changes)):
            own[pick.randrange(len(own))] = f"x{pick.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


def saved(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/docs")
    return spark.read.parquet(f"{tmp_path}/docs")


def test_recall_of_the_settings():
    assert missed(0.85, forest.ORDERS, forest.DEPTH) < 1.3e-5
    assert missed(0.85, forest.ORDERS, forest.SHORTEST) < 3e-8


def test_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    wanted = expected(rows)
    assert rows_of(op11_lsh_forest(spark, sf_dir), *COLUMNS) == wanted
    assert any(i != c for i, _, c, _ in wanted)


@pytest.mark.parametrize("limits", [{}, {"region_bytes": 1500, "task_bytes": 4000}])
def test_awkward_texts_and_large_groups(spark, tmp_path, limits):
    # A chain, a star and pairs at the very threshold; the words in another order are another set.
    star = [f"w{k}" for k in range(200)]
    texts = awkward_texts() + copies(1, 40) + copies(2, 3) + copies(3, 30, changes=8, base=star) + copies(4, 200, words=40)
    texts += ["A b c", "a  B\tc", "a b c d", "a b", "A B", "b a", "x", " ".join(f"s{k}" for k in range(22))]
    texts += [" ".join(f"s{k}" for k in range(n)) for n in (18, 19, 20, 21, 25)]
    docs = saved(spark, documents(spark, texts), tmp_path)
    wanted = expected(docs.collect())
    assert rows_of(near_dedup(docs, **limits), *COLUMNS) == wanted
    kept = without_near_copies(docs, **limits)
    assert kept.columns == docs.columns
    assert kept.count() == near_dedup(docs).select("component_row").distinct().count()


def test_scans_that_are_packed_anew(spark, tmp_path, monkeypatch):
    docs = documents(spark, awkward_texts() + copies(5, 60)).repartition(7, "doc_id")
    docs = saved(spark, docs, tmp_path)
    store = forest.stored

    def changing(df, name, *args):
        out = store(df, name, *args)
        if name == "signatures":
            spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        return out

    monkeypatch.setattr(forest, "stored", changing)
    try:
        assert rows_of(near_dedup(docs), *COLUMNS) == expected(docs.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_empty_table(spark, tmp_path):
    docs = saved(spark, documents(spark, []), tmp_path)
    assert near_dedup(docs).count() == 0 and without_near_copies(docs).count() == 0
