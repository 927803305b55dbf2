"""Quality rules against a plain computation."""

from __future__ import annotations

import re
from collections import Counter

from samples import awkward_texts, documents, rows_of

from martflow.llm.queries import op10_quality_rules
from martflow.llm.rules import apply_rules, quality_rules

FIGURES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def expected(doc_id, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (doc_id, len(words), sum(map(len, words)), symbols, dup, len(covered), failed)


def test_figures_of_awkward_texts(spark):
    docs = documents(spark, awkward_texts())
    wanted = sorted((expected(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert rows_of(quality_rules(docs), *FIGURES) == wanted


def test_figures_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wanted = sorted((expected(r.doc_id, r.text) for r in docs.collect()), key=repr)
    got = op10_quality_rules(spark, sf_dir)
    assert rows_of(got, *FIGURES) == wanted
    assert got.filter("kept and base_failed").count() == 0
    assert got.filter("kept").count() > 0.5 * len(wanted)


def body(k: int, n: int = 60) -> str:
    return " ".join(f"word{k}x{i}" for i in range(n))


def test_frequent_lines(spark):
    shared = " ".join(f"menu{i}" for i in range(100))
    # Ten texts of one host hold the line; two of them little else. Another host holds it twice.
    texts = [f"{body(k)}\n{shared.upper() if k % 2 else shared}" for k in range(8)]
    texts += [f"a few words {k}\n  {shared}" for k in (8, 9)]
    rows = [(k, t, None, "h", None, "", 0, 0, 0.0) for k, t in enumerate(texts)]
    rows += [(20 + k, f"{body(20 + k)}\n{shared}", None, None, None, "", 0, 0, 0.0) for k in range(2)]
    rows += [(30 + k, texts[0], None, "h", None, "", 0, 0, 0.0) for k in range(30)]
    from samples import DOCS

    docs = spark.createDataFrame(rows, DOCS)
    settings = {"line_texts": 5, "line_share": 0.1, "least_left": 0.3}
    got = {r.doc_id: r for r in quality_rules(docs, **settings).collect()}
    left = {k: got[k].n_words_left for k in got}
    assert all(left[k] in (60, 160) for k in range(8)) and left[20] == left[21] == 160
    # One text keeps the line whatever its copies.
    texts_with_line = {t: left[k] for k, t in enumerate(texts)}
    assert sum(n > 100 for n in texts_with_line.values()) == 1
    assert sum(not got[k].kept for k in (8, 9)) >= 1
    assert len(got) == len(rows)

    kept = {r.doc_id: r for r in apply_rules(docs, **settings).collect()}
    assert set(kept) == {k for k in got if got[k].kept}
    for k in range(8):
        assert ("menu7" in kept[k].text.lower()) == (left[k] > 100)
        assert body(k) in kept[k].text and kept[k].kept == ""
    assert apply_rules(docs, **settings).columns == docs.columns


def test_production_limit_is_one_for_hosts_of_all_sizes(spark):
    from samples import DOCS

    menu = " ".join(f"menu{i}" for i in range(100))
    rows, ids = [], iter(range(10_000))

    def add(host, text, times=1):
        rows.extend((next(ids), text, None, host, None, "", 0, 0, 0.0) for _ in range(times))

    for k in range(8):  # every page of a small host
        add("small", f"{body(k)}\n{menu}")
    for k in range(1200):  # under 1 % of a larger one
        add("large", f"{body(k)}\n{menu}" if k < 8 else body(k))
    for k in range(6):
        add("rare", f"{body(k)}\n{menu}")
    add("copies", f"{body(0)}\n{menu}", 6)  # copies are documents
    add("copies", f"{body(1)}\n{menu}")
    rows += [(9_999, f"{body(k // 6)}\n{menu}", None, "again", None, "", 0, 0, 0.0) for k in range(12)]
    for host in ("small", "large"):
        for k in (100, 101):  # little else: rejected, but for the one that keeps the line
            add(host, f"a few words {k}\n{menu}")
    docs = spark.createDataFrame(rows, DOCS)
    got = quality_rules(docs).collect()
    left = {h: Counter(r.n_words_left for r in got if r.host == h and r.n_words > 60) for h in ("small", "large", "rare", "copies", "again")}
    for host in ("small", "large"):
        assert sum(n for words, n in left[host].items() if words > 100) == 1
        assert sum(not r.kept for r in got if r.host == host) >= 1
    assert left["rare"] == {160: 6} and left["again"] == {160: 12}
    assert left["copies"] in ({60: 1, 160: 6}, {60: 6, 160: 1})


def test_empty_table(spark):
    docs = documents(spark, [])
    assert quality_rules(docs).count() == 0 and apply_rules(docs).count() == 0
