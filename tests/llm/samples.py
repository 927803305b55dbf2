"""Small documents with the cases that break things."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, text_hash long, shard int, score double"


def awkward_texts(seed: int = 5) -> list[str | None]:
    pick = random.Random(seed)
    vocabulary = ["alpha", "Beta", "GAMMA", "delta,", "épsilon", "zeta-eta", "42", "#tag", "日本", "of", "the", "<b>"]
    texts: list[str | None] = [None, "", " ", "\n", "\n\n  \n", "one", "A B\nA B\na b\n\nA B", "x " * 3000, "\U0001f600 ok"]
    for n in (1, 2, 3, 9, 10, 11, 60, 200, 4000):
        words = [pick.choice(vocabulary) for _ in range(n)]
        texts.append("".join(w + pick.choice([" ", " ", "\n", "\t", "  "]) for w in words))
    texts += [texts[-1], texts[-2], texts[-2]]
    return texts


def documents(spark, texts: list[str | None]):
    """With a null id, a repeated id, null columns and names that clash with results."""
    ids: list[int | None] = [*range(len(texts))]
    if len(ids) > 3:
        ids[1], ids[3] = None, 2
    sources = ["s0", "s1", None]
    rows = [(i, t, None, sources[k % 3], None, "k", 7, 3, 0.5) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, DOCS)


def rows_of(df, *columns: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
