"""Hard negatives against plain inner products."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import rows_of

from martflow.llm.hard_negatives import bit_planes, mine_hard_negatives, scores, subset_sums
from martflow.llm.queries import op13_four_russians

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
VECTORS = "vec_id long, embedding array<float>, label int, row long, anchor string, positive_score double"


def whole(rows):
    return [
        (r.vec_id, r.label, [math.floor(256 * float(x)) for x in r.embedding])
        for r in rows
        if None not in (r.vec_id, r.label, r.embedding) and all(x is not None and math.isfinite(x) for x in r.embedding)
    ]


def expected(rows, anchor=50, positives=5, negatives=3):
    out, rows = [], whole(rows)
    for k, (a, label, own) in enumerate(rows):
        if a % anchor:
            continue
        scored = [(-sum(x * y for x, y in zip(own, v, strict=False)), i, la) for m, (i, la, v) in enumerate(rows) if m != k]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:positives]:
            fit = sorted(s for s in scored if s[2] != label and -50 * p <= -100 * s[0] <= -95 * p)[:negatives]
            out += [(a, positive, r + 1, i, -p, -s) for r, (s, i, _) in enumerate(fit)]
    return sorted(out, key=repr)


def relabelled(rows):
    return [type("R", (), dict(vec_id=r.vec_id, embedding=r.embedding, label=(r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)) for r in rows]


def test_scores():
    pick = np.random.default_rng(3)
    for most in (1, 300, 5000):
        a, c = pick.integers(-most, most + 1, (7, 24)), pick.integers(-most, most + 1, (50, 24))
        assert (scores(subset_sums(a), bit_planes(c)) == c @ a.T).all()


def test_table(spark, sf_dir):
    rows = relabelled(spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect())
    wanted = expected(rows)
    assert rows_of(op13_four_russians(spark, sf_dir), *COLUMNS) == wanted and wanted


def awkward(spark):
    pick = random.Random(4)
    rows = []
    for k in range(260):
        base = [pick.choice([-1.0, 0.5, 1.0, 0.25]) for _ in range(11)] if k % 3 else [0.5] * 11
        rows.append((k % 200, base, pick.choice([0, 0, 0, 1, 2]), None, "x", 0.5))
    rows += rows[:3]
    nan, inf = float("nan"), float("inf")
    rows += [(None, [1.0] * 11, 0), (50, None, 0), (50, [1.0] * 11, None), (1, [nan] * 11, 1), (2, [inf] + [1.0] * 10, 1), (3, [None, 1.0], 1)]
    rows += [(300, [], 0), (350, [1.0], 1), (400, [1.0] * 17, 0), (-50, [0.3] * 11, 2), (7, [-1.0] * 11, 9)]
    return spark.createDataFrame([(*r, None, "x", 0.5)[:6] for r in rows], VECTORS)


@pytest.mark.parametrize("block_rows", [65_536, 3])
def test_awkward_vectors(spark, block_rows):
    vectors = awkward(spark)
    wanted = expected(vectors.collect())
    found = mine_hard_negatives(vectors, F.col("vec_id") % 50 == 0, block_rows=block_rows)
    assert rows_of(found, *COLUMNS) == wanted and wanted


def test_too_large_components(spark):
    vectors = spark.createDataFrame([(0, [1e9], 0), (1, [1e9], 0), (2, [1e9], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="too large"):
        mine_hard_negatives(vectors, F.col("vec_id") == 0).collect()


def test_empty_table(spark):
    vectors = spark.createDataFrame([], VECTORS)
    assert mine_hard_negatives(vectors, F.col("vec_id") % 50 == 0).count() == 0
