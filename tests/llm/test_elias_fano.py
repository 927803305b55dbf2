"""Elias-Fano sequences and tries against plain searches."""

from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from martflow.llm.elias_fano import EliasFano, Trie


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1 << 40) | st.integers(0, 60), max_size=80), st.lists(st.integers(0, 1 << 41), max_size=20))
def test_sequence(values, targets):
    values = np.array(sorted(values), dtype=np.int64)
    targets = np.array([*targets, *values, *(values + 1), 0], dtype=np.int64)
    sequence = EliasFano(values)
    assert (sequence[np.arange(len(values))] == values.astype(np.uint64)).all()
    assert (sequence.successor(targets) == np.searchsorted(values, targets)).all()


def test_trie():
    pick = np.random.default_rng(3)
    pairs = np.unique(pick.integers(0, 300, (5000, 2)) ** 2, axis=0)
    codes = pick.integers(1, 255, len(pairs)).astype(np.uint8)
    trie = Trie(pairs[:, 0], pairs[:, 1], codes)
    known = {tuple(p): c for p, c in zip(pairs.tolist(), codes.tolist(), strict=True)}
    asked = np.concatenate([pairs, pick.integers(0, 90_000, (3000, 2)), pairs[:, ::-1]])
    got = trie.lookup(asked[:, 0], asked[:, 1])
    assert got.tolist() == [known.get(tuple(p), 0) for p in asked.tolist()]
    none = np.zeros(0, dtype=np.int64)
    assert Trie(none, none, none.astype(np.uint8)).lookup(np.array([1]), np.array([2])).tolist() == [0]
