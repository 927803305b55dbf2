"""Suffix arrays and common prefixes against sorting."""

from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from martflow.llm.suffix_arrays import common_prefixes, suffix_array


def check(data: bytes):
    array = np.frombuffer(data, dtype=np.uint8)
    order, words = suffix_array(array)
    wanted = sorted(range(len(data)), key=lambda i: data[i:])
    assert order.tolist() == wanted
    shared = common_prefixes(array, order, words).tolist()
    for k, (a, b) in enumerate(zip(wanted, wanted[1:], strict=False), 1):
        n = 0
        while max(a, b) + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        assert shared[k] == n


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"\x00", b"a", b"ab", b"abcabcabcabc", b"\xff", b"\x00\x00"]), max_size=60).map(b"".join))
def test_small(data):
    check(data)


def test_repetitive():
    for data in (b"", b"x", b"a" * 500, b"\x00" * 300, b"abcdefghij" * 80, b"ab" * 100 + b"\xff" + b"ab" * 120):
        check(data)
    pick = np.random.default_rng(1)
    base = pick.integers(97, 101, 400, dtype=np.uint8).tobytes()
    check(b"\xff".join([base, base[50:300], base, base[:200] + b"z" + base[200:]]))
