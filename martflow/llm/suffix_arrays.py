"""Suffix arrays in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number, zeros past the end."""
    out = data.astype(np.uint64)
    for size in (1, 2, 4):
        ahead = np.zeros_like(out)
        ahead[:-size] = out[size:]
        out = (out << np.uint64(8 * size)) | ahead
    return out


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes of a byte array, and ``words_at`` of it.

    Suffixes are sorted by eight bytes first. Then every round sorts only the
    groups that are still tied, by the ranks of the suffixes as many bytes ahead
    as the ties agree on, which doubles that length. A suffix that ends before
    another one with the same bytes goes on sorts first.
    """
    n = len(data)
    words = words_at(data)
    # Zeros past the end do not equal zeros in the data: each of the last seven suffixes is a group of its own.
    length = np.minimum(n - np.arange(n), 8)
    tails = np.unique(words[max(n - 7, 0) :])
    if np.isin(words, tails).sum() > len(tails):
        order = np.lexsort((length, words))
    else:
        order = np.argsort(words)
    rank = np.full(n + 1, -1, dtype=np.int64)

    def groups(same: np.ndarray, places: np.ndarray) -> np.ndarray:
        first = np.concatenate([[True], ~same])
        return places[np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))]

    if n:
        same = (words[order[1:]] == words[order[:-1]]) & (length[order[1:]] == 8) & (length[order[:-1]] == 8)
        rank[order] = groups(same, np.arange(n))
    ahead, places = 8, np.arange(n)
    while True:
        heads = rank[order[places]]
        tied = np.zeros(len(places), dtype=bool)
        tied[1:] = heads[1:] == heads[:-1]
        tied[:-1] |= tied[1:]
        places = places[tied]
        if not len(places):
            return order, words
        own = order[places]
        # What is tied agrees on ``ahead`` bytes, so none of it ends before; at the end the rank is -1.
        keys = rank[own] * (n + 2) + rank[own + ahead] + 1
        by_key = np.argsort(keys)
        own, keys = own[by_key], keys[by_key]
        order[places] = own
        rank[own] = groups(keys[1:] == keys[:-1], places)
        ahead *= 2


def common_prefixes(data: np.ndarray, order: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each place in the suffix array, the bytes its suffix shares with the one before it.

    Kasai's order: going through the text, a suffix shares one byte less than
    its left neighbour if both are preceded by equal bytes. So only the others
    are compared, eight bytes at a time, and the rest is filled in.
    """
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    reducible = (at > 0) & (before > 0)
    reducible[reducible] = data[at[reducible] - 1] == data[before[reducible] - 1]
    # The left neighbour of a reducible suffix has the left neighbour of the other before it.
    reducible[1:] &= before[:-1] >= 0
    left = np.flatnonzero(~reducible & (before >= 0))
    shared = np.zeros(n, dtype=np.int64)
    limit = n - np.maximum(left, before[left])
    done = np.zeros(len(left), dtype=np.int64)
    active = np.flatnonzero(limit > 0)
    while len(active):
        a, b = left[active] + done[active], before[left[active]] + done[active]
        differ = words[a] ^ words[b]
        same = differ == 0
        # Leading zero bytes of the difference.
        top = differ[~same]
        zero = np.zeros(len(top), dtype=np.int64)
        for k in range(7, 0, -1):
            zero += top < (np.uint64(1) << np.uint64(8 * k))
        done[active[~same]] += zero
        active = active[same]
        done[active] += 8
        active = active[done[active] < limit[active]]
    shared[left] = np.minimum(done, limit)
    source = np.maximum.accumulate(np.where(reducible, 0, at))
    filled = np.where(reducible, shared[source] - (at - source), shared)
    return np.maximum(filled, 0)[order]
