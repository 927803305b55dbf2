"""Elias-Fano sequences and a two-level n-gram trie of them, queried in batches by numpy."""

from __future__ import annotations

import tempfile

import numpy as np

ONE, SIX, LAST = np.uint64(1), np.uint64(6), np.uint64(63)
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
# For every byte, the place of its k-th set bit.
BYTE_SELECT = np.array(
    [[([b for b in range(8) if byte >> b & 1] + [0] * 8)[k] for k in range(8)] for byte in range(256)], dtype=np.uint8
)


def _select(words: np.ndarray, before: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the ``wanted``-th set bits; ``before`` has the set bits before each word."""
    at = np.searchsorted(before, wanted, side="right") - 1
    word, left = words[at], wanted - before[at]
    place = np.zeros(len(wanted), dtype=np.int64)
    open_ = np.ones(len(wanted), dtype=bool)
    byte = np.zeros(len(wanted), dtype=np.int64)
    for k in range(8):
        piece = (word >> np.uint64(8 * k)).astype(np.uint8)
        count = np.bitwise_count(piece)
        here = open_ & (left < count)
        byte[here], place[here] = piece[here], 8 * k
        open_ &= ~here
        left = np.where(open_, left - count, left)
    return 64 * at + place + BYTE_SELECT[byte, np.minimum(left, 7)]


class EliasFano:
    """A non-decreasing sequence of integers in about two bits and log2(universe / n) each.

    Low bits are packed; high parts are written in unary into a bit vector, with
    the ones before each of its words counted.
    """

    def __init__(self, values: np.ndarray):
        values = values.astype(np.uint64)
        self.n = len(values)
        largest = int(values[-1]) if self.n else 0
        self.low_bits = max(0, (largest // max(self.n, 1)).bit_length() - 1)
        self.buckets = (largest >> self.low_bits) + 1
        bits = np.zeros(-(-(self.n + self.buckets + 1) // 64), dtype=np.uint64)
        places = (values >> np.uint64(self.low_bits)) + np.arange(self.n, dtype=np.uint64)
        np.bitwise_or.at(bits, (places >> SIX).astype(np.int64), ONE << (places & LAST))
        self.high = bits
        ones = np.bitwise_count(bits).astype(np.int64)
        self.ones = (np.cumsum(ones) - ones).astype(np.int64)
        self.low = np.zeros(self.n * self.low_bits // 64 + 2, dtype=np.uint64)
        if self.low_bits:
            low = values & ((ONE << np.uint64(self.low_bits)) - ONE)
            at = np.arange(self.n, dtype=np.uint64) * np.uint64(self.low_bits)
            word, shift = (at >> SIX).astype(np.int64), at & LAST
            np.bitwise_or.at(self.low, word, low << shift)
            spill = np.flatnonzero(shift + np.uint64(self.low_bits) > 64)
            np.bitwise_or.at(self.low, word[spill] + 1, low[spill] >> (np.uint64(64) - shift[spill]))

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(index), dtype=np.uint64)
        at = index.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> SIX).astype(np.int64), at & LAST
        # A shift by 64 in two steps, as one is undefined.
        value = (self.low[word] >> shift) | ((self.low[word + 1] << (LAST - shift)) << ONE)
        return value & ((ONE << np.uint64(self.low_bits)) - ONE)

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        high = _select(self.high, self.ones, index).astype(np.uint64) - index.astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self._low(index)

    def _bucket_start(self, bucket: np.ndarray) -> np.ndarray:
        """How many values lie in earlier buckets: the ones before the bucket's zero."""
        zeros = 64 * np.arange(len(self.ones), dtype=np.int64) - self.ones
        out = np.zeros(len(bucket), dtype=np.int64)
        later = bucket > 0
        wanted = bucket[later] - 1
        out[later] = _select(self.high ^ ALL, zeros, wanted) - wanted
        return out

    def successor(self, targets: np.ndarray) -> np.ndarray:
        """For each target the first index of a value that is not smaller; n if there is none."""
        targets = targets.astype(np.uint64)
        bucket = (targets >> np.uint64(self.low_bits)).astype(np.int64)
        inside = bucket < self.buckets
        first, last = np.full(len(targets), self.n), np.full(len(targets), self.n)
        if self.n:
            first[inside] = self._bucket_start(bucket[inside])
            last[inside] = self._bucket_start(bucket[inside] + 1)
        wanted = targets & ((ONE << np.uint64(self.low_bits)) - ONE)
        active = np.flatnonzero(first < last)
        while len(active):
            middle = (first[active] + last[active]) // 2
            smaller = self._low(middle) < wanted[active]
            first[active[smaller]] = middle[smaller] + 1
            last[active[~smaller]] = middle[~smaller]
            active = active[first[active] < last[active]]
        return first

    def find(self, targets: np.ndarray) -> np.ndarray:
        """The index of each target, -1 if it is not there."""
        at = self.successor(targets)
        there = at < self.n
        there[there] = self[at[there]] == targets[there].astype(np.uint64)
        return np.where(there, at, -1)


class Trie:
    """Contexts, and below each its followers with a code; all levels mapped from one file.

    Followers are numbers relative to their context: each context's are moved up
    by the last value before them, so the whole level is one increasing
    sequence. A lookup adds the same amount and searches the successor. Where a
    context's followers begin is a monotone sequence of pointers.
    """

    def __init__(self, contexts: np.ndarray, followers: np.ndarray, codes: np.ndarray):
        """``contexts`` and ``followers`` are sorted together; no pair repeats."""
        distinct, first = np.unique(contexts, return_index=True)
        pointers = np.append(first, len(contexts))
        ends = followers[pointers[1:] - 1].astype(np.int64) + 1 if len(distinct) else np.zeros(0, dtype=np.int64)
        base = np.concatenate([[0], np.cumsum(ends)])[: len(distinct)]
        self.levels = [
            EliasFano(distinct),
            EliasFano(pointers),
            EliasFano(followers + np.repeat(base, np.diff(pointers))),
        ]
        self.codes = codes
        self._map()

    def _map(self) -> None:
        """Moves all arrays into one file without a name and maps it, so that the system may page it out."""
        self.file = tempfile.TemporaryFile()
        slots = [(level, name) for level in self.levels for name in ("high", "ones", "low")] + [(self, "codes")]
        places = []
        for owner, name in slots:
            array = getattr(owner, name)
            self.file.seek(-self.file.tell() % 8, 1)
            places.append((owner, name, self.file.tell(), array.dtype, array.shape))
            self.file.write(array.tobytes())
        self.file.write(b"\0")
        self.file.flush()
        for owner, name, at, kind, shape in places:
            mapped = np.memmap(self.file, dtype=kind, mode="r", offset=at, shape=shape) if shape[0] else np.zeros(shape, kind)
            setattr(owner, name, mapped)

    def lookup(self, contexts: np.ndarray, followers: np.ndarray) -> np.ndarray:
        """The code of each pair, 0 if the trie does not have it."""
        out = np.zeros(len(contexts), dtype=self.codes.dtype)
        # Queries are sorted by context: each context is searched once.
        distinct, which = np.unique(contexts, return_inverse=True)
        level1, pointers, level2 = self.levels
        at = level1.find(distinct)
        begin, end, base = (np.zeros(len(distinct), dtype=np.int64) for _ in range(3))
        there = at >= 0
        begin[there], end[there] = pointers[at[there]].astype(np.int64), pointers[at[there] + 1].astype(np.int64)
        moved = there & (begin > 0)
        base[moved] = level2[begin[moved] - 1].astype(np.int64) + 1
        known = np.flatnonzero(there[which])
        own = which[known]
        found = level2.find(base[own] + followers[known])
        hit = (found >= begin[own]) & (found < end[own])
        out[known[hit]] = self.codes[found[hit]]
        return out
