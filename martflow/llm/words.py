"""Words of a batch of texts as numpy arrays, split on bytes without a loop over words."""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from martflow.llm.common import LOWER_A_Z

LOWER = np.frombuffer(LOWER_A_Z, dtype=np.uint8)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: ``[^\x20\x09-\x0D]+``: everything but white space.
VISIBLE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, lower-case letters and all beyond ASCII.
ALPHANUMERIC = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after another, and each text's start and the end; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = pa.large_binary() if texts.type in (pa.large_string(), pa.large_binary()) else pa.binary()
    texts = pc.fill_null(texts.cast(kind), b"")
    _, offsets, data = texts.buffers()
    wide = np.int64 if kind == pa.large_binary() else np.int32
    bounds = np.frombuffer(offsets, dtype=wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """An Arrow array of byte strings that lie one after another in ``data``."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` over each text."""
    running = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=running[1:])
    return running[bounds[1:]] - running[bounds[:-1]]


class Words:
    """Runs of ``inside`` bytes of every text.

    starts, ends: byte positions; bounds: each text's first word, and the end;
    ids: a number for each word, equal for equal words of the batch.
    """

    def __init__(self, texts: pa.Array, inside: np.ndarray = VISIBLE, lower: bool = True):
        self.raw, self.text_bounds = text_buffers(texts)
        self.data = LOWER[self.raw] if lower else self.raw
        self.mask = inside[self.data]
        n = len(self.data)
        first = self.mask.copy()
        first[1:] &= ~self.mask[:-1]
        last = self.mask.copy()
        last[:-1] &= ~self.mask[1:]
        # A word ends with its text.
        edges = self.text_bounds[:-1][self.text_bounds[:-1] < n]
        first[edges] = self.mask[edges]
        edges = self.text_bounds[1:][self.text_bounds[1:] > 0] - 1
        last[edges] = self.mask[edges]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, self.text_bounds)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @cached_property
    def texts(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    @cached_property
    def _encoded(self) -> pa.DictionaryArray:
        return strings(self.data[self.mask], self.ends - self.starts).dictionary_encode()

    @property
    def ids(self) -> np.ndarray:
        return self._encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    @property
    def vocabulary(self) -> pa.Array:
        return self._encoded.dictionary

    @cached_property
    def vocabulary_hashes(self) -> np.ndarray:
        """64-bit hashes of the distinct words, the same in every batch."""
        digest = xxhash.xxh3_64_intdigest
        words = self.vocabulary.to_pylist()
        return np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers one to one."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ragged(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array: ``values`` cut at ``bounds``."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, type=kind))
