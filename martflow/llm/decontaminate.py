"""Benchmark decontamination by a broadcast set of word windows.

The windows of the test items are ten consecutive words each, or the whole item
if it is shorter. Their words are numbered, their hashes sorted, and the index,
a few arrays, is broadcast; distinct items are taken in blocks of at most
``BLOCK_BYTES`` of text, and each block is a scan of its own that stores nothing
but its hits, so what is broadcast has a bound however large the benchmarks are.
A scan looks up every window of every document and verifies each hit word by
word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import batches_of_bytes, packed, stored, unpacked, with_rows
from martflow.llm.words import ALPHANUMERIC, Words, mixed, powers

WINDOW = 10
#: The driver may take so much to index a block of items, which takes up to so many times the items' text
#: (measured with words of three letters); what is broadcast is a quarter of it.
INDEX_BYTES, INDEX_TIMES = 256 << 20, 32
BLOCK_BYTES = INDEX_BYTES // INDEX_TIMES
BATCH_BYTES = 8 << 20
BASE = 0xD1B54A32D192ED03


class WindowIndex:
    """Sorted hashes of the distinct windows of some items, by length, with their words and items, all in arrays."""

    def __init__(self, items: pa.Table, window: int = WINDOW):
        """``items``: item_id (a name or null) and text."""
        words = Words(items.column("text"), ALPHANUMERIC)
        self.vocabulary, self.names = words.vocabulary, items.column("item_id").combine_chunks()
        self.ids = words.ids.astype(np.int32) if len(words) else np.zeros(0, dtype=np.int32)
        lengths = np.minimum(words.counts, window)
        self.bounds = words.bounds.astype(np.int32)
        self.by_length = []
        for n in np.unique(lengths[lengths > 0]).tolist():
            own = np.flatnonzero(lengths == n)
            windows = words.counts[own] - n + 1
            first = np.arange(windows.sum()) + np.repeat(words.bounds[own] - (np.cumsum(windows) - windows), windows)
            hashes = self.hashes([self.ids[first + k] for k in range(n)])
            order = np.argsort(hashes, kind="stable")
            hashes, first = hashes[order], first[order].astype(np.int32)
            del order
            same = hashes[1:] == hashes[:-1]
            for k in range(n):
                same &= self.ids[first[1:] + k] == self.ids[first[:-1] + k]
            start = np.flatnonzero(np.concatenate([[True], ~same]))
            self.by_length.append((n, hashes[start], first, np.append(start, len(first)).astype(np.int32)))

    def holders(self, places: np.ndarray) -> list[str]:
        """Names of the items that windows start in."""
        item = np.searchsorted(self.bounds, places, side="right") - 1
        return [name for name in self.names.take(pa.array(item)).to_pylist() if name is not None]

    @staticmethod
    def hashes(columns) -> np.ndarray:
        total = np.uint64(0)
        for power, column in zip(powers(BASE, len(columns)), columns, strict=True):
            total = total + power * (column.astype(np.uint64) + np.uint64(1))
        return mixed(np.atleast_1d(total))

    def matches(self, words: Words) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(first words, length, window numbers, places in items and their bounds by window number) of all verified hits."""
        known = pc.index_in(words.vocabulary, value_set=self.vocabulary)
        known = pc.fill_null(known, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = known[words.ids] if len(words) else np.zeros(0, dtype=np.int64)
        gaps = np.concatenate([[0], np.cumsum(ids < 0)])
        for n, hashes, places, bounds in self.by_length:
            if len(ids) < n:
                continue
            first = np.flatnonzero(gaps[n:] == gaps[: len(ids) - n + 1])
            first = first[words.texts[first] == words.texts[first + n - 1]]
            wanted = self.hashes([ids[first + k] for k in range(n)])
            low, high = np.searchsorted(hashes, wanted), np.searchsorted(hashes, wanted, side="right")
            # Windows with equal hashes are tried one after another.
            while (low < high).any():
                first, low, high = (x[low < high] for x in (first, low, high))
                same = np.ones(len(first), dtype=bool)
                for k in range(n):
                    same &= self.ids[places[bounds[low]] + k] == ids[first + k]
                yield first[same], n, low[same], places, bounds
                low = low + 1


def _scanner(index, clean: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of_bytes(batches, "text", BATCH_BYTES):
            words = Words(batch.column("text"), ALPHANUMERIC)
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            spans = batch.column("_spans")
            lengths = pc.list_value_length(spans).fill_null(0).to_numpy(zero_copy_only=False)
            flat = spans.flatten().to_numpy(zero_copy_only=False) + np.repeat(words.bounds[:-1], lengths)
            np.add.at(edge, flat[0::2], 1)
            np.add.at(edge, flat[1::2], -1)
            items = [set(x) for x in batch.column("_items").to_pylist()]
            for first, n, window, places, bounds in index.value.matches(words):
                np.add.at(edge, first, 1)
                np.add.at(edge, first + n, -1)
                for text, w in set(zip(words.texts[first].tolist(), window.tolist(), strict=True)):
                    items[text].update(index.value.holders(places[bounds[w] : bounds[w + 1]]))
            hit = np.zeros(len(words) + 2, dtype=bool)
            hit[1:-1] = np.cumsum(edge[:-1]) > 0
            # Runs of hit words; a text's last word ends its run.
            starts = np.flatnonzero(hit[1:-1] & (~hit[:-2] | np.isin(np.arange(len(words)), words.bounds)))
            ends = np.flatnonzero(hit[1:-1] & (~hit[2:] | np.isin(np.arange(1, len(words) + 1), words.bounds))) + 1
            texts = words.texts[starts]
            flat = np.stack([starts, ends], axis=1) - words.bounds[texts][:, None]
            cuts = np.searchsorted(starts, words.bounds) * 2
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns["_n_words"] = pa.array(words.counts.astype(np.int64))
            columns["_spans"] = pa.ListArray.from_arrays(
                pa.array(cuts.astype(np.int32)), pa.array(flat.ravel().astype(np.int32))
            )
            columns["_items"] = pa.array([sorted(x) for x in items], type=pa.list_(pa.string()))
            if clean and len(starts):
                columns["text"] = _cut(batch.column("text"), words, starts, ends, texts)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return scan


def _cut(texts: pa.Array, words: Words, starts: np.ndarray, ends: np.ndarray, owners: np.ndarray) -> pa.Array:
    out = texts.to_pylist()
    for row in np.unique(owners):
        whole = words.raw[words.text_bounds[row] : words.text_bounds[row + 1]].tobytes()
        kept, at = [], 0
        for k in np.flatnonzero(owners == row):
            kept.append(whole[at : words.starts[starts[k]] - words.text_bounds[row]])
            at = words.ends[ends[k] - 1] - words.text_bounds[row]
        out[row] = b"\n".join([*kept, whole[at:]]).decode()
    return pa.array(out, type=pa.string())


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: tuple[str, ...] = (),
    clean: bool = False,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the benchmark windows in it.

    Returns doc_id, the columns of ``keep``, n_words, n_hit (words inside a
    window's occurrence), n_items, items_sha256 (of the items' sorted ids),
    contaminated, spans (first and end word of every hit run, flat) and items.
    With ``clean`` and ``text`` in ``keep`` the hit spans are cut out of the
    text. Null texts have no words. Null items are ignored; items without an id
    hit words but are not listed; repeated items count once. Repeated rows are
    judged alike, and empty tables give empty or clean results.
    """
    spark = docs.sparkSession
    keep = tuple(c for c in keep if c != "doc_id")
    items = (
        benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).filter("text is not null").distinct()
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    held = dict.fromkeys(("doc_id", "text", *keep))

    def scanned(rows: DataFrame, block: int) -> DataFrame:
        # At most about block_bytes of text reach the driver at a time.
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()
        index = spark.sparkContext.broadcast(WindowIndex(own, window))
        return rows.mapInArrow(_scanner(index, clean and block == blocks - 1), rows.schema)

    nothing = [
        F.lit(0).cast("long").alias("_n_words"),
        F.array().cast("array<int>").alias("_spans"),
        F.array().cast("array<string>").alias("_items"),
    ]
    if blocks == 1:
        rows = scanned(docs.select(*held, *nothing), 0)
    else:
        # Texts are stored once; of each block but the last only the hits are.
        texts = with_rows(docs.select(*held), "texts")
        hits = [
            stored(scanned(texts.select("row", "text", *nothing), k).filter("size(_spans) > 0").drop("text"), "hits")
            for k in range(blocks - 1)
        ]
        merged = reduce(DataFrame.unionByName, hits).groupBy("row").agg(
            F.flatten(F.collect_list("_spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("_items"))).alias("items")
        )
        found = texts.join(stored(merged, "hits").withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left")
        carried = [F.coalesce("spans", nothing[1]).alias("_spans"), F.coalesce("items", nothing[2]).alias("_items")]
        rows = scanned(found.select(*held, nothing[0], *carried), blocks - 1)
    n_hit = F.expr("aggregate(sequence(0, size(_spans) div 2 - 1), 0L, (s, i) -> s + _spans[2 * i + 1] - _spans[2 * i])")
    n_hit = F.when(F.size("_spans") > 0, n_hit).otherwise(F.lit(0).cast("long"))
    return rows.select(
        "doc_id",
        *keep,
        F.col("_n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.size("_spans") > 0).alias("contaminated"),
        F.col("_spans").alias("spans"),
        F.col("_items").alias("items"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with the hit spans cut out.

    All columns are kept, whatever their names. A null text holds no window and
    stays; of repeated rows all stay or all go. Without documents or items
    nothing is removed.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove documents or spans, not {remove}")
    rows = packed(docs, "doc_id", "text")
    found = find_leaks(rows, benchmark, keep=("text", "_kept"), clean=remove == "spans")
    if remove == "documents":
        found = found.filter(~F.col("contaminated"))
    return unpacked(found, docs.columns, "doc_id", "text")
