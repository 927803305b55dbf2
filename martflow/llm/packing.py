"""Best-fit packing of tokenised documents into sequences of a fixed length.

Pieces of one length are interchangeable, and so are sequences with one gap, so
best-fit needs no more than the number of pieces of each length. The rounds run
on the driver, over that histogram, which has at most as many lengths as a
sequence has tokens; no sweep is distributed, and as one round follows another
no two pieces compete for a gap. A round takes the longest length that is left
and the smallest gap that is large enough, fills it with the lower ranks of the
length, and lets the others go on to the next gap or open sequences. What a
round decides are ranges of ranks, and the table of all ranges is as small as
there are classes, whatever the number of documents. Tasks then look up every
piece's place in that table by its rank among the pieces of its length, which is
counted in blocks, so that no length meets in one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import batches_of_bytes, numbered, stored
from martflow.llm.tokens import ranks_encoder

SEQUENCE = 1024
END_ID = 2
BATCH_BYTES = 8 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _tokenizer(vocabulary, pattern: str, sequence: int, end_id: int, with_ids: bool):
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ranks_encoder(vocabulary.value, pattern)
        for batch in batches_of_bytes(batches, "text", BATCH_BYTES):
            ids, bounds = encoder.ids(batch.column("text"))
            ids = np.insert(ids.astype("<u4"), bounds[1:], end_id)
            bounds = bounds + np.arange(len(bounds))
            lengths = np.diff(bounds)
            count = -(-lengths // sequence)
            row = np.repeat(np.arange(len(lengths)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            # The first piece takes what whole sequences leave.
            stop = lengths[row] - (count[row] - 1 - piece) * sequence
            start = np.maximum(stop - sequence, 0)
            begin, end = bounds[row] + start, bounds[row] + stop
            data = memoryview(ids).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            columns = [
                batch.column("doc_id").take(pa.array(row)),
                pa.array(piece.astype(np.int32)),
                pa.array(start),
                pa.array(stop - start),
                pa.array(crc, type=pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return tokenise


def tokenised(
    docs: DataFrame,
    vocabulary: bytes,
    pattern: str,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of every row of ``docs``: doc_id, piece, start, length, ids_crc32, and ids if asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = PIECES + (", ids array<int>" if with_ids else "")
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_tokenizer(shared, pattern, sequence, end_id, with_ids), schema)


def best_fit(counts: dict[int, int], sequence: int) -> list[tuple[int, int, int, int, int]]:
    """Ranges (length, first rank, pieces, first sequence, offset), one piece in each sequence of a range."""
    gaps: list[int] = []  # those that some sequences have, sorted
    open_runs: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, how many)
    ranges = []
    sequences = 0

    def give(gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in open_runs:
                insort(gaps, gap)
            open_runs.setdefault(gap, []).append((first, many))

    for length in sorted((n for n in counts if counts[n]), reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                # The rest opens sequences, each for as many pieces as it holds.
                gap, first, many = sequence, sequences, -(-left // (sequence // length))
                sequences += many
            else:
                gap = gaps[at]
                first, many = open_runs[gap].pop()
                if not open_runs[gap]:
                    del open_runs[gap]
                    gaps.pop(at)
            taken = min(many, left)
            ranges.append((length, rank, taken, first, sequence - gap))
            rank, left = rank + taken, left - taken
            give(gap - length, first, taken)
            give(gap, first + taken, many - taken)
    return ranges


def _placer(ranges):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ranges sorted by length and rank have one combined key.
        table = ranges.value
        keys = (table[:, 0] << 48) | table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 48) | rank, side="right") - 1
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array(table[at, 3] + rank - table[at, 1]),
                    pa.array(table[at, 4]),
                ],
                names=[*names, "sequence_id", "offset"],
            )

    return place


def pack_documents(
    docs: DataFrame,
    vocabulary: bytes,
    pattern: str,
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Packs every row of ``docs`` (doc_id, text) into sequences of at most ``sequence`` tokens.

    ``vocabulary`` and ``pattern`` are those of a byte-level BPE in rank form.
    A document's ids end with ``end_id``; only documents that are longer than a
    sequence are cut, the remainder first. Returns a row per piece with
    sequence_id, gapless from 0, and offset, gapless from 0 in each sequence;
    ``with_ids`` adds the ids themselves. A null or empty text is the end id
    alone; null ids and repeated rows are packed like others; an empty table
    gives an empty result; further columns are ignored.
    """
    spark = docs.sparkSession
    pieces = stored(tokenised(docs, vocabulary, pattern, sequence, end_id, with_ids), "pieces")
    # At most a row for each length.
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    table = np.array(sorted(best_fit(counts, sequence)), dtype=np.int64).reshape(-1, 5)
    ranked = numbered(pieces, ["length"], ["doc_id", "piece"], "rank")
    schema = f"{PIECES}{', ids array<int>' if with_ids else ''}, sequence_id long, offset long"
    return ranked.mapInArrow(_placer(spark.sparkContext.broadcast(table)), schema)
