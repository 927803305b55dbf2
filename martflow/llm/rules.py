"""Quality rules with line frequencies across documents.

One pass over the texts yields each document's rule figures and the hashes of
its normalised lines (words lower-cased, white space squeezed). From then on
only hashes move: lines are counted by the distinct documents of a host that
hold them, folded to a row per text and then to one per line before anything is
compared. A line in more documents than the limit goes from all texts but one,
the text with the smallest hash, so that nothing that is repeated is lost
entirely. A document with too few words left is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import batches_of_bytes, packed, stored, unpacked
from martflow.llm.words import VISIBLE, Words, byte_class, mixed, per_text, powers, ragged, strings

MIN_WORDS = 50
MOST_REPEATED = 50  # percent of the words
#: A line is frequent above this many documents of a host, whatever the host's size.
LINE_TEXTS = 6
#: A share of the host's documents that a line has to pass too; none in production.
LINE_SHARE = 0.0
#: A document is depleted below MIN_WORDS or this share of its words.
LEAST_LEFT = 0.3
SYMBOLS = byte_class(*[(ord(c), ord(c)) for c in "#*$%&|<>"])
NEWLINE = 0x0A
BATCH_BYTES = 8 << 20
LINE_BASE = 0x9E3779B97F4A7C15

FIGURES = (
    "doc_id long, host string, text_hash long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, lines array<long>, line_words array<int>"
)


def repeated_words(words: Words) -> np.ndarray:
    """Whether each word lies in a three-word window that its text has twice or more."""
    n = len(words)
    covered = np.zeros(n, dtype=bool)
    if n < 3:
        return covered
    ids, texts = words.ids, words.texts
    size = len(words.vocabulary)
    pairs = ids[:-1] * size + ids[1:]
    if size**3 >= 1 << 62:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * size + ids[2:]
    inside = np.flatnonzero(texts[:-2] == texts[2:])
    windows, texts = windows[inside], texts[inside]
    order = np.argsort(windows, kind="stable")
    same = (windows[order[1:]] == windows[order[:-1]]) & (texts[order[1:]] == texts[order[:-1]])
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    for k in range(3):
        covered[inside[twice] + k] = True
    return covered


class Lines:
    """Lines of every text that hold a word."""

    def __init__(self, words: Words):
        breaks = np.flatnonzero(words.raw == NEWLINE)
        first_bytes = np.union1d(words.text_bounds[:-1], breaks + 1)
        # Texts and the lines of texts begin where a number of words have begun before.
        line = np.searchsorted(first_bytes, words.starts, side="right")
        self.first_words = np.flatnonzero(np.diff(line, prepend=-1)) if len(words) else np.zeros(0, dtype=np.int64)
        self.n_words = np.diff(self.first_words, append=len(words))
        self.bounds = np.searchsorted(self.first_words, words.bounds)
        self.start_bytes = first_bytes[line[self.first_words] - 1] if len(words) else self.first_words
        ends = np.concatenate([first_bytes[1:], [len(words.raw)]])
        self.end_bytes = ends[line[self.first_words] - 1] if len(words) else self.first_words

    def normal_hashes(self, words: Words) -> np.ndarray:
        if not len(words):
            return np.zeros(0, dtype=np.int64)
        place = np.arange(len(words)) - np.repeat(self.first_words, self.n_words)
        terms = words.vocabulary_hashes[words.ids] * powers(LINE_BASE, int(self.n_words.max()))[place]
        return mixed(np.add.reduceat(terms, self.first_words)).view(np.int64)

    def repeats(self, words: Words) -> np.ndarray:
        """For each text, the lines that equal an earlier line byte for byte."""
        stops = self.end_bytes - (words.raw[np.maximum(self.end_bytes, 1) - 1] == NEWLINE) if len(words) else self.end_bytes
        lengths = stops - self.start_bytes
        inside = np.zeros(len(words.raw) + 1, dtype=np.int8)
        np.add.at(inside, self.start_bytes, 1)
        np.add.at(inside, stops, -1)
        kept = words.raw[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        ids = strings(kept, lengths).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        texts = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        first = np.unique(texts * (len(ids) + 1) + ids, return_index=True)[1]
        again = np.ones(len(ids), dtype=bool)
        again[first] = False
        return per_text(again, self.bounds)


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_of_bytes(batches, "text", BATCH_BYTES):
        words = Words(batch.column("text"), VISIBLE)
        exact = Words(batch.column("text"), VISIBLE, lower=False)
        lines = Lines(words)
        hashes = lines.normal_hashes(words)
        code_points = (words.raw & 0xC0) != 0x80
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                batch.column("host"),
                batch.column("text_hash"),
                pa.array(words.counts.astype(np.int64)),
                pa.array(per_text(code_points & words.mask, words.text_bounds)),
                pa.array(per_text(SYMBOLS[words.raw], words.text_bounds)),
                pa.array(lines.repeats(words)),
                pa.array(per_text(repeated_words(exact), exact.bounds)),
                ragged(hashes, lines.bounds, pa.int64()),
                ragged(lines.n_words.astype(np.int32), lines.bounds, pa.int32()),
            ],
            names=[f.split()[0] for f in FIGURES.split(", ")],
        )


def _input(docs: DataFrame, host: str) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"),
        F.col(host).cast("string").alias("host"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        "text",
    )


def figures(docs: DataFrame, host: str = "source") -> DataFrame:
    """Rule figures and line hashes of every row, written to the shared folder."""
    return stored(_input(docs, host).mapInArrow(_figures, FIGURES), "figures")


def lines_to_remove(
    figures: DataFrame, line_texts: int = LINE_TEXTS, line_share: float = LINE_SHARE
) -> DataFrame:
    """(host, text_hash, removed, removed_words): what goes from each text with frequent lines.

    A line is frequent in more than ``line_texts`` documents of its host and,
    if a share is given, more than ``line_share`` of them.
    """
    # A document is an id with a text; rows without an id are documents each.
    documents = (
        figures.groupBy("host", "text_hash", "doc_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy(F.col("host").alias("d_host"), F.col("text_hash").alias("d_hash"))
        .agg(F.sum(F.when(F.col("doc_id").isNull(), F.col("rows")).otherwise(F.lit(1))).alias("documents"))
    )
    texts = figures.dropDuplicates(["host", "text_hash"]).join(
        documents, F.col("host").eqNullSafe(F.col("d_host")) & (F.col("text_hash") == F.col("d_hash"))
    )
    once = (
        texts.select("host", "text_hash", "documents", F.inline(F.arrays_zip("lines", "line_words")))
        .groupBy("host", F.col("lines").alias("line"), "text_hash")
        .agg(F.sum("line_words").alias("words"), F.first("documents").alias("documents"))
    )
    # A line of a single text has its keeper only.
    counted = (
        once.groupBy("host", "line")
        .agg(F.sum("documents").alias("documents"), F.min("text_hash").alias("keeper"), F.max("text_hash").alias("last"))
        .filter((F.col("documents") > line_texts) & (F.col("keeper") != F.col("last")))
    )
    if line_share:
        limits = documents.groupBy("d_host").agg((F.sum("documents") * F.lit(line_share)).alias("limit"))
        counted = counted.join(limits, F.col("host").eqNullSafe(F.col("d_host"))).filter(
            F.col("documents") > F.col("limit")
        )
    frequent = counted.select(F.col("host").alias("f_host"), F.col("line").alias("f_line"), "keeper")
    return (
        once.join(
            frequent,
            F.col("host").eqNullSafe(F.col("f_host"))
            & (F.col("line") == F.col("f_line"))
            & (F.col("text_hash") != F.col("keeper")),
        )
        .groupBy("host", "text_hash")
        .agg(F.collect_set("line").alias("removed"), F.sum("words").cast("long").alias("removed_words"))
    )


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    line_texts: int = LINE_TEXTS,
    line_share: float = LINE_SHARE,
    least_left: float = LEAST_LEFT,
) -> DataFrame:
    """Every row's rule figures and verdict.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_words_left, text_hash, host and
    removed (the hashes of the lines that go). Base rules fail a row below
    ``MIN_WORDS`` words or with over half of its words in repeated three-word
    windows. Else it is kept unless the frequent lines of its host leave fewer
    than ``MIN_WORDS`` words or ``least_left`` of them. Null and empty texts
    have no words and fail; a null host is a host of its own; repeated rows are
    judged alike; null ids stay; an empty table gives an empty result; further
    columns are ignored.
    """
    base = figures(docs, host)
    gone = lines_to_remove(base, line_texts, line_share)
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    depleted = (left < MIN_WORDS) | (left < F.lit(least_left) * F.col("n_words"))
    # Stored, so that the join is one of plain tables and a text with very many copies can be split.
    gone = stored(
        gone.select(F.col("host").alias("_host"), F.col("text_hash").alias("_hash"), "removed", "removed_words"),
        "frequent-lines",
    )
    return (
        base.drop("lines", "line_words")
        .join(gone, (F.col("text_hash") == F.col("_hash")) & F.col("host").eqNullSafe(F.col("_host")), "left")
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            failed.alias("base_failed"),
            (~failed & ~depleted).alias("kept"),
            left.alias("n_words_left"),
            "text_hash",
            "host",
            "removed",
        )
    )


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        touched = pc.list_value_length(batch.column("removed")).fill_null(0).to_numpy(zero_copy_only=False) > 0
        texts = batch.column("text")
        if touched.any():
            out = texts.to_pylist()
            for row in np.flatnonzero(touched):
                words = Words(texts.slice(row, 1))
                lines = Lines(words)
                gone = np.isin(lines.normal_hashes(words), np.array(batch.column("removed")[row].as_py(), dtype=np.int64))
                whole = words.raw.tobytes()
                kept, at = [], 0
                for start, end in zip(lines.start_bytes[gone], lines.end_bytes[gone], strict=True):
                    kept.append(whole[at:start])
                    at = end
                out[row] = b"".join([*kept, whole[at:]]).decode()
            texts = pa.array(out, type=pa.string())
        columns = [texts if n == "text" else batch.column(n) for n in batch.schema.names if n != "removed"]
        yield pa.RecordBatch.from_arrays(columns, names=[n for n in batch.schema.names if n != "removed"])


def apply_rules(docs: DataFrame, **settings) -> DataFrame:
    """The kept rows of ``docs`` with frequent lines taken out of their texts; columns as they were.

    Null, empty and very short texts fail the base rules and go. Repeated rows
    are judged alike and all stay or go; a null host is a host. Other columns
    are kept, whatever their names. An empty table stays empty.
    """
    host = settings.get("host", "source")
    verdicts = stored(
        quality_rules(docs, **settings)
        .filter("kept")
        .groupBy(F.col("text_hash").alias("_hash"), F.col("host").alias("_host"))
        .agg(F.first("removed").alias("removed")),
        "verdicts",
    )
    rows = packed(docs, "text").select(
        "*",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        F.col("_kept")[host].cast("string").alias("host"),
    )
    joined = rows.join(
        verdicts, (F.col("text_hash") == F.col("_hash")) & F.col("host").eqNullSafe(F.col("_host"))
    ).select("text", "_kept", "removed")
    schema = joined.drop("removed").schema
    return unpacked(joined.mapInArrow(_without_lines, schema), docs.columns, "text")
