"""Toxicity by a factorization machine over hashed terms.

Terms are a text's words and the beginnings of its words, hashed into a fixed
space. A chi-square test over the training texts, counted by Spark, leaves out
the terms that are as frequent with either label. The machine gives a term a
weight and a short vector; a text's score adds the weights of its terms and the
products of all pairs of vectors, so that terms which matter together, such as
an insult with the mention of a group or several words of one stem, count beyond
what each adds. Weights start at zero and decay, so what pairs explain is left
to the vectors.

Training takes at most ``SAMPLE_ROWS`` labelled rows, those whose ids hash
lowest, and at most ``MOST_TERMS`` terms: both bound what is broadcast and what
the driver fits. Scoring reads whole texts of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import batches_of_bytes, held_in, stored
from martflow.llm.words import ALPHANUMERIC, Words, ragged

SAMPLE_ROWS = 20_000
#: The sample's texts have fewer such terms by far; it bounds what the driver holds of any other sample.
MOST_TERMS = 1 << 16
SPACE_BITS = 24
PREFIXES = (4, 5, 6, 7, 8)
LEAST_TEXTS = 5
#: Low enough for terms that tell in company only; by chance alone one in 600 is above.
LEAST_CHI_SQUARE = 10.0
FACTORS = 8
STEPS = 4000
STEP_ROWS = 256
#: These, the prefixes and the limit above caught most of ten settings on a fifth of the training rows (see README).
WEIGHT_DECAY, FACTOR_DECAY, FIRST_FACTORS = 1e-4, 3e-4, 0.1
BATCH_BYTES = 8 << 20


def term_table(words: Words) -> np.ndarray:
    """Hashed terms of each distinct word: the word and its beginnings; -1 where it is too short."""
    digest = xxhash.xxh3_64_intdigest
    mask = (1 << SPACE_BITS) - 1
    table = [
        [digest(b"=" + w) & mask, *[digest(b"^" + w[:n]) & mask if len(w) >= n else -1 for n in PREFIXES]]
        for w in words.vocabulary.to_pylist()
    ]
    return np.array(table, dtype=np.int64).reshape(-1, 1 + len(PREFIXES))


def _distinct(rows: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(rows * size + values)
    return keys // size, keys % size


def text_terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) pairs of a batch, each once."""
    table = term_table(words)
    texts, ids = _distinct(words.texts, words.ids, max(len(table), 1))
    terms = table[ids]
    texts = np.repeat(texts, terms.shape[1])
    terms = terms.ravel()
    return _distinct(texts[terms >= 0], terms[terms >= 0], 1 << SPACE_BITS)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_of_bytes(batches, "text", BATCH_BYTES):
        texts, terms = text_terms(Words(batch.column("text"), ALPHANUMERIC))
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        found, at = np.unique(terms, return_inverse=True)
        ones = np.bincount(at, weights=toxic[texts], minlength=len(found)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(np.bincount(at, minlength=len(found)).astype(np.int64)), pa.array(ones)],
            names=["term", "texts", "toxic"],
        )


def features(words: Words, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place among the sorted ``terms``) pairs of a batch, each once."""
    table = term_table(words)
    place = np.searchsorted(terms, table)
    known = (place < len(terms)) & (terms[np.minimum(place, len(terms) - 1)] == table) if len(terms) else table < -1
    useful = known.any(axis=1)[words.ids] if len(words) else np.zeros(0, dtype=bool)
    texts, ids = words.texts[useful], words.ids[useful]
    width = table.shape[1]
    pairs = known[ids].ravel()
    return _distinct(np.repeat(texts, width)[pairs], place[ids].ravel()[pairs], max(len(terms), 1))


@dataclass
class Machine:
    """Weights of a factorization machine over sorted hashed terms."""

    terms: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, texts: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
        out = np.full(n, self.bias) + np.bincount(texts, weights=self.weights[places], minlength=n)
        for k in range(self.factors.shape[1]):
            v = self.factors[places, k]
            total = np.bincount(texts, weights=v, minlength=n)
            out += 0.5 * (total**2 - np.bincount(texts, weights=v**2, minlength=n))
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(
    terms: np.ndarray,
    texts: np.ndarray,
    places: np.ndarray,
    labels: np.ndarray,
    steps: int = STEPS,
    seed: int = 7,
) -> Machine:
    """Logistic loss, Adam on small batches. ``texts`` is sorted."""
    n, m = len(labels), len(terms)
    rate = (labels.sum() + 0.5) / (n + 2)
    machine = Machine(terms, float(np.log(rate / (1 - rate))), np.zeros(m), np.zeros((m, FACTORS)))
    if not n or not m:
        return machine
    machine.factors = np.random.default_rng(seed).normal(0, FIRST_FACTORS, (m, FACTORS))
    pick = np.random.default_rng(seed)
    bounds = np.searchsorted(texts, np.arange(n + 1))
    parameters = [np.array([machine.bias]), machine.weights, machine.factors]
    means = [np.zeros_like(p) for p in parameters]
    squares = [np.zeros_like(p) for p in parameters]
    queue = np.zeros(0, dtype=np.int64)
    for step in range(1, steps + 1):
        if not len(queue):
            queue = pick.permutation(n)
        rows, queue = queue[:STEP_ROWS], queue[STEP_ROWS:]
        sizes = bounds[rows + 1] - bounds[rows]
        at = np.repeat(bounds[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        own, place = np.repeat(np.arange(len(rows)), sizes), places[at]
        error = (sigmoid(machine.logits(own, place, len(rows))) - labels[rows]) / len(rows)
        # A sum over no terms at all would be of integers.
        linear = np.bincount(place, weights=error[own], minlength=m).astype(float)
        grads = [np.array([error.sum()]), linear, np.zeros((m, FACTORS))]
        for k in range(FACTORS):
            v = machine.factors[place, k]
            total = np.bincount(own, weights=v, minlength=len(rows))
            grads[2][:, k] = np.bincount(place, weights=error[own] * (total[own] - v), minlength=m)
        grads[1] += WEIGHT_DECAY * machine.weights
        grads[2] += FACTOR_DECAY * machine.factors
        for p, g, mean, square in zip(parameters, grads, means, squares, strict=True):
            mean += 0.1 * (g - mean)
            square += 0.001 * (g * g - square)
            p -= 0.02 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        machine.bias = float(parameters[0][0])
    return machine


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, most_terms: int = MOST_TERMS) -> Machine:
    """A machine from ``labels`` (doc_id, toxic) of rows that are not held out.

    Of an id with several labels the highest counts; null ids and labels, and
    labels without a document, are left out.
    """
    sample = (
        labels.filter(~held_in(0, 5) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample_rows)
    )
    # A broadcast of at most sample_rows ids.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    texts = stored(rows.groupBy("text").agg(F.max("toxic").alias("toxic")), "toxicity-sample")
    n, toxic = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    # Chi-square of term against label, from the four counts.
    a, b = F.col("toxic").cast("double"), (F.col("texts") - F.col("toxic")).cast("double")
    c, d = F.lit(float(toxic)) - a, F.lit(float(n - toxic)) - b
    chi_square = F.lit(float(n)) * F.pow(a * d - b * c, 2) / ((a + b) * (c + d) * (a + c) * (b + d))
    picked = (
        texts.mapInArrow(_term_counts, "term long, texts long, toxic long")
        .groupBy("term")
        .agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"))
        .filter((F.col("texts") >= LEAST_TEXTS) & (F.col("texts") < n))
        .select("term", F.when((a + c) * (b + d) > 0, chi_square).alias("chi_square"))
        .filter(F.col("chi_square") >= LEAST_CHI_SQUARE)
        .orderBy(F.desc("chi_square"), "term")
        .limit(most_terms)
        .collect()
    )
    terms = np.array(sorted(r.term for r in picked), dtype=np.int64)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of_bytes(batches, "text", BATCH_BYTES):
            own, places = features(Words(batch.column("text"), ALPHANUMERIC), terms)
            bounds = np.searchsorted(own, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), ragged(places.astype(np.int32), bounds, pa.int32())], names=["toxic", "places"]
            )

    # At most sample_rows rows of places among most_terms terms; sorted, so that tasks' order doesn't matter.
    found = texts.mapInArrow(rows_of, "toxic int, places array<int>").toArrow().to_pydict()
    rows = sorted(zip(found["places"], found["toxic"], strict=True))
    return fit(
        terms,
        np.repeat(np.arange(len(rows)), [len(places) for places, _ in rows]).astype(np.int64),
        np.array([p for places, _ in rows for p in places], dtype=np.int64),
        np.array([toxic for _, toxic in rows], dtype=float),
    )


def score_toxicity(docs: DataFrame, machine: Machine) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with held_out, score and predicted.

    Held out are rows whose crc32(doc_id as text) mod 5 is 0; a null id is not.
    Null and empty texts have no terms and score the bias. Repeated rows score
    alike; an empty table gives an empty result; further columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches_of_bytes(batches, "text", BATCH_BYTES):
            own, places = features(Words(batch.column("text"), ALPHANUMERIC), model.terms)
            scores = sigmoid(model.logits(own, places, batch.num_rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), held_in(0, 5).alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
