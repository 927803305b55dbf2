"""Removal of repeated byte strings by per-shard suffix arrays.

Every text yields anchors: in each window of ``length`` bytes the gram with the
smallest hash. Equal windows have equal anchors, so a window whose anchor occurs
once in the corpus cannot repeat, and only the others go on: this loses no
repeat and leaves the repeated parts of the corpus with some margin.

What goes on is dealt to shards by each text's smallest repeated anchor, so that
texts with common parts mostly meet; many texts with one anchor are cut into
several shards. A shard sorts its suffixes (Larsson-Sadakane), takes their
common prefixes (Kasai), and finds windows that repeat within it. Windows whose
anchor also occurs in other shards leave it as digests, a digest once for each
class of equal windows. Ranges of digests then meet: they are sorted together,
and each shard's digests are looked up in those of several shards by binary
search.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import (
    batches_of_bytes,
    only_rows,
    packed,
    shuffle_partitions,
    stored,
    text_bytes,
    unpacked,
    with_rows,
    without_rows,
)
from martflow.llm.suffix_arrays import common_prefixes, suffix_array
from martflow.llm.words import mixed, powers, ragged, text_buffers

LENGTH = 400
SHARD_BYTES = 3 << 20
BATCH_BYTES = 4 << 20
#: What a window's digest and place take, and how much of it one range of digests holds.
DIGEST_BYTES, RANGE_BYTES = 24, 64 << 20
GRAM_BASES = (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F)
ORDER_BITS = 24
SEPARATOR = 0xFF
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def string_hashes(data: np.ndarray, starts: np.ndarray, length: int, base: int) -> np.ndarray:
    """64-bit hashes of the strings of ``length`` bytes at ``starts``."""
    symbols = mixed(np.arange(256, dtype=np.uint64) + np.uint64(base & 0xFFFF))
    running = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(symbols[data] * powers(base, len(data)), out=running[1:])
    inverse = pow(base, -1, 1 << 64)
    back = powers(inverse, len(data) + 1)
    return mixed((running[starts + length] - running[starts]) * back[starts])


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of ``width`` consecutive keys from each place on."""
    n = len(keys)
    blocks = np.full((-(-n // width) + 1) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks[:n] = keys
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : n + width - 1])


def anchors(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, hash, first window, last window) of each anchor of texts that lie one after another."""
    if len(data) <= 1 << ORDER_BITS:
        owner, _, *found = _anchors(data, bounds, length)
        return owner, *found
    # Positions have to fit the order's bits: text by text, and long ones in stretches that overlap by a window less a byte.
    step = (1 << ORDER_BITS) - length + 1
    parts = [_anchors(data[:0], np.zeros(2, dtype=np.int64), length)]
    for k, (begin, end) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        for start in range(begin, end - length + 1, step):
            piece = data[start : min(end, start + step + length - 1)]
            owner, at, hashes, first, last = _anchors(piece, np.array([0, len(piece)]), length)
            shift = start - begin
            parts.append((owner + k, at + start, hashes, first + shift, last + shift))
    owner, at, hashes, first, last = (np.concatenate(p) for p in zip(*parts, strict=True))
    # An anchor whose windows begin in two stretches is one.
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])])[: len(at)]
    return owner[new], hashes[new], first[new], last[np.append(new[1:], True)[: len(at)]]


def _anchors(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, place, hash, first window, last window) for at most 2^ORDER_BITS bytes."""
    gram = length // 2
    n = len(data)
    texts = np.flatnonzero(np.diff(bounds) >= length)
    none = np.zeros(0, dtype=np.int64)
    if not len(texts):
        return none, none, none, none, none
    grams = string_hashes(data, np.arange(n - gram + 1), gram, GRAM_BASES[0])
    low = np.uint64((1 << ORDER_BITS) - 1)
    # The leftmost of equal minima: which of them depends on the window alone.
    chosen = _window_minima((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & low
    counts = bounds[texts + 1] - bounds[texts] - length + 1
    windows = np.repeat(bounds[texts] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    owner = np.repeat(texts, counts)
    at = chosen[windows].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])]))
    last = np.append(first[1:], len(windows)) - 1
    owner, at = owner[first], at[first]
    return owner, at, grams[at].view(np.int64), windows[first] - bounds[owner], windows[last] - bounds[owner]


def _find_anchors(length: int):
    def find(batches):
        for batch in batches_of_bytes(batches, "text", BATCH_BYTES):
            data, bounds = text_buffers(batch.column("text"))
            owner, hashes, first, last = anchors(data, bounds, length)
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    ragged(hashes, cuts, pa.int64()),
                    ragged(first.astype(np.int32), cuts, pa.int32()),
                    ragged(last.astype(np.int32), cuts, pa.int32()),
                ],
                names=[*names, "anchors", "first", "last"],
            )

    return find


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of runs of set flags, and the places after them."""
    edges = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` bytes lie in a stretch from one of ``starts`` to before its end."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, ends, -1)
    return np.cumsum(edges[:-1]) > 0


def steps(values: np.ndarray) -> bytes:
    """Numbers that mostly rise by little, as the bytes of their steps, byte by byte of equal weight: easily compressed."""
    taken = np.diff(values, prepend=0).astype("<i8")
    return np.ascontiguousarray(taken.view(np.uint8).reshape(-1, 8).T).tobytes()


def from_steps(data: bytes) -> np.ndarray:
    taken = np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T)
    return np.cumsum(taken.view("<i8").ravel())


#: ``spans`` are first and last starts of runs of repeated windows: a repeated passage takes 8 bytes, not 4 a window.
FOUND = "row long, text string, spans binary, shard long, bucket int, high binary, low binary, rows binary, places binary"


def _shard(length: int, buckets: int):
    """One row per text with the windows that repeat in the shard, and rows of digests for other shards."""

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        shard = table.column("shard")[0].as_py()
        rows = table.column("row").to_numpy()
        text, bounds = text_buffers(table.column("text"))
        parts, owner, offset, asked, at = [], [], [], [], 0
        windows = table.column("windows").combine_chunks()
        cuts = windows.offsets.to_numpy()
        fields = {f.name: windows.values.field(f.name).to_numpy(zero_copy_only=False) for f in windows.values.type}
        for k in range(len(rows)):
            own = text[bounds[k] : bounds[k + 1]]
            first, last = (fields[n][cuts[k] : cuts[k + 1]] for n in ("first", "last"))
            abroad = np.zeros(len(own) + 1, dtype=np.int64)
            inside = np.zeros(len(own) + 1, dtype=np.int64)
            cross = fields["cross"][cuts[k] : cuts[k + 1]]
            np.add.at(inside, first, 1)
            np.add.at(inside, last + length, -1)
            np.add.at(abroad, first[cross], 1)
            np.add.at(abroad, last[cross] + 1, -1)
            wanted, abroad = np.cumsum(inside[:-1]) > 0, np.cumsum(abroad[:-1]) > 0
            for a, b in zip(*runs(wanted), strict=True):
                mark = np.array([SEPARATOR, *len(parts).to_bytes(6)], dtype=np.uint8)
                parts += [own[a:b], mark]
                owner += [k]
                offset += [(at, b - a, a)]
                asked.append(np.concatenate([abroad[a:b], np.zeros(len(mark), dtype=bool)]))
                at += b - a + len(mark)
        data = np.concatenate([*parts, np.zeros(0, dtype=np.uint8)]).astype(np.uint8)
        asked = np.concatenate([*asked, np.zeros(0, dtype=bool)]).astype(bool)
        order, words = suffix_array(data)
        prefixes = common_prefixes(data, order, words)
        del words
        # Whole windows only: those that end within their part.
        whole = np.zeros(len(data), dtype=bool)
        for start, size, _ in offset:
            whole[start : start + max(0, size - length + 1)] = True
        group = np.cumsum(prefixes < length)
        sizes = np.bincount(group[whole[order]], minlength=int(group[-1]) + 1 if len(group) else 1)
        repeated = np.zeros(len(data), dtype=bool)
        repeated[order] = sizes[group] > 1
        repeated &= whole
        part_starts = np.array([o[0] for o in offset], dtype=np.int64)
        shift = np.array([o[2] - o[0] for o in offset], dtype=np.int64)
        part_owner = np.array(owner, dtype=np.int64)

        def located(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            part = np.searchsorted(part_starts, places, side="right") - 1
            return part_owner[part], places + shift[part]

        own, places = located(np.flatnonzero(repeated)) if len(offset) else (np.zeros(0, int), np.zeros(0, int))
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (places[1:] != places[:-1] + 1)])[: len(own)]
        spans = np.stack([places[new], places[np.append(new[1:], True)[: len(own)]]]).astype("<i4")
        ends = np.searchsorted(own[new], np.arange(len(rows) + 1))
        out = {
            "row": rows.tolist(),
            "text": table.column("text").to_pylist(),
            "spans": [spans[:, a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)],
            **{n: [None] * len(rows) for n in ("shard", "bucket", "high", "low", "rows", "places")},
        }
        # One window of each class that other shards may have; its place only if it does not repeat here.
        sent = order[(asked & whole)[order]]
        of = group[(asked & whole)[order]]
        sent = np.sort(sent[np.unique(of, return_index=True)[1]])
        if len(sent):
            high, low = (string_hashes(data, sent, length, base) for base in GRAM_BASES)
            own, places = located(sent)
            # In the order of the texts, so that places take few bytes; whether a window repeats here is their last bit.
            places = places * 2 + repeated[sent]
            bucket = (high >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            by_bucket = np.argsort(bucket, kind="stable")
            limits = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(limits)):
                part = by_bucket[limits[b] : limits[b + 1]]
                digests = high[part].tobytes(), low[part].tobytes()
                values = (None, None, None, shard, int(b), *digests, steps(rows[own[part]]), steps(places[part]))
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
        return pa.table([pa.array(v, type=t) for v, t in zip(out.values(), kinds, strict=True)], names=list(out))

    return search


def _merge(table: pa.Table) -> pa.Table:
    """Of one range of digests, those that several shards have: (row, start) of the windows that wait for them."""
    columns = {name: [np.frombuffer(b, dtype="<u8") for b in table.column(name).to_pylist()] for name in ("high", "low")}
    columns |= {name: [from_steps(b) for b in table.column(name).to_pylist()] for name in ("rows", "places")}
    high, low = np.concatenate(columns["high"]), np.concatenate(columns["low"])
    order = np.lexsort((low, high))
    same = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
    several = np.zeros(len(order), dtype=bool)
    several[order[1:][same]] = True
    several[order[:-1][same]] = True
    shared = np.unique(high[several])
    rows, places = [], []
    start = 0
    for run, own, place in zip(columns["high"], columns["rows"], columns["places"], strict=True):
        # Each shard's digests against the merged ones of several shards.
        at = np.searchsorted(shared, run)
        met = (at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == run) if len(shared) else np.zeros(len(run), bool)
        met &= several[start : start + len(run)] & (place & 1 == 0)
        rows.append(own[met])
        places.append(place[met] >> 1)
        start += len(run)
    rows, places = np.concatenate(rows), np.concatenate(places)
    order = np.argsort(rows, kind="stable")
    rows, places = rows[order], places[order]
    found, first = np.unique(rows, return_index=True)
    cuts = np.append(first, len(rows))
    starts = [places[a:b].astype("<i4").tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
    return pa.table({"row": pa.array(found, type=pa.int64()), "more": pa.array(starts, type=pa.binary())})


def _cut(length: int):
    """Spans and what is left of each text."""

    def cut(batches):
        for batch in batches:
            texts, cuts, left = batch.column("text").to_pylist(), [], []
            removed, shas = [], []
            for text, own, more in zip(texts, batch.column("spans").to_pylist(), batch.column("more").to_pylist(), strict=True):
                data = np.frombuffer((text or "").encode(), dtype=np.uint8)
                first, last = np.frombuffer(own or b"", dtype="<i4").astype(np.int64).reshape(2, -1)
                single = np.frombuffer(b"".join(more or []), dtype="<i4").astype(np.int64)
                gone = covered(np.append(first, single), np.append(last, single) + length, len(data))
                kept = data[~gone].tobytes()
                cuts.append(len(runs(gone)[0]))
                removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(kept).hexdigest())
                left.append(kept.decode(errors="ignore"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(removed, pa.int64()), pa.array(cuts, pa.int64()), pa.array(shas), pa.array(left, pa.string())],
                names=["row", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )

    return cut


def find_repeats(docs: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with what its repeated strings leave.

    A byte goes if it lies in a string of ``length`` bytes that also starts
    anywhere else in the texts, in this text or another; strings do not cross
    texts. Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, row and
    kept_text, which is null where the text stays as it is; of a character that
    is cut through nothing is kept in it. Null is an empty text. Copies of a
    text of ``length`` bytes or more go entirely, and repeated rows are copies.
    Null ids stay; an empty table gives an empty result; further columns are
    ignored. Rows are numbered once and stored with their numbers.
    """
    return _repeats(with_rows(docs.select(F.col("doc_id").cast("long"), "text"), "texts"), length, shard_bytes)


def _repeats(texts: DataFrame, length: int = LENGTH, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``find_repeats`` of a stored table (row, doc_id, text)."""
    spark = texts.sparkSession
    whole = F.coalesce(F.col("text"), F.lit(""))
    marked = texts.select(
        "row",
        "doc_id",
        text_bytes(F.col("text")).alias("n_bytes"),
        F.unhex(F.md5(whole)).alias("digest"),
        F.sha2(whole, 256).alias("sha"),
        "text",
    )
    schema = "row long, doc_id long, n_bytes long, digest binary, sha string, anchors array<long>, first array<int>, last array<int>"
    signed = stored(marked.mapInArrow(_find_anchors(length), schema), "anchors")
    copies = stored(
        signed.filter(F.col("n_bytes") >= length).groupBy("digest").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("copies")),
        "copies",
    )
    several = copies.filter("copies > 1").select(F.col("digest").alias("_digest"), "rep")
    # Of copies only the first goes on: the numbers of the others are sent to the anchors, which are not exchanged by text.
    further = stored(
        signed.filter(F.col("n_bytes") >= length)
        .select("row", "digest")
        .join(several, F.col("digest") == F.col("_digest"))
        .filter("row != rep")
        .select("row"),
        "further-copies",
    )
    each = without_rows(signed.select("row", "anchors", "first", "last"), further).select(
        "row", F.inline(F.arrays_zip(F.col("anchors").alias("anchor"), "first", "last"))
    )
    # Groupings are stored before they are joined on their key: a join of two plain tables is one whose
    # partitions adaptive execution can split, whatever a frequent anchor weighs.
    common = stored(each.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "common")
    held = stored(each.join(common, "anchor"), "repeated-anchors")
    own = held.groupBy("row").agg(
        F.min("anchor").alias("mark"), F.sum(F.col("last") - F.col("first") + 1).alias("weight"), F.count(F.lit(1)).alias("n")
    )
    # A run of windows takes as many bytes as windows, and one window more.
    own = own.withColumn("weight", F.col("weight") + F.lit(length))
    marks = own.groupBy("mark").agg(F.sum("weight").alias("total")).withColumn(
        "parts", F.ceil(F.col("total") / F.lit(shard_bytes)).cast("int")
    )
    small, every = marks.agg(F.sum(F.when(F.col("parts") == 1, F.col("total"))), F.sum("total")).first()
    packs = max(1, -(-(small or 0) // shard_bytes))
    # A window has at most one digest, so a range of digests has a bound whatever the corpus weighs.
    buckets = max(shuffle_partitions(spark), -(-(every or 0) * DIGEST_BYTES // RANGE_BYTES))
    dealt = stored(
        own.join(marks, "mark").select(
            "row",
            F.when(F.col("parts") == 1, F.pmod(F.xxhash64("mark"), F.lit(packs)))
            .otherwise(F.lit(packs) + F.pmod(F.xxhash64("mark", F.pmod(F.xxhash64("row"), F.col("parts"))), F.lit(1 << 40)))
            .alias("shard"),
        ),
        "shards",
    )
    placed = held.join(dealt, "row")
    abroad = stored(
        placed.groupBy("anchor")
        .agg((F.min("shard") != F.max("shard")).alias("cross"))
        .filter("cross")
        .select(F.col("anchor").alias("met")),
        "met-anchors",
    )
    windows = (
        placed.join(abroad, F.col("anchor") == F.col("met"), "left")
        .groupBy("row")
        .agg(
            F.min("shard").alias("shard"),
            F.collect_list(F.struct("first", "last", F.col("met").isNotNull().alias("cross"))).alias("windows"),
        )
    )
    windows = stored(windows, "windows")
    found = stored(
        only_rows(texts.select("row", "text"), windows.select("row"))
        .join(windows.withColumnRenamed("row", "_row").hint("shuffle_hash"), F.col("row") == F.col("_row"))
        .select("row", "shard", "windows", "text")
        .groupBy("shard")
        .applyInArrow(_shard(length, buckets), FOUND),
        "found",
    )
    # Stored, so that the exchange of digests is over before texts are exchanged again.
    met = stored(found.filter("bucket is not null").groupBy("bucket").applyInArrow(_merge, "row long, more binary"), "met-windows")
    more = met.groupBy("row").agg(F.collect_list("more").alias("more")).withColumnRenamed("row", "_row")
    cut = (
        found.filter("bucket is null")
        .select("row", "text", "spans")
        .join(more, F.col("row") == F.col("_row"), "left")
        .filter((F.length("spans") > 0) | F.col("more").isNotNull())
        .select("row", "text", "spans", "more")
        .mapInArrow(_cut(length), "row long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
        .withColumnRenamed("row", "_row")
    )
    all_gone = F.col("_digest").isNotNull() & (F.col("n_bytes") >= length)
    return (
        signed.select("row", "doc_id", "n_bytes", "digest", "sha")
        .join(several.select("_digest"), F.col("digest") == F.col("_digest"), "left")
        .join(cut, F.col("row") == F.col("_row"), "left")
        .select(
            "doc_id",
            "n_bytes",
            F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(all_gone, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(all_gone, EMPTY_SHA256).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
            "row",
            F.when(all_gone, "").otherwise(F.col("kept_text")).alias("kept_text"),
        )
    )


def remove_repeats(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with repeated strings cut out of the texts; rows of which nothing is left go.

    All columns are kept, whatever their names. Rows whose text is null, empty or
    shorter than ``length`` have no such string and stay as they are; copies of a
    longer text go, all of them. An empty table stays empty.
    """
    rows = with_rows(packed(docs, "text"), "texts")
    found = _repeats(rows.select("row", F.col("_kept.doc_id").cast("long").alias("doc_id"), "text"), **settings)
    changed = stored(found.filter("n_removed > 0").select("row", "kept_text"), "kept-texts")
    ids = changed.select("row")
    cut = only_rows(rows, ids).drop("text").join(changed.hint("shuffle_hash"), "row").filter("trim(kept_text) != ''")
    left = without_rows(rows, ids).select("text", "_kept").union(cut.select("kept_text", "_kept"))
    return unpacked(left, docs.columns, "text")
