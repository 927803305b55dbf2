"""N-gram Jaccard join by MinHash banding with exact verification.

A text's signature is a number of trees' worth of minimum hashes of its word
shingles. This is an LSH forest cut at one depth, which is plain banding: the
longest prefix at which a pair at the threshold shares one in some tree with the
target recall is worked out from the settings before a text is read, only that
many hashes a tree are computed, and texts with equal prefixes are candidates.
No trie is built and no prefix is shortened text by text. Texts of one prefix
are linked to the smallest of them, never pair by pair; in the connected parts
lies every similar pair that shares a prefix.

Each part is verified exactly: its texts meet in a task, small parts many to a
task, large parts cut into blocks of bounded size of which every two meet. Pairs
stay inside a task; what leaves it are each text's number of links and a
spanning forest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import batches_of_bytes, packed, stored, text_bytes, unpacked, with_rows
from martflow.llm.graph import components
from martflow.llm.words import VISIBLE, Words, mixed, powers, ragged

SHINGLE = 5
THRESHOLD = 0.8
TREES = 32
DEPTH = 8
RECALL = 0.9999
BLOCK_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
COLUMNS_AT_ONCE = 4096
SHINGLE_BASE, CLASS_BASE, PREFIX_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB


def matched_depth(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix with which a pair at the threshold is found with the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each text, or of all its words if they are fewer; with bounds."""
    counts = words.counts
    per_text = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    first = np.arange(bounds[-1]) + np.repeat(words.bounds[:-1] - bounds[:-1], per_text)
    length = np.repeat(np.minimum(counts, size), per_text)
    hashes = words.vocabulary_hashes[words.ids] if len(words) else np.zeros(0, dtype=np.uint64)
    total = length.astype(np.uint64)
    for k, power in enumerate(powers(SHINGLE_BASE, size)):
        inside = length > k
        total[inside] += hashes[first[inside] + k] * power
    return mixed(total), bounds


def _reduce(function, values: np.ndarray, bounds: np.ndarray, empty) -> np.ndarray:
    """``function.reduceat`` between bounds, ``empty`` where there is nothing."""
    out = np.full(len(bounds) - 1, empty, dtype=values.dtype)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = function.reduceat(values, bounds[some])
    return out


def _signatures(size: int, trees: int, depth: int):
    pick = np.random.default_rng(20_240_501)
    masks = pick.integers(0, 1 << 32, trees * depth, dtype=np.uint32)
    factors = pick.integers(0, 1 << 31, trees * depth, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def sign(batches):
        for batch in batches_of_bytes(batches, "text", BATCH_BYTES):
            words = Words(batch.column("text"), VISIBLE)
            hashes, bounds = shingles(words, size)
            low = hashes.astype(np.uint32)
            prefixes = np.zeros((batch.num_rows, trees), dtype=np.uint64)
            for k, (mask, factor) in enumerate(zip(masks, factors, strict=True)):
                least = _reduce(np.minimum, (low ^ mask) * factor, bounds, 0)
                prefixes[:, k // depth] = prefixes[:, k // depth] * np.uint64(PREFIX_BASE) + least + np.uint64(1)
            prefixes = mixed(prefixes + np.arange(trees, dtype=np.uint64)[None, :] * np.uint64(CLASS_BASE))
            # Texts with the same words in the same order are one class.
            word_hashes = words.vocabulary_hashes[words.ids] if len(words) else np.zeros(0, dtype=np.uint64)
            place = np.arange(len(words)) - np.repeat(words.bounds[:-1], words.counts)
            longest = int(words.counts.max()) if batch.num_rows else 0
            halves = [
                mixed(_reduce(np.add, mixed(word_hashes + salt) * powers(CLASS_BASE, longest)[place], words.bounds, 0))
                for salt in (np.uint64(1), np.uint64(2))
            ]
            digests = np.stack([*halves, words.counts.astype(np.uint64)], axis=1)
            classes = [d.tobytes() if n else None for d, n in zip(digests, words.counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("bytes"),
                    pa.array(classes, type=pa.binary()),
                    ragged(prefixes.view(np.int64).ravel(), np.arange(batch.num_rows + 1) * trees, pa.int64()),
                ],
                names=["row", "doc_id", "bytes", "class", "prefixes"],
            )

    return sign


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which texts of ``left`` are similar to which of ``right``, exactly."""
    sizes = np.array([len(s) for s in sets])
    owners = np.repeat(np.arange(len(sets)), sizes)
    distinct, column = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(column, minlength=len(distinct)) > 1
    number = np.cumsum(shared) - 1
    owners, column = owners[shared[column]], number[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    owners, column = owners[order], column[order]
    both = np.zeros((len(left), len(right)), dtype=np.int64)
    for start in range(0, int(shared.sum()), COLUMNS_AT_ONCE):
        a, b = np.searchsorted(column, [start, start + COLUMNS_AT_ONCE])
        held = np.zeros((len(sets), COLUMNS_AT_ONCE), dtype=np.float32)
        held[owners[a:b], column[a:b] - start] = 1
        both += (held[left] @ held[right].T).astype(np.int64)
    either = sizes[left][:, None] + sizes[right][None, :] - both
    return both >= threshold * either - 1e-9


def _forest(similar: np.ndarray) -> np.ndarray:
    """The smallest member of each node's component."""
    label = np.arange(len(similar))
    while True:
        near = np.where(similar, label[None, :], len(label)).min(axis=1, initial=len(label))
        label, before = np.minimum(label, near), label
        label = label[label]
        if (label == before).all():
            return label


def _verifier(size: int, threshold: float):
    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([("component", "ascending"), ("i", "ascending"), ("j", "ascending"), ("row", "ascending")])
        component, i, j, block, rows = (
            table.column(c).to_numpy() for c in ("component", "i", "j", "block", "row")
        )
        hashes, bounds = shingles(Words(table.column("text"), VISIBLE), size)
        sets = [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        cuts = np.flatnonzero((np.diff(component) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        root, links = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True):
            own = np.arange(b - a)
            if i[a] == j[a]:
                similar = _links(sets[a:b], own, own, threshold)
                np.fill_diagonal(similar, False)
            else:
                left, right = own[block[a:b] == i[a]], own[block[a:b] == j[a]]
                similar = np.zeros((b - a, b - a), dtype=bool)
                if len(left) and len(right):
                    found = _links(sets[a:b], left, right, threshold)
                    similar[np.ix_(left, right)] = found
                    similar[np.ix_(right, left)] = found.T
            links[a:b] = similar.sum(axis=1)
            root[a:b] = rows[a:b][_forest(similar)]
        return pa.table({"node": rows, "root": root, "links": links})

    return verify


def near_duplicates(
    docs: DataFrame,
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its class of near duplicates.

    Rows are numbered once and stored with their numbers. Words are runs of anything but ASCII white space, A-Z lower-cased. Two texts are
    linked if the Jaccard similarity of their sets of ``size``-word shingles
    (all words, if they are fewer) is ``threshold`` or more; a class is a
    connected component of links. Returns doc_id, class_id (the smallest doc_id
    of the class; null if it has none), n_links (other texts linked to this
    one; texts that differ in case or white space only count as one),
    text_class (the smallest doc_id of the texts with the same words), row and
    class_row. Texts without words, null included, link to nothing, each a class
    of its own. Repeated rows are copies. An empty table gives an empty result;
    further columns are ignored.
    """
    texts = with_rows(docs.select(F.col("doc_id").cast("long"), "text"), "texts")
    return _classes(texts, size, threshold, trees, depth, recall, block_bytes)


def _classes(
    rows: DataFrame,
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``near_duplicates`` of a stored table (row, doc_id, text)."""
    depth = matched_depth(threshold, trees, depth, recall)
    texts = rows.select("row", "doc_id", text_bytes(F.col("text")).alias("bytes"), "text")
    signed = stored(
        texts.mapInArrow(
            _signatures(size, trees, depth), "row long, doc_id long, bytes long, class binary, prefixes array<long>"
        ),
        "signatures",
    )
    # Groupings are stored before they are joined on their key: a join of two plain tables is one whose
    # partitions adaptive execution can split, whatever a class of copies weighs.
    first = stored(
        signed.filter("class is not null").groupBy("class").agg(
            F.min("row").alias("rep"), F.min("doc_id").alias("text_class")
        ),
        "first",
    )
    members = stored(
        signed.select("row", "doc_id", "bytes", "class")
        .join(first, "class", "left")
        .select("row", "doc_id", "bytes", F.coalesce("rep", "row").alias("rep"), F.coalesce("text_class", "doc_id").alias("text_class")),
        "members",
    )
    reps = first.select("rep")
    entries = signed.join(reps, F.col("row") == F.col("rep")).select("row", F.explode("prefixes").alias("prefix"))
    heads = stored(
        entries.groupBy("prefix").agg(F.min("row").alias("head"), F.max("row").alias("last")).filter("head < last"), "heads"
    )
    # A text meets at most one head in each tree. It is linked to the smallest of them, and so are the others,
    # which leaves about one edge a text.
    met = (
        entries.join(heads, "prefix")
        .filter("row != head")
        .groupBy("row")
        .agg(F.collect_set("head").alias("heads"))
        .select("row", F.array_min("heads").alias("least"), "heads")
    )
    between = met.select(F.explode("heads").alias("a"), F.col("least").alias("b")).filter("a != b").distinct()
    parts = components(met.select(F.col("row").alias("a"), F.col("least").alias("b")).unionByName(between))

    sized = parts.join(members.select("row", "bytes"), F.col("node") == F.col("row")).select("node", "component", "bytes")
    blocks = stored(
        sized.groupBy("component").agg(
            F.ceil(F.sum("bytes") / F.lit(block_bytes)).cast("int").alias("blocks"), F.sum("bytes").alias("part_bytes")
        ),
        "blocks",
    )
    packs = max(1, (blocks.filter("blocks = 1").agg(F.sum("part_bytes")).first()[0] or 0) // block_bytes)
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    meetings = (
        sized.join(blocks, "component")
        .select("node", "component", "blocks", block.alias("block"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(
            "node", "component", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "blocks"
        )
        .select(
            "node",
            "component",
            "block",
            "i",
            "j",
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(packs)))
            .otherwise(F.lit(packs) + F.pmod(F.xxhash64("component", "i", "j"), F.lit(1 << 40)))
            .alias("task"),
        )
    )
    verified = stored(
        texts.select("row", "text")
        .join(stored(meetings, "meetings").hint("shuffle_hash"), F.col("row") == F.col("node"))
        .select("task", "component", "i", "j", "block", "row", "text")
        .groupBy("task")
        .applyInArrow(_verifier(size, threshold), "node long, root long, links long"),
        "verified",
    )
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(verified.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    of_text = stored(
        links.join(classes, "node", "left").select(
            F.col("node").alias("rep"), "links", F.coalesce("component", "node").alias("class_row")
        ),
        "of-text",
    )
    found = members.join(of_text, "rep", "left").select(
        "row", "doc_id", "text_class", F.coalesce("class_row", "rep").alias("class_row"), F.coalesce("links", F.lit(0)).alias("n_links")
    )
    named = stored(found.groupBy("class_row").agg(F.min("doc_id").alias("class_id")), "named")
    return found.join(named, "class_row").select("doc_id", "class_id", "n_links", "text_class", "row", "class_row")


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one row of each class of near duplicates: the smallest doc_id's first one.

    All columns are kept, whatever their names. Texts without words, null
    included, are each a class of their own, so all of them stay; of repeated
    rows with words one stays. A null id comes last. An empty table stays empty.
    """
    rows = with_rows(packed(docs, "text"), "texts")
    found = _classes(rows.select("row", F.col("_kept.doc_id").cast("long").alias("doc_id"), "text"), **settings)
    kept = found.groupBy("class_row").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    ).select(F.col("first.row").alias("_row"))
    return unpacked(rows.join(kept.hint("shuffle_hash"), F.col("row") == F.col("_row")), docs.columns, "text")
