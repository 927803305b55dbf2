"""Near duplicates by a MinHash LSH forest of sorted signature orders.

A text's signature has, for each of several orders, a key of minimum hashes of
its shingles. All texts are sorted by each order's keys (a range shuffle of rows
and keys, without texts), and a text's longest common prefixes with its two
neighbours tell whether it has candidates in that order at all: most texts leave
the forest here. A region is a run of an order in which all share a prefix. It
starts with the shortest prefix and becomes deeper only where it is too large
for one task, so sparse parts of the forest are searched wider than dense ones.
Even the deepest regions keep the recall stated below.

Links are confirmed on the full sets, in two steps. First each text is compared
with its neighbour in some orders, in chunks of the sorted order, which joins up
most large groups of copies. Then only the regions that still hold several
components are looked through: all but a region's largest component is compared
with the whole region. A region is one group in one task, and regions of the
same texts go to the same task, so a text travels once for all its orders; a
region that is too large even at full depth is cut into blocks, and each block
of its lesser components meets each block of the region.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import batches_of_bytes, packed, stored, text_bytes, unpacked, with_rows
from martflow.llm.graph import components
from martflow.llm.near_duplicates import shingles
from martflow.llm.words import VISIBLE, Words, mixed, text_buffers

SHINGLE = 3
#: Hundredths of the union that the intersection must reach.
SIMILARITY = 85
#: A pair at the threshold shares a prefix of the shortest depth in some order but for 2 in 10**8, and one
#: of the full depth but for 1.2 in 10**5.
ORDERS = 24
SHORTEST, DEPTH = 4, 6
NEIGHBOUR_ORDERS = 2
REGION_BYTES = 1 << 20
TASK_BYTES = 4 << 20
BATCH_BYTES = 8 << 20
HASH_BYTES = 2
SALTS = (0x9FB21C651E98DF25, 0x3C79AC492BA7B653)


def missed(similarity: float, orders: int, depth: int) -> float:
    """The share of pairs of this similarity without a common prefix in any order."""
    return (1 - similarity**depth) ** orders


def distinct_shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and their bounds."""
    hashes, bounds = shingles(Words(texts, VISIBLE), size)
    sets = [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    counts = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    return flat, np.concatenate([[0], np.cumsum(counts)])


def _signer(size: int, orders: int, depth: int):
    pick = np.random.default_rng(11)
    masks = pick.integers(0, 1 << 32, orders * depth, dtype=np.uint32)
    factors = pick.integers(0, 1 << 31, orders * depth, dtype=np.uint32) * np.uint32(2) + np.uint32(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of_bytes(batches, "text", BATCH_BYTES):
            flat, bounds = distinct_shingles(batch.column("text"), size)
            counts = np.diff(bounds)
            some = np.flatnonzero(counts)
            starts = bounds[some]
            low = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
            keys = np.zeros((batch.num_rows, orders * depth), dtype=">u2")
            digests = np.zeros((batch.num_rows, 3), dtype=np.uint64)
            digests[:, 2] = counts
            if len(some):
                for k, (mask, factor) in enumerate(zip(masks, factors, strict=True)):
                    least = np.minimum.reduceat((low ^ mask) * factor, starts)
                    keys[some, k] = mixed(least) >> np.uint64(48)
                for k, salt in enumerate(SALTS):
                    digests[some, k] = np.add.reduceat(mixed(flat ^ np.uint64(salt)), starts)
            # Texts with the same set are one class, whatever the order of their words.
            classes = [d.tobytes() if n else None for d, n in zip(digests, counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    batch.column("bytes"),
                    pa.array(counts),
                    pa.array(classes, type=pa.binary()),
                    pa.array([k.tobytes() for k in keys], type=pa.binary()),
                ],
                names=["row", "doc_id", "bytes", "n_shingles", "class", "keys"],
            )

    return sign


def _neighbours(depth: int, shortest: int, neighbour_orders: int, chunk_bytes: int):
    """Keeps the entries of sorted orders that share a prefix with a neighbour, or may with one in another task."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        before, total = True, 0  # whether the held entry is wanted for its predecessor; bytes in chunks so far
        first_chunk = TaskContext.get().partitionId() << 32

        def kept(entries: pa.RecordBatch, wanted: np.ndarray) -> pa.RecordBatch:
            nonlocal total
            entries = entries.filter(pa.array(wanted))
            sizes = entries.column("bytes").to_numpy()
            chunked = entries.column("order").to_numpy() < neighbour_orders
            ends = total + np.cumsum(np.where(chunked, sizes, 0))
            total = int(ends[-1]) if len(ends) else total
            chunk = pa.array(first_chunk + ends // chunk_bytes, mask=~chunked)
            return pa.RecordBatch.from_arrays([*entries.columns, chunk], names=[*entries.schema.names, "chunk"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            keys = text_buffers(batch.column("key"))[0].reshape(batch.num_rows, depth, HASH_BYTES)
            order = batch.column("order").to_numpy()
            equal = (keys[1:] == keys[:-1]).all(axis=2) & (order[1:] == order[:-1])[:, None]
            shared = np.cumprod(equal, axis=1).sum(axis=1) >= shortest
            wanted = np.concatenate([[before], shared])[:-1] | shared
            yield kept(batch.slice(0, batch.num_rows - 1), wanted)
            before = bool(shared[-1]) if len(shared) else before
            held = batch.slice(batch.num_rows - 1)
        if held is not None:
            yield kept(held, np.ones(1, dtype=bool))

    return look


class _Sets:
    """The shingle sets of a task's texts, as numbers of shingles that the task knows."""

    def __init__(self, texts: pa.Array, size: int):
        flat, self.bounds = distinct_shingles(texts, size)
        distinct, self.columns = np.unique(flat, return_inverse=True)
        self.sizes = np.diff(self.bounds)
        self.flags = np.zeros(len(distinct), dtype=np.int8)

    def similar(self, one: int, others: np.ndarray, similarity: int) -> np.ndarray:
        """Which of ``others`` are linked to ``one``, exactly."""
        # A union is at least the larger set, an intersection at most the smaller one.
        low, high = np.minimum(self.sizes[others], self.sizes[one]), np.maximum(self.sizes[others], self.sizes[one])
        near = np.flatnonzero(100 * low >= similarity * high)
        linked = np.zeros(len(others), dtype=bool)
        if len(near):
            own = self.columns[self.bounds[one] : self.bounds[one + 1]]
            self.flags[own] = 1
            near_sizes = self.sizes[others[near]]
            starts = np.cumsum(near_sizes) - near_sizes
            place = np.arange(near_sizes.sum()) + np.repeat(self.bounds[others[near]] - starts, near_sizes)
            both = np.add.reduceat(self.flags[self.columns[place]], starts, dtype=np.int64)
            self.flags[own] = 0
            linked[near] = 100 * both >= similarity * (near_sizes + self.sizes[one] - both)
        return linked


class _Parts:
    """Components of a task's texts; remembers what joined them."""

    def __init__(self, component: np.ndarray):
        _, first, which = np.unique(component, return_index=True, return_inverse=True)
        self.root = first[which]
        self.joined: list[tuple[int, int]] = []

    def join(self, one: int, others: np.ndarray) -> None:
        for other in others:
            a, b = self.root[one], self.root[other]
            if a != b:
                self.root[self.root == b] = a
                self.joined.append((one, int(other)))


def _links(rows: np.ndarray, parts: _Parts) -> pa.Table:
    pairs = np.array(parts.joined, dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": rows[pairs[:, 0]], "b": rows[pairs[:, 1]]})


def _link_neighbours(size: int, similarity: int):
    """Compares each text of a chunk with the next one of its order."""

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("key", "ascending"), ("tie", "ascending")]).combine_chunks()
        rows, order = table.column("row").to_numpy(), table.column("order").to_numpy()
        distinct, first, which = np.unique(rows, return_index=True, return_inverse=True)
        sets = _Sets(table.column("text").take(pa.array(first)), size)
        parts = _Parts(np.arange(len(distinct)))
        for one, other, same in zip(which, which[1:], order[1:] == order[:-1], strict=False):
            if same and parts.root[one] != parts.root[other] and sets.similar(one, np.array([other]), similarity)[0]:
                parts.join(one, [other])
        return _links(distinct, parts)

    return link


def _link_regions(size: int, similarity: int):
    """Compares all but the largest component of each region with the whole region."""

    def link(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rows = table.column("row").to_numpy()
        sets, parts = _Sets(table.column("text"), size), _Parts(table.column("component").to_numpy())
        entries = table.column("entries").combine_chunks()
        owner = np.repeat(np.arange(len(rows)), np.diff(entries.offsets.to_numpy()))
        flat = entries.flatten()
        region, side = flat.field("region").to_numpy(), flat.field("side").to_numpy()
        key = text_buffers(flat.field("key"))[0].reshape(len(owner), -1)
        order = np.lexsort([*key.T[::-1], region])
        for members in np.split(order, np.flatnonzero(np.diff(region[order])) + 1):
            texts, sides = owner[members], side[members]
            every, lesser = texts[sides != 1], texts[sides != 0]
            if (sides == 2).all():
                for one, other in zip(texts, texts[1:], strict=False):
                    if parts.root[one] != parts.root[other] and sets.similar(one, np.array([other]), similarity)[0]:
                        parts.join(one, [other])
                roots, counts = np.unique(parts.root[every], return_counts=True)
                lesser = every[parts.root[every] != roots[counts.argmax()]]
            for one in lesser:
                others = every[parts.root[every] != parts.root[one]]
                if len(others):
                    parts.join(one, others[sets.similar(one, others, similarity)])
        return _links(rows, parts)

    return link


def _prefix(depth: int):
    return F.xxhash64("order", F.substring("key", 1, depth * HASH_BYTES))


def _regions(entries: DataFrame, shortest: int, depth: int, region_bytes: int) -> DataFrame:
    """``entries`` that have company, with the region of each: as shallow as fits a task, else at full depth."""
    found, level = None, shortest
    while True:
        at = entries.withColumn("region", _prefix(level))
        sizes = stored(
            at.groupBy("region")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("region_bytes"), F.min("row").alias("least"))
            .filter("n > 1"),
            "region-sizes",
        )
        sized = stored(at.join(sizes, "region").drop("n"), "regions")
        fits = sized if level == depth else sized.filter(F.col("region_bytes") <= region_bytes)
        found = fits if found is None else found.unionByName(fits)
        if level == depth or sizes.filter(F.col("region_bytes") > region_bytes).isEmpty():
            return found
        entries = sized.filter(F.col("region_bytes") > region_bytes).drop("region", "region_bytes", "least")
        level += 1


def _meetings(regions: DataFrame, labels: DataFrame, region_bytes: int, task_bytes: int) -> DataFrame:
    """(task, row, component, entries) for the regions that hold several components."""
    own = stored(
        regions.join(labels, F.col("row") == F.col("node"), "left").select(
            "row", "key", "bytes", "region", "least", F.coalesce("component", "row").alias("component")
        ),
        "region-texts",
    )
    per_component = own.groupBy("region", "component").agg(F.sum("bytes").alias("b"), F.min("least").alias("least"))
    several = stored(
        per_component.groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("b").alias("all_bytes"),
            F.max("b").alias("largest"),
            F.max(F.struct("b", "component")).alias("main"),
            F.min("least").alias("least"),
        )
        .filter("n > 1")
        .select(
            "region",
            "least",
            F.col("main.component").alias("main"),
            "all_bytes",
            F.ceil(F.col("all_bytes") / region_bytes).cast("int").alias("blocks"),
            F.ceil((F.col("all_bytes") - F.col("largest")) / region_bytes).cast("int").alias("lesser_blocks"),
        ),
        "open-regions",
    )
    small = several.filter("blocks <= 1").agg(F.sum("all_bytes")).first()[0] or 0
    packs = F.lit(max(1, -(-small // task_bytes)))

    def place(side: int, block, lesser_block):
        task = packs + F.pmod(F.xxhash64("region", block, lesser_block), F.lit(1 << 40))
        return F.struct(task.alias("task"), F.xxhash64("region", block, lesser_block).alias("region"), F.lit(side).alias("side"))

    block = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    lesser_block = F.pmod(F.xxhash64("row", F.lit(1)), F.greatest("lesser_blocks", F.lit(1))).cast("int")
    whole = F.array(
        F.struct(F.pmod(F.xxhash64("least"), packs).alias("task"), F.col("region").alias("region"), F.lit(2).alias("side"))
    )
    as_any = F.transform(
        F.sequence(F.lit(0), F.greatest("lesser_blocks", F.lit(1)) - 1), lambda k: place(0, block, k)
    )
    as_lesser = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: place(1, k, lesser_block))
    places = F.when(F.col("blocks") <= 1, whole).otherwise(
        F.when(F.col("component") == F.col("main"), as_any).otherwise(F.concat(as_any, as_lesser))
    )
    return (
        own.drop("least")
        .join(several, "region")
        .select("row", "component", "key", F.explode(places).alias("at"))
        .groupBy(F.col("at.task").alias("task"), "row")
        .agg(F.first("component").alias("component"), F.collect_list(F.struct("at.region", "at.side", "key")).alias("entries"))
    )


def _found(
    texts: DataFrame,
    size: int = SHINGLE,
    similarity: int = SIMILARITY,
    orders: int = ORDERS,
    shortest: int = SHORTEST,
    depth: int = DEPTH,
    region_bytes: int = REGION_BYTES,
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """``near_dedup`` of a stored table (row, doc_id, text)."""
    signed = stored(
        texts.select("row", "doc_id", text_bytes(F.col("text")).alias("bytes"), "text").mapInArrow(
            _signer(size, orders, depth),
            "row long, doc_id long, bytes long, n_shingles long, class binary, keys binary",
        ),
        "signatures",
    )
    first = stored(signed.filter("class is not null").groupBy("class").agg(F.min("row").alias("rep")), "first")
    members = stored(
        signed.select("row", "doc_id", "n_shingles", "class")
        .join(first, "class", "left")
        .select("row", "doc_id", "n_shingles", F.coalesce("rep", "row").alias("rep")),
        "members",
    )
    width = depth * HASH_BYTES
    entries = (
        signed.join(first.select("rep"), F.col("row") == F.col("rep"))
        .select("row", "bytes", "keys", F.explode(F.sequence(F.lit(0), F.lit(orders - 1))).alias("order"))
        .select("row", "bytes", "order", F.expr(f"substring(keys, order * {width} + 1, {width})").alias("key"))
        .withColumn("tie", F.xxhash64("order", "row"))
    )
    near = stored(
        entries.repartitionByRange("order", "key", "tie")
        .sortWithinPartitions("order", "key", "tie")
        .mapInArrow(
            _neighbours(depth, shortest, NEIGHBOUR_ORDERS, task_bytes),
            "row long, bytes long, order int, key binary, tie long, chunk long",
        ),
        "entries",
    )
    plain = texts.select(F.col("row").alias("text_row"), "text")
    chunks = stored(near.filter("chunk is not null"), "chunks")
    neighbours = stored(
        plain.join(chunks.hint("shuffle_hash"), F.col("text_row") == F.col("row"))
        .select("chunk", "row", "order", "key", "tie", "text")
        .groupBy("chunk")
        .applyInArrow(_link_neighbours(size, similarity), "a long, b long"),
        "neighbour-links",
    )
    regions = _regions(near.drop("tie", "chunk"), shortest, depth, region_bytes)
    meetings = stored(_meetings(regions, components(neighbours), region_bytes, task_bytes), "meetings")
    linked = stored(
        plain.join(meetings.hint("shuffle_hash"), F.col("text_row") == F.col("row"))
        .select("task", "row", "component", "entries", "text")
        .groupBy("task")
        .applyInArrow(_link_regions(size, similarity), "a long, b long"),
        "region-links",
    )
    labels = components(neighbours.unionByName(linked))
    named = stored(
        members.join(labels, F.col("rep") == F.col("node"), "left").select(
            "row", "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_row")
        ),
        "named",
    )
    smallest = stored(named.groupBy("component_row").agg(F.min("doc_id").alias("component_id")), "smallest")
    return named.join(smallest, "component_row")


def near_dedup(docs: DataFrame, **settings: int) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its component of near duplicates.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a text's
    set are its distinct runs of ``size`` words, or all its words as one if they
    are fewer. Two texts are linked if the intersection of their sets is at least
    ``similarity`` hundredths of the union, compared exactly; candidates are
    missed with the probability ``missed`` gives. Returns doc_id, n_shingles,
    component_id (the smallest doc_id that links reach, its own included), kept
    (whether doc_id is component_id; in a component without any id, true), row
    and component_row.

    A text without words, null included, has no shingles and links to nothing.
    Repeated rows are copies, and so is a repeated id with another text if that
    text is similar; of several rows with the smallest id all are kept. A null id
    is the last to name a component. An empty table gives an empty result;
    further columns are ignored.
    """
    texts = with_rows(docs.select(F.col("doc_id").cast("long"), "text"), "texts")
    found = _found(texts, **settings)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "row", "component_row")


def without_near_copies(docs: DataFrame, **settings: int) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id's first row, with all its columns."""
    rows = with_rows(packed(docs, "text"), "texts")
    found = _found(rows.select("row", F.col("_kept.doc_id").cast("long").alias("doc_id"), "text"), **settings)
    first = (
        found.groupBy("component_row")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
        .select(F.col("first.row").alias("_row"))
    )
    return unpacked(rows.join(first.hint("shuffle_hash"), F.col("row") == F.col("_row")), docs.columns, "text")
