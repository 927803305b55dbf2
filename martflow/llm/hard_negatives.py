"""Hard negatives by exact integer scores, in the manner of the Four Russians.

A vector's components become integers. Of an anchor, every sum of a subset of
eight neighbouring components is looked up in a table of 256 entries; of a
candidate, one bit of eight neighbouring components is one byte of a bit plane.
A score is then one lookup for each byte, added up within a plane and shifted
and added from plane to plane, with the sign in the highest plane.

Anchors and candidates are dealt to blocks, and every two blocks meet in one
task, which hands on the few best of each anchor: scores never leave it. The
positives are found first; their scores bound the negatives of a second pass.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.common import shuffle_partitions, stored

GROUP = 8
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score, in hundredths of the positive's.
LEAST_SHARE, MOST_SHARE = 50, 95
ANCHORS_AT_ONCE, CANDIDATES_AT_ONCE = 256, 1024
#: Rows that meet in one task, of either kind.
BLOCK_ROWS = 65_536


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for each byte, the sum of the components whose bits are set."""
    n, width = anchors.shape
    groups = width // GROUP
    sums = np.zeros((groups, 1 << GROUP, n), dtype=anchors.dtype)
    for bit in range(GROUP):
        half = 1 << bit
        sums[:, half : 2 * half] = sums[:, :half] + anchors[:, bit::GROUP].T[:, None, :]
    return sums


def bit_planes(candidates: np.ndarray) -> np.ndarray:
    """(planes, candidates, groups): bytes of the two's complement, the highest plane last."""
    n, width = candidates.shape
    high = int(np.where(candidates < 0, ~candidates, candidates).max(initial=0)).bit_length() + 1
    return np.stack([np.packbits((candidates >> k) & 1, axis=1, bitorder="little") for k in range(high)])


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors): exact inner products."""
    found = np.zeros((planes.shape[1], sums.shape[2]), dtype=sums.dtype)
    looked = np.empty_like(found)
    planes = planes.astype(np.intp)
    highest = len(planes) - 1
    for k in range(highest, -1, -1):
        found <<= 1
        for group, table in enumerate(sums):
            np.take(table, planes[k][:, group], axis=0, out=looked, mode="clip")
            if k == highest:
                found -= looked
            else:
                found += looked
    return found


class _Side:
    """Rows of one side of a task, sorted by id, as arrays."""

    def __init__(self, table: pa.Table, width: int):
        table = table.combine_chunks()
        ids, rows = table.column("vec_id").to_numpy(), table.column("row").to_numpy()
        order = np.lexsort([rows, ids])
        self.ids, self.rows, self.labels = ids[order], rows[order], table.column("label").to_numpy()[order]
        lists = table.column("components").combine_chunks() if table.num_rows else None
        self.values = np.zeros((len(order), width), dtype=np.int64)
        if lists is not None:
            lengths = np.diff(lists.offsets.to_numpy())
            owner = np.repeat(np.arange(len(order)), lengths)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            self.values[owner, place] = lists.flatten().to_numpy()
            self.values = self.values[order]
        self.table, self.order = table, order


def _sides(candidates: pa.Table, anchors: pa.Table) -> tuple[_Side, _Side, type]:
    longest = max(
        (pa.compute.max(pa.compute.list_value_length(t.column("components"))).as_py() or 0 for t in (candidates, anchors)),
        default=0,
    )
    width = -(-max(longest, 1) // GROUP) * GROUP
    left, right = _Side(candidates, width), _Side(anchors, width)
    most = [max((abs(int(v)) for v in (s.values.min(initial=0), s.values.max(initial=0)))) + 1 for s in (left, right)]
    bound = 2 * most[0] * most[1] * width
    if bound >= 1 << 53:
        raise ValueError(f"components up to {most[0] / SCALE:.3g} and {most[1] / SCALE:.3g} are too large for exact scores")
    return left, right, np.int32 if bound < 1 << 31 else np.int64


def _blocks(n: int, size: int):
    return ((k, min(k + size, n)) for k in range(0, n, size))


def _best(anchor: np.ndarray, score: np.ndarray, place: np.ndarray, most: int) -> np.ndarray:
    """Which entries are among the first ``most`` of their anchor: high scores first, then by place."""
    order = np.lexsort([place, -score, anchor])
    sorted_anchor = anchor[order]
    first = np.searchsorted(sorted_anchor, sorted_anchor)
    return order[np.arange(len(order)) - first < most]


def _joined(parts: list[tuple]) -> list[np.ndarray]:
    if not parts:
        return [np.zeros(0, dtype=np.int64)] * 3
    return [np.concatenate(p) for p in zip(*parts, strict=True)]


def _find_positives(most: int):
    def find(_key, candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        if not candidates.num_rows or not anchors.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("anchor_row", "positive_row", "positive_id", "positive_score")})
        left, right, kind = _sides(candidates, anchors)
        planes = bit_planes(left.values)
        found = []
        for label in np.unique(right.labels):
            mine, theirs = np.flatnonzero(right.labels == label), np.flatnonzero(left.labels == label)
            for a, b in _blocks(len(mine), ANCHORS_AT_ONCE):
                own = mine[a:b]
                sums, parts = subset_sums(right.values[own].astype(kind)), []
                for c, d in _blocks(len(theirs), CANDIDATES_AT_ONCE):
                    block = theirs[c:d]
                    got = scores(sums, planes[:, block])
                    # One more than is wanted: the anchor itself may be among them.
                    if len(block) > most + 1:
                        enough = got >= np.partition(got, len(block) - most - 1, axis=0)[len(block) - most - 1]
                    else:
                        enough = np.ones(got.shape, dtype=bool)
                    enough &= left.rows[block][:, None] != right.rows[own][None, :]
                    row, column = np.nonzero(enough)
                    score = got[row, column].astype(np.int64)
                    best = _best(column, score, row, most)
                    parts.append((own[column[best]], score[best], block[row[best]]))
                anchor, score, place = _joined(parts)
                best = _best(anchor, score, place, most)
                found.append((anchor[best], score[best], place[best]))
        anchor, score, place = _joined(found)
        return pa.table(
            {
                "anchor_row": right.rows[anchor],
                "positive_row": left.rows[place],
                "positive_id": left.ids[place],
                "positive_score": score,
            }
        )

    return find


def _find_negatives(most: int, least_share: int, most_share: int):
    names = ("anchor_row", "place", "negative_id", "negative_score", "negative_row")

    def find(_key, candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        if not candidates.num_rows or not anchors.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        left, right, kind = _sides(candidates, anchors)
        bounds = right.table.column("positive_scores").to_pylist()
        bounds = [bounds[k] for k in right.order]
        count = max(map(len, bounds))
        # Without a positive of this place no score fits.
        low = np.array([[least_share * p for p in b] + [1] * (count - len(b)) for b in bounds])
        high = np.array([[most_share * p for p in b] + [0] * (count - len(b)) for b in bounds])
        fits = low <= high
        lowest = np.where(fits, low, np.iinfo(np.int64).max).min(axis=1)
        highest = np.where(fits, high, np.iinfo(np.int64).min).max(axis=1)
        # The same bounds for whole scores.
        lowest, highest = -(-lowest // 100), highest // 100
        planes = bit_planes(left.values)
        found = []
        for a, b in _blocks(len(right.rows), ANCHORS_AT_ONCE):
            sums = subset_sums(right.values[a:b].astype(kind))
            parts: list[list[tuple]] = [[] for _ in range(count)]
            for c, d in _blocks(len(left.rows), CANDIDATES_AT_ONCE):
                got = scores(sums, planes[:, c:d])
                near = (got >= lowest[a:b]) & (got <= highest[a:b]) & (left.labels[c:d, None] != right.labels[None, a:b])
                row, column = np.nonzero(near)
                score = got[row, column].astype(np.int64)
                row, column = row + c, column + a
                for k in range(count):
                    inside = np.flatnonzero((100 * score >= low[column, k]) & (100 * score <= high[column, k]))
                    best = inside[_best(column[inside], score[inside], row[inside], most)]
                    parts[k].append((column[best], score[best], row[best]))
            for k in range(count):
                anchor, score, place = _joined(parts[k])
                best = _best(anchor, score, place, most)
                found.append((anchor[best], score[best], place[best], np.full(len(best), k)))
        anchor, score, place, k = [np.concatenate(p) for p in zip(*found, strict=True)]
        columns = (right.rows[anchor], k.astype(np.int64), left.ids[place], score, left.rows[place])
        return pa.table(dict(zip(names, columns, strict=True)))

    return find


def _meetings(candidates: DataFrame, anchors: DataFrame, block_rows: int, find: Callable, schema: str) -> DataFrame:
    """``find`` on every block of candidates with every block of anchors."""
    spark = candidates.sparkSession
    many, few = candidates.count(), anchors.count()
    candidate_blocks = max(shuffle_partitions(spark), -(-many // block_rows))
    anchor_blocks = max(1, -(-few // block_rows))

    def block(of: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(of)).cast("int")

    def all_of(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    left = candidates.withColumn("c", block(candidate_blocks)).withColumn("a", all_of(anchor_blocks))
    right = anchors.withColumn("a", block(anchor_blocks)).withColumn("c", all_of(candidate_blocks))
    return left.groupBy("a", "c").cogroup(right.groupBy("a", "c")).applyInArrow(find, schema)


def mine_hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_share: int = LEAST_SHARE,
    most_share: int = MOST_SHARE,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The hardest negatives of every anchor and positive, by exact scores against all rows.

    ``vectors`` has vec_id, embedding and label; ``anchor`` is a condition on
    vec_id and label. A component x counts as floor(scale * x), x as double; a
    score is the inner product. An anchor's positives are the ``positives`` other
    rows of its label with the highest scores, and a positive's negatives the
    ``negatives`` highest of another label whose score is between ``least_share``
    and ``most_share`` hundredths of the positive's; so a negative positive score
    has none. Ties go to the smaller vec_id. Returns anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score; an anchor or positive without
    negatives has no row.

    Rows with a null vec_id, label or vector, or a component that is null or not
    finite, take no part. Repeated rows are rows of their own, and other rows to
    each other. A shorter vector counts as filled up with zeros, an empty one
    scores 0. Components whose scores may pass 2**53 are refused. An empty table
    gives an empty result; further columns are ignored.

    The work is anchors times rows, as the contract of exact scores has it; a
    task holds at most about ``block_rows`` rows of either side.
    """
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    rows = stored(
        vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding", anchor.alias("anchor"))
        .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
        .select(
            F.monotonically_increasing_id().alias("row"),
            "vec_id",
            "label",
            F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("components"),
            F.coalesce("anchor", F.lit(False)).alias("anchor"),
        ),
        "vectors",
    )
    candidates = rows.drop("anchor")
    anchors = rows.filter("anchor").drop("anchor")

    first = Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    found = _meetings(
        candidates,
        anchors,
        block_rows,
        _find_positives(positives),
        "anchor_row long, positive_row long, positive_id long, positive_score long",
    )
    pairs = stored(
        found.withColumn("place", F.row_number().over(first) - 1).filter(F.col("place") < positives), "positives"
    )
    bounds = stored(
        pairs.groupBy("anchor_row")
        .agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("found"))
        .select("anchor_row", F.col("found.positive_score").alias("positive_scores")),
        "bounds",
    )
    bounded = stored(anchors.join(bounds, F.col("row") == F.col("anchor_row")).drop("anchor_row"), "anchors")

    last = Window.partitionBy("anchor_row", "place").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    mined = stored(
        _meetings(
            candidates,
            bounded,
            block_rows,
            _find_negatives(negatives, least_share, most_share),
            "anchor_row long, place long, negative_id long, negative_score long, negative_row long",
        )
        .withColumn("rank", F.row_number().over(last))
        .filter(F.col("rank") <= negatives),
        "negatives",
    )
    names = bounded.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    return (
        mined.join(pairs.withColumn("place", F.col("place").cast("long")), ["anchor_row", "place"])
        .join(names, "anchor_row")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
