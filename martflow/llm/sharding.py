"""Sharding by a hierarchical weighted hash tree.

A tree names regions, their racks and the racks' shards, each shard with a
weight; the weight of a rack or region is the sum below it. A key descends
level by level: at each node every child draws an exponential number from the
hash of key and child, divided by the child's weight, and the smallest draw
wins, so a child wins in proportion to its weight. A draw depends on that child
alone. If weights change, a key moves only into a subtree that became heavier
or out of one that became lighter; what is drawn between other children stays.

Only DataFrame functions are used; a row needs no shuffle to find its shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import numbered, text_bytes

#: region -> rack -> shard -> weight
Tree = dict[str, dict[str, dict[int, float]]]

ROW_OVERHEAD = 8


def uniform_tree(regions: int, racks: int, shards: int) -> Tree:
    """Equal weights; shards are numbered through from 0."""
    return {
        f"region{r}": {
            f"rack{k}": {(r * racks + k) * shards + s: 1.0 for s in range(shards)} for k in range(racks)
        }
        for r in range(regions)
    }


def with_shard(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, numbered next, in a region and rack of its own.

    No present subtree changes its weight, so rows move into the new shard only.
    """
    number = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return {**tree, f"region-of-{number}": {"rack0": {number: weight}}}


def shard_weight(node: dict | float) -> float:
    return float(node) if not isinstance(node, dict) else math.fsum(shard_weight(child) for child in node.values())


def _draw(key: Column, path: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(path)), 11)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(2**53))) / F.lit(weight)


def _choice(key: Column, path: str, children: dict) -> Column:
    """The child that wins the draw; ties, which need equal hashes, go to the smaller name."""
    weighted = [(name, weight) for name, child in children.items() if (weight := shard_weight(child)) > 0]
    if not weighted:
        raise ValueError(f"no weight below {path or 'the root'}")
    draws = [
        F.struct(_draw(key, f"{path}/{name}", weight).alias("draw"), F.lit(name).alias("name"))
        for name, weight in weighted
    ]
    return F.array_min(F.array(*draws))["name"]


def descend(df: DataFrame, tree: Tree, key: str = "doc_id", prefix: str = "") -> DataFrame:
    """Adds ``<prefix>region``, ``<prefix>rack`` and ``<prefix>shard``.

    Equal keys meet in one shard; null counts as a key.
    """
    region, rack, shard = (f"{prefix}{level}" for level in ("region", "rack", "shard"))
    out = df.withColumn(region, _choice(F.col(key), "", tree))
    racks = shards = F
    for r, below in tree.items():
        if shard_weight(below) <= 0:
            continue
        racks = racks.when(F.col(region) == r, _choice(F.col(key), f"/{r}", below))
        for k, leaves in below.items():
            if shard_weight(leaves) > 0:
                at = (F.col(region) == r) & (F.col(rack) == k)
                shards = shards.when(at, _choice(F.col(key), f"/{r}/{k}", leaves))
    return out.withColumn(rack, racks).withColumn(shard, shards.cast("int"))


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree | None = None) -> DataFrame:
    """Puts every row of ``docs`` (doc_id, text) into a shard of ``tree``.

    Returns doc_id, size (UTF-8 bytes and ``ROW_OVERHEAD``), text_crc32, law,
    shard, slot (gapless from 0 in each shard), grown_shard (in ``grown``; null
    without one), region and rack. Null ids are one key and share a shard. A
    null text has no bytes and the checksum of the empty text. Repeated rows
    each keep a row and a slot. An empty table gives an empty result. Further
    columns of ``docs`` are ignored.
    """
    rows = docs.select(
        "doc_id",
        (text_bytes(F.col("text")) + ROW_OVERHEAD).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = descend(rows, tree)
    if grown is None:
        placed = placed.withColumn("grown_shard", F.lit(None).cast("int"))
    else:
        placed = descend(placed, grown, prefix="grown_").drop("grown_region", "grown_rack")
    slots = numbered(placed, ["shard"], ["doc_id", "text_crc32"], "slot")
    return slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "region", "rack")
