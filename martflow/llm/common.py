"""What several operators share: shared-folder tables, numbering, blocks of texts."""

from __future__ import annotations

import functools
import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOWER_A_Z = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def with_package(query: Callable) -> Callable:
    """``query`` with this package's folder on the path of Python workers, which need not be installed with it."""
    root = str(Path(__file__).resolve().parents[2])

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        environment = spark.sparkContext.environment
        known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
        if root not in known:
            environment["PYTHONPATH"] = os.pathsep.join([root, *known])
        return query(spark, *args)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where the session names none (tests, single-machine sessions) it is a folder
    below the session's warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shared").rstrip("/")


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage: whatever reads the result finds the same rows in the same
    order, also after executors were lost.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_rows(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` stored with a number for each row, ``row``.

    The number depends on how Spark packs files into the partitions of a scan,
    which changes with the cores of the moment. So it is made once, and later
    jobs read it.
    """
    return stored(docs.withColumn("row", F.monotonically_increasing_id()), name)


#: Row numbers that are sent to all tasks: 8 MiB of them.
BROADCAST_ROWS = 1 << 20


def _sent(ids: DataFrame) -> DataFrame | None:
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else None


def only_rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` without those that the stored table ``ids`` (row) lacks, before a join that shuffles them.

    Few enough numbers are broadcast; more leave the choice to the join.
    """
    sent = _sent(ids)
    return rows if sent is None else rows.join(sent, "row", "left_semi")


def without_rows(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` without those in the stored table ``ids`` (row); only many numbers shuffle them."""
    sent = _sent(ids)
    return rows.join(ids.hint("shuffle_hash") if sent is None else sent, "row", "left_anti")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``rows`` of a stored table with ``name``: 0, 1, 2, ... within equal ``keys``.

    No group meets in one task: its rows are dealt to blocks by their content
    and place, numbered in each block, and moved up by the rows of the blocks
    before. ``keys`` must not be null. The blocks are stored once and read twice:
    places that were made anew by each read could differ between the two.
    """
    keys, order = list(keys), list(order)
    blocks = max(16, shuffle_partitions(rows.sparkSession))
    dealt = stored(
        rows.withColumn("_row", F.monotonically_increasing_id()).withColumn(
            "_block", F.pmod(F.xxhash64(*order, "_row"), F.lit(blocks))
        ),
        "blocks",
    )
    within = dealt.withColumn(
        "_place", F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*order, "_row")) - 1
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(*keys, "_block")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_block", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        within.join(offsets, [*keys, "_block"])
        .withColumn(name, (F.col("_place") + F.col("_offset")).cast("long"))
        .select(*rows.columns, name)
    )


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, none for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def held_in(bucket: int, of: int) -> Column:
    """Whether crc32(doc_id as text) mod ``of`` is ``bucket``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == bucket, F.lit(False))


def packed(docs: DataFrame, *own: str) -> DataFrame:
    """``own`` columns and all others in one struct, where their names clash with nothing."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    return docs.select(*own, F.struct(F.lit(True).alias("_"), *others).alias("_kept"))


def unpacked(rows: DataFrame, columns: Sequence[str], *own: str) -> DataFrame:
    """The columns of ``packed`` as they were."""
    return rows.select(*[c if c in own else F.col("_kept")[c].alias(c) for c in columns])


def batches_of_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in pieces of about ``limit`` bytes of ``column`` or a single row."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start, lengths = 0, pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        for row, length in enumerate(lengths):
            size += int(length)
            if size >= limit:
                held.append(batch.slice(start, row + 1 - start))
                yield _joined(held)
                held, size, start = [], 0, row + 1
        if start < batch.num_rows:
            held.append(batch.slice(start))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    whole = pa.Table.from_batches(parts).combine_chunks().to_batches()
    return whole[0]
