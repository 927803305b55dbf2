"""Where two versions of a table differ: a tree of checksums, then only the leaves that differ.

Each side is read once for checksums that do not depend on row order: one per
branch (for example a month) and key bucket. They are summed up to branches and
compared from the top, so equal branches are done with. The rows of the leaves
that differ are then compared by key; all others are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 64
BRANCH, LEAF = "_branch", "_leaf"
HASH_SUM = "decimal(38,0)"


def _digest(columns: Sequence[str], salt: int) -> Column:
    """A hash of a row's values; an unknown value is one of its own, not a gap."""
    return F.xxhash64(F.lit(salt), *[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


def _placed(df: DataFrame, key: Sequence[str], branch: Column, buckets: int) -> DataFrame:
    leaf = F.pmod(_digest(key, 0), F.lit(buckets)).cast("int")
    return df.select("*", branch.cast("string").alias(BRANCH), leaf.alias(LEAF))


def checksums(df: DataFrame, key: Sequence[str], branch: Column, buckets: int = BUCKETS) -> DataFrame:
    """Rows and two order-independent checksums per branch and key bucket.

    A sum tells a doubled row from none, which an exclusive or would not; the
    two are of different hashes, so they err independently.
    """
    values = df.columns
    return (
        _placed(df, key, branch, buckets)
        .groupBy(BRANCH, LEAF)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(_digest(values, 1).cast(HASH_SUM)).cast(HASH_SUM).alias("total"),
            F.bit_xor(_digest(values, 2)).alias("parity"),
        )
    )


def _unequal(left: DataFrame, right: DataFrame, *by: str) -> DataFrame:
    """The values of ``by`` at which the two sides' checksums are not the same."""
    found = ["rows", "total", "parity"]
    other = right.select(*[F.col(c).alias(f"other_{c}") for c in (*by, *found)])
    same_place = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"other_{c}")) for c in by])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"other_{c}")) for c in found])
    joined = left.join(other, same_place, "full_outer").filter(~same)
    here = F.col("rows").isNotNull()
    return joined.select(*[F.when(here, F.col(c)).otherwise(F.col(f"other_{c}")).alias(c) for c in by])


def _summed(leaves: DataFrame) -> DataFrame:
    return leaves.groupBy(BRANCH).agg(
        F.sum("rows").alias("rows"), F.sum("total").cast(HASH_SUM).alias("total"), F.bit_xor("parity").alias("parity")
    )


def unequal_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """The leaves of two tables of ``checksums`` that differ: first the branches that do, then their leaves.

    The tables have as many rows as branches times buckets, however large the
    data; give stored ones, which are read twice.
    """
    branches = _unequal(_summed(left), _summed(right), BRANCH).withColumnRenamed(BRANCH, "_open")
    within = [t.join(branches, F.col(BRANCH).eqNullSafe(F.col("_open")), "left_semi") for t in (left, right)]
    return _unequal(*within, BRANCH, LEAF)


def table_differences(
    expected: DataFrame, found: DataFrame, key: Sequence[str], branch: Column, folder: str, buckets: int = BUCKETS
) -> DataFrame:
    """``differing_rows`` of two stored tables, by checksums that are kept in ``folder``.

    Both are read once for checksums and once more for the leaves that differ.
    """
    spark = expected.sparkSession
    sides = []
    for name, df in (("expected", expected), ("found", found.select(*expected.columns))):
        checksums(df, key, branch, buckets).write.parquet(f"{folder}/{name}")
        sides.append(spark.read.parquet(f"{folder}/{name}"))
    unequal_leaves(*sides).write.parquet(f"{folder}/unequal")
    return differing_rows(expected, found, key, branch, spark.read.parquet(f"{folder}/unequal"), buckets)


def differing_rows(
    expected: DataFrame, found: DataFrame, key: Sequence[str], branch: Column, leaves: DataFrame, buckets: int = BUCKETS
) -> DataFrame:
    """One row per key whose rows are not the same on both sides, looked for in ``leaves`` only.

    ``difference`` is ``lost`` (fewer rows than expected, none changed),
    ``doubled`` (more, all of them copies of expected ones), ``added`` (more,
    others) or ``changed``; with ``expected_rows``, ``found_rows`` and, for
    changed keys, the ``columns`` whose smallest or largest value differs.
    Unknown key parts are values like others; a key may have any number of rows.
    """
    columns, open_leaves = expected.columns, leaves.select(F.col(BRANCH).alias("_b"), F.col(LEAF).alias("_l"))

    def side(df: DataFrame, is_expected: int) -> DataFrame:
        placed = _placed(df.select(*columns), key, branch, buckets)
        kept = placed.join(open_leaves, F.col(BRANCH).eqNullSafe(F.col("_b")) & (F.col(LEAF) == F.col("_l")), "left_semi")
        return kept.select(*columns, F.lit(is_expected).alias("_e"), F.lit(1 - is_expected).alias("_f"))

    values = side(expected, 1).unionByName(side(found, 0)).groupBy(*columns).agg(F.sum("_e").alias("_e"), F.sum("_f").alias("_f"))
    less, more = F.col("_e") > F.col("_f"), F.col("_f") > F.col("_e")
    measures = [c for c in columns if c not in key]

    def differs(c: str) -> Column:
        ends = [(f(F.when(less, F.col(c))), f(F.when(more, F.col(c)))) for f in (F.min, F.max)]
        return ~reduce(Column.__and__, [a.eqNullSafe(b) for a, b in ends])

    per_key = values.groupBy(*key).agg(
        F.sum("_e").alias("expected_rows"),
        F.sum("_f").alias("found_rows"),
        F.coalesce(F.sum(F.when(less, F.col("_e") - F.col("_f"))), F.lit(0)).alias("_less"),
        F.coalesce(F.sum(F.when(more, F.col("_f") - F.col("_e"))), F.lit(0)).alias("_more"),
        F.count_if(more & (F.col("_e") == 0)).alias("_new"),
        F.array(*[F.when(differs(c), F.lit(c)) for c in measures]).alias("_columns"),
    )
    difference = (
        F.when((F.col("_less") > 0) & (F.col("_more") > 0), "changed")
        .when(F.col("_less") > 0, "lost")
        .when(F.col("_new") > 0, "added")
        .otherwise("doubled")
    )
    return per_key.filter("_less > 0 or _more > 0").select(
        *key,
        difference.alias("difference"),
        "expected_rows",
        "found_rows",
        F.when(difference == "changed", F.array_join(F.array_compact("_columns"), ",")).alias("columns"),
    )
