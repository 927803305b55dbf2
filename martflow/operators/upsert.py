"""Slowly changing dimension, type 1: overwrite matches, add new keys, keep the rest.

One full outer join on the key yields the new table and, per row, what happened
to it. Rules:

* A matched row takes every listed column from the source, NULL included.
* A matched row counts as updated even if nothing differs.
* Target rows the source does not mention stay.
* The source must have each key once and no NULL key. This is counted on the
  key column alone, as a subquery of the same plan; a violation fails the job
  before any row is merged. Giving ``latest_by`` instead picks one row per key:
  the greatest by those columns, ties broken by the other columns, so the
  choice is reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE = "change"
UPDATED, INSERTED, KEPT = "updated", "inserted", "kept"


def _violation(source: DataFrame, key: str, repeats_too: bool) -> Column:
    """Scalar: what is wrong with the source's keys, NULL if nothing is."""
    copies = source.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    wrong = F.col("key").isNull()
    if repeats_too:
        wrong |= F.col("copies") > 1
    # NULL sorts first, so a NULL key is the one reported.
    first = copies.filter(wrong).agg(F.min(F.struct("key", "copies")).alias("first")).select("first.*")
    rows = F.col("copies").cast("string")
    message = F.when(
        F.col("key").isNull() & F.col("copies").isNotNull(),
        F.concat(F.lit(f"upsert source has NULL {key} in rows: "), rows),
    ).when(
        F.col("copies").isNotNull(),
        F.concat(F.lit(f"upsert source repeats {key} "), F.col("key").cast("string"), F.lit(", copies: "), rows),
    )
    return first.select(message.alias("message")).scalar()


def one_row_per_key(source: DataFrame, key: str, latest_by: Sequence[str] = ()) -> DataFrame:
    """The source with a single row per key, or an error at run time.

    Choosing by ``latest_by`` folds the rows of a key map-side, so even a key
    with most of the rows arrives as one row per task.
    """
    violation = _violation(source, key, repeats_too=not latest_by)
    sound = F.when(violation.isNotNull(), F.raise_error(violation).cast("boolean")).otherwise(F.lit(True))
    if latest_by:
        order = list(dict.fromkeys([*latest_by, *source.columns]))
        best = source.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct(*order)).alias("_row"))
        return best.select("_row.*").select(*source.columns).filter(sound)
    return source.filter(sound)


def scd1_changes(
    target: DataFrame,
    source: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    latest_by: Sequence[str] = (),
) -> DataFrame:
    """The merged table plus a ``change`` column: updated, inserted or kept.

    ``columns`` are the ones the source overwrites (default: all but the key).
    Other target columns keep their value, and are NULL in inserted rows.
    """
    columns = [c for c in target.columns if c != key] if columns is None else list(columns)
    old = target.alias("old")
    used = list(dict.fromkeys([key, *columns, *latest_by]))
    new = one_row_per_key(source.select(*used), key, latest_by).alias("new")
    old_key, new_key = F.col(f"old.{key}"), F.col(f"new.{key}")
    in_source = new_key.isNotNull()

    def merged(name: str) -> Column:
        kind = target.schema[name].dataType
        if name == key:
            value = F.coalesce(new_key.cast(kind), old_key)
        elif name in columns:
            value = F.when(in_source, F.col(f"new.{name}").cast(kind)).otherwise(F.col(f"old.{name}"))
        else:
            value = F.col(f"old.{name}")
        return value.alias(name)

    change = F.when(old_key.isNull(), INSERTED).when(in_source, UPDATED).otherwise(KEPT)
    return old.join(new, old_key == new_key, "full_outer").select(
        *[merged(c) for c in target.columns], change.alias(CHANGE)
    )


def scd1_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    latest_by: Sequence[str] = (),
) -> DataFrame:
    """The merged table alone."""
    return scd1_changes(target, source, key, columns, latest_by).drop(CHANGE)


def change_counts() -> list[Column]:
    """Aggregates over a ``change`` column; also usable with ``DataFrame.observe``."""
    change = F.col(CHANGE)
    return [
        F.count_if(change == UPDATED).alias("updated_count"),
        F.count_if(change == INSERTED).alias("inserted_count"),
        F.count_if(change == KEPT).alias("kept_count"),
    ]


def scd1_counts(changes: DataFrame) -> DataFrame:
    """One row with the number of updated, inserted and kept rows."""
    return changes.agg(*change_counts())
