"""Distributed integrity checks.

Each check returns a frame of findings. Rows are folded by key before they are
shuffled, so a repeated value costs no more than a rare one.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.functions.text import NOT_BLANK, POSTAL_CODE
from martflow.schemas import FOREIGN_KEYS, PRIMARY_KEYS, ForeignKey


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row values that occur more than once, with their number of copies."""
    columns = list(columns or df.columns)
    return df.groupBy(columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def key_violations(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Key values that are repeated or have an unknown part, with their number of rows."""
    key = [key] if isinstance(key, str) else list(key)
    unknown = reduce(Column.__or__, [F.col(k).isNull() for k in key])
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter((F.col("copies") > 1) | unknown)


def _counted(df: DataFrame, tests: Mapping[tuple[str, ...], Column], *names: str) -> DataFrame:
    """Count conditions in one pass over ``df``; one labelled row per condition.

    ``tests`` maps labels (one per name in ``names``) to a condition.
    """
    rows = F.count(F.lit(1))
    findings = F.array(
        *[
            F.struct(
                *[F.lit(text).alias(name) for name, text in zip(names, labels)],
                rows.alias("checked_rows"),
                F.count_if(test).alias("failed_rows"),
            )
            for labels, test in tests.items()
        ]
    )
    return df.agg(findings.alias("findings")).select(F.inline("findings"))


def _is_missing(columns: Sequence[str]) -> dict[str, Column]:
    return {c: F.col(c).isNull() for c in columns}


def _is_misformatted(rules: Mapping[str, str]) -> dict[str, Column]:
    return {c: ~F.col(c).cast("string").rlike(pattern) for c, pattern in rules.items()}


def missing_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column."""
    tests = {(c,): test for c, test in _is_missing(columns or df.columns).items()}
    return _counted(df, tests, "column").withColumnRenamed("failed_rows", "missing_rows")


def format_violations(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Known values per column that do not match the column's regular expression."""
    tests = {(c,): test for c, test in _is_misformatted(rules).items()}
    return _counted(df, tests, "column").withColumnRenamed("failed_rows", "bad_rows")


def misformatted_rows(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """The rows behind ``format_violations``."""
    return df.filter(~F.col(column).cast("string").rlike(pattern))


def parents_without_children(parent: DataFrame, parent_key: str, child: DataFrame, child_key: str) -> DataFrame:
    """Parent keys no child row refers to."""
    children = child.select(F.col(child_key).alias("_child_key")).distinct()
    return parent.join(children, F.col(parent_key) == F.col("_child_key"), "left_anti").select(parent_key)


EXACT = "decimal(38,4)"


def reconciliation(source: DataFrame, mart: DataFrame, measures: Mapping[str, str]) -> DataFrame:
    """Totals before and after a load, one row per measure.

    ``measures`` maps a source column to the mart column holding its sums; give
    a column of ones to compare row counts. Values are shown as double, but the
    difference is taken of exact sums.
    """

    def totals(df: DataFrame, columns: Mapping[str, str], value: str) -> DataFrame:
        sums = df.agg(*[F.sum(F.col(c).cast(EXACT)).cast(EXACT).alias(m) for m, c in columns.items()])
        return sums.unpivot([], list(columns), "measure", value)

    before = totals(source, {m: s for s, m in measures.items()}, "before")
    after = totals(mart, {m: m for m in measures.values()}, "after")
    return before.join(after, "measure").select(
        "measure",
        F.col("before").cast("double").alias("source_value"),
        F.col("after").cast("double").alias("mart_value"),
        (F.col("after") - F.col("before")).cast("double").alias("difference"),
    )


def calendar_gaps(dim_time: DataFrame) -> DataFrame:
    """Days between the first and last calendar day that have no row."""
    span = dim_time.agg(F.min("date").alias("first"), F.max("date").alias("last")).filter(F.col("first").isNotNull())
    expected = span.select(F.explode(F.sequence("first", "last")).alias("missing_date"))
    return expected.join(dim_time.select("date"), F.col("missing_date") == F.col("date"), "left_anti")


def orphan_keys(fact: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """Known fact keys the dimension lacks, with the number of fact rows."""
    used = fact.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("fact_rows"))
    parents = dimension.select(F.col(key).alias("_parent_key"))
    return used.join(parents, F.col(column) == F.col("_parent_key"), "left_anti")


def _dimension_keys(tables: Mapping[str, DataFrame], dimensions: Iterable[str]) -> DataFrame:
    """``(dimension, dimension_key, copies)`` over several dimensions."""
    keys = [
        tables[d].select(F.lit(d).alias("dimension"), F.col(PRIMARY_KEYS[d]).cast("bigint").alias("dimension_key"))
        for d in dimensions
    ]
    return union_all(keys).groupBy("dimension", "dimension_key").agg(F.count(F.lit(1)).alias("copies"))


def _used_keys(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey]) -> DataFrame:
    """``(fk, key, fact_rows, referred)``: known fact keys with their number of rows.

    ``fk`` is the position in ``keys``, ``referred`` its dimension.
    """

    def unfolded(fact: str) -> DataFrame:
        pairs = [
            F.struct(F.lit(i).alias("fk"), F.col(fk.column).cast("bigint").alias("key"))
            for i, fk in enumerate(keys)
            if fk.fact == fact
        ]
        return tables[fact].select(F.inline(F.array(*pairs))).filter(F.col("key").isNotNull())

    facts = list(dict.fromkeys(fk.fact for fk in keys))
    return (
        union_all([unfolded(f) for f in facts])
        .groupBy("fk", "key")
        .agg(F.count(F.lit(1)).alias("fact_rows"))
        .withColumn("referred", F.element_at(F.array(*[F.lit(fk.dimension) for fk in keys]), F.col("fk") + 1))
    )


def foreign_keys(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey] = FOREIGN_KEYS) -> DataFrame:
    """One row per foreign key: fact rows with a known key, and those without a parent.

    Each fact is read once for all its keys, and its rows are folded to one per
    key value before the shuffle; the dimensions join that small result.
    """
    parents = _dimension_keys(tables, dict.fromkeys(fk.dimension for fk in keys))
    joined = _used_keys(tables, keys).join(
        parents,
        (F.col("referred") == F.col("dimension")) & (F.col("key") == F.col("dimension_key")),
        "left",
    )

    def total(number: int, orphans_only: bool) -> Column:
        of_this_key = F.col("fk") == number
        if orphans_only:
            of_this_key &= F.col("dimension").isNull()
        return F.coalesce(F.sum(F.when(of_this_key, F.col("fact_rows"))), F.lit(0))

    findings = F.array(
        *[
            F.struct(
                F.lit(fk.fact).alias("fact"),
                F.lit(fk.column).alias("column"),
                F.lit(fk.dimension).alias("dimension"),
                total(i, orphans_only=False).alias("checked_rows"),
                total(i, orphans_only=True).alias("orphan_rows"),
            )
            for i, fk in enumerate(keys)
        ]
    )
    return joined.agg(findings.alias("findings")).select(F.inline("findings"))


# --- one table with the outcome of every check --------------------------------

# Columns that may not be NULL and formats of a sound mart.
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "dim_time": ("time_key", "date"),
    "dim_customer": ("customer_key", "name", "segment"),
    "dim_product": ("product_key", "product_name"),
    "dim_location": ("location_key", "country", "region"),
    "fct_sales": ("customer_key", "location_key", "product_key", "time_key", "quantity", "sales"),
    "fct_marketing": ("customer_key", "location_key", "time_key"),
}
FORMATS: dict[str, dict[str, str]] = {
    "dim_location": {"postal_code": POSTAL_CODE},
    "dim_customer": {"name": NOT_BLANK},
    "dim_product": {"product_name": NOT_BLANK},
}


def _finding(df: DataFrame, table: Column, check: Column, column: Column, failed: str = "failed_rows") -> DataFrame:
    return df.select(
        table.alias("table"),
        check.alias("check"),
        column.alias("column"),
        F.col("checked_rows").cast("bigint").alias("checked_rows"),
        F.col(failed).cast("bigint").alias("failed_rows"),
        (F.col(failed) == 0).alias("passed"),
    )


def _column_findings(df: DataFrame, table: str, required: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """Missing values and formats of a table from a single pass."""
    tests = {("missing", c): test for c, test in _is_missing(required).items()}
    tests |= {("format", c): test for c, test in _is_misformatted(rules).items()}
    return _finding(_counted(df, tests, "check", "column"), F.lit(table), F.col("check"), F.col("column"))


def _duplicate_findings(df: DataFrame, table: str) -> DataFrame:
    copies = df.groupBy(df.columns).agg(F.count(F.lit(1)).alias("copies"))
    total = copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("checked_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("failed_rows"),
    )
    return _finding(total, F.lit(table), F.lit("duplicates"), F.lit("*"))


def key_findings(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Uniqueness of every primary key, from one grouping of all of them."""
    keys = _dimension_keys(tables, PRIMARY_KEYS)
    surplus = F.when(F.col("dimension_key").isNull(), F.col("copies")).otherwise(F.col("copies") - 1)

    def total(value: Column, dimension: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("dimension") == dimension, value)), F.lit(0))

    findings = F.array(
        *[
            F.struct(
                F.lit(d).alias("table"),
                F.lit(key).alias("column"),
                total(F.col("copies"), d).alias("checked_rows"),
                total(surplus, d).alias("failed_rows"),
            )
            for d, key in PRIMARY_KEYS.items()
        ]
    )
    counted = keys.agg(findings.alias("findings")).select(F.inline("findings"))
    return _finding(counted, F.col("table"), F.lit("unique"), F.col("column"))


def foreign_key_findings(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Known fact keys without a parent, over all foreign keys."""
    found = foreign_keys(tables)
    return _finding(found, F.col("fact"), F.lit("foreign_key"), F.col("column"), failed="orphan_rows")


def _calendar_findings(dim_time: DataFrame) -> DataFrame:
    span = F.datediff(F.max("date"), F.min("date")) + 1
    counted = dim_time.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        F.coalesce(span - F.count_distinct("date"), F.lit(0)).alias("failed_rows"),
    )
    return _finding(counted, F.lit("dim_time"), F.lit("complete"), F.lit("date"))


def _reconciled_findings(tables: Mapping[str, DataFrame], lines: DataFrame) -> DataFrame:
    """Totals of the sales fact against the order lines: a measure fails if they differ at all."""
    measures = {"quantity": "quantity", "subtotal": "sales"}
    compared = reconciliation(lines, tables["fct_sales"], measures)
    counted = lines.agg(F.count(F.lit(1)).alias("checked_rows")).scalar()
    failed = F.coalesce((F.col("difference") != 0).cast("int"), F.lit(0))
    found = compared.select("measure", counted.alias("checked_rows"), failed.alias("failed_rows"))
    return _finding(found, F.lit("fct_sales"), F.lit("reconciled"), F.col("measure"))


def check_suite(
    tables: Mapping[str, DataFrame],
    required: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS,
    formats: Mapping[str, Mapping[str, str]] = FORMATS,
    unique_rows: Sequence[str] = ("fct_sales", "fct_marketing"),
    lines: DataFrame | None = None,
) -> DataFrame:
    """``(table, check, column, checked_rows, failed_rows, passed)`` for a whole mart.

    ``duplicates`` counts copies beyond the first of equal rows, ``unique``
    copies beyond the first of a key plus rows with a NULL key, ``missing``
    NULLs, ``format`` known values that do not match, ``complete`` days missing
    from the calendar and ``foreign_key`` fact rows whose known key has no
    parent. With the order ``lines`` behind the sales fact, ``reconciled`` fails
    by 1 for a total that differs. Pass stored tables: each is scanned a few times.
    """
    findings = [_duplicate_findings(tables[t], t) for t in unique_rows]
    findings.append(key_findings(tables))
    findings += [
        _column_findings(tables[t], t, required.get(t, ()), formats.get(t, {}))
        for t in tables
        if required.get(t) or formats.get(t)
    ]
    findings.append(_calendar_findings(tables["dim_time"]))
    findings.append(foreign_key_findings(tables))
    if lines is not None:
        findings.append(_reconciled_findings(tables, lines))
    return union_all(findings)
