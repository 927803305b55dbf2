"""Rules on rows: what can be repaired is, what cannot is set aside with the rule's name."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martflow.functions.text import NOT_BLANK, POSTAL_CODE, repaired_postal_code

FAILED, REPAIRED = "failed_rules", "repaired_rules"


@dataclass(frozen=True)
class Rule:
    """A column's values must satisfy ``holds``; ``repair`` is tried on those that do not.

    ``holds`` that is neither true nor false (an unknown value, mostly) passes.
    """

    name: str
    column: str
    holds: Callable[[Column], Column]
    repair: Callable[[Column], Column] | None = None


def known(column: str) -> Rule:
    return Rule(f"{column} known", column, lambda c: c.isNotNull())


def formatted(column: str, pattern: str, repair: Callable[[Column], Column] | None = None) -> Rule:
    return Rule(f"{column} format", column, lambda c: c.cast("string").rlike(pattern), repair)


#: The bundled places have postal codes that lost their leading zeros.
LOCATION_RULES = (
    known("location_key"),
    known("country"),
    formatted("country", NOT_BLANK),
    formatted("postal_code", POSTAL_CODE, lambda c: repaired_postal_code(F.trim(c))),
)


def judged(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with repaired columns, and the names of the rules that failed and that were repaired.

    Rules are applied in order, and a later one sees what an earlier one has
    repaired. A value that its repair does not mend stays as it was.
    """
    failed, mended = [], []
    for rule in rules:
        value = F.col(rule.column)
        wrong = ~F.coalesce(rule.holds(value), F.lit(True))
        if rule.repair is not None:
            better = rule.repair(value)
            helps = wrong & F.coalesce(rule.holds(better), F.lit(False))
            flag = f"_mended_{len(mended)}"
            df = df.withColumn(flag, helps).withColumn(rule.column, F.when(helps, better).otherwise(value))
            mended.append((flag, rule.name))
            wrong = ~F.coalesce(rule.holds(F.col(rule.column)), F.lit(True))
        flag = f"_failed_{len(failed)}"
        df = df.withColumn(flag, wrong)
        failed.append((flag, rule.name))

    def names(flags: list[tuple[str, str]]) -> Column:
        found = [F.when(F.col(flag), F.lit(name)) for flag, name in flags]
        return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")

    out = df.withColumn(FAILED, names(failed)).withColumn(REPAIRED, names(mended))
    return out.drop(*[flag for flag, _ in failed + mended])


@dataclass(frozen=True)
class Repaired:
    """What passes, what does not, and how many rows each rule failed and repaired."""

    accepted: DataFrame
    rejected: DataFrame
    failed: dict[str, int]
    repaired: dict[str, int]


def split(df: DataFrame, rules: Sequence[Rule], path: str) -> Repaired:
    """Judge ``df`` and store it below ``path``, in one pass that also counts.

    Accepted rows have the columns of ``df``, rejected ones also the names of the
    rules they fail. Whatever the source, each row is in one of the two.
    """
    spark, columns = df.sparkSession, df.columns
    folder = f"{path}/judged-{uuid4().hex}"
    counts = Observation()
    numbers = [
        F.count_if(F.array_contains(list_of, rule.name)).alias(f"{list_of} {k}")
        for k, rule in enumerate(rules)
        for list_of in (FAILED, REPAIRED)
    ]
    rejected = (F.size(FAILED) > 0).alias("_rejected")
    stored = judged(df, rules).observe(counts, F.count(F.lit(1)).alias("rows"), *numbers).select("*", rejected)
    stored.write.partitionBy("_rejected").parquet(folder)
    schema = stored.schema
    both = spark.read.schema(schema).parquet(folder)
    found = counts.get
    return Repaired(
        both.filter(~F.col("_rejected")).select(*columns),
        both.filter("_rejected").select(*columns, FAILED, REPAIRED),
        {rule.name: found[f"{FAILED} {k}"] for k, rule in enumerate(rules)},
        {rule.name: found[f"{REPAIRED} {k}"] for k, rule in enumerate(rules) if rule.repair is not None},
    )
