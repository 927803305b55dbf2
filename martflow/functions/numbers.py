"""Arithmetic with the mart's rounding and division rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martflow.schemas import MONEY


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL where the denominator is zero or unknown."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded_mean(total: Column, n: Column, digits: int = 2) -> Column:
    """``total / n`` rounded half away from zero.

    ``total`` should be an exact (decimal) sum, so that the result does not
    depend on the order in which partitions were added up. The quotient goes
    through a decimal because rounding a double would round its binary
    neighbour: 2.675 is stored below 2.675.
    """
    return F.round(ratio(total, n).cast("decimal(18,10)"), digits)


def money_sum(column: str) -> Column:
    """Exact sum of money, whatever the order of the rows, also of a double column."""
    return F.sum(F.col(column).cast(MONEY)).cast(MONEY)


def or_zero(total: Column) -> Column:
    """A sum that gives 0, not NULL, for a group without any value."""
    return F.coalesce(total, F.lit(0))
