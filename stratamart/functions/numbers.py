"""Arithmetic that is exact where it sums and NULL-safe where it divides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"  # an amount
TOTAL = "decimal(24,2)"  # a sum of amounts, of any number of rows


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nz(x) -> Column:
    """The value, or NULL where it is zero, so that a ratio over it is NULL."""
    return F.nullif(_c(x), F.lit(0))


def ratio(part, whole, digits: int) -> Column:
    """part / whole, rounded. Money over money stays decimal, counts over counts go to double."""
    return F.round(_c(part) / nz(whole), digits)


def pct(part, whole, digits: int) -> Column:
    return F.round(_c(part) / nz(whole) * 100, digits)


def exact_sum(x) -> Column:
    """Sum of money; decimal addition does not depend on the order of the rows."""
    return F.sum(_c(x).cast(TOTAL)).cast(TOTAL)


def rounded_sum(x, digits: int = 2) -> Column:
    """Sum of a double, rounded once at the end; added up with six places, so that row order does not matter."""
    return F.round(F.sum(_c(x).cast("decimal(28,6)")), digits)


def flag_sum(x) -> Column:
    return F.sum(_c(x).cast("int"))


def exact_mean(x, digits: int) -> Column:
    """Mean through a decimal sum, so that a mean of doubles does not depend on row order."""
    return F.round(F.avg(_c(x).cast("decimal(28,6)")), digits)
