"""Text standardising and tolerant parsing (bad input becomes NULL, also under ANSI mode)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tidy(x) -> Column:
    return F.trim(_c(x))


def code(x) -> Column:
    """Codes are upper case without padding."""
    return F.upper(tidy(x))


def mixed_case(x) -> Column:
    return F.initcap(tidy(x))


def parse_date(x, fmt: str) -> Column:
    return F.to_date(F.try_to_timestamp(_c(x).cast("string"), F.lit(fmt)))


def parse_timestamp(x, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(_c(x), F.lit(fmt))


def parse_number(x) -> Column:
    """Number behind thousands separators; suppression marks such as (D) become NULL."""
    digits = F.regexp_replace(_c(x), ",", "")
    return F.when(digits.rlike(r"^[0-9.]+$"), digits.try_cast("double"))
