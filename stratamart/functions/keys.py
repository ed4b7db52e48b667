"""Key expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_key(*parts: str) -> Column:
    """Stable 32-hex-digit key of a fact line: the head of SHA-256 over the joined parts."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 32)


def in_key_slice(keys: Sequence[str], keep_pct: int) -> Column:
    """True for about keep_pct percent of the keys; every copy of a key shares its fate.

    The hash is widened before abs() because the smallest int has no positive counterpart.
    """
    return F.abs(F.hash(*keys).cast("bigint")) % 100 < keep_pct
