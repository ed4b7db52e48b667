"""One row per key, canonical projection and contract splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()) -> DataFrame:
    """Keep the newest row of every key.

    Rows that tie on ``newest_by`` are ordered by all their other columns, so the
    survivor never depends on how the rows were laid out. Because the filter asks
    for rank 1, Spark trims each task's output to one row per key before the
    shuffle (WindowGroupLimit): a key that fills a third of the input still sends
    at most one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_by]
    order = [F.col(c).desc_nulls_last() for c in [*newest_by, *rest]] or [F.lit(1)]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__pick", F.row_number().over(w)).where("__pick = 1").drop("__pick")


def key_copies(df: DataFrame, key: str) -> DataFrame:
    """Each key that is not NULL with the number of rows that carry it, in ``<key>_copies``."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(f"{key}_copies"))


def conform(df: DataFrame, shape: Sequence[tuple[str, str]], source_of: dict[str, str], **tags: str) -> DataFrame:
    """Project a feed onto an ordered (name, type) shape.

    A name without a source column in this feed becomes a typed NULL. Casts are
    tolerant: a value that does not fit the type becomes NULL, as it did before
    ANSI mode.
    """
    present = set(df.columns)

    def pick(name: str, dtype: str) -> Column:
        origin = source_of.get(name)
        value = F.col(origin).try_cast(dtype) if origin in present else F.lit(None).cast(dtype)
        return value.alias(name)

    return df.select(
        *(pick(n, t) for n, t in shape), *(F.lit(v).alias(k) for k, v in tags.items())
    )


def first_failure(*rules: tuple[str, Column]) -> Column:
    """Name of the first broken rule, NULL for a row that keeps the contract."""
    reason = F.lit(None).cast("string")
    for name, broken in reversed(rules):
        reason = F.when(broken, F.lit(name)).otherwise(reason)
    return reason


def business_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_")]
