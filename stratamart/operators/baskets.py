"""Co-occurrence counts that never list the pairs of a raw basket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def basket_signatures(df: DataFrame, basket: Sequence[str], member: str) -> DataFrame:
    """(channel-like first basket key, sorted member set) with the number of baskets sharing it.

    Baskets with the same set of members are one counted row from here on, so the
    cost of pairing follows the number of distinct sets, not the number of baskets.
    """
    sets = df.groupBy(*basket).agg(F.sort_array(F.collect_set(member)).alias("members"))
    return sets.groupBy(basket[0], "members").agg(F.count("*").alias("baskets"))


def pair_counts(signatures: DataFrame, group: str, a: str, b: str, out: str) -> DataFrame:
    """Unordered pairs inside the distinct sets, weighted by the baskets behind each set."""
    left = signatures.select(group, "members", "baskets", F.posexplode("members").alias("i", a))
    right = left.select("*", F.explode(F.slice(F.col("members"), F.col("i") + 2, F.size("members"))).alias(b))
    return right.groupBy(group, a, b).agg(F.sum("baskets").alias(out))


def member_counts(signatures: DataFrame, group: str, member: str, out: str) -> DataFrame:
    return (
        signatures.select(group, "baskets", F.explode("members").alias(member))
        .groupBy(group, member).agg(F.sum("baskets").alias(out))
    )
