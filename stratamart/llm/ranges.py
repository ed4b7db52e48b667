"""Ordered sums and neighbours without a window over a whole group: range sort, one figure per range, windows inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import settle_at

HERE = ["p_group", "p_range"]


def _ranged(df: DataFrame, group: Column, order: list[Column]) -> DataFrame:
    ranged = df.withColumn("p_group", group).repartitionByRange(F.col("p_group"), *order).withColumn("p_range", F.spark_partition_id())
    return settle_at(ranged, "ranges")[0]  # the ranges must not move between the uses


def prefix_sums(df: DataFrame, group: Column, order: list[Column], value: Column) -> DataFrame:
    """df with ``before``: the sum of value over the rows of its group that precede it in order. group is not NULL."""
    ranged = _ranged(df.withColumn("p_value", value), group, order)
    # a row for each (group, range) that meet: at most as many as groups and ranges together
    totals = ranged.groupBy(*HERE).agg(F.sum("p_value").alias("p_total"))
    earlier = Window.partitionBy("p_group").orderBy("p_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*HERE, F.coalesce(F.sum("p_total").over(earlier), F.lit(0)).alias("p_offset"))
    within = Window.partitionBy(*HERE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = ranged.withColumn("p_within", F.coalesce(F.sum("p_value").over(within), F.lit(0)))
    return running.join(offsets, HERE).withColumn("before", F.col("p_offset") + F.col("p_within")).drop(*HERE, "p_offset", "p_within", "p_value")


def next_value(df: DataFrame, group: Column, order: list[Column], value: Column) -> DataFrame:
    """df with ``following``: value in the next row of its group in order, NULL in the last. group is not NULL."""
    ranged = _ranged(df.withColumn("p_value", F.struct(value.alias("v"))), group, order)
    firsts = ranged.groupBy(*HERE).agg(F.min(F.struct(*(c.alias(f"o{k}") for k, c in enumerate(order)), F.col("p_value").alias("v")))["v"].alias("p_first"))
    later = Window.partitionBy("p_group").orderBy("p_range")
    carried = firsts.select(*HERE, F.lead("p_first").over(later).alias("p_next"))
    inside = ranged.withColumn("p_lead", F.lead("p_value").over(Window.partitionBy(*HERE).orderBy(*order)))
    return inside.join(carried, HERE).withColumn("following", F.coalesce("p_lead", "p_next")["v"]).drop(*HERE, "p_lead", "p_next", "p_value")
