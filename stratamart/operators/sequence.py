"""Look-back operators that cut a busy key into time bins instead of sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.sinks.scratch import settle


def previous_value(
    df: DataFrame, key: str, order: Sequence[str], value: str, bin_: Column, out: str,
) -> DataFrame:
    """lag(value) per key in ``order``, with the work split by (key, bin).

    ``bin_`` must rise with the first order column. The table is read and shuffled once, by (key, bin), and an ordinary lag is
    used inside a bin. What the last row of a bin hands on to the key's next bin is one row a bin; only the first row of each
    bin meets it.
    """
    binned = df.withColumn("__bin", bin_).repartition(key, "__bin")
    inside = Window.partitionBy(key, "__bin").orderBy(*order)
    local = settle(binned.select(
        "*", F.lag(value).over(inside).alias("__lag"), (F.row_number().over(inside) == 1).alias("__first"), F.lead(F.lit(True)).over(inside).isNull().alias("__last")), "bins")
    across = Window.partitionBy("__k").orderBy("__b")
    carry = local.where("__last").select(F.col(key).alias("__k"), F.col("__bin").alias("__b"), F.struct(F.col(value).alias("v")).alias("__end")).withColumn(
        "__carried", F.lag("__end").over(across)["v"]).drop("__end")
    opening = local.where("__first").drop("__lag").join(carry, F.col(key).eqNullSafe(F.col("__k")) & F.col("__bin").eqNullSafe(F.col("__b")), "left")
    return opening.withColumn(out, F.col("__carried")).select(*df.columns, out).unionByName(
        local.where("NOT __first").withColumn(out, F.col("__lag")).select(*df.columns, out))


def events_in_trailing_window(
    df: DataFrame, key: str, at_seconds: Column, span: int, out: str,
) -> DataFrame:
    """Rows of the same key in the ``span`` seconds up to and including each row's second.

    Rows are counted per (key, second) before any shuffle of consequence. A count
    lies in its own bin of ``span`` seconds and is copied into the next, so every
    window is answered inside one (key, bin): at most 2 x span rows, however busy
    the key is. Rows without a time are peers of each other only.
    """
    timed = df.withColumn("__s", at_seconds)
    per_second = timed.groupBy(F.col(key).alias("__k"), "__s").agg(F.count("*").alias("__n"))
    home = F.floor(F.col("__s") / span)
    bins = F.when(home.isNull(), F.array(home)).otherwise(F.array(home, home + 1))
    spread = per_second.select("__k", "__s", "__n", home.alias("__home"), F.explode(bins).alias("__b"))
    w = Window.partitionBy("__k", "__b").orderBy("__s").rangeBetween(-span, 0)
    counted = (
        spread.withColumn(out, F.sum("__n").over(w)).where("__b <=> __home")
        .select("__k", F.col("__s").alias("__t"), out)
    )
    return (
        timed.join(counted, F.col(key).eqNullSafe(F.col("__k")) & F.col("__s").eqNullSafe(F.col("__t")), "left")
        .select(*df.columns, out)
    )


def dense_months(df: DataFrame, groups: Sequence[str], month: str) -> DataFrame:
    """Every 'yyyy-MM' between a group's first and last, so that rows back means months back."""
    first = F.to_date(F.concat(F.min(month), F.lit("-01")))
    last = F.to_date(F.concat(F.max(month), F.lit("-01")))
    span = df.groupBy(*groups).agg(F.sequence(first, last, F.expr("INTERVAL 1 MONTH")).alias("__m"))
    return span.select(*groups, F.explode("__m").alias("__d")).select(
        *groups, F.date_format("__d", "yyyy-MM").alias(month)
    )
