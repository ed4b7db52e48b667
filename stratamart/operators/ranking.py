"""Exact ranks and n-tiles over populations too large for one task.

A window without a bounded partition moves every row to one task. Here the
values are range-partitioned instead and written once, with the number of their
range. What lies before a range follows from the totals of the ranges, a row for
each range and group; what lies before a value inside its range is local.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.sinks.scratch import settle


@dataclass(frozen=True)
class Ranking:
    """rank() within ``groups``, and percent_rank() in the opposite order if it has a name."""

    groups: tuple[str, ...]
    rank_as: str
    percent_rank_as: str | None = None


def _same(left: str, right: str, cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols))


def rankings(df: DataFrame, value: str, wanted: Sequence[Ranking], descending: bool = True, counted_from: DataFrame | None = None) -> DataFrame:
    """Add several rankings of one value, each within groups of its own, out of one sort by range.

    Equal values are collapsed to one counted row first, so a value shared by a third of a group is one row here and an
    ordinary (skew-splittable) join key on the way back. Both directions come from the same counts: rows ahead of a value and
    rows behind it. NULLs are lowest. ``counted_from`` may name a cheaper frame with the same rows to count the values in.
    """
    columns = [*dict.fromkeys(g for r in wanted for g in r.groups)]
    shared = [g for g in columns if all(g in r.groups for r in wanted)]
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_first()
    counted = (counted_from or df).groupBy(*columns, value).agg(F.count("*").alias("__n"))
    ranged = settle(counted.repartitionByRange(*shared, order).withColumn("__part", F.spark_partition_id()), "ranges")
    # one shuffle by range serves the windows of all rankings
    placed = ranged.repartition("__part")
    names = []
    for i, r in enumerate(wanted):
        here = Window.partitionBy("__part", *r.groups)
        up_to = here.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        # a value is one counted row of the finest groups, and one for each finer group in the others
        peers = F.col("__n") if set(r.groups) == set(columns) else F.sum("__n").over(Window.partitionBy("__part", *r.groups, value))
        placed = placed.withColumns({f"__upto{i}": F.sum("__n").over(up_to), f"__peers{i}": peers})
    for i, r in enumerate(wanted):
        whole = Window.partitionBy(*r.groups)
        before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        totals = ranged.groupBy("__part", *r.groups).agg(F.sum("__n").alias("__t")).select(
            "__part", *r.groups, F.coalesce(F.sum("__t").over(before), F.lit(0)).alias(f"__start{i}"), F.sum("__t").over(whole).alias(f"__size{i}"))
        placed = placed.alias("l").join(totals.alias("t"), _same("l", "t", ["__part", *r.groups])).select("l.*", f"t.__start{i}", f"t.__size{i}")
        ahead_and_own = F.col(f"__start{i}") + F.col(f"__upto{i}")
        names.append((ahead_and_own - F.col(f"__peers{i}") + 1).alias(r.rank_as))
        if r.percent_rank_as:
            size = F.col(f"__size{i}")
            names.append(F.coalesce((size - ahead_and_own) / F.nullif(size - 1, F.lit(0)).cast("double"), F.lit(0.0)).alias(r.percent_rank_as))
    out = df.alias("d").join(placed.select(*columns, value, *names).alias("p"), _same("d", "p", [*columns, value]))
    added = [n for r in wanted for n in (r.rank_as, r.percent_rank_as) if n]
    return out.select("d.*", *(F.col(f"p.{n}") for n in added))


def rank_within(
    df: DataFrame, groups: Sequence[str], value: str, rank_as: str,
    descending: bool = True, percent_rank_as: str | None = None, counted_from: DataFrame | None = None,
) -> DataFrame:
    """Add rank() of ``value`` within ``groups`` (and percent_rank in the opposite order); see rankings()."""
    return rankings(df, value, [Ranking(tuple(groups), rank_as, percent_rank_as)], descending, counted_from)


def ntile_scores(df: DataFrame, key: str, measures: dict[str, str], tiles: int) -> DataFrame:
    """Add ntile(tiles) of several columns at once, each ascending with ``key`` as tie-break.

    ``measures`` maps output column to column; inputs must be numeric. All measures are stacked as (measure, value, key) rows
    and sorted once by range. The totals of the ranges (a row a range and measure) say in which range and at which place the
    last row of each tile lies; these rows, tiles x measures at most, are read by place out of what was written, and
    assigning tiles is a comparison in each row. Nothing is shuffled after the sort.
    """
    names = list(measures)
    stacked = df.select(
        F.explode(F.array(*(
            F.struct(F.lit(i).alias("m"), F.col(measures[n]).cast("decimal(28,6)").alias("v"), F.col(key).alias("k"))
            for i, n in enumerate(names)
        ))).alias("e")
    ).select("e.*")
    ordered = settle(
        stacked.repartitionByRange("m", "v", "k").sortWithinPartitions("m", "v", "k")
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ranges")
    totals: dict[int, list] = {}
    for r in ordered.groupBy("m", "__part").agg(F.count("*").alias("n"), F.min("__at").alias("first")).orderBy("m", "__part").collect():
        totals.setdefault(r["m"], []).append(r)
    places = []
    for m, ranges in totals.items():
        size = sum(r["n"] for r in ranges)
        for t in range(1, tiles):
            end, seen = t * (size // tiles) + min(t, size % tiles), 0  # the tile's last row, counted from 1
            for r in ranges if end else ():
                if seen < end <= seen + r["n"]:
                    places.append((m, r["__part"], r["first"] + end - seen - 1))
                seen += r["n"]
    at = [(F.col("m") == m) & (F.col("__part") == p) & (F.col("__at") == i) for m, p, i in set(places)]
    ends = {(r["m"], r["__part"], r["__at"]): (r["v"], r["k"]) for r in ordered.where(reduce(lambda a, b: a | b, at)).collect()} if at else {}
    kind = df.schema[key].dataType

    def tile(i: int, col: str) -> Column:
        value, here = F.col(col).cast("decimal(28,6)"), F.col(key)
        passed = F.lit(1)
        for m, p, a in places:  # tiles whose last row lies before this one; NULL values sort first, as do NULL keys
            if m == i:
                v, k = ends[m, p, a]
                edge, edge_key = F.lit(v).cast("decimal(28,6)"), F.lit(k).cast(kind)
                passed = passed + F.when(F.struct(edge.alias("v"), edge_key.alias("k")) < F.struct(value.alias("v"), here.alias("k")), 1).otherwise(0)
        return passed

    return df.select("*", *(tile(i, measures[n]).alias(n) for i, n in enumerate(names)))
