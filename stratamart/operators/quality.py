"""Data-quality measurements, gates, quarantine, profiling and reconciliation.

Measurements of one table are taken in one aggregate and turned into rows with
unpivot; nothing is counted check by check.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions import nz, ratio
from stratamart.operators.keyed import business_columns


# --- ledger -------------------------------------------------------------------

def measure(df: DataFrame, table: str, measures: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """(table_name, rule, scope, metric_value) rows from one pass; measures are (rule, scope, aggregate)."""
    one_row = df.agg(*(agg.cast("bigint").alias(f"m{i}") for i, (_, _, agg) in enumerate(measures)))
    lines = F.array(*(
        F.struct(F.lit(rule).alias("rule"), F.lit(scope).alias("scope"), F.col(f"m{i}").alias("metric_value"))
        for i, (rule, scope, _) in enumerate(measures)
    ))
    return one_row.select(F.lit(table).alias("table_name"), F.explode(lines).alias("x")).select("table_name", "x.*")


def repeated_key_count(df: DataFrame, keys: Sequence[str], table: str, rule: str, scope: str = "in") -> DataFrame:
    """Ledger row: how many keys are carried by more than one row."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return measure(per_key, table, [(rule, scope, F.count_if(F.col("n") > 1))])


def stamp_ledger(rows: DataFrame, batch_id: str) -> DataFrame:
    return rows.withColumns({"batch_id": F.lit(batch_id), "measured_at": F.current_timestamp()})


# --- gates --------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    """One gate check over a one-row frame of counts.

    ``observed`` is the measured ratio or count, ``passes`` its verdict and
    ``detail`` the explanation; all are expressions over the counts.
    """

    table: str
    name: str
    observed: Column
    threshold: float
    passes: Column
    detail: Column


def at_least(table: str, name: str, part: Column, whole: Column, threshold: float, detail: Column) -> Check:
    """A ratio check; an empty table measures 0."""
    share = F.coalesce(part.cast("double") / nz(whole).cast("double"), F.lit(0.0))
    return Check(table, name, share, threshold, share >= threshold, detail)


def none_of(table: str, name: str, offenders: Column, detail: Column, whole: Column | None = None) -> Check:
    """A strict check that passes only without offenders; with ``whole`` it observes the clean share."""
    if whole is None:
        observed = F.when(offenders == 0, 1.0).otherwise(0.0)
    else:
        observed = 1.0 - F.coalesce(offenders.cast("double") / nz(whole).cast("double"), F.lit(0.0))
    return Check(table, name, observed, 1.0, offenders == 0, detail)


def run_checks(counts: DataFrame, checks: Sequence[Check], batch_id: str, run_date: str) -> DataFrame:
    """One result row per check, with PASS or FAIL."""
    rows = F.array(*(
        F.struct(
            F.lit(batch_id).alias("batch_id"), F.lit(run_date).alias("run_date"),
            F.lit(c.table).alias("table_name"), F.lit(c.name).alias("check_name"),
            c.observed.cast("double").alias("observed"), F.lit(float(c.threshold)).alias("threshold"),
            F.when(c.passes, "PASS").otherwise("FAIL").alias("status"), c.detail.alias("detail"),
        ) for c in checks
    ))
    return counts.select(F.explode(rows).alias("r")).select("r.*").withColumn("checked_at", F.current_timestamp())


def gate_verdict(results: DataFrame) -> DataFrame:
    """PASS, FAIL or (without any result) NOT_RUN, with the number of checks and failures."""
    failed = F.count_if(F.col("status") == "FAIL")
    return results.agg(F.count("*").alias("checks"), failed.alias("failed")).select(
        F.when(F.col("checks") == 0, "NOT_RUN").when(F.col("failed") > 0, "FAIL").otherwise("PASS").alias("verdict"),
        "checks", "failed",
    )


def side_by_side(*one_row_frames: DataFrame) -> DataFrame:
    """Columns of several one-row aggregates in one row, each read as a scalar subquery."""
    base, *others = one_row_frames
    for other in others:
        packed = other.select(F.struct(*other.columns)).scalar()
        base = base.withColumn("__s", packed).select("*", *(F.col("__s")[c].alias(c) for c in other.columns)).drop("__s")
    return base


# --- quarantine ---------------------------------------------------------------

def tag_reasons(df: DataFrame, rules: Sequence[tuple[str, Column]], column: str = "reject_reason") -> DataFrame:
    """One row for each rule that a row breaks, all rules in one pass; a row that breaks none is dropped, NULL breaks nothing."""
    broken = F.array_compact(F.array(*(F.when(rule, F.lit(name)) for name, rule in rules)))
    return df.withColumn(column, F.explode(broken))


def quarantine(tagged: DataFrame, entity: str, key: Column, payload: Sequence[str], remediation: dict[str, str]) -> DataFrame:
    """Tagged rows in the shared shape; the payload keeps the named columns as JSON."""
    advice = F.create_map(*(F.lit(x) for pair in remediation.items() for x in pair))
    return tagged.select(
        key.cast("string").alias("record_key"),
        F.lit(entity).alias("source_entity"),
        "reject_reason",
        F.try_element_at(advice, F.col("reject_reason")).alias("remediation"),
        F.to_json(F.struct(*payload)).alias("record_payload"),
    )


def triage(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy("source_entity", "reject_reason", "remediation").agg(F.count("*").alias("records"))


# --- profiling ----------------------------------------------------------------

COUNTED_TYPES = ("string", "boolean", "date")


def profile(df: DataFrame, table: str, batch_id: str, run_date: str) -> DataFrame:
    """NULL share of every business column; exact cardinality (NULL included) of the cheap types, else -1.

    NULLs are counted in one map-side aggregate. Cardinality stacks the cheap
    columns as (column, value) rows and removes duplicates, which shuffles each
    distinct value once instead of running one job per column.
    """
    cols = business_columns(df)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)))
    lines = F.array(*(
        F.struct(F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col(f"c{i}").alias("null_count"))
        for i, c in enumerate(cols)
    ))
    nulls = counts.select("n", F.explode(lines).alias("x")).select(F.col("n").alias("table_row_count"), "x.*")
    cheap = [c for c in cols if types[c] in COUNTED_TYPES]
    if cheap:
        pairs = df.select(F.explode(F.array(*(
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cheap
        ))).alias("x")).select("x.*")
        distinct = pairs.distinct().groupBy("column_name").agg(F.count("*").alias("d"))
        nulls = nulls.join(distinct, "column_name", "left")
    else:
        nulls = nulls.withColumn("d", F.lit(None).cast("bigint"))
    counted = F.col("column_name").isin(cheap)
    return nulls.select(
        F.lit(batch_id).alias("batch_id"), F.lit(run_date).alias("run_date"), F.lit(table).alias("table_name"),
        "column_name", "data_type", "table_row_count", "null_count",
        F.coalesce(F.round(F.col("null_count") * 100.0 / nz("table_row_count"), 2), F.lit(0.0)).alias("null_pct"),
        F.when(counted, F.coalesce("d", F.lit(0))).otherwise(-1).alias("distinct_count"),
        F.current_timestamp().alias("profiled_at"),
    )


# --- reconciliation -----------------------------------------------------------

def multiset_digest(columns: Sequence[str]) -> Column:
    """An aggregate that is equal for equal multisets of rows, whatever their order.

    It joins the exclusive or of one row hash with the exact sum of another. The first alone loses rows that come in
    pairs. A hash skips NULL, so the rows' NULL flags are hashed too: ('a', NULL) and (NULL, 'a') differ.
    """
    names = sorted(columns)
    flags = [F.col(c).isNull() for c in names]
    one, two = (F.xxhash64(F.lit(salt), *names, *flags) for salt in ("first", "second"))
    return F.concat_ws(":", F.bit_xor(one).cast("string"), F.sum(two.cast("decimal(20,0)")).cast("string"))


def control_totals(df: DataFrame, domain: Column, amount: str, side: str) -> DataFrame:
    """Row count, amount sum and an order-free checksum per domain."""
    return df.groupBy(domain.alias("domain")).agg(
        F.count("*").alias(f"{side}_rows"),
        F.sum(F.col(amount).cast("decimal(18,2)")).alias(f"{side}_amount"),
        multiset_digest(df.columns).alias(f"{side}_checksum"),
    )


def differing_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Numbers of the hash buckets of the keys whose rows are not the same multiset on both sides; at most ``buckets`` rows."""
    def summed(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(_bucket(keys, buckets)).agg(multiset_digest(df.columns).alias(name))

    both = summed(left, "a").join(summed(right.select(*left.columns), "b"), "bucket", "full")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket")


def differing_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = 4096) -> DataFrame:
    """Rows that the two sides do not hold equally often, with their number on each side.

    Digests by bucket go first: where layers agree but for a few rows, only the buckets of those rows are compared row by
    row. Equal rows are counted before the shuffle, so a row that fills a third of a side is one row a task.
    """
    cols = left.columns
    wanted = differing_buckets(left, right, keys, buckets)

    def kept(df: DataFrame, is_left: int) -> DataFrame:
        return df.select(*cols, _bucket(keys, buckets)).join(wanted, "bucket", "left_semi").select(
            *cols, F.lit(is_left).alias("__l"), F.lit(1 - is_left).alias("__r"))

    counted = kept(left, 1).unionByName(kept(right, 0)).groupBy(*cols).agg(F.sum("__l").alias("left_copies"), F.sum("__r").alias("right_copies"))
    return counted.where("left_copies <> right_copies")


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("bucket"), *keys), F.lit(buckets)).cast("int").alias("bucket")


def compare_controls(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """Both layers by domain with one verdict per control; a domain on one side only fails."""
    both = left.join(right, "domain", "full")
    out = both
    for control in ("rows", "amount", "checksum"):
        same = F.col(f"{a}_{control}").eqNullSafe(F.col(f"{b}_{control}"))
        out = out.withColumn(f"{control}_status", F.when(same, "PASS").otherwise("FAIL"))
    return out


def variance_check(totals: DataFrame, a: str, b: str, tolerance_pct: float) -> DataFrame:
    """Absolute difference of a from b in percent of b; within the tolerance passes."""
    gap = F.abs(F.col(a) - F.col(b))
    return totals.withColumn("variance_pct", F.abs(ratio(gap * 100, b, 4))).withColumn(
        "status", F.when(F.col("variance_pct") <= tolerance_pct, "PASS").otherwise("FAIL")
    )


# --- lineage --------------------------------------------------------------------

def lineage_check(layers: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Batch ids of several layers; consistent when one batch is in every layer and no other is in any."""
    ids = [
        df.select(F.lit(layer).alias("layer"), F.col(column).alias("batch_id")).distinct() for layer, (df, column) in layers.items()
    ]
    stacked = ids[0]
    for more in ids[1:]:
        stacked = stacked.unionByName(more)
    return stacked.agg(
        F.count_distinct("batch_id").alias("batches"), F.count_distinct("layer").alias("layers"),
    ).withColumn("consistent", (F.col("batches") == 1) & (F.col("layers") == len(layers)))


def lineage_by_layer(layers: dict[str, tuple[Sequence[DataFrame], str]]) -> DataFrame:
    """For each layer: tables, rows, rows without a batch, and the batches that its rows carry, as a sorted list."""
    parts = [
        df.groupBy(F.col(column).alias("batch_id")).agg(F.count("*").alias("n")).select(F.lit(layer).alias("layer"), F.lit(k).alias("nr"), "batch_id", "n")
        for layer, (tables, column) in layers.items() for k, df in enumerate(tables)]
    stacked = parts[0]
    for more in parts[1:]:
        stacked = stacked.unionByName(more)
    return stacked.groupBy("layer").agg(
        F.count_distinct("nr").alias("tables"), F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(F.col("batch_id").isNull(), F.col("n"))), F.lit(0)).alias("unstamped"),
        F.array_join(F.sort_array(F.collect_set("batch_id")), ",").alias("batches"))


def audit_trail(*landed: DataFrame) -> DataFrame:
    """Rows and distinct files per source system and batch."""
    cols = ["_source_system", "_batch_id", "_source_file"]
    per_file = [df.groupBy(*cols).agg(F.count("*").alias("n")) for df in landed]
    stacked = per_file[0]
    for more in per_file[1:]:
        stacked = stacked.unionByName(more)
    return stacked.groupBy("_source_system", "_batch_id").agg(
        F.sum("n").alias("rows"), F.count_distinct("_source_file").alias("files"))
