"""The gated banking flow, replay by day and the two load strategies, as driver functions over catalog tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.operators import quality
from stratamart.plans import banking as bank
from stratamart.sinks import tables as t

GOLD_TABLES = ("account_balance_daily", "fraud_signal_summary")
AUDIT_DDL = "batch_id STRING, run_date STRING, stage STRING, table_name STRING, row_count BIGINT, status STRING, logged_at TIMESTAMP"


@dataclass
class BankFlow:
    """setup, ingest, bronze gate; PASS builds silver and gold, FAIL quarantines; the audit always runs.

    A strict flow also gates on the key ledger of silver and builds gold only when the silver gate passes.
    """

    spark: SparkSession
    prefix: str
    location: str | None = None
    strict: bool = False

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}_{layer}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def setup(self) -> None:
        for layer, comment in (("bronze", "Raw banking feeds"), ("silver", "Conformed banking tables"), ("gold", "Banking marts")):
            place = f"{self.location}/{layer}" if self.location else None
            t.create_database(self.spark, f"{self.prefix}_{layer}", comment, place)
        t.create_if_absent(self.spark, self.name("gold", "pipeline_audit_log"), AUDIT_DDL)

    def ingest(self, accounts: DataFrame, txns: DataFrame, run: bank.Run) -> None:
        t.overwrite(bank.bronze_accounts(accounts, run), self.name("bronze", "raw_accounts"))
        t.overwrite(bank.bronze_transactions(txns, run), self.name("bronze", "raw_transactions"), ["_run_date"])

    def gate(self, results: DataFrame, layer: str) -> str:
        """Keep the check results and return the verdict the flow branches on."""
        table = self.name(layer, "dq_results")
        t.overwrite(results, table)
        return quality.gate_verdict(self.spark.table(table)).head()["verdict"]

    def build_silver(self, run: bank.Run) -> str:
        accounts, txns = self.read("bronze", "raw_accounts"), self.read("bronze", "raw_transactions")
        t.overwrite(bank.dim_account(accounts, run), self.name("silver", "dim_account"))
        keyed = t.stage(bank.keyed_transactions(txns), self.name("silver", "_stg_keyed"), run.batch_id)
        t.overwrite_partitioned(bank.txn_clean(keyed, self.read("silver", "dim_account"), run), self.name("silver", "txn_clean"), "txn_date")
        dim = self.read("silver", "dim_account")
        t.overwrite(bank.txn_rejects(txns, keyed, dim), self.name("silver", "txn_rejects"))
        clean, rejects = self.read("silver", "txn_clean"), self.read("silver", "txn_rejects")
        ledger = bank.key_ledger(keyed, clean, rejects) if self.strict else None
        verdict = self.gate(bank.validate_silver(dim, clean, rejects, txns, run, ledger), "silver")
        t.drop_stage(self.spark, self.name("silver", "_stg_keyed"))
        return verdict

    def build_gold(self, run: bank.Run, wanted: Sequence[str] = GOLD_TABLES) -> None:
        clean, dim = self.read("silver", "txn_clean"), self.read("silver", "dim_account")
        if "account_balance_daily" in wanted:
            t.overwrite_partitioned(bank.account_balance_daily(clean, dim, run), self.name("gold", "account_balance_daily"), "txn_date")
        if "fraud_signal_summary" in wanted:
            t.overwrite(bank.fraud_signal_summary(bank.txn_signals(clean), run), self.name("gold", "fraud_signal_summary"))

    def profile_each(self, targets: Sequence[tuple[str, str]], run: bank.Run) -> None:
        """Profiles of several tables in one append."""
        parts = [quality.profile(self.read(*x), self.name(*x), run.batch_id, run.date) for x in targets]
        t.append(reduce(DataFrame.unionByName, parts), self.name("gold", "table_stats"))

    def audit(self, run: bank.Run) -> DataFrame:
        """Count the rows that this run left in the expected tables and both gates, append to the log, return this run's rows.

        A table that holds rows of other batches only is ABSENT for this one, and a gate without results of it is NOT_RUN.
        """
        manifest = [
            ("bronze", "raw_accounts"), ("bronze", "raw_transactions"), ("bronze", "quarantine_records"), ("silver", "dim_account"),
            ("silver", "txn_clean"), ("silver", "txn_rejects"), *(("gold", g) for g in GOLD_TABLES)]
        rows = []
        for layer, table in manifest:
            name = self.name(layer, table)
            if self.spark.catalog.tableExists(name):
                counted = self.spark.table(name).agg(F.count("*").alias("all"), F.count_if(F.col("_batch_id") == run.batch_id).alias("row_count")).select(
                    "row_count", F.when((F.col("row_count") > 0) | (F.col("all") == 0), "PRESENT").otherwise("ABSENT").alias("status"))
            else:
                counted = self.spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"), F.lit("ABSENT").alias("status"))
            rows.append(counted.select(F.lit(layer).alias("stage"), F.lit(f"{layer}.{table}").alias("table_name"), "row_count", "status"))
        for layer in ("bronze", "silver"):
            name = self.name(layer, "dq_results")
            if self.spark.catalog.tableExists(name):
                own = self.spark.table(name).where(F.col("batch_id") == run.batch_id)
                gate = quality.gate_verdict(own).select(F.col("checks").alias("row_count"), F.col("verdict").alias("status"))
            else:
                gate = self.spark.range(1).select(F.lit(0).cast("bigint").alias("row_count"), F.lit("NOT_RUN").alias("status"))
            rows.append(gate.select(F.lit(layer).alias("stage"), F.lit(f"GATE:{layer}_quality").alias("table_name"), "row_count", "status"))
        logged = reduce(DataFrame.unionByName, rows).select(
            F.lit(run.batch_id).alias("batch_id"), F.lit(run.date).alias("run_date"), "*", F.current_timestamp().alias("logged_at"))
        t.append(logged, self.name("gold", "pipeline_audit_log"))
        return self.spark.table(self.name("gold", "pipeline_audit_log")).where(F.col("batch_id") == run.batch_id)

    def run(self, accounts: DataFrame, txns: DataFrame, run: bank.Run) -> DataFrame:
        self.setup()
        self.ingest(accounts, txns, run)
        raw_a, raw_t = self.read("bronze", "raw_accounts"), self.read("bronze", "raw_transactions")
        if self.gate(bank.validate_bronze(raw_a, raw_t, run), "bronze") == "PASS":
            if self.build_silver(run) == "PASS" or not self.strict:
                self.build_gold(run)
                self.profile_each([("gold", g) for g in GOLD_TABLES], run)
        else:
            t.overwrite(bank.quarantine_records(raw_a, raw_t, run), self.name("bronze", "quarantine_records"))
        return self.audit(run)


def run_status(audit: DataFrame) -> DataFrame:
    """SUCCESS only when both gates passed."""
    gates = audit.where(F.startswith("table_name", F.lit("GATE:")))
    passed = F.count_if(F.col("status") == "PASS")
    return gates.agg(F.when(passed == 2, "SUCCESS").otherwise("DEGRADED").alias("run_status"))


# --- replay and load strategies -------------------------------------------------------------

def day_digests(rows: DataFrame, day_column: str) -> DataFrame:
    """Rows and multiset digest of each day, one row a day of the calendar."""
    return rows.groupBy(F.col(day_column).alias("day")).agg(F.count("*").alias("rows"), quality.multiset_digest(rows.columns).alias("digest"))


def stale_days(source: DataFrame, held: DataFrame, day_column: str) -> DataFrame:
    """Days whose rows differ between a source and a table: (day, rows and digest in the source, NULL where it has none).

    Both sides are read once and summed before their shuffle, so a day that holds a third of all rows is one row a task.
    """
    wanted, found = day_digests(source, day_column), day_digests(held.select(*source.columns), day_column)
    both = wanted.alias("w").join(found.alias("f"), F.col("w.day").eqNullSafe(F.col("f.day")), "full")
    return both.where(~F.col("w.digest").eqNullSafe(F.col("f.digest"))).select(F.coalesce("w.day", "f.day").alias("day"), "w.rows", "w.digest")


def replay_days(source: DataFrame, read_day: Callable[[date], DataFrame], table: str, day_column: str, stage: str) -> DataFrame:
    """Re-land the days that differ, one at a time: read the day alone, write it aside, verify it, then merge it into the table.

    ``source`` tells the days and what each must hold; ``read_day(day)`` reads that day's slice, as a range that reaches the
    scan. A slice whose digest is not that of the source stays out of the table and is reported FAILED, a day that only
    the table holds is reported EXTRA and left alone; NULL days are reported SKIPPED. A killed replay is run again: days
    already merged no longer differ. Returns (day, rows, status), one row a day that differed.
    """
    spark = source.sparkSession
    outcomes = []
    for r in stale_days(source, spark.table(table), day_column).orderBy("day").collect():  # days of a calendar, not rows
        if r.day is None or r.rows is None:
            outcomes.append((r.day, 0, "SKIPPED" if r.day is None else "EXTRA"))
            continue
        t.overwrite(read_day(r.day).select(*source.columns), stage)
        landed = day_digests(spark.table(stage), day_column).collect()  # one row where the slice holds that day alone
        sound = [(x.day, x.rows, x.digest) for x in landed] == [(r.day, r.rows, r.digest)]
        if sound:
            t.replace_partitions(spark.table(stage), table)
        outcomes.append((r.day, r.rows, "MERGED" if sound else "FAILED"))
    t.drop_stage(spark, stage)
    return spark.createDataFrame(outcomes, "day date, rows bigint, status string")


def load(df: DataFrame, table: str, partition: str, strategy: str) -> None:
    """FULL_REFRESH replaces the table, INCREMENTAL only the partitions that ``df`` carries."""
    if strategy == "FULL_REFRESH" or not df.sparkSession.catalog.tableExists(table):
        t.overwrite_partitioned(df, table, partition)
    elif strategy == "INCREMENTAL":
        t.replace_partitions(df, table)
    else:
        raise ValueError(f"unknown load strategy {strategy!r}")


def table_summary(spark: SparkSession, table: str, key: str, rows: int = 10) -> DataFrame:
    """The number of rows of a table, beside its first rows by key with their places."""
    df = spark.table(table)
    first = df.orderBy(key).limit(rows)
    total = df.count()
    return first.withColumn("place", F.row_number().over(Window.orderBy(key))).withColumn("table_name", F.lit(table.rpartition(".")[2])).select(
        "*", F.lit(total).alias("total"))
