"""Catalog writes. Only functions here trigger jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 4_000_000


def create_database(spark: SparkSession, name: str, comment: str = "", location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT '{_quoted(comment)}'{place}")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def overwrite(df: DataFrame, table: str, partition_by: Sequence[str] = (), rows_per_file: int | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet").option("compression", "snappy")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def append(df: DataFrame, table: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(table)


def overwrite_partitioned(df: DataFrame, table: str, column: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Replace a table partitioned by one column.

    REBALANCE lets adaptive execution split a partition value that holds most of
    the rows over several tasks and merge the small ones; sorting inside each
    task keeps one file open at a time.
    """
    even = df.hint("rebalance", column).sortWithinPartitions(column)
    overwrite(even, table, [column], rows_per_file)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Overwrite only the partitions present in ``df``; the table must exist.

    The mode is an option of this one write, which insertInto would ignore: the write goes to the table's folder and the
    catalog is told of partitions that are new. No setting of the session changes, so writers of other partitions may run
    beside it. Values are cast to the table's types.
    """
    spark = df.sparkSession
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if not partitions:
        raise ValueError(f"{table} has no partitions to replace")
    typed = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in spark.table(table).schema.fields))
    typed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(location_of(spark, table))
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)


def create_table_as(spark: SparkSession, table: str, query: str, **frames: DataFrame) -> None:
    """DROP + CREATE TABLE AS over a SQL text; frames are referred to as {name}."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} USING parquet AS {query}", **frames)


def create_if_absent(spark: SparkSession, table: str, ddl: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet")


def set_comment(spark: SparkSession, table: str, comment: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('comment' = '{_quoted(comment)}')")


def stamp(df: DataFrame, layer: str, batch_id: str) -> DataFrame:
    return df.withColumns({f"_{layer}_batch_id": F.lit(batch_id), f"_{layer}_ts": F.current_timestamp()})


def has_batch(spark: SparkSession, table: str, column: str, batch_id: str) -> bool:
    """Whether the table exists and was written for this batch."""
    if not spark.catalog.tableExists(table):
        return False
    df = spark.table(table)
    if column not in df.columns:
        return False
    first = df.select(column).head(1)
    return bool(first) and first[0][0] == batch_id


def publish(df: DataFrame, table: str, layer: str, batch_id: str, partition_by: str | None = None, comment: str = "") -> bool:
    """Stamp and write a table unless it already carries this batch; True when written."""
    spark = df.sparkSession
    if has_batch(spark, table, f"_{layer}_batch_id", batch_id):
        return False
    stamped = stamp(df, layer, batch_id)
    if partition_by:
        overwrite_partitioned(stamped, table, partition_by)
    else:
        overwrite(stamped, table, rows_per_file=ROWS_PER_FILE)
    if comment:
        set_comment(spark, table, comment)
    return True


def stage(df: DataFrame, table: str, batch_id: str) -> DataFrame:
    """Write an intermediate once per batch and read it back; drop it with drop_stage."""
    spark = df.sparkSession
    if not has_batch(spark, table, "_stage_batch_id", batch_id):
        overwrite(df.withColumn("_stage_batch_id", F.lit(batch_id)), table)
    return spark.table(table).drop("_stage_batch_id")


def drop_stage(spark: SparkSession, *tables: str) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def write_ledger_part(rows: DataFrame, table: str, part: str) -> None:
    """Ledger rows of one part of a batch; writing the same part again replaces it."""
    spark = rows.sparkSession
    df = rows.withColumn("part", F.lit(part))
    if spark.catalog.tableExists(table):
        replace_partitions(df, table)
    else:
        overwrite(df, table, ["batch_id", "part"])


def describe(spark: SparkSession, database: str) -> DataFrame:
    """Tables and columns of a database, from the catalog."""
    found = [
        (t.name, i, c.name, c.dataType)
        for t in sorted(spark.catalog.listTables(database), key=lambda t: t.name)
        for i, c in enumerate(spark.catalog.listColumns(f"{database}.{t.name}"))
    ]
    return spark.createDataFrame(found, "table_name string, position int, column_name string, data_type string")


def location_of(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").head(1)
    return rows[0]["data_type"] if rows else None


def census(spark: SparkSession, databases: Sequence[str]) -> DataFrame:
    """Tables and rows per layer; stage tables are skipped and a missing layer counts zero."""
    parts = []
    for db in databases:
        names = [t.name for t in spark.catalog.listTables(db)] if spark.catalog.databaseExists(db) else []
        kept = [n for n in names if not n.startswith("_stg")]
        rows = spark.createDataFrame([(db, 0, 0)], "layer string, t int, n bigint")
        for name in kept:
            counted = spark.table(f"{db}.{name}").agg(F.count("*").alias("n"))
            rows = rows.unionByName(counted.select(F.lit(db).alias("layer"), F.lit(1).alias("t"), "n"))
        parts.append(rows)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("layer").agg(F.sum("t").alias("tables"), F.sum("n").alias("rows"))
