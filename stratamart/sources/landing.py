"""Landing: extracts into bronze tables with an audit trail, and single-table ingest jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.sinks.tables import create_database, overwrite
from stratamart.sources.defects import inject_defects

AUDIT = ("_source_system", "_source_file", "_batch_id", "_ingest_ts")


def with_audit(df: DataFrame, system: str, file: str, batch_id: str) -> DataFrame:
    return df.withColumns({
        "_source_system": F.lit(system), "_source_file": F.lit(file),
        "_batch_id": F.lit(batch_id), "_ingest_ts": F.current_timestamp(),
    })


def with_lineage(df: DataFrame, system: str, file: str, batch_id: str, run_date: str) -> DataFrame:
    """The five lineage columns of a banking feed."""
    return df.withColumns({
        "_batch_id": F.lit(batch_id), "_run_date": F.lit(run_date), "_source_system": F.lit(system),
        "_source_file": F.lit(file), "_ingested_at": F.current_timestamp(),
    })


def land(spark: SparkSession, extracts: dict[str, DataFrame], database: str, systems: dict[str, str], batch_id: str, location: str | None = None, dirty: bool = False) -> None:
    """Land every extract, with injected defects if asked; file sizes are bounded by rows per file rather than by counting first."""
    create_database(spark, database, "Raw landing layer with an audit trail", location)
    for name, df in extracts.items():
        stamped = with_audit(inject_defects(name, df) if dirty else df, systems.get(name, "unknown"), f"{name}.parquet", batch_id)
        overwrite(stamped, f"{database}.{name}", rows_per_file=4_000_000)


def ingest(spark: SparkSession, df: DataFrame, database: str, table: str, comment: str, location: str | None = None) -> DataFrame:
    """Create the database, replace the table, report its row count and columns."""
    create_database(spark, database, comment, location)
    overwrite(df, f"{database}.{table}")
    landed = spark.table(f"{database}.{table}")
    columns = F.lit(",".join(landed.columns))
    return landed.agg(F.count("*").alias("total_rows")).select(F.lit(table).alias("table_name"), "total_rows", columns.alias("column_list"))
