"""File readers. Schemas are declared wherever the feed has one; inference is for ad-hoc CSV only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_csv_inferred(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.csv(list(paths), header=True, inferSchema=True)


def read_csv_declared(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def read_tsv(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None, width: int | None = None) -> DataFrame:
    """Tab-separated text with a header, every column a string.

    A gzipped file is one split, so pass ``width`` to spread it before heavy work.
    """
    reader = spark.read
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    df = reader.csv(list(paths), sep="\t", header=True)
    return df.repartition(width) if width else df


def read_json_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def parse_json_documents(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Documents already held as text in a column."""
    return df.select(F.from_json(column, schema).alias("doc")).select("doc.*")


def rows_with_schema(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def read_landed(spark: SparkSession, table: str, audit: Sequence[str] = ("_source_system", "_source_file", "_batch_id", "_ingest_ts")) -> DataFrame:
    """A landed catalog table without its audit columns."""
    return spark.table(table).drop(*audit)
