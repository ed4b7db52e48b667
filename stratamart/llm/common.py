"""What the text operators share: reading tables, words, folds, and tables in the shared folder."""

from __future__ import annotations

import atexit
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.session import scratch_path

#: A word of a text, for Spark's and DuckDB's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"


#: What one batch between Spark and Python holds at most: texts can be long, and every task has a batch on either side.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def bound_batches(spark: SparkSession) -> None:
    """Bound the batches of this session; what the caller has set lower stays."""
    for key, most in BATCH_CONF.items():
        now = spark.conf.get(key).removesuffix("b")
        if now.lstrip("-").isdigit() and not 0 < int(now) <= int(most):  # a size with another unit is the caller's own
            spark.conf.set(key, most)


def as_text(key: Column | str) -> Column:
    """A whole number on its way through pandas, which would round it beside a NULL; cast back with cast("long")."""
    return (F.col(key) if isinstance(key, str) else key).cast("long").cast("string")


def as_given(keys: pd.Series) -> pd.Series:
    """Such keys of a batch as plain objects, None where there is none, ready to go out again."""
    return pd.Series([k if isinstance(k, str) else None for k in keys], dtype="object")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of an input table."""
    bound_batches(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*(F.col(f"`{c}`") for c in columns)) if columns else df


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8 with A-Z lower-cased; bytes.split() cuts at exactly the six white-space bytes of WORD."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def word_count(text: Column) -> Column:
    """Words of a text inside the JVM; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo folds; a NULL key counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def settle_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write df to a table in the shared folder, which outlives any executor; (what was written, its path).

    The table goes at the end of the application; free() deletes it earlier, once nothing reads it any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    atexit.register(free, spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def free(spark: SparkSession, path: str) -> None:
    """Delete a table of settle_at, by Hadoop's file system, whatever store it lies in."""
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # at exit the session may be gone; the folder's owner clears it then
        pass


def _add_parts(batches: Iterator[pd.DataFrame], how: np.ufunc = np.add) -> Iterator[pd.DataFrame]:
    parts: dict[int, np.ndarray] = {}
    n = 0
    for batch in batches:
        for row, count, part in zip(batch["row"], batch["n"], batch["part"], strict=True):
            n += count
            if row >= 0:
                more = np.frombuffer(part, dtype=np.float32).astype(np.float64)
                parts[row] = how(parts[row], more) if row in parts else more
    yield pd.DataFrame({"row": [-1, *parts], "n": [n, *(0 for _ in parts)], "part": [b"", *(p.tobytes() for p in parts.values())]})


def add_vectors(made: DataFrame, how: np.ufunc = np.add) -> tuple[int, dict[int, np.ndarray]]:
    """Add up what tasks emit: (row, n, part) with parts of float32 by row, and n counted. The sums come to the driver.

    ``how`` adds two parts; np.logaddexp adds the logarithms of sums that would be too large themselves.

    A vector is cut into rows, so its pieces add up in different tasks, one batch at a time. The caller's vectors have a
    length that does not follow the data.
    """
    n, parts = 0, {}
    for r in made.repartition("row").mapInPandas(lambda batches: _add_parts(batches, how), "row int, n long, part binary").collect():
        n += r["n"]
        if r["row"] >= 0:
            parts[r["row"]] = np.frombuffer(bytes(r["part"]), dtype=np.float64)
    return n, parts
