"""Intermediates written to the shared folder and read back.

Parquet keeps column pruning and gives the next stage true sizes, so the choice
between broadcast and shuffle joins rests on what was written. The files live
where every executor can read them and survive the loss of one.
"""

from __future__ import annotations

import atexit
import contextlib
import threading
from collections.abc import Iterator

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from stratamart.session import application_folder, scratch_path

_owned: set[str] = set()  # applications whose folder is deleted at the end
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_writing: dict[str, tuple[int, str | None]] = {}  # application: writes under way, and what the setting was before them


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in here delete their shuffle files as they end, and not when the driver happens to collect its garbage.

    A write is a query of its own, which nobody runs again. The setting is the session's, so writes side by side are counted
    and the last one restores it.
    """
    app = spark.sparkContext.applicationId
    with _lock:
        n, before = _writing.get(app, (0, None))
        if n == 0:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _writing[app] = n + 1, before
    try:
        yield
    finally:
        with _lock:
            n, before = _writing[app]
            _writing[app] = n - 1, before
            if n == 1:
                spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def packed(df: DataFrame, partition_by: str | None = None) -> DataFrameWriter:
    """A writer that keeps disk low: zstd, and a table partitioned by a column of few values (years) is sorted where its rows are.

    Moving whole rows to their year first would put all of them on disk once more. Each task writes a file a year instead, so
    no year is a task of its own however large it is.
    """
    writer = (df.sortWithinPartitions(partition_by) if partition_by else df).write.option("compression", "zstd")
    return writer.partitionBy(partition_by) if partition_by else writer


def settle(df: DataFrame, label: str = "part", partition_by: str | None = None) -> DataFrame:
    """Compute ``df`` once; the result is a plain scan of what was written."""
    path = scratch_path(df.sparkSession, label)
    if df.sparkSession.sparkContext.applicationId not in _owned:
        _owned.add(df.sparkSession.sparkContext.applicationId)
        atexit.register(_at_end, df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        packed(df, partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote by settle(); other applications' tables stay. Also called when it ends."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _at_end(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may have been stopped before
        drop_scratch(spark)
