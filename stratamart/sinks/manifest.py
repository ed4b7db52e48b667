"""A manifest of batches: many tables published together, restartable, all or none.

Every table of a batch is written below a path of its own, and a commit record (one small Parquet folder, never changed) says
where it lies and how many rows it has. When all tables of a layer are committed, one more record seals the layer for the
batch. Readers follow the newest seal, so they see the tables of one batch together: those of an unfinished batch stay
invisible, however far it came. A batch that starts again keeps what is committed and writes the rest.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.sinks.scratch import packed, shuffles_dropped
from stratamart.sinks.tables import ROWS_PER_FILE, create_database

RECORD = "batch_id string, layer string, table_name string, path string, partition_by string, rows long, kind string, at timestamp"
COMMITTED, SEALED = "COMMITTED", "SEALED"
WRITTEN, KEPT, FAILED = "WRITTEN", "KEPT", "FAILED"


@dataclass(frozen=True)
class Outcome:
    """What became of one table in one run."""

    layer: str
    table_name: str
    status: str
    rows: int | None = None
    detail: str | None = None


@dataclass(frozen=True)
class Commit:
    path: str
    partition_by: str | None
    rows: int


class Manifest:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._records = f"{self.root}/commits"
        self._seen: dict[tuple[str, str, str], Commit] = {}  # a commit never changes, so it is read once
        spark.createDataFrame([], RECORD).write.mode("ignore").parquet(f"{self._records}/begin")

    def records(self) -> DataFrame:
        """All records. A record that was being written when its driver died does not show."""
        return self.spark.read.schema(RECORD).option("recursiveFileLookup", True).parquet(self._records)

    def _record(self, batch_id: str, layer: str, table: str, path: str, partition_by: str | None, rows: int, kind: str) -> None:
        row = self.spark.createDataFrame([(batch_id, layer, table, path, partition_by, rows, kind)], RECORD.rpartition(",")[0])
        row.withColumn("at", F.current_timestamp()).coalesce(1).write.parquet(f"{self._records}/{layer}-{table}-{uuid.uuid4().hex}")

    def commits(self, batch_id: str, layer: str) -> dict[str, Commit]:
        """The committed tables of a batch: a row a table. Of two drivers that wrote the same one the first counts."""
        found = self.records().where((F.col("batch_id") == batch_id) & (F.col("layer") == layer) & (F.col("kind") == COMMITTED))
        first = found.groupBy("table_name").agg(F.min_by(F.struct("path", "partition_by", "rows"), F.struct("at", "path")).alias("c"))
        held = {r["table_name"]: Commit(r["c"]["path"], r["c"]["partition_by"], r["c"]["rows"]) for r in first.collect()}
        self._seen.update({(batch_id, layer, t): c for t, c in held.items()})
        return held

    def sealed(self, layer: str) -> str | None:
        """The batch that readers of a layer see."""
        newest = self.records().where((F.col("layer") == layer) & (F.col("kind") == SEALED)).agg(F.max_by("batch_id", "at")).head()
        return newest[0]

    def write(self, df: DataFrame, batch_id: str, layer: str, table: str, partition_by: str | None = None) -> Commit:
        """Write a table of the batch and commit it; the rows are counted in the files' footers."""
        path = f"{self.root}/{layer}/{table}/{batch_id}-{uuid.uuid4().hex[:8]}"
        with shuffles_dropped(self.spark):
            packed(df, partition_by).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
        rows = self.spark.read.schema(df.schema).parquet(path).count()
        self._record(batch_id, layer, table, path, partition_by, rows, COMMITTED)
        self._seen[batch_id, layer, table] = Commit(path, partition_by, rows)
        return self._seen[batch_id, layer, table]

    def seal(self, batch_id: str, layer: str, tables: Iterable[str]) -> bool:
        """Make the batch the one that readers see, if all its tables are committed; True if it was not sealed before."""
        if set(tables) - set(self.commits(batch_id, layer)):
            return False
        same = (F.col("batch_id") == batch_id) & (F.col("layer") == layer) & (F.col("kind") == SEALED)
        if not self.records().where(same).isEmpty():
            return False
        self._record(batch_id, layer, "", "", None, len(set(tables)), SEALED)
        return True

    def read(self, layer: str, table: str, batch_id: str | None = None) -> DataFrame:
        """A table as of the newest seal, or of a given batch."""
        batch = batch_id or self.sealed(layer)
        held = self.find(batch, layer, table) if batch else None
        if held is None:
            raise LookupError(f"{layer}.{table} is not committed in batch {batch}")
        return self.spark.read.parquet(held.path)

    def find(self, batch_id: str, layer: str, table: str, fresh: bool = True) -> Commit | None:
        """A table's commit; unless ``fresh``, only as far as commits() has told it before."""
        if (batch_id, layer, table) not in self._seen and fresh:
            self.commits(batch_id, layer)
        return self._seen.get((batch_id, layer, table))

    def expose(self, layer: str, database: str, tables: Iterable[str], comments: dict[str, str] | None = None) -> None:
        """Catalog tables over the sealed batch's files. Only names change hands, so this can be done again at any time."""
        batch = self.sealed(layer)
        held = self.commits(batch, layer) if batch else {}
        create_database(self.spark, database, f"Tables of the {layer} layer", f"{self.root}/catalog/{database}")
        for table in tables:
            name = f"{database}.{table}"
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            self.spark.catalog.createTable(name, path=held[table].path, source="parquet", description=(comments or {}).get(table))
            if held[table].partition_by:
                self.spark.catalog.recoverPartitions(name)

    def sweep(self, batch_id: str, layer: str, keep: Iterable[str]) -> int:
        """Delete what a finished batch left of this layer: stages, and files of attempts that were never committed."""
        wanted = {c.path for t, c in self.commits(batch_id, layer).items() if t in set(keep)}
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        top = hadoop(f"{self.root}/{layer}")
        fs = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        gone = 0
        for table in fs.listStatus(top) if fs.exists(top) else []:
            for attempt in fs.listStatus(table.getPath()):
                place = attempt.getPath()
                if place.getName().startswith(f"{batch_id}-") and f"{self.root}/{layer}/{table.getPath().getName()}/{place.getName()}" not in wanted:
                    fs.delete(place, True)
                    gone += 1
        return gone


def side_by_side_jobs(spark: SparkSession, jobs: dict[str, Callable[[], Outcome]], layer: str, width: int) -> list[Outcome]:
    """Run jobs that do not need each other, some at a time, each in a pool and job group of its own.

    Under fair scheduling small tables do not wait for large ones. An error stays with its table and is reported.
    """
    sc = spark.sparkContext

    def one(name: str) -> Outcome:
        sc.setLocalProperty("spark.scheduler.pool", f"{layer}.{name}")
        sc.setJobGroup(f"{layer}.{name}", f"Build {layer}.{name}")
        try:
            return jobs[name]()
        except Exception as error:  # whatever broke, the other tables go on and the run reports it
            return Outcome(layer, name, FAILED, None, str(error).strip().split("\n")[0][:300])
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)
            sc.setLocalProperty("spark.jobGroup.id", None)

    with ThreadPoolExecutor(max_workers=width) as pool:
        return list(pool.map(one, jobs))
