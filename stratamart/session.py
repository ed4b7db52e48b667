"""Session settings and the shared folders a job may write to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the jobs are designed around. Shuffle width is left to the caller:
# adaptive execution coalesces a generous initial number.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset, a folder in the warehouse, which executors share too."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for tables that outlive one query, below a folder of this application only."""
    return f"{application_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stratamart/{spark.sparkContext.applicationId}"
