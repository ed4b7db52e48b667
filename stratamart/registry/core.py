"""Registry of comparable queries.

An entry has a ``shape`` ("name:type ..."): both sides are cast to it, so the two
engines are compared on values. Types: i whole number, f double, s text, b
boolean, d date as text, t timestamp (to the second) as text.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.plans.retail.layers import RetailLayers
from stratamart.sources.star import DUCK, TABLES, Star, feeds


class Context:
    """Everything a query may read for one session and folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.star = Star(spark, folder)
        self.lock = threading.RLock()
        self.retail = RetailLayers(spark, self.bronze)

    def bronze(self, name: str) -> DataFrame:
        """A raw retail table: the large ones are projections of the lines, which are files, so no copy is written."""
        return self.star[f"src_{name}"]

    def __getitem__(self, name: str) -> DataFrame:
        return self.star[name]


_contexts: dict[tuple[str, str, int], Context] = {}


def _state(spark: SparkSession, folder: str) -> int:
    """Changes when a table of the folder is written again."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return hash(tuple(sorted((f.getPath().getName(), f.getModificationTime(), f.getLen()) for f in files)))


def context(spark: SparkSession, folder: str) -> Context:
    key = (spark.sparkContext.applicationId, folder, _state(spark, folder))
    if key not in _contexts:
        _contexts[key] = Context(spark, folder)
    return _contexts[key]


@dataclass(frozen=True)
class Entry:
    name: str
    shape: str
    build: Callable[[Context], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}
RELATIONS: dict[str, str] = {}  # name -> SQL of a reusable expected relation


def query(name: str, shape: str, sql: str | None = None):
    """Register ``build(ctx)`` under ``name``; ``sql`` is what it must equal."""
    def add(build: Callable[[Context], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"{name} registered twice")
        ENTRIES[name] = Entry(name, shape, build, sql)
        return build
    return add


def relation(name: str, sql: str) -> None:
    RELATIONS[name] = sql


def _fields(shape: str) -> list[tuple[str, str]]:
    return [tuple(part.split(":")) for part in shape.split()]


_SPARK_CAST: dict[str, Callable[[Column], Column]] = {
    "i": lambda c: c.cast("bigint"), "f": lambda c: c.cast("double"), "s": lambda c: c.cast("string"),
    "b": lambda c: c.cast("boolean"), "d": lambda c: c.cast("date").cast("string"),
    "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
}
_DUCK_CAST = {
    "i": "CAST({c} AS BIGINT)", "f": "CAST({c} AS DOUBLE)", "s": "CAST({c} AS VARCHAR)", "b": "CAST({c} AS BOOLEAN)",
    "d": "CAST(CAST({c} AS DATE) AS VARCHAR)", "t": "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')",
}


def shaped(df: DataFrame, shape: str) -> DataFrame:
    return df.select(*(_SPARK_CAST[t](F.col(c)).alias(c) for c, t in _fields(shape)))


def spark_query(entry: Entry) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return shaped(entry.build(context(spark, folder)), entry.shape)
    run.__name__ = entry.name
    return run


@cache
def _known() -> dict[str, str]:
    return {**feeds(DUCK), **RELATIONS}


def _plain(text: str) -> str:
    return re.sub(r"\{(\w+)\}", r"\1", text)


def with_clause(sql: str) -> str:
    """WITH ... for every {relation} the SQL needs, directly or not."""
    ctes: dict[str, str] = {}

    def visit(text: str) -> None:
        for dep in re.findall(r"\{(\w+)\}", text):
            if dep in TABLES or dep in ctes:
                continue
            visit(_known()[dep])
            ctes[dep] = _known()[dep]

    visit(sql)
    parts = ", ".join(f"{n} AS ({_plain(t)})" for n, t in ctes.items())
    return f"WITH {parts} " if parts else ""


def oracle(entry: Entry) -> str:
    cols = ", ".join(f'{_DUCK_CAST[t].format(c=c)} AS {c}' for c, t in _fields(entry.shape))
    return f"{with_clause(entry.sql)}SELECT {cols} FROM ({_plain(entry.sql)})"


# --- SQL helpers of the expected side ------------------------------------------------

def rnd(expr: str, digits: int, kept: int = 20) -> str:
    """Round half up on the shortest decimal text of a double, which is how Spark rounds doubles."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,{kept})), {digits}) AS DOUBLE)"


def pctn_(a: str, b: str, digits: int) -> str:
    """Percent of counts: double arithmetic."""
    return rnd(f"CAST({a} AS DOUBLE) / nullif({b}, 0) * 100", digits)


def divn_(a: str, b: str, digits: int) -> str:
    return rnd(f"CAST({a} AS DOUBLE) / nullif({b}, 0)", digits)


# Ratios of money are exact decimals in Spark. The double quotient is within a few 1e-10
# of them, so cutting it to 9 places first restores exact halves.
def pct_(a: str, b: str, digits: int) -> str:
    return rnd(f"CAST({a} AS DOUBLE) * 100 / nullif(CAST({b} AS DOUBLE), 0)", digits, 9)


def div_(a: str, b: str, digits: int) -> str:
    return rnd(f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)", digits, 9)


def mean_(x: str, digits: int) -> str:
    return rnd(f"CAST(sum(CAST({x} AS DECIMAL(28,6))) AS DOUBLE) / nullif(count({x}), 0)", digits, 9)


def latest_(source: str, keys: str, newest: str = "", rest: str = "") -> str:
    """One row per key, newest first, remaining columns as tie-break."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in f"{newest} {rest}".split()) or "1"
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"
