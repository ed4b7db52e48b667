"""Compare registered queries with their SQL in the checking database: python check.py [name-prefix ...]."""

from __future__ import annotations

import os
import signal
import sys
import threading
import time

import duckdb

from stratamart.registry import all_entries
from stratamart.registry.core import oracle, spark_query
from stratamart.session import build_session
from stratamart.sources.star import TABLES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


LIMIT = int(os.environ.get("CHECK_LIMIT", "90"))


def _too_long(*_):
    raise TimeoutError(f"over {LIMIT} seconds")


def normal(rows) -> list[tuple]:
    def one(v):
        if v is None:
            return (0, "")
        return (1, repr(float(v))) if isinstance(v, (int, float)) and not isinstance(v, bool) else (1, str(v))
    return sorted(tuple(one(v) for v in row) for row in rows)


def main(prefixes: list[str]) -> int:
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    signal.signal(signal.SIGALRM, _too_long)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    bad = 0
    for name, entry in all_entries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        signal.alarm(LIMIT)
        try:
            df = spark_query(entry)(spark, FOLDER)
            got = [tuple(r) for r in df.collect()]
            plan = df._jdf.queryExecution().executedPlan().toString()
            for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
                if node in plan:
                    print(f"   plan of {name} has {node}")
            spent = time.time() - start
            signal.alarm(0)
            if entry.sql is None:
                print(f"{name:34s} rows-only {len(got):7d}  {spent:6.1f}s", flush=True)
                continue
            watch = threading.Timer(LIMIT, db.interrupt)
            watch.start()
            mark = time.time()
            res = db.execute(oracle(entry))
            cols = [c[0] for c in res.description]
            want = res.fetchall()
            watch.cancel()
            a, b = normal(got), normal(want)
            same = a == b and df.columns == cols
            print(f"{name:34s} {'OK  ' if same else 'DIFF'} {len(got):7d} {len(want):7d}  {spent:6.1f}s  (expected side {time.time() - mark:.1f}s)", flush=True)
            if not same:
                bad += 1
                sa, sb = set(a), set(b)
                print("   columns", df.columns == cols, "\n   spark ", [x for x in a if x not in sb][:2], "\n   oracle", [x for x in b if x not in sa][:2])
        except Exception as e:  # report and go on
            bad += 1
            print(f"{name:34s} ERR  {str(e)[:600]}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
