"""Time headline queries: one JSON line on stdout.

Each time includes planning and a full evaluation into Spark's no-op sink. As in a
layered build, the facts read landed raw tables (``raw_feeds``) and the marts
read silver tables (``silver_build``); both are written once and timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from stratamart.registry import all_entries
from stratamart.registry.core import context, spark_query
from stratamart.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "fct_sales", "fct_returns", "fct_inventory", "dim_customer",
    "kpi_daily_executive", "agg_sales_by_channel_month", "agg_store_performance_month", "agg_product_performance",
    "agg_category_trend_month", "dim_customer_rfm", "agg_customer_channel_mix", "agg_promotion_effectiveness",
    "agg_returns_by_reason_month", "agg_inventory_health_weekly", "agg_category_affinity",
    "channel_revenue_summary", "crop_yield_trend", "customer_rfm_segments", "readmission_risk", "drug_safety_signal",
    "bank_txn_signals", "bank_fraud_summary", "bank_balance_daily", "dq_results_table", "dq_quarantine", "dq_ledger",
    "taxi_daily_revenue", "taxi_top_pickups", "score_sentiment",
]
SILVER = ["dim_date", "dim_item", "dim_store", "dim_promotion", "dim_return_reason", "dim_warehouse", "dim_customer",
          "fct_sales", "fct_returns", "fct_inventory"]
RAW = ["store_sales", "catalog_sales", "web_sales", "store_returns", "catalog_returns", "web_returns", "inventory"]


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=os.environ.get("BENCH_SHUFFLE", "16"), spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{FOLDER}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the executors
    took: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        took[name] = round(time.perf_counter() - start, 3)

    entries = all_entries()
    ctx = context(spark, FOLDER)
    timed("raw_feeds", lambda: [ctx.bronze(n) for n in RAW])
    timed("silver_build", lambda: [ctx.retail.silver(n) for n in SILVER])
    for name in HEADLINE:
        run = spark_query(entries[name])
        timed(name, lambda: run(spark, FOLDER).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "total_seconds_headline_queries", "value": round(sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS)}))
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
