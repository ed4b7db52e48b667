"""Registered queries against their SQL. TEST_ALL=1 runs every one, otherwise a cross-section."""

import os

import duckdb
import pytest

from check import normal
from stratamart.registry import all_entries
from stratamart.registry.core import oracle, spark_query
from stratamart.sources.star import TABLES

CROSS_SECTION = [
    "dim_address", "dim_store", "dim_customer", "fct_sales", "fct_returns", "fct_inventory", "dq_rejects_sales", "dq_ledger", "kpi_daily_executive",
    "agg_category_trend_month", "agg_product_performance", "dim_customer_rfm", "agg_promotion_effectiveness", "agg_category_affinity", "channel_revenue_summary",
    "crop_yield_trend", "crop_yield_trend_sql", "customer_rfm_segments", "readmission_risk", "bank_balance_daily", "bank_fraud_summary", "recon_variance",
    "src_tsv_gz", "src_json_explode", "sink_ledger_part", "replay_slice", "load_strategy", "score_sentiment", "win_rank", "taxi_top_tips",
]
NAMES = list(all_entries()) if os.environ.get("TEST_ALL") else CROSS_SECTION


@pytest.fixture(scope="module")
def db(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, folder, db, name):
    entry = all_entries()[name]
    df = spark_query(entry)(spark, folder)
    got = [tuple(r) for r in df.collect()]
    if entry.sql is not None:
        want = db.execute(oracle(entry))
        assert df.columns == [c[0] for c in want.description]
        assert normal(got) == normal(want.fetchall())


def test_contract():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 200
