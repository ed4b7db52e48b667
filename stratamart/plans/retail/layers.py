"""The retail layers as named tables: raw feeds in, silver and marts out."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from stratamart.operators.quality import stamp_ledger
from stratamart.plans.retail import dims, facts, marts
from stratamart.sinks.scratch import settle

PARTITIONED = {"fct_sales": "sold_year", "fct_returns": "returned_year", "fct_inventory": "snapshot_year"}

MARTS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "kpi_daily_executive": (marts.kpi_daily_executive, ("fct_sales", "fct_returns", "dim_date")),
    "agg_sales_by_channel_month": (marts.agg_sales_by_channel_month, ("fct_sales",)),
    "agg_store_performance_month": (marts.agg_store_performance_month, ("fct_sales", "dim_store")),
    "agg_product_performance": (marts.agg_product_performance, ("fct_sales", "fct_returns", "dim_item")),
    "agg_category_trend_month": (marts.agg_category_trend_month, ("fct_sales", "dim_item")),
    "dim_customer_rfm": (marts.dim_customer_rfm, ("fct_sales", "fct_returns", "dim_customer")),
    "agg_customer_channel_mix": (marts.agg_customer_channel_mix, ("fct_sales",)),
    "agg_promotion_effectiveness": (marts.agg_promotion_effectiveness, ("fct_sales", "dim_promotion")),
    "agg_returns_by_reason_month": (marts.agg_returns_by_reason_month, ("fct_returns", "dim_return_reason", "dim_item")),
    "agg_inventory_health_weekly": (marts.agg_inventory_health_weekly, ("fct_inventory", "fct_sales", "dim_warehouse", "dim_item")),
    "agg_category_affinity": (marts.agg_category_affinity, ("fct_sales", "dim_item")),
}
STAGE, LEDGER = "_stg_sales_flagged", "dq_metrics"
COMMENTS = {name: spec.comment for name, spec in dims.DIMENSIONS.items()} | {
    "dim_customer": "Customer with demographics, household, income and address",
    "fct_sales": "Store, catalogue and web sales at one grain",
    "fct_returns": "Store, catalogue and web returns at one grain",
    "fct_inventory": "Stock position per item and warehouse",
    "dq_rejects_sales": "Sales lines that broke the contract, with the reason",
    LEDGER: "What each table arrived with, what was mended and what was published",
}
SILVER = [*dims.DIMENSIONS, "dim_customer", "fct_sales", "dq_rejects_sales", "fct_returns", "fct_inventory"]


class RetailLayers:
    """Builds any table of the retail model from raw feeds.

    ``fresh(name)`` is the transformation itself. ``silver(name)`` is the table as
    downstream jobs see it: written once, then scanned.
    """

    def __init__(self, spark: SparkSession, bronze: Callable[[str], DataFrame], keep_pct: int = 100):
        self.spark, self.bronze, self.keep_pct = spark, bronze, keep_pct
        self._written: dict[str, DataFrame] = {}

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._written:
            self._written[name] = settle(build(), name, PARTITIONED.get(name))
        return self._written[name]

    def silver(self, name: str) -> DataFrame:
        return self.once(name, lambda: self.fresh(name))

    def raw_sales(self) -> DataFrame:
        return facts.raw_sales(self.bronze, self.keep_pct)

    def raw_returns(self) -> DataFrame:
        return facts.raw_returns(self.bronze, self.keep_pct)

    def raw_inventory(self) -> DataFrame:
        return facts.raw_inventory(self.bronze, self.keep_pct)

    def flagged_sales(self) -> DataFrame:
        """Replays removed and contracts checked; read by the fact and by the rejects, so staged."""
        return self.once(STAGE, lambda: facts.flagged_sales(self.raw_sales()))

    def fresh(self, name: str) -> DataFrame:
        b = self.bronze
        if name in dims.DIMENSIONS:
            return dims.build(name, b(dims.DIMENSIONS[name].feed))
        if name == "dim_customer":
            return dims.build_customer(
                b("customer"), b("customer_demographics"), b("household_demographics"), b("income_band"), self.silver("dim_address"))
        if name == "fct_sales":
            return facts.fct_sales(self.flagged_sales(), self.silver("dim_date"))
        if name == "dq_rejects_sales":
            return facts.sales_rejects(self.flagged_sales())
        if name == "fct_returns":
            return facts.fct_returns(self.raw_returns(), self.silver("dim_date"))
        if name == "fct_inventory":
            return facts.fct_inventory(self.raw_inventory(), self.silver("dim_date"))
        raise KeyError(name)

    def mart(self, name: str) -> DataFrame:
        build, inputs = MARTS[name]
        return build(*(self.silver(i) for i in inputs))

    def published(self, name: str) -> DataFrame:
        """A mart, ledger or reject table as the reports read it."""
        if name == LEDGER:
            return self.once(name, self.ledger)
        if name in MARTS:
            return self.once(name, lambda: self.mart(name))
        return self.silver(name)

    # --- ledger -----------------------------------------------------------------

    def ledger_part_one(self) -> DataFrame:
        part = facts.dimension_ledger(self.bronze, self.silver)
        return part.unionByName(facts.sales_ledger(self.raw_sales(), self.flagged_sales(), self.silver("fct_sales")))

    def ledger_part_two(self) -> DataFrame:
        return facts.returns_inventory_ledger(
            self.raw_returns(), self.silver("fct_returns"), self.raw_inventory(), self.silver("fct_inventory"))

    def ledger(self, batch_id: str = "batch") -> DataFrame:
        return stamp_ledger(reduce(DataFrame.unionByName, [self.ledger_part_one(), self.ledger_part_two()]), batch_id)
