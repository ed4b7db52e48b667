"""The retail build as one flow over a manifest: land, silver, gold, each layer visible as a whole or not at all.

Bronze takes every extract with its audit columns, several at a time. Silver and gold build in waves of tables that do not
need each other. A table that is committed for the batch is kept; one that fails is reported and leaves the others committed,
and the layer is sealed only once all its tables are. The next layer refuses to start before that.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.operators.quality import lineage_by_layer
from stratamart.plans.retail import dims
from stratamart.plans.retail.layers import COMMENTS, LEDGER, MARTS, PARTITIONED, SILVER, STAGE, RetailLayers
from stratamart.sinks.manifest import FAILED, KEPT, WRITTEN, Manifest, Outcome, side_by_side_jobs
from stratamart.sinks.tables import census, stamp
from stratamart.sources.defects import inject_defects
from stratamart.sources.landing import AUDIT, with_audit

# The system each extract comes from.
SYSTEMS = {
    "store_sales": "pos_dw", "store_returns": "pos_dw", "store": "pos_dw",
    "catalog_sales": "catalog_erp", "catalog_returns": "catalog_erp", "catalog_page": "catalog_erp", "call_center": "catalog_erp",
    "web_sales": "web_storefront", "web_returns": "web_storefront", "web_page": "web_storefront", "web_site": "web_storefront",
    "customer": "crm_mdm", "customer_address": "crm_mdm", "customer_demographics": "crm_mdm", "household_demographics": "crm_mdm", "income_band": "crm_mdm",
    "item": "merch_erp", "promotion": "merch_erp", "inventory": "merch_erp", "warehouse": "merch_erp",
    "date_dim": "ref_data", "time_dim": "ref_data", "ship_mode": "ref_data", "reason": "ref_data",
}
#: Tables of silver that do not need each other, wave by wave; a stage comes before those that read it.
WAVES: list[list[str]] = [[*dims.DIMENSIONS], ["dim_customer", STAGE, "fct_returns", "fct_inventory"], ["fct_sales", "dq_rejects_sales"], [LEDGER]]
#: Marts at a time. Each shuffles the whole fact, and what is shuffled lies on disk until its mart is written.
MARTS_AT_ONCE = 2
LAYERS = {"bronze": list(SYSTEMS), "silver": [*SILVER, LEDGER], "gold": list(MARTS)}


class RetailFlow(RetailLayers):
    """One batch of the retail build below ``root``; ``extracts(name)`` is the raw feed."""

    def __init__(self, spark: SparkSession, root: str, prefix: str, extracts: Callable[[str], DataFrame], batch_id: str,
                 dirty: bool = False, keep_pct: int = 100, width: int = 8):
        super().__init__(spark, self.landed, keep_pct)
        self.manifest, self.prefix, self.extracts, self.batch_id = Manifest(spark, root), prefix, extracts, batch_id
        self.dirty, self.width = dirty, width
        self._rows: dict[str, tuple[str, int]] = {}

    # --- tables of the batch -------------------------------------------------------

    def landed(self, name: str) -> DataFrame:
        """A landed extract without its audit columns."""
        return self.of_batch("bronze", name).drop(*AUDIT)

    def of_batch(self, layer: str, name: str) -> DataFrame:
        return self.manifest.read(layer, name, self.batch_id)

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table of silver or gold as committed in this batch, without its stamp; built and committed if it is not yet."""
        if name not in self._written:
            layer = "gold" if name in MARTS else "silver"
            held = self.manifest.find(self.batch_id, layer, name, fresh=False)  # the build begins by reading what is committed
            status = KEPT if held else WRITTEN
            held = held or self.manifest.write(stamp(build(), layer, self.batch_id), self.batch_id, layer, name, PARTITIONED.get(name))
            self._rows[name] = status, held.rows
            self._written[name] = self.spark.read.parquet(held.path).drop(f"_{layer}_batch_id", f"_{layer}_ts")
        return self._written[name]

    # --- layers --------------------------------------------------------------------

    def land(self) -> list[Outcome]:
        held = self.manifest.commits(self.batch_id, "bronze")

        def one(name: str) -> Outcome:
            if name in held:
                return Outcome("bronze", name, KEPT, held[name].rows)
            feed = self.extracts(name)
            raw = with_audit(inject_defects(name, feed) if self.dirty else feed, SYSTEMS[name], f"{name}.parquet", self.batch_id)
            return Outcome("bronze", name, WRITTEN, self.manifest.write(raw, self.batch_id, "bronze", name).rows)

        done = side_by_side_jobs(self.spark, {n: (lambda n=n: one(n)) for n in SYSTEMS}, "bronze", self.width)
        return self._finish("bronze", done)

    def build_silver(self) -> list[Outcome]:
        self._require("bronze")
        return self._build("silver", WAVES, lambda name: self.flagged_sales() if name == STAGE else self.published(name))

    def build_gold(self) -> list[Outcome]:
        self._require("silver")
        return self._build("gold", [list(MARTS)], self.published, min(self.width, MARTS_AT_ONCE))

    def _build(self, layer: str, waves: Sequence[list[str]], build: Callable[[str], DataFrame], width: int | None = None) -> list[Outcome]:
        def one(name: str) -> Outcome:
            build(name)
            return Outcome(layer, name, *self._rows[name])

        done: list[Outcome] = []
        held = self.manifest.commits(self.batch_id, layer)
        for wave in waves:
            if any(o.status == FAILED for o in done):
                done += [Outcome(layer, n, FAILED, None, "not started") for n in wave]
                continue
            # a stage is needed only while one of its readers is missing
            names = [n for n in wave if n != STAGE or not {"fct_sales", "dq_rejects_sales", LEDGER} <= set(held)]
            done += side_by_side_jobs(self.spark, {n: (lambda n=n: one(n)) for n in names}, layer, width or self.width)
        return self._finish(layer, [o for o in done if o.table_name != STAGE or o.status == FAILED])

    def _finish(self, layer: str, done: list[Outcome]) -> list[Outcome]:
        """Seal, name in the catalog and clear up, if every table is there."""
        database = f"{self.prefix}_{layer}"
        if self.manifest.seal(self.batch_id, layer, LAYERS[layer]):
            self.manifest.expose(layer, database, LAYERS[layer], COMMENTS)
            self.manifest.sweep(self.batch_id, layer, LAYERS[layer])
        elif self.manifest.sealed(layer) and not all(self.spark.catalog.tableExists(f"{database}.{t}") for t in LAYERS[layer]):
            self.manifest.expose(layer, database, LAYERS[layer], COMMENTS)  # a driver died between the seal and the names
        return done

    def _require(self, layer: str) -> None:
        if set(LAYERS[layer]) - set(self.manifest.commits(self.batch_id, layer)):
            raise RuntimeError(f"{layer} of batch {self.batch_id} is not complete")

    def run(self) -> list[Outcome]:
        """All three layers, up to the first that is not complete."""
        done: list[Outcome] = []
        for layer in (self.land, self.build_silver, self.build_gold):
            done += layer()
            if any(o.status == FAILED for o in done):
                break
        return done

    # --- proof ---------------------------------------------------------------------

    def census(self, *more: str) -> DataFrame:
        """Tables and rows of each layer, from the catalog."""
        return census(self.spark, [f"{self.prefix}_{layer}" for layer in (*LAYERS, *more)])

    def lineage(self) -> DataFrame:
        """Batches that the rows of each layer carry."""
        stamps = {"bronze": "_batch_id", "silver": "_silver_batch_id", "gold": "_gold_batch_id"}
        return lineage_by_layer({layer: ([self.spark.table(f"{self.prefix}_{layer}.{t}") for t in tables], stamps[layer]) for layer, tables in LAYERS.items()})


def outcomes(spark: SparkSession, *runs: list[Outcome]) -> DataFrame:
    """The outcomes of several runs side by side: status_0, status_1, ... and the rows of the last one that has them."""
    shape = "layer string, table_name string, status string, rows long, detail string"
    parts = [spark.createDataFrame([(o.layer, o.table_name, o.status, o.rows, o.detail) for o in run], shape).select(
        "layer", "table_name", F.lit(k).alias("run"), "status", "rows", "detail") for k, run in enumerate(runs)]
    stacked = reduce(DataFrame.unionByName, parts).groupBy("layer", "table_name")
    return stacked.agg(F.max_by("rows", F.when(F.col("rows").isNotNull(), F.col("run"))).alias("rows"),
                       *(F.max(F.when(F.col("run") == k, F.col("status"))).alias(f"status_{k}") for k in range(len(runs))))
