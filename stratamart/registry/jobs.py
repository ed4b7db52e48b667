"""Sources, sinks, catalog jobs, flows and scoring."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.functions import code
from stratamart.operators import quality
from stratamart.operators.keyed import latest_per_key
from stratamart.plans import banking as bank, flows, scoring
from stratamart.plans.retail import facts
from stratamart.plans.retail.flow import LAYERS, SYSTEMS, RetailFlow, outcomes
from stratamart.plans.retail.layers import COMMENTS
from stratamart.registry.banking import _PROFILE, PROFILES, RUN, profile_sql
from stratamart.registry.core import Context, query, relation
from stratamart.session import scratch_path
from stratamart.sinks import tables as t
from stratamart.sources import readers, shapes
from stratamart.sources.defects import REPLAYS, RULES, hit, inject_defects, slices
from stratamart.sources.landing import ingest

BATCH = "batch_20240120"


def fresh_db(ctx: Context, layer: str = "lab") -> str:
    """A database of its own below the shared folder, so that a rerun never meets older tables."""
    name = f"sm_{uuid.uuid4().hex[:10]}_{layer}"
    t.create_database(ctx.spark, name, f"Tables of {layer}", scratch_path(ctx.spark, name))
    return name


def _as_text(df, path: str, **options) -> str:
    df.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **options).csv(path)
    return path


# --- sources ----------------------------------------------------------------------------------
query("src_parquet", "l_orderkey:i l_quantity:f", "SELECT l_orderkey, l_quantity FROM {lineitem}")(
    lambda c: readers.read_parquet(c.spark, f"{c.folder}/lineitem.parquet").select("l_orderkey", "l_quantity"))
query("src_csv_inferred", "c_custkey:i c_name:s c_nationkey:i c_acctbal:f c_mktsegment:s", "SELECT * FROM {customer}")(
    lambda c: readers.read_csv_inferred(c.spark, [_as_text(c["customer"], scratch_path(c.spark, "csv"))]))
query("src_csv_declared", "account_id:s customer_id:s account_type:s branch_code:s currency:s opening_balance:f status:s opened_on:s risk_band:i", "SELECT * FROM {src_accounts}")(
    lambda c: readers.read_csv_declared(c.spark, _as_text(c["src_accounts"], scratch_path(c.spark, "csv")), bank.ACCOUNT_SCHEMA))


def _tsv(c: Context):
    paths = [_as_text(c["src_crops"].where(cond), scratch_path(c.spark, "tsv"), sep="\t", compression="gzip") for cond in ("YEAR < '1998'", "YEAR >= '1998'")]
    return readers.read_tsv(c.spark, paths, c["src_crops"].columns)


query("src_tsv_gz", "COMMODITY_DESC:s STATISTICCAT_DESC:s STATE_ALPHA:s YEAR:s VALUE:s", "SELECT * FROM {src_crops}")(_tsv)
query("src_rows_declared", "o_orderkey:i label:s", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open' END AS label FROM {orders} WHERE o_orderstatus IN ('F', 'O')")(
    lambda c: c["orders"].join(readers.rows_with_schema(c.spark, [("F", "filled"), ("O", "open")], "o_orderstatus string, label string"), "o_orderstatus"))
_STUDY = """to_json(named_struct('protocolSection', named_struct(
  'identificationModule', named_struct('nctId', concat('NCT', o_orderkey), 'briefTitle', o_orderpriority),
  'statusModule', named_struct('overallStatus', o_orderstatus, 'startDateStruct', named_struct('date', CAST(CAST(o_orderdate AS DATE) AS STRING))),
  'designModule', named_struct('phases', CASE WHEN o_orderkey % 3 = 0 THEN array() WHEN o_orderkey % 3 = 1 THEN array('PHASE1', 'PHASE2') END, 'enrollmentInfo', named_struct('count', o_custkey)),
  'conditionsModule', CASE WHEN o_orderkey % 4 > 0 THEN named_struct('conditions', array(concat('C', o_orderkey % 9), 'other')) END,
  'sponsorCollaboratorsModule', named_struct('leadSponsor', named_struct('name', CASE WHEN o_orderkey % 5 > 0 THEN concat('S', o_custkey) END)))))"""
query("src_json_flatten", "nct_id:s brief_title:s overall_status:s phase:s primary_condition:s lead_sponsor:s enrollment_count:i start_date:s completion_date:s", """
  SELECT 'NCT' || o_orderkey AS nct_id, o_orderpriority AS brief_title, o_orderstatus AS overall_status, CASE WHEN o_orderkey % 3 = 1 THEN 'PHASE1' ELSE 'NA' END AS phase,
  CASE WHEN o_orderkey % 4 > 0 THEN 'C' || o_orderkey % 9 END AS primary_condition, CASE WHEN o_orderkey % 5 > 0 THEN 'S' || o_custkey END AS lead_sponsor, o_custkey AS enrollment_count,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS start_date, NULL AS completion_date FROM {orders}""")(
    lambda c: shapes.flatten_studies(readers.parse_json_documents(c["orders"].select(F.expr(_STUDY).alias("doc")), "doc", shapes.STUDY_SCHEMA)))
_REPORT = """to_json(named_struct('safetyreportid', CAST(l_orderkey AS STRING), 'receivedate', CAST(CAST(l_shipdate AS DATE) AS STRING), 'serious', CAST(1 + l_linenumber % 2 AS STRING),
  'primarysource', named_struct('reportercountry', l_linestatus), 'patient', named_struct('patientsex', l_returnflag,
  'drug', CASE WHEN l_suppkey % 4 > 0 THEN array(named_struct('medicinalproduct', concat('D', l_suppkey)), named_struct('medicinalproduct', 'X')) END,
  'reaction', CASE l_partkey % 3 WHEN 1 THEN array(named_struct('reactionmeddrapt', concat('R', l_partkey % 20))) WHEN 2 THEN array(named_struct('reactionmeddrapt', concat('R', l_partkey % 20)), named_struct('reactionmeddrapt', 'PAIN')) END)))"""
_REPORT_SQL = """SELECT CAST(l_orderkey AS VARCHAR) AS safety_report_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS receive_date, CAST(1 + l_linenumber % 2 AS VARCHAR) AS serious, NULL AS seriousness_death,
  NULL AS patient_age, l_returnflag AS patient_sex, l_linestatus AS reporter_country, CASE WHEN l_suppkey % 4 > 0 THEN 'D' || l_suppkey END AS drug_name, """
query("src_json_explode", "safety_report_id:s receive_date:s serious:s seriousness_death:s patient_age:s patient_sex:s reporter_country:s drug_name:s reaction_term:s",
      _REPORT_SQL + "'R' || l_partkey % 20 AS reaction_term FROM {lineitem} WHERE l_partkey % 3 > 0 UNION ALL " + _REPORT_SQL + "'PAIN' FROM {lineitem} WHERE l_partkey % 3 = 2")(
    lambda c: shapes.explode_reports(readers.parse_json_documents(c["lineitem"].select(F.expr(_REPORT).alias("doc")), "doc", shapes.REPORT_SCHEMA)))
query("src_rename_repair", "invoice_no:s stock_code:s description:s quantity:i invoice_date:d unit_price:f customer_id:i country:s", "SELECT * FROM {v_orders}")(
    lambda c: shapes.normalise_orders(*(c["src_orders_sheet"].where(f"InvoiceDate {op} DATE '1998-01-01'") for op in ("<", ">="))))
query("src_state_crop_filter", "COMMODITY_DESC:s STATISTICCAT_DESC:s UNIT_DESC:s STATE_ALPHA:s STATE_NAME:s YEAR:s VALUE:s", "SELECT * FROM {v_crop_rows}")(lambda c: shapes.state_crop_rows(c["src_crops"]))


def _defects(c: Context):
    """Rates of the injected defects and that no clean key is lost."""
    clean = c["src_store_sales"].where("ss_net_paid IS NOT NULL AND ss_quantity > 0 AND ss_item_sk IS NOT NULL")
    dirty = inject_defects("store_sales", clean)
    keys = ["ss_ticket_number", "ss_item_sk"]
    lost = clean.join(dirty, keys, "left_anti").agg(F.count("*").alias("lost_keys"))
    sizes = clean.agg(F.count("*").alias("clean_rows"))
    d = dirty.agg(F.count("*").alias("n"), F.count_if(F.col("ss_net_paid").isNull()).alias("nulls"), F.count_if(F.col("ss_quantity") < 0).alias("negatives"))
    n, m = F.col("clean_rows"), F.col("n")
    return quality.side_by_side(sizes, lost, d).withColumns({
        "replays_near_rate": ((m - n) / n).between(0.008, 0.022), "nulls_near_rate": (F.col("nulls") / m).between(0.001, 0.009), "negatives_near_rate": (F.col("negatives") / m).between(0.0, 0.006)})


query("src_defect_injection", "clean_rows:i lost_keys:i replays_near_rate:b nulls_near_rate:b negatives_near_rate:b",
      "SELECT count(*) AS clean_rows, 0 AS lost_keys, true AS replays_near_rate, true AS nulls_near_rate, true AS negatives_near_rate FROM {src_store_sales} WHERE ss_net_paid IS NOT NULL AND ss_quantity > 0 AND ss_item_sk IS NOT NULL")(_defects)


def _damage(c: Context):
    """Per rule: rows of its feed, and whether the rows that it hits are near its rate."""
    parts = []
    for feed in sorted({r.feed for r in RULES}):
        clean = c[f"src_{feed}"]
        rules = [(r, start) for r, start in slices(feed) if r.column in clean.columns]
        counted = clean.agg(F.count("*").alias("n"), *(F.count_if(hit(clean.columns, r, start)).alias(f"h{k}") for k, (r, start) in enumerate(rules)))
        parts.append(counted.select(F.inline(F.array(*(F.struct(F.lit(r.feed).alias("feed"), F.lit(r.column).alias("column_name"), F.lit(r.kind).alias("kind"), F.col("n").alias("feed_rows"),
            (F.abs(F.col(f"h{k}") - F.col("n") * r.rate / 1e4) <= 4 * F.sqrt(F.col("n") * r.rate / 1e4) + 3).alias("near_rate")) for k, (r, _) in enumerate(rules))))))
    return reduce(DataFrame.unionByName, parts)


query("src_defect_rules", "feed:s column_name:s kind:s feed_rows:i near_rate:b", " UNION ALL ".join(
    f"SELECT '{r.feed}' AS feed, '{r.column}' AS column_name, '{r.kind}' AS kind, count(*) AS feed_rows, true AS near_rate FROM {{src_{r.feed}}}" for r in RULES))(_damage)


# --- landing ----------------------------------------------------------------------------------
def retail_flow(ctx: Context, extracts=None, dirty: bool = False, root: str | None = None) -> RetailFlow:
    """A retail flow of its own, over the 24 extracts."""
    name = f"sm_{uuid.uuid4().hex[:10]}"
    return RetailFlow(ctx.spark, root or scratch_path(ctx.spark, name), name, extracts or (lambda n: ctx[f"src_{n}"]), BATCH, dirty=dirty)


def built(ctx: Context) -> tuple[RetailFlow, list, list]:
    """The flow run once for this context and then once more: flow, outcomes, outcomes of the rerun by a new driver."""
    with ctx.lock:
        if not hasattr(ctx, "built_flow"):
            flow = retail_flow(ctx)
            first = flow.run()
            again = RetailFlow(ctx.spark, flow.manifest.root, flow.prefix, flow.extracts, BATCH)
            ctx.built_flow = flow, first, again.run()
    return ctx.built_flow


def landed(ctx: Context) -> str:
    """Bronze database of all 24 extracts, landed once per context."""
    with ctx.lock:
        if not hasattr(ctx, "landed_db"):
            flow = retail_flow(ctx)
            flow.land()
            ctx.landed_db = f"{flow.prefix}_bronze"
    return ctx.landed_db


def _landed_dirty(c: Context):
    """Rows of each extract landed with defects, and that its distinct keys are all there."""
    flow = retail_flow(c, dirty=True)
    flow.land()
    parts = []
    for n, keys in KEYS.items():
        source, held = c[f"src_{n}"], flow.manifest.read("bronze", n)
        counted = quality.side_by_side(source.agg(F.count("*").alias("feed_rows")), held.agg(F.count("*").alias("m"), F.count_distinct(F.struct(*keys)).alias("distinct_keys")))
        rate = REPLAYS.get(n, 0) / 1e4 * F.col("feed_rows")
        near = F.abs(F.col("m") - F.col("feed_rows") - rate) <= 4 * F.sqrt(rate) + (3 if n in REPLAYS else 0)
        parts.append(counted.select(F.lit(n).alias("table_name"), "feed_rows", "distinct_keys", near.alias("replays_near_rate")))
    return reduce(DataFrame.unionByName, parts)


# What tells the rows of an extract apart; a sold line without its item is known by its order alone.
KEYS = {
    "store_sales": ["ss_item_sk", "ss_ticket_number"], "catalog_sales": ["cs_item_sk", "cs_order_number"], "web_sales": ["ws_item_sk", "ws_order_number"],
    "store_returns": ["sr_item_sk", "sr_ticket_number"], "catalog_returns": ["cr_item_sk", "cr_order_number"], "web_returns": ["wr_item_sk", "wr_order_number"],
    "inventory": ["inv_item_sk", "inv_warehouse_sk", "inv_date_sk"],
    "customer": ["c_customer_sk"], "customer_address": ["ca_address_sk"], "customer_demographics": ["cd_demo_sk"], "household_demographics": ["hd_demo_sk"],
    "income_band": ["ib_income_band_sk"], "item": ["i_item_sk"], "store": ["s_store_sk"], "date_dim": ["d_date_sk"], "time_dim": ["t_time_sk"], "web_site": ["web_site_sk"],
    "web_page": ["wp_web_page_sk"], "call_center": ["cc_call_center_sk"], "catalog_page": ["cp_catalog_page_sk"], "warehouse": ["w_warehouse_sk"], "promotion": ["p_promo_sk"],
    "ship_mode": ["sm_ship_mode_sk"], "reason": ["r_reason_sk"],
}
query("bronze_land_dirty", "table_name:s feed_rows:i distinct_keys:i replays_near_rate:b", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS feed_rows, count(DISTINCT ({', '.join(k)})) AS distinct_keys, true AS replays_near_rate FROM {{src_{n}}}" for n, k in KEYS.items()))(_landed_dirty)


_LANDED = " UNION ALL ".join(f"SELECT '{n}' AS table_name, '{s}' AS _source_system, '{BATCH}' AS _batch_id, '{n}.parquet' AS _source_file, count(*) AS rows FROM {{src_{n}}}" for n, s in SYSTEMS.items())


def _bronze_land(c: Context):
    db = landed(c)
    parts = [c.spark.table(f"{db}.{n}").groupBy("_source_system", "_batch_id", "_source_file").agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(n)) for n in SYSTEMS]
    return reduce(DataFrame.unionByName, parts)


query("bronze_land", "table_name:s _source_system:s _batch_id:s _source_file:s rows:i", _LANDED)(_bronze_land)
query("src_catalog_scan", "c_customer_sk:i c_customer_id:s c_email_address:s", "SELECT c_customer_sk, c_customer_id, c_email_address FROM {src_customer}")(
    lambda c: readers.read_landed(c.spark, f"{landed(c)}.customer"))
query("dq_audit_trail", "_source_system:s _batch_id:s rows:i files:i", f"SELECT _source_system, _batch_id, sum(rows) AS rows, count(DISTINCT _source_file) AS files FROM ({_LANDED}) GROUP BY 1, 2")(
    lambda c: quality.audit_trail(*(c.spark.table(f"{landed(c)}.{n}") for n in SYSTEMS)))
_DEFECTS = " UNION ALL ".join([
    "SELECT 'customer' AS tbl, 'duplicate customer keys' AS defect, (SELECT count(*) FROM (SELECT c_customer_sk FROM {src_customer} GROUP BY 1 HAVING count(*) > 1)) AS n",
    "SELECT 'customer', 'missing email', count(*) FROM {src_customer} WHERE c_email_address IS NULL",
    "SELECT 'customer', 'untrimmed first name', count(*) FROM {src_customer} WHERE c_first_name <> trim(c_first_name)",
    "SELECT 'customer_address', 'country spelling variants', count(DISTINCT ca_country) FROM {src_customer_address}",
    "SELECT 'customer_address', 'lower-case state codes', count(*) FROM {src_customer_address} WHERE ca_state <> upper(ca_state)",
    "SELECT 'customer_address', 'missing zip', count(*) FROM {src_customer_address} WHERE ca_zip IS NULL",
    "SELECT 'item', 'missing price', count(*) FROM {src_item} WHERE i_current_price IS NULL",
    "SELECT 'store_sales', 'null net_paid', count(*) FROM {src_store_sales} WHERE ss_net_paid IS NULL",
    "SELECT 'store_sales', 'negative quantity', count(*) FROM {src_store_sales} WHERE ss_quantity < 0",
    "SELECT 'store_sales', 'duplicate (item,ticket)', count(*) FROM (SELECT 1 FROM {src_store_sales} GROUP BY ss_item_sk, ss_ticket_number HAVING count(*) > 1)",
])
query("dq_defect_report", "tbl:s defect:s n:i", _DEFECTS)(lambda c: facts.defect_report(lambda n: c[f"src_{n}"]))
VERTICAL_FEEDS = {  # table: (feed, comment)
    "card_transactions": ("src_cards", "Card payments"), "trial_registry": ("src_trials", "Clinical trials"), "adverse_events": ("src_adverse", "Adverse event reports"),
    "beneficiaries": ("customer", "Plan members"), "inpatient_claims": ("src_claims", "Inpatient claims"), "yellow_tripdata": ("src_taxi", "Taxi trips"),
    "orders": ("src_orders_sheet", "Retail orders"), "store_sales": ("src_store_sales", "Store sales"), "crop_statistics": ("src_crops", "Census crops"),
}


def _ingest_all(c: Context):
    db, out = fresh_db(c, "verticals"), None
    for table, (feed, comment) in VERTICAL_FEEDS.items():
        df = c[feed]
        if table == "orders":
            df = shapes.normalise_orders(df)
        elif table == "crop_statistics":
            df = shapes.state_crop_rows(df)
        rows = ingest(c.spark, df, db, table, comment)
        out = rows if out is None else out.unionByName(rows)
    return out


query("ingest_vertical", "table_name:s total_rows:i", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS total_rows FROM {{{'v_crop_rows' if n == 'crop_statistics' else f}}}" for n, (f, _) in VERTICAL_FEEDS.items()))(_ingest_all)

# --- sinks -----------------------------------------------------------------------------------
_MIX = "SELECT o_orderpriority, count(*) AS orders FROM {orders} GROUP BY 1"


def _mix(c: Context):
    return c["orders"].groupBy("o_orderpriority").agg(F.count("*").alias("orders"))


def _overwritten(c: Context):
    table = f"{fresh_db(c)}.mix"
    t.overwrite(_mix(c).where("orders < 0"), table)
    t.overwrite(_mix(c), table)
    return c.spark.table(table)


def _appended(c: Context):
    table = f"{fresh_db(c)}.mix"
    t.overwrite(_mix(c), table)
    t.append(_mix(c), table)
    return c.spark.table(table)


def _partitioned(c: Context):
    table = f"{fresh_db(c)}.sales"
    t.overwrite_partitioned(c["orders"].withColumn("order_year", F.year("o_orderdate")), table, "order_year")
    return c.spark.table(table)


def _ctas(c: Context):
    table = f"{fresh_db(c)}.mix"
    for _ in range(2):
        t.create_table_as(c.spark, table, _MIX, orders=c["orders"])
    return c.spark.table(table)


def _published(c: Context):
    """The second publish of a batch writes nothing; a new batch replaces the table."""
    table, mix = f"{fresh_db(c)}.mix", _mix(c)
    wrote = [t.publish(mix, table, "silver", b, comment="Order mix") for b in ("b1", "b1", "b2")]
    return c.spark.table(table).withColumns({f"wrote_{i}": F.lit(w) for i, w in enumerate(wrote)})


def _staged(c: Context):
    table = f"{fresh_db(c)}._stg_mix"
    first, again = t.stage(_mix(c), table, "b1"), t.stage(_mix(c).where("false"), table, "b1")
    rows = quality.side_by_side(first.agg(F.sum("orders").alias("first_total")), again.agg(F.sum("orders").alias("reused_total")))
    out = c.spark.createDataFrame([tuple(rows.head())], rows.schema)
    t.drop_stage(c.spark, table)
    return out.withColumn("stage_left", F.lit(c.spark.catalog.tableExists(table)))


def _ledger_twice(c: Context):
    """Writing a part of a batch again replaces it instead of doubling it."""
    table = f"{fresh_db(c)}.dq_metrics"
    one = quality.stamp_ledger(quality.measure(c["orders"], "orders", [("rows", "in", F.count("*"))]), BATCH)
    two = quality.stamp_ledger(quality.measure(c["lineitem"], "lineitem", [("rows", "in", F.count("*"))]), BATCH)
    for rows, part in ((one, "a"), (two, "b"), (two, "b")):
        t.write_ledger_part(rows, table, part)
    return c.spark.table(table)


query("sink_overwrite", "o_orderpriority:s orders:i", _MIX)(_overwritten)
query("sink_append", "o_orderpriority:s orders:i", f"{_MIX} UNION ALL {_MIX}")(_appended)
query("sink_partitioned", "o_orderkey:i o_totalprice:f order_year:i", "SELECT o_orderkey, o_totalprice, year(o_orderdate) AS order_year FROM {orders}")(_partitioned)
query("sink_ctas", "o_orderpriority:s orders:i", _MIX)(_ctas)
query("sink_idempotent_publish", "o_orderpriority:s orders:i _silver_batch_id:s wrote_0:b wrote_1:b wrote_2:b", f"SELECT *, 'b2' AS _silver_batch_id, true AS wrote_0, false AS wrote_1, true AS wrote_2 FROM ({_MIX})")(_published)
query("sink_stage", "first_total:i reused_total:i stage_left:b", "SELECT count(*) AS first_total, count(*) AS reused_total, false AS stage_left FROM {orders}")(_staged)
query("sink_ledger_part", "table_name:s rule:s scope:s metric_value:i batch_id:s part:s",
      f"SELECT 'orders' AS table_name, 'rows' AS rule, 'in' AS scope, count(*) AS metric_value, '{BATCH}' AS batch_id, 'a' AS part FROM {{orders}} UNION ALL SELECT 'lineitem', 'rows', 'in', count(*), '{BATCH}', 'b' FROM {{lineitem}}")(_ledger_twice)
query("sink_stamp", "n_nationkey:i n_name:s _gold_batch_id:s stamped:b", "SELECT n_nationkey, n_name, 'b7' AS _gold_batch_id, true AS stamped FROM {nation}")(
    lambda c: t.stamp(c["nation"], "gold", "b7").withColumn("stamped", F.col("_gold_ts").isNotNull()))
def _files(c: Context):
    """Orders written with a limit of rows per file; what the files then hold."""
    name = f"{fresh_db(c)}.orders_in_files"
    t.overwrite(c["orders"], name, rows_per_file=1_000)
    held = c.spark.table(name).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    return held.agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 1_000).alias("over_limit"), (F.count("*") >= F.ceil(F.sum("n") / 1_000)).alias("enough_files"))


query("sink_file_target", "total:i over_limit:i enough_files:b", "SELECT count(*) AS total, 0 AS over_limit, true AS enough_files FROM {orders}")(_files)


# Rows of every published table, for the expected side.
_SILVER_ROWS = {n: f"SELECT count(*) FROM {{{r}}}" for n, r in {
    **{n: f"r_{n}" for n in LAYERS["silver"] if n.startswith("dim_")}, "fct_sales": "r_sales", "fct_returns": "r_returns", "fct_inventory": "r_inventory",
    "dq_rejects_sales": "m_dq_rejects_sales", "dq_metrics": "m_dq_metrics"}.items()}
_ROWS = {"bronze": {n: f"SELECT count(*) FROM {{src_{n}}}" for n in SYSTEMS}, "silver": _SILVER_ROWS, "gold": {n: f"SELECT count(*) FROM {{m_{n}}}" for n in LAYERS["gold"]}}


def _per_table(layer: str, more: str = "") -> str:
    return " UNION ALL ".join(f"SELECT '{layer}' AS layer, '{n}' AS table_name, ({q}) AS rows{more}" for n, q in _ROWS[layer].items())


for _layer in LAYERS:  # the first run writes every table, the second one none
    query(f"flow_retail_{ {'bronze': 'land'}.get(_layer, _layer) }", "layer:s table_name:s rows:i status_0:s status_1:s", _per_table(_layer, ", 'WRITTEN' AS status_0, 'KEPT' AS status_1"))(
        lambda c, layer=_layer: outcomes(c.spark, *built(c)[1:]).where(F.col("layer") == layer))
# A figure of every mart, read from the catalog.
_FIGURE = {
    "dim_customer_rfm": "net_lifetime_value", "agg_customer_channel_mix": "channel_revenue", "agg_promotion_effectiveness": "promoted_revenue", "agg_returns_by_reason_month": "refund_amount",
    "agg_inventory_health_weekly": "week_revenue", "agg_category_affinity": "baskets_together"}


def _mart_totals(c: Context):
    flow = built(c)[0]
    return reduce(DataFrame.unionByName, [c.spark.table(f"{flow.prefix}_gold.{n}").groupBy("_gold_batch_id").agg(
        F.count("*").alias("rows"), F.sum(F.col(_FIGURE.get(n, "net_revenue")).cast("decimal(24,2)")).alias("total")).withColumn("table_name", F.lit(n)) for n in LAYERS["gold"]])


query("flow_retail_totals", "table_name:s _gold_batch_id:s rows:i total:f", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{BATCH}' AS _gold_batch_id, count(*) AS rows, CAST(sum(CAST({_FIGURE.get(n, 'net_revenue')} AS DECIMAL(24,2))) AS DOUBLE) AS total FROM {{m_{n}}} HAVING count(*) > 0" for n in LAYERS["gold"]))(_mart_totals)


def _resumed(c: Context):
    """An extract that cannot be read leaves the others committed and the layer unsealed; the next run writes only that one."""
    def broken(name: str) -> DataFrame:
        if name == "web_sales":
            raise OSError("the extract is not there")
        return c[f"src_{name}"]

    flow = retail_flow(c, broken)
    first, early = flow.land(), flow.manifest.sealed("bronze")
    second = RetailFlow(c.spark, flow.manifest.root, flow.prefix, lambda n: c[f"src_{n}"], BATCH).land()
    return outcomes(c.spark, first, second).withColumns({"sealed_0": F.lit(early == BATCH), "sealed_1": F.lit(flow.manifest.sealed("bronze") == BATCH)})


query("flow_retail_resume", "table_name:s rows:i status_0:s status_1:s sealed_0:b sealed_1:b", f"""SELECT *, CASE table_name WHEN 'web_sales' THEN 'FAILED' ELSE 'WRITTEN' END AS status_0,
  CASE table_name WHEN 'web_sales' THEN 'WRITTEN' ELSE 'KEPT' END AS status_1, false AS sealed_0, true AS sealed_1 FROM ({_per_table('bronze')})""")(_resumed)


def _described(c: Context, layer: str):
    """Tables of a layer with their rows, and their comments as the catalog has them."""
    flow = built(c)[0]
    db = f"{flow.prefix}_{layer}"
    return reduce(DataFrame.unionByName, [c.spark.table(f"{db}.{x.name}").agg(F.count("*").alias("rows")).withColumns({
        "table_name": F.lit(x.name), "comment": F.lit(x.description)}) for x in c.spark.catalog.listTables(db)])


def _comment_sql(n: str) -> str:
    return "'" + COMMENTS[n].replace("'", "''") + "'" if n in COMMENTS else "NULL"


def _if_absent(c: Context):
    """Creating a table again leaves its rows alone."""
    name = f"{fresh_db(c)}.nations"
    for _ in range(2):
        t.create_if_absent(c.spark, name, "n_nationkey INT, n_name STRING")
        t.append(c["nation"].select(F.col("n_nationkey").cast("int"), "n_name"), name)
    return c.spark.table(name)


def _databases(c: Context):
    """A database created again keeps its tables; what it holds, by layer."""
    flow = built(c)[0]
    for layer in LAYERS:
        t.create_database(c.spark, f"{flow.prefix}_{layer}", "again")
    return flow.census().withColumns({"layer": F.replace("layer", F.lit(f"{flow.prefix}_"), F.lit("")), "described": F.lit(all(
        c.spark.catalog.getDatabase(f"{flow.prefix}_{x}").description == f"Tables of the {x} layer" for x in LAYERS))})


_CENSUS = " UNION ALL ".join(f"SELECT layer, count(*) AS tables, sum(rows) AS rows FROM ({_per_table(x)}) GROUP BY 1" for x in LAYERS)
query("ddl_table_if_absent", "n_nationkey:i n_name:s", "SELECT n_nationkey, n_name FROM {nation} UNION ALL SELECT n_nationkey, n_name FROM {nation}")(_if_absent)
query("ddl_comment", "table_name:s comment:s rows:i", " UNION ALL ".join(f"SELECT '{n}' AS table_name, {_comment_sql(n)} AS comment, ({q}) AS rows FROM (SELECT 1)" for n, q in _ROWS["silver"].items()))(
    lambda c: _described(c, "silver"))
query("ddl_database", "layer:s tables:i rows:i described:b", f"SELECT *, true AS described FROM ({_CENSUS})")(_databases)
_KIND = "CASE WHEN {t} IN ('string', 'VARCHAR') THEN 'text' WHEN {t} IN ('date', 'DATE') THEN 'date' WHEN {t} IN ('timestamp', 'TIMESTAMP') THEN 'time' ELSE 'number' END"
query("cat_inspect", "table_name:s position:i column_name:s kind:s", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, row_number() OVER () - 1 AS position, column_name, {_KIND.format(t='column_type')} AS kind FROM (DESCRIBE SELECT * FROM {{src_{n}}})" for n in SYSTEMS))(
    lambda c: t.describe(c.spark, landed(c)).where(~F.startswith("column_name", F.lit("_"))).withColumn("kind", F.expr(_KIND.format(t="data_type"))))
query("job_table_summary", "table_name:s total:i place:i c_customer_sk:i", """SELECT 'customer' AS table_name, (SELECT count(*) FROM {src_customer}) AS total, row_number() OVER (ORDER BY c_customer_sk) AS place, c_customer_sk
  FROM (SELECT c_customer_sk FROM {src_customer} ORDER BY 1 LIMIT 10)""")(lambda c: flows.table_summary(c.spark, f"{landed(c)}.customer", "c_customer_sk"))
query("job_table_summary_sql", "customer_id:i rfm_score:i segment:s", "SELECT customer_id, rfm_score, segment FROM {v_segments} ORDER BY rfm_score DESC, customer_id LIMIT 10")(
    lambda c: c.spark.sql("SELECT * FROM {seg} ORDER BY rfm_score DESC, customer_id LIMIT 10", seg=_segments(c)))


def _segments(c: Context):
    from stratamart.registry.verticals import segments
    return segments(c)


query("dq_census", "layer:s tables:i rows:i", f"{_CENSUS} UNION ALL SELECT 'absent', 0, 0")(
    lambda c: (lambda flow: flow.census("absent").withColumn("layer", F.replace("layer", F.lit(f"{flow.prefix}_"), F.lit(""))))(built(c)[0]))
query("dq_lineage_check", "layer:s tables:i rows:i unstamped:i batches:s", f"SELECT *, 0 AS unstamped, '{BATCH}' AS batches FROM ({_CENSUS})")(lambda c: built(c)[0].lineage())


# --- flows -----------------------------------------------------------------------------------
def _flow(c: Context, run: bank.Run):
    name = f"sm_{uuid.uuid4().hex[:10]}"
    flow = flows.BankFlow(c.spark, name, scratch_path(c.spark, name))
    return flow, flow.run(c["src_accounts"], c["src_txns"], run)


def _clean_flow(c: Context):
    """The strict flow over the rows of both feeds that keep the contract, currencies trimmed at the source."""
    accounts = latest_per_key(c["src_accounts"].where("account_id IS NOT NULL"), ["account_id"])
    kept = latest_per_key(c["src_txns"].where("txn_id IS NOT NULL"), ["txn_id"]).withColumn("currency", code("currency")).where(
        (F.col("amount") > 0) & F.col("currency").isin(bank.CURRENCIES) & F.col("txn_ts").try_cast("timestamp").isNotNull())
    name = f"sm_{uuid.uuid4().hex[:10]}"
    flow = flows.BankFlow(c.spark, name, scratch_path(c.spark, name), strict=True)
    return flow.run(accounts, kept.join(accounts.select("account_id"), "account_id", "left_semi").select(*c["src_txns"].columns), RUN)


def _two_batches(c: Context):
    """A batch that passes, then one that does not, into the same databases: the audit of the second one."""
    flow, _ = _flow(c, bank.Run("2024-01-19", threshold=0.5))
    return flow.run(c["src_accounts"], c["src_txns"], RUN)


_AUDIT = "batch_id:s run_date:s stage:s table_name:s row_count:i status:s"


def _audit(*rows: tuple[str, str, str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{BATCH}' AS batch_id, '{RUN.date}' AS run_date, '{s}' AS stage, '{n}' AS table_name, ({q}) AS row_count, '{st}' AS status" for s, n, q, st in rows)


def _n(rel: str) -> str:
    return f"SELECT count(*) FROM {{{rel}}}"


_RAW = [("bronze", "bronze.raw_accounts", _n("src_accounts"), "PRESENT"), ("bronze", "bronze.raw_transactions", _n("src_txns"), "PRESENT")]
_DIRTY = _audit(
    *_RAW, ("bronze", "bronze.quarantine_records", _n("b_quarantine"), "PRESENT"), *((s, f"{s}.{n}", "0", "ABSENT") for s, n in (
        ("silver", "dim_account"), ("silver", "txn_clean"), ("silver", "txn_rejects"), ("gold", "account_balance_daily"), ("gold", "fraud_signal_summary"))),
    ("bronze", "GATE:bronze_quality", "9", "FAIL"), ("silver", "GATE:silver_quality", "0", "NOT_RUN"))
_PASSING = _audit(
    *_RAW, ("bronze", "bronze.quarantine_records", "0", "ABSENT"), ("silver", "silver.dim_account", _n("b_dim"), "PRESENT"), ("silver", "silver.txn_clean", _n("b_clean"), "PRESENT"),
    ("silver", "silver.txn_rejects", _n("b_rejects_all"), "PRESENT"), ("gold", "gold.account_balance_daily", _n("b_balance"), "PRESENT"), ("gold", "gold.fraud_signal_summary", _n("b_summary"), "PRESENT"),
    ("bronze", "GATE:bronze_quality", "9", "PASS"), ("silver", "GATE:silver_quality", "10", "FAIL"))
query("flow_medallion_bank", _AUDIT, _DIRTY)(lambda c: _flow(c, RUN)[1])
query("flow_medallion_bank_pass", _AUDIT, _PASSING)(lambda c: _flow(c, bank.Run(RUN.date, threshold=0.5))[1])
_DATED = "{b_clean} WHERE txn_date IS NOT NULL"
_CLEAN = _audit(
    ("bronze", "bronze.raw_accounts", _n("b_dim"), "PRESENT"), ("bronze", "bronze.raw_transactions", f"SELECT count(*) FROM {_DATED}", "PRESENT"),
    ("bronze", "bronze.quarantine_records", "0", "ABSENT"), ("silver", "silver.dim_account", _n("b_dim"), "PRESENT"),
    ("silver", "silver.txn_clean", f"SELECT count(*) FROM {_DATED}", "PRESENT"), ("silver", "silver.txn_rejects", "0", "PRESENT"),
    ("gold", "gold.account_balance_daily", f"SELECT count(DISTINCT (account_id, txn_date)) FROM {_DATED}", "PRESENT"),
    ("gold", "gold.fraud_signal_summary", f"SELECT count(DISTINCT account_id) FROM {_DATED}", "PRESENT"),
    ("bronze", "GATE:bronze_quality", "9", "PASS"), ("silver", "GATE:silver_quality", "11", "PASS"))
query("flow_medallion_bank_clean", _AUDIT, _CLEAN)(_clean_flow)
query("flow_medallion_bank_two_batches", _AUDIT, _DIRTY)(_two_batches)
query("dq_manifest_audit", "run_status:s", "SELECT 'DEGRADED' AS run_status FROM {region} WHERE r_regionkey = 0")(lambda c: flows.run_status(_flow(c, RUN)[1]))


def _profiled(c: Context):
    flow = flows.BankFlow(c.spark, f"sm_{uuid.uuid4().hex[:10]}", scratch_path(c.spark, "flow"))
    flow.setup()
    flow.ingest(c["src_accounts"], c["src_txns"], RUN)
    flow.profile_each([("bronze", "raw_transactions")], RUN)
    return flow.read("gold", "table_stats").withColumn("table_name", F.element_at(F.split("table_name", r"\."), -1))


query("flow_profile_each", "table_name:s column_name:s data_type:s table_row_count:i null_count:i null_pct:f distinct_count:i", _PROFILE)(_profiled)


def _profiled_layers(c: Context):
    """Profiles of all tables that a run of the flow leaves; it profiles the marts itself."""
    flow, _ = _flow(c, bank.Run(RUN.date, threshold=0.5))
    flow.profile_each([(layer, name) for layer, name, *_ in PROFILES if layer != "gold"], RUN)
    return flow.read("gold", "table_stats").withColumn("table_name", F.element_at(F.split("table_name", r"\."), -1))


query("flow_profile_layers", "table_name:s column_name:s data_type:s table_row_count:i null_count:i null_pct:f distinct_count:i",
      " UNION ALL ".join(profile_sql(name, rel, types) for _, name, rel, types in PROFILES))(_profiled_layers)


def _by_day(c: Context):
    return c["events"].select("event_id", "value", F.to_date("ts").alias("event_date"))


def _stale(c: Context, table: str) -> None:
    t.overwrite_partitioned(_by_day(c).withColumn("value", F.when(F.dayofmonth("event_date") % 5 == 0, 0.0).otherwise(F.col("value"))), table, "event_date")


def _replay(c: Context):
    """A table with stale days, replayed: its name and the outcome of each day."""
    table = f"{fresh_db(c)}.events"
    _stale(c, table)

    def read_day(day):
        start = F.lit(str(day)).cast("timestamp")
        return c["events"].where((F.col("ts") >= start) & (F.col("ts") < start + F.expr("INTERVAL 1 DAY"))).select(
            "event_id", "value", F.to_date("ts").alias("event_date"))

    return table, flows.replay_days(_by_day(c), read_day, table, "event_date", f"{table}_day")


def _replayed(c: Context):
    return c.spark.table(_replay(c)[0])


def _loaded(c: Context):
    table = f"{fresh_db(c)}.events"
    _stale(c, table)
    flows.load(_by_day(c).where(F.dayofmonth("event_date") % 5 == 0), table, "event_date", "INCREMENTAL")
    incremental = c.spark.table(table).withColumn("strategy", F.lit("INCREMENTAL"))
    full = f"{fresh_db(c)}.events"
    flows.load(_by_day(c), full, "event_date", "FULL_REFRESH")
    return incremental.unionByName(c.spark.table(full).withColumn("strategy", F.lit("FULL_REFRESH")))


_EVENTS = "SELECT event_id, value, CAST(ts AS DATE) AS event_date FROM {events}"
query("replay_slice", "event_id:i value:f event_date:d", _EVENTS)(_replayed)
query("replay_slice_days", "day:d rows:i status:s", f"""SELECT event_date AS day, count(*) AS rows, 'MERGED' AS status FROM ({_EVENTS})
  WHERE day(event_date) % 5 = 0 GROUP BY 1 HAVING count(*) FILTER (value IS DISTINCT FROM 0) > 0""")(lambda c: _replay(c)[1])
query("load_strategy", "strategy:s event_id:i value:f event_date:d", f"SELECT *, 'INCREMENTAL' AS strategy FROM ({_EVENTS}) UNION ALL SELECT *, 'FULL_REFRESH' FROM ({_EVENTS})")(_loaded)

# --- scoring -----------------------------------------------------------------------------------
_REQUEST = """SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 29 > 0 THEN o_totalprice / 10 END AS claim_amount, CASE WHEN o_orderkey % 31 > 0 THEN CAST(o_custkey % 240 AS DOUBLE) END AS policy_tenure_months,
  CAST(o_orderkey % 12 AS DOUBLE) AS num_prior_claims, CAST(150 + o_custkey % 900 AS DOUBLE) AS premium_amount, CASE WHEN o_orderkey % 58 > 0 THEN CAST(o_orderkey % 60 AS DOUBLE) END AS claim_to_premium_ratio,
  CAST(o_orderkey % 120 AS DOUBLE) AS days_to_report FROM {orders}"""
relation("s_requests", _REQUEST)


def requests(c: Context):
    return c.spark.sql(_REQUEST, orders=c["orders"])


query("score_validate", "request_id:i rejection:s", """SELECT request_id, CASE WHEN claim_amount IS NULL OR policy_tenure_months IS NULL OR claim_to_premium_ratio IS NULL THEN 'Missing required feature(s): ' ||
  concat_ws(', ', CASE WHEN claim_amount IS NULL THEN 'claim_amount' END, CASE WHEN policy_tenure_months IS NULL THEN 'policy_tenure_months' END, CASE WHEN claim_to_premium_ratio IS NULL THEN 'claim_to_premium_ratio' END) END AS rejection FROM {s_requests}""")(
    lambda c: scoring.with_rejection(requests(c), scoring.CLAIM_FEATURES))


def _claim_model(c: Context):
    if not hasattr(c, "claim_model"):
        c.claim_model = scoring.train_claim_model(scoring.synthetic_claims(c["orders"].select("o_orderkey"), "o_orderkey"))
    return c.claim_model


def _trained(c: Context):
    claims = scoring.synthetic_claims(c["orders"].select("o_orderkey"), "o_orderkey")
    scored = scoring.score_claims(_claim_model(c), claims)
    fraud = F.col("is_fraud") == 1
    p = F.col("fraud_probability")
    return scored.agg(F.count("*").alias("claims"), F.coalesce(F.min(p.between(0, 1)), F.lit(True)).alias("all_in_range"), (F.avg(F.when(fraud, p)) > F.avg(F.when(~fraud, p))).alias("separates"))


query("train_claim_model", "claims:i all_in_range:b separates:b", "SELECT count(*) AS claims, true AS all_in_range, true AS separates FROM {orders}")(_trained)
query("score_claim_fraud", "request_id:i rejected:b labelled_right:b", """SELECT request_id, claim_amount IS NULL OR policy_tenure_months IS NULL OR claim_to_premium_ratio IS NULL AS rejected,
  CASE WHEN claim_amount IS NOT NULL AND policy_tenure_months IS NOT NULL AND claim_to_premium_ratio IS NOT NULL THEN true END AS labelled_right FROM {s_requests}""")(
    lambda c: scoring.score_claims(_claim_model(c), requests(c)).withColumns({
        "rejected": F.col("rejection").isNotNull(),
        "labelled_right": F.col("fraud_probability").between(0, 1) & ((F.col("fraud_probability") >= 0.5) == (F.col("risk_label") == "fraud"))}))


def _flowers(c: Context):
    """Parts in the role of flowers: four measures that tell three brands' groups apart."""
    group = F.col("p_partkey") % 3
    return c["part"].select(
        "p_partkey", F.element_at(F.array(F.lit("setosa"), F.lit("versicolor"), F.lit("virginica")), (group + 1).cast("int")).alias("species"),
        (4 + group + F.col("p_size") / 100).alias("sepal_length"), (F.lit(3.0) - group * 0.2 + F.col("p_size") / 200).alias("sepal_width"),
        (1 + group * 2 + F.col("p_size") / 60).alias("petal_length"), (F.lit(0.2) + group * 0.8).alias("petal_width"))


def _classified(c: Context):
    data = _flowers(c)
    if not hasattr(c, "flower_model"):
        c.flower_model = scoring.train_classifier(data, scoring.FLOWER_FEATURES, "species")
    return scoring.classify(c.flower_model, data, scoring.FLOWER_FEATURES)


query("train_classifier", "species:s parts:i accurate:b", "SELECT CASE p_partkey % 3 WHEN 0 THEN 'setosa' WHEN 1 THEN 'versicolor' ELSE 'virginica' END AS species, count(*) AS parts, true AS accurate FROM {part} GROUP BY 1")(
    lambda c: _classified(c).groupBy("species").agg(F.count("*").alias("parts"), (F.avg((F.col("species") == F.col("predicted_class")).cast("int")) > 0.95).alias("accurate")))
query("score_classify", "p_partkey:i classes:i sums_to_one:b known:b", "SELECT p_partkey, 3 AS classes, true AS sums_to_one, true AS known FROM {part}")(
    lambda c: _classified(c).select("p_partkey", F.size("probabilities").alias("classes"),
        (F.abs(F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda a, x: a + x) - 1) < 1e-5).alias("sums_to_one"), F.map_contains_key("probabilities", F.col("predicted_class")).alias("known")))
_WORDS = {"the": (0.2, 0.1), "that": (-0.3, 0.25), "and": (0.05, 0.0), "there": (0.6, 0.5), "la": (-0.25, 0.3), "les": (0.4, 0.9), "then": (-0.8, 1.0), "her": (0.125, 0.4)}
_LEX = ", ".join(f"('{w}', {int(p * 1000)}, {int(s * 1000)})" for w, (p, s) in _WORDS.items())
query("score_sentiment", "doc_id:i polarity:f subjectivity:f sentiment:s", f"""
  SELECT *, CASE WHEN polarity > 0.1 THEN 'positive' WHEN polarity < -0.1 THEN 'negative' ELSE 'neutral' END AS sentiment FROM (
  SELECT doc_id, coalesce(CAST(round(CAST(CAST(sum(p) / 1000.0::DOUBLE / count(p) AS VARCHAR) AS DECIMAL(38,20)), 6) AS DOUBLE), 0) AS polarity,
    coalesce(CAST(round(CAST(CAST(sum(s) / 1000.0::DOUBLE / count(p) AS VARCHAR) AS DECIMAL(38,20)), 6) AS DOUBLE), 0) AS subjectivity
  FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM {{documents}}) LEFT JOIN (VALUES {_LEX}) x(word, p, s) ON w = word GROUP BY 1)""")(
    lambda c: scoring.score_sentiment(c["documents"].select("doc_id", "text"), lexicon=_WORDS))
