"""Single operators over the supplied tables: projections, predicates, joins, aggregates, windows, sets, functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.functions import code, exact_sum, in_key_slice, line_key, parse_date, parse_number, parse_timestamp, pct
from stratamart.operators import keyed
from stratamart.operators.baskets import basket_signatures, pair_counts
from stratamart.operators.ranking import ntile_scores, rank_within
from stratamart.operators.sequence import events_in_trailing_window, previous_value
from stratamart.registry.core import Context, latest_, pct_, pctn_, query, rnd

D = "CAST({} AS DECIMAL(18,2))"


def money(c: str):
    return F.col(c).cast("decimal(18,2)")


# --- projections and predicates --------------------------------------------------------------
query("proj_rename_cast", "order_id:i customer_id:i total:f ordered_on:d", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, " + D.format("o_totalprice") + " AS total, o_orderdate AS ordered_on FROM {orders}")(
    lambda c: c["orders"].select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").cast("int").alias("customer_id"), money("o_totalprice").alias("total"), F.col("o_orderdate").cast("date").alias("ordered_on")))
query("proj_rename", "supplier_id:i supplier_name:s balance:f", "SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_acctbal AS balance FROM {supplier}")(
    lambda c: c["supplier"].withColumnsRenamed({"s_suppkey": "supplier_id", "s_name": "supplier_name", "s_acctbal": "balance"}).drop("s_nationkey"))
query("proj_derive", "l_orderkey:i l_linenumber:i net:f taxed:f", "SELECT l_orderkey, l_linenumber, net, net * (1 + CAST(l_tax AS DECIMAL(4,2))) AS taxed FROM (SELECT *, "
      "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS net FROM {lineitem})")(
    lambda c: c["lineitem"].withColumn("net", F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)")))
    .withColumn("taxed", F.col("net") * (1 + F.col("l_tax").cast("decimal(4,2)"))))
_PARTY = [("party_id", "bigint"), ("party_name", "string"), ("balance", "decimal(18,2)"), ("segment", "string")]
query("proj_conform", "party_id:i party_name:s balance:f segment:s kind:s", "SELECT c_custkey AS party_id, c_name AS party_name, " + D.format("c_acctbal") + " AS balance, c_mktsegment AS segment, 'customer' AS kind FROM {customer} "
      "UNION ALL SELECT s_suppkey, s_name, " + D.format("s_acctbal") + ", NULL, 'supplier' FROM {supplier}")(
    lambda c: keyed.conform(c["customer"], _PARTY, {"party_id": "c_custkey", "party_name": "c_name", "balance": "c_acctbal", "segment": "c_mktsegment"}, kind="customer")
    .unionByName(keyed.conform(c["supplier"], _PARTY, {"party_id": "s_suppkey", "party_name": "s_name", "balance": "s_acctbal"}, kind="supplier")))
query("proj_drop_internal", "r_regionkey:i r_name:s", "SELECT r_regionkey, r_name FROM {region}")(
    lambda c: (lambda df: df.select(*keyed.business_columns(df)))(c["region"].withColumns({"_batch_id": F.lit("b"), "_note": F.lit(1)})))
query("pred_null", "ca_address_sk:i missing:b", "SELECT ca_address_sk, ca_country IS NULL AS missing FROM {src_customer_address} WHERE ca_zip IS NULL OR ca_country IS NULL")(
    lambda c: c["src_customer_address"].where(F.col("ca_zip").isNull() | F.col("ca_country").isNull()).withColumn("missing", F.col("ca_country").isNull()))
query("pred_compare", "l_orderkey:i l_linenumber:i", "SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_quantity > 45 AND l_discount <= 0.05 AND l_returnflag <> 'N'")(
    lambda c: c["lineitem"].where("l_quantity > 45 AND l_discount <= 0.05D AND l_returnflag <> 'N'"))
query("pred_in", "o_orderpriority:s orders:i", "SELECT o_orderpriority, count(*) AS orders FROM {orders} WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1")(
    lambda c: c["orders"].where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).groupBy("o_orderpriority").agg(F.count("*").alias("orders")))
query("pred_not_in", "currency:s txns:i", "SELECT currency, count(*) AS txns FROM {src_txns} WHERE currency NOT IN ('INR', 'usd') GROUP BY 1")(
    lambda c: c["src_txns"].where(~F.col("currency").isin("INR", "usd")).groupBy("currency").agg(F.count("*").alias("txns")))
query("pred_between", "p_size:i parts:i", "SELECT p_size, count(*) AS parts FROM {part} WHERE p_size >= 10 AND p_size <= 20 GROUP BY 1")(
    lambda c: c["part"].where(F.col("p_size").between(10, 20)).groupBy("p_size").agg(F.count("*").alias("parts")))
query("pred_prefix", "p_partkey:i p_name:s", "SELECT p_partkey, p_name FROM {part} WHERE substr(p_name, 1, 3) = 'red'")(lambda c: c["part"].where(F.col("p_name").startswith("red")))
query("pred_like", "invoice_no:s", "SELECT DISTINCT Invoice AS invoice_no FROM {src_orders_sheet} WHERE Invoice NOT LIKE 'C%'")(
    lambda c: c["src_orders_sheet"].where("`Invoice` NOT LIKE 'C%'").select(F.col("Invoice").alias("invoice_no")).distinct())
query("pred_regex", "VALUE:s n:i", "SELECT VALUE, count(*) AS n FROM {src_crops} WHERE regexp_matches(VALUE, '^[0-9.]+$') GROUP BY 1")(
    lambda c: c["src_crops"].where(F.col("VALUE").rlike(r"^[0-9.]+$")).groupBy("VALUE").agg(F.count("*").alias("n")))
query("pred_contains", "c_customer_sk:i c_email_address:s", "SELECT DISTINCT c_customer_sk, c_email_address FROM {src_customer} WHERE c_email_address IS NOT NULL AND position('@' IN c_email_address) = 0")(
    lambda c: c["src_customer"].where(~F.col("c_email_address").contains("@")).select("c_customer_sk", "c_email_address").distinct())
query("pred_having", "l_orderkey:i l_linenumber:i copies:i", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM {lineitem} GROUP BY 1, 2 HAVING count(*) > 1")(
    lambda c: c["lineitem"].groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies")).where("copies > 1"))
query("pred_scalar_subquery", "o_orderkey:i days_before_last:i", "SELECT o_orderkey, date_diff('day', o_orderdate, (SELECT max(o_orderdate) FROM {orders})) AS days_before_last FROM {orders} WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.5 FROM {orders})")(
    lambda c: c["orders"].where(F.col("o_totalprice") > c["orders"].agg(F.avg("o_totalprice") * 1.5).scalar())
    .withColumn("days_before_last", F.datediff(c["orders"].agg(F.max("o_orderdate")).scalar(), "o_orderdate")))
query("slice_hash", "split_keys:i rows_at_100:i sane_share:b", "SELECT 0 AS split_keys, (SELECT count(*) FROM {lineitem}) AS rows_at_100, true AS sane_share")(
    lambda c: _slice_facts(c["lineitem"], ["l_orderkey", "l_linenumber"]))


def _slice_facts(df: DataFrame, keys: list[str]) -> DataFrame:
    """A key is kept whole or not at all; at 20 percent about a fifth of the keys stays."""
    marked = df.withColumns({"kept": in_key_slice(keys, 20).cast("int"), "whole": in_key_slice(keys, 100).cast("int")})
    per_key = marked.groupBy(*keys).agg(F.min("kept").alias("lo"), F.max("kept").alias("hi"), F.sum("whole").alias("w"))
    return per_key.agg(F.count_if(F.col("lo") != F.col("hi")).alias("split_keys"), F.sum("w").alias("rows_at_100"), F.avg("hi").between(0.15, 0.25).alias("sane_share"))


# --- joins -------------------------------------------------------------------------------------
query("join_left_dim", "c_custkey:i c_name:s nation:s", "SELECT c_custkey, c_name, n_name AS nation FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey AND n_regionkey < 3")(
    lambda c: c["customer"].join(c["nation"].where("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation")), "c_nationkey", "left"))
query("join_broadcast", "r_name:s suppliers:i", "SELECT r_name, count(*) AS suppliers FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey GROUP BY 1")(
    # nation and region are read from files: Spark broadcasts them because their measured size is below the threshold
    lambda c: c["supplier"].join(c["nation"], F.col("s_nationkey") == F.col("n_nationkey")).join(c["region"], F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.count("*").alias("suppliers")))
query("join_snowflake", "c_customer_sk:i cd_gender:s hd_buy_potential:s ib_upper_bound:i", "SELECT DISTINCT c_customer_sk, cd_gender, hd_buy_potential, ib_upper_bound FROM {src_customer} LEFT JOIN {src_customer_demographics} ON c_current_cdemo_sk = cd_demo_sk "
      "LEFT JOIN {src_household_demographics} ON c_current_hdemo_sk = hd_demo_sk LEFT JOIN {src_income_band} ON hd_income_band_sk = ib_income_band_sk")(
    lambda c: c["src_customer"].join(c["src_customer_demographics"], F.col("c_current_cdemo_sk") == F.col("cd_demo_sk"), "left")
    .join(c["src_household_demographics"], F.col("c_current_hdemo_sk") == F.col("hd_demo_sk"), "left").join(c["src_income_band"], F.col("hd_income_band_sk") == F.col("ib_income_band_sk"), "left")
    .select("c_customer_sk", "cd_gender", "hd_buy_potential", "ib_upper_bound").distinct())
query("join_inner", "event_id:i c_name:s", "SELECT event_id, c_name FROM {events} JOIN {customer} ON user_id = c_custkey WHERE event_type = 'purchase'")(
    lambda c: c["events"].where("event_type = 'purchase'").join(c["customer"], F.col("user_id") == F.col("c_custkey")))
query("join_semi", "c_custkey:i", "SELECT c_custkey FROM {customer} WHERE EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")(
    lambda c: c["customer"].join(c["orders"].where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi"))
query("join_anti", "txn_id:s account_id:s", "SELECT txn_id, account_id FROM {src_txns} t WHERE NOT EXISTS (SELECT 1 FROM {src_accounts} a WHERE a.account_id = t.account_id)")(
    lambda c: c["src_txns"].join(c["src_accounts"], "account_id", "left_anti"))
query("join_multi_key", "l_partkey:i l_suppkey:i lines:i stock:i", "SELECT l_partkey, l_suppkey, lines, stock FROM (SELECT l_partkey, l_suppkey, count(*) AS lines FROM {lineitem} GROUP BY 1, 2) l "
      "LEFT JOIN (SELECT inv_item_sk, inv_warehouse_sk, sum(inv_quantity_on_hand) AS stock FROM {src_inventory} WHERE inv_date_sk IS NOT NULL GROUP BY 1, 2) ON l_partkey = inv_item_sk AND l_suppkey = inv_warehouse_sk")(
    lambda c: c["lineitem"].groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("lines")).join(
        c["src_inventory"].where("inv_date_sk IS NOT NULL").groupBy(F.col("inv_item_sk").alias("l_partkey"), F.col("inv_warehouse_sk").alias("l_suppkey")).agg(F.sum("inv_quantity_on_hand").alias("stock")), ["l_partkey", "l_suppkey"], "left"))
query("join_self_theta", "type_a:s type_b:s orders:i", "WITH b AS (SELECT DISTINCT l_orderkey, p_type FROM {lineitem} JOIN {part} ON l_partkey = p_partkey) "
      "SELECT x.p_type AS type_a, y.p_type AS type_b, count(*) AS orders FROM b x JOIN b y ON x.l_orderkey = y.l_orderkey AND x.p_type < y.p_type GROUP BY 1, 2")(
    lambda c: pair_counts(basket_signatures(c["lineitem"].join(c["part"], F.col("l_partkey") == F.col("p_partkey")).withColumn("all", F.lit(1)), ["all", "l_orderkey"], "p_type"), "all", "type_a", "type_b", "orders"))
query("join_agg_to_agg", "c_custkey:i orders:i spent:f events:i", "SELECT c_custkey, orders, spent, coalesce(n, 0) AS events FROM (SELECT o_custkey AS c_custkey, count(*) AS orders, sum(" + D.format("o_totalprice") + ") AS spent FROM {orders} GROUP BY 1) "
      "LEFT JOIN (SELECT user_id, count(*) AS n FROM {events} GROUP BY 1) ON c_custkey = user_id")(
    lambda c: c["orders"].groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), exact_sum("o_totalprice").alias("spent"))
    .join(c["events"].groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("events")), "c_custkey", "left").na.fill(0, ["events"]))
query("join_map_lookup", "o_orderkey:i weight:i", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 1 END AS weight FROM {orders}")(
    lambda c: c["orders"].withColumn("weight", F.try_element_at(F.create_map(F.lit("F"), F.lit(3), F.lit("O"), F.lit(1)), F.col("o_orderstatus"))))

# --- aggregates ---------------------------------------------------------------------------------
query("agg_group_basic", "l_returnflag:s l_linestatus:s n:i qty:f avg_qty:f lo:f hi:f", "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, avg(l_quantity) AS avg_qty, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM {lineitem} GROUP BY 1, 2")(
    lambda c: c["lineitem"].groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.avg("l_quantity").alias("avg_qty"), F.min("l_extendedprice").alias("lo"), F.max("l_extendedprice").alias("hi")))
query("agg_global", "last_order:d last_ship:d", "SELECT (SELECT max(o_orderdate) FROM {orders}) AS last_order, (SELECT max(l_shipdate) FROM {lineitem}) AS last_ship")(
    lambda c: c["orders"].agg(F.max("o_orderdate").alias("last_order")).withColumn("last_ship", c["lineitem"].agg(F.max("l_shipdate")).scalar()))
query("agg_conditional", "o_orderpriority:s open_orders:i closed_value:f", "SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'O') AS open_orders, sum(CASE WHEN o_orderstatus = 'F' THEN " + D.format("o_totalprice") + " ELSE 0 END) AS closed_value FROM {orders} GROUP BY 1")(
    lambda c: c["orders"].groupBy("o_orderpriority").agg(F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"), exact_sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0)).alias("closed_value")))
query("agg_bool_sum", "user_id:i large:i errors:i", "SELECT user_id, count(*) FILTER (value > 100) AS large, count(*) FILTER (event_type = 'error') AS errors FROM {events} GROUP BY 1")(
    lambda c: c["events"].groupBy("user_id").agg(F.sum((F.col("value") > 100).cast("int")).alias("large"), F.sum((F.col("event_type") == "error").cast("int")).alias("errors")))
query("agg_distinct", "l_returnflag:s parts:i suppliers:i", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM {lineitem} GROUP BY 1")(
    lambda c: c["lineitem"].groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers")))
query("agg_distinct_composite", "l_returnflag:s order_lines:i", "SELECT l_returnflag, count(DISTINCT l_orderkey || '|' || l_linenumber) AS order_lines FROM {lineitem} GROUP BY 1")(
    lambda c: c["lineitem"].groupBy("l_returnflag").agg(F.count_distinct(F.struct("l_orderkey", "l_linenumber")).alias("order_lines")))
query("agg_collect_set", "user_id:i kinds:s", "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds FROM {events} GROUP BY 1")(
    lambda c: c["events"].groupBy("user_id").agg(F.concat_ws(",", F.sort_array(F.collect_set("event_type"))).alias("kinds")))
query("agg_first", "o_custkey:i first_status:s", "SELECT o_custkey, arg_min(o_orderstatus, o_orderkey) AS first_status FROM {orders} GROUP BY 1")(
    lambda c: c["orders"].groupBy("o_custkey").agg(F.min_by("o_orderstatus", "o_orderkey").alias("first_status")))
_PIVOT_SQL = "SELECT l_linestatus, " + ", ".join(f"sum(CASE WHEN l_returnflag = '{x}' THEN l_quantity END) AS qty_{x.lower()}" for x in "ANR") + " FROM {lineitem} GROUP BY 1"
query("agg_pivot", "l_linestatus:s qty_a:f qty_n:f qty_r:f", _PIVOT_SQL)(
    lambda c: c["lineitem"].groupBy("l_linestatus").pivot("l_returnflag", list("ANR")).agg(F.sum("l_quantity")).withColumnsRenamed({x: f"qty_{x.lower()}" for x in "ANR"}))
query("agg_pivot_case", "l_linestatus:s qty_a:f qty_n:f qty_r:f", _PIVOT_SQL)(lambda c: c.spark.sql(_PIVOT_SQL, lineitem=c["lineitem"]))
query("agg_two_level", "p_brand:s parts:i best_part_lines:i lines:i", "SELECT p_brand, count(*) AS parts, max(n) AS best_part_lines, sum(n) AS lines FROM (SELECT p_brand, p_partkey, count(*) AS n FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY 1, 2) GROUP BY 1")(
    # lines are counted per part before the join: a part sold very often is one row in it
    lambda c: c["lineitem"].groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n")).join(c["part"].select("p_partkey", "p_brand"), "p_partkey")
    .groupBy("p_brand").agg(F.count("*").alias("parts"), F.max("n").alias("best_part_lines"), F.sum("n").alias("lines")))
query("agg_ratio_pct", "p_type:s discount_pct:f", f"SELECT p_type, {pct_('sum(disc)', 'sum(gross)', 2)} AS discount_pct FROM {{src_line}} GROUP BY 1")(
    lambda c: c["src_line"].groupBy("p_type").agg(exact_sum("disc").alias("d"), exact_sum("gross").alias("g")).withColumn("discount_pct", pct("d", "g", 2)))
query("agg_expr_key", "day:d hour:i n:i", "SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, count(*) AS n FROM {events} GROUP BY 1, 2")(
    lambda c: c["events"].groupBy(F.to_date("ts").alias("day"), F.hour("ts").alias("hour")).agg(F.count("*").alias("n")))
query("agg_on_agg_window", "event_type:s n:i share_pct:f", f"SELECT event_type, count(*) AS n, {pctn_('count(*)', '(SELECT count(*) FROM {events})', 2)} AS share_pct FROM {{events}} GROUP BY 1")(
    lambda c: c["events"].groupBy("event_type").agg(F.count("*").alias("n")).withColumn("share_pct", pct("n", F.sum("n").over(Window.partitionBy()), 2)))
query("agg_decimal_sum", "o_orderstatus:s total:f", "SELECT o_orderstatus, sum(" + D.format("o_totalprice") + ") AS total FROM {orders} GROUP BY 1")(
    lambda c: c["orders"].groupBy("o_orderstatus").agg(F.sum(money("o_totalprice")).cast("decimal(18,2)").alias("total")))
query("agg_distinct_rows", "p_brand:s p_type:s", "SELECT DISTINCT p_brand, p_type FROM {part}")(lambda c: c["part"].select("p_brand", "p_type").distinct())

# --- windows -------------------------------------------------------------------------------------
_LINE_REST = "l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus"
query("win_row_number_dedup", "l_orderkey:i l_linenumber:i l_partkey:i l_suppkey:i l_quantity:f l_shipdate:d", latest_("{lineitem}", "l_orderkey, l_linenumber", "l_shipdate", _LINE_REST))(
    lambda c: keyed.latest_per_key(c["lineitem"], ["l_orderkey", "l_linenumber"], ["l_shipdate"]))
query("win_lag", "o_orderkey:i o_custkey:i prior:d", "SELECT o_orderkey, o_custkey, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prior FROM {orders}")(
    lambda c: previous_value(c["orders"].select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderdate", F.trunc(F.col("o_orderdate").cast("date"), "year"), "prior"))
query("win_lag_n", "ym:s revenue:f year_before:f", "SELECT ym, revenue, lag(revenue, 12) OVER (ORDER BY ym) AS year_before FROM (SELECT strftime(o_orderdate, '%Y-%m') AS ym, sum(" + D.format("o_totalprice") + ") AS revenue FROM {orders} GROUP BY 1)")(
    # twelve rows per year remain after the aggregate
    lambda c: c["orders"].groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("ym")).agg(exact_sum("o_totalprice").alias("revenue")).withColumn("year_before", F.lag("revenue", 12).over(Window.orderBy("ym"))))
query("win_ntile", "c_custkey:i quintile:i", "SELECT c_custkey, ntile(5) OVER (ORDER BY " + D.format("c_acctbal") + ", c_custkey) AS quintile FROM {customer}")(
    lambda c: ntile_scores(c["customer"].select("c_custkey", money("c_acctbal").alias("bal")), "c_custkey", {"quintile": "bal"}, 5))
query("win_rank", "p_partkey:i p_type:s size_rank:i", "SELECT p_partkey, p_type, rank() OVER (PARTITION BY p_type ORDER BY p_size DESC) AS size_rank FROM {part}")(
    lambda c: rank_within(c["part"].select("p_partkey", "p_type", "p_size"), ["p_type"], "p_size", "size_rank"))
query("win_percent_rank", "p_partkey:i size_percentile:f", f"SELECT p_partkey, {rnd('percent_rank() OVER (PARTITION BY p_type ORDER BY p_size) * 100', 1)} AS size_percentile FROM {{part}}")(
    lambda c: rank_within(c["part"].select("p_partkey", "p_type", "p_size"), ["p_type"], "p_size", "r", percent_rank_as="s").withColumn("size_percentile", F.round(F.col("s") * 100, 1)))
query("win_share_of_total", "p_type:s p_brand:s share_pct:f", f"SELECT p_type, p_brand, {pct_('q', 'sum(q) OVER (PARTITION BY p_type)', 2)} AS share_pct FROM (SELECT p_type, p_brand, CAST(sum(p_retailprice) AS DECIMAL(18,2)) AS q FROM {{part}} GROUP BY 1, 2)".replace("CAST(sum(p_retailprice) AS DECIMAL(18,2))", "sum(CAST(p_retailprice AS DECIMAL(18,2)))"))(
    lambda c: c["part"].groupBy("p_type", "p_brand").agg(exact_sum("p_retailprice").alias("q")).withColumn("share_pct", pct("q", F.sum("q").over(Window.partitionBy("p_type")), 2)))
query("win_partition_count", "user_id:i event_type:s n:i kinds:i", "SELECT user_id, event_type, n, count(*) OVER (PARTITION BY user_id) AS kinds FROM (SELECT user_id, event_type, count(*) AS n FROM {events} GROUP BY 1, 2)")(
    lambda c: c["events"].groupBy("user_id", "event_type").agg(F.count("*").alias("n")).withColumn("kinds", F.count("*").over(Window.partitionBy("user_id"))))
query("win_first_value", "user_id:i event_type:s favourite:s", "SELECT user_id, event_type, first_value(event_type) OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS favourite FROM (SELECT user_id, event_type, count(*) AS n FROM {events} GROUP BY 1, 2)")(
    lambda c: c["events"].groupBy("user_id", "event_type").agg(F.count("*").alias("n")).withColumn("favourite", F.first("event_type").over(Window.partitionBy("user_id").orderBy(F.desc("n"), "event_type"))))
query("win_running_rows", "user_id:i day:d running:f", "SELECT user_id, day, sum(v) OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS running FROM (SELECT user_id, CAST(ts AS DATE) AS day, sum(" + D.format("value") + ") AS v FROM {events} GROUP BY 1, 2)")(
    lambda c: c["events"].groupBy("user_id", F.to_date("ts").alias("day")).agg(exact_sum("value").alias("v"))
    .withColumn("running", F.sum("v").over(Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, 0))))
query("win_range_seconds", "event_id:i in_window:i", "SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY CAST(floor(epoch(ts)) AS BIGINT) RANGE BETWEEN 600 PRECEDING AND CURRENT ROW) AS in_window FROM {events}")(
    lambda c: events_in_trailing_window(c["events"].select("event_id", "event_type", "ts"), "event_type", F.unix_seconds(F.col("ts").cast("timestamp")), 600, "in_window"))
query("win_range_days_avg", "day:d avg_7d:f", f"SELECT day, {rnd('CAST(sum(v) OVER w AS DOUBLE) / count(*) OVER w', 2, 9)} AS avg_7d FROM (SELECT CAST(ts AS DATE) AS day, sum({D.format('value')}) AS v FROM {{events}} GROUP BY 1) WINDOW w AS (ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)")(
    lambda c: c["events"].groupBy(F.to_date("ts").alias("day")).agg(exact_sum("value").alias("v"))
    .withColumn("avg_7d", F.round(F.avg("v").over(Window.orderBy(F.unix_date("day")).rangeBetween(-6, 0)), 2)))

# --- sorts, limits, sets -------------------------------------------------------------------------
query("sort_global", "n_name:s n_regionkey:i", "SELECT n_name, n_regionkey FROM {nation} ORDER BY n_regionkey, n_name")(lambda c: c["nation"].orderBy("n_regionkey", "n_name"))
query("topk", "o_orderkey:i o_totalprice:f", "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")(lambda c: c["orders"].orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20))
query("topk_abs", "c_custkey:i off_mean:f", "SELECT c_custkey, c_acctbal - 4500 AS off_mean FROM {customer} ORDER BY abs(c_acctbal - 4500) DESC, c_custkey LIMIT 15")(
    lambda c: c["customer"].withColumn("off_mean", F.col("c_acctbal") - 4500).orderBy(F.abs("off_mean").desc(), "c_custkey").limit(15))
query("sort_within_partitions", "parts:i breaks:i", "SELECT count(*) AS parts, 0 AS breaks FROM {part}")(
    lambda c: c["part"].repartition(8, "p_type").sortWithinPartitions("p_brand", "p_partkey").select(
        "p_brand", "p_partkey", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("place")).withColumn(
        "before", F.lag(F.struct("p_brand", "p_partkey")).over(Window.partitionBy("task").orderBy("place"))).agg(
        F.count("*").alias("parts"), F.count_if(F.col("before") > F.struct("p_brand", "p_partkey")).alias("breaks")))
_BOTH = "SELECT c_custkey AS id, c_name AS name FROM {customer} UNION ALL SELECT s_suppkey, s_name FROM {supplier}"


def _parties(c: Context):
    return c["customer"].select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), c["supplier"].select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))


query("set_union_by_name", "id:i name:s", _BOTH)(lambda c: (lambda a, b: a.unionByName(b))(*_parties(c)))
query("set_union_missing", "id:i name:s role:s", "SELECT c_custkey AS id, c_name AS name, NULL AS role FROM {customer} UNION ALL SELECT s_suppkey, s_name, 'seller' FROM {supplier}")(
    lambda c: (lambda a, b: a.unionByName(b.withColumn("role", F.lit("seller")), allowMissingColumns=True))(*_parties(c)))
query("set_union_reduce", "id:i name:s", _BOTH + " UNION ALL SELECT n_nationkey, n_name FROM {nation}")(
    lambda c: reduce(DataFrame.unionByName, [*_parties(c), c["nation"].select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))]))
query("set_union_all_sql", "id:i name:s", _BOTH)(lambda c: c.spark.sql(_BOTH, customer=c["customer"], supplier=c["supplier"]))
query("set_distinct", "l_orderkey:i l_returnflag:s", "SELECT DISTINCT l_orderkey, l_returnflag FROM {lineitem}")(lambda c: c["lineitem"].select("l_orderkey", "l_returnflag").distinct())

# --- scalar functions ------------------------------------------------------------------------------
query("fn_string_case", "id:i a:s b:s d:s", "SELECT DISTINCT ca_address_sk AS id, upper(trim(ca_state)) AS a, lower(trim(ca_county)) AS b, trim(ca_city) AS d FROM {src_customer_address}")(
    lambda c: c["src_customer_address"].select(F.col("ca_address_sk").alias("id"), code("ca_state").alias("a"), F.lower(F.trim("ca_county")).alias("b"), F.trim("ca_city").alias("d")).distinct())
query("fn_string_build", "c_custkey:i joined:s padded:s part:s", "SELECT c_custkey, c_mktsegment || '-' || c_nationkey AS joined, lpad(CAST(c_custkey * 977 AS VARCHAR), 5, '0') AS padded, substr(c_name, 1, 4) AS part FROM {customer}")(
    lambda c: c["customer"].select("c_custkey", F.concat_ws("-", "c_mktsegment", "c_nationkey").alias("joined"), F.lpad((F.col("c_custkey") * 977).cast("string"), 5, "0").alias("padded"), F.substring("c_name", 1, 4).alias("part")))
query("fn_string_match", "p_partkey:i has_ring:b starts_red:b plain:s", "SELECT p_partkey, position('ring' IN p_name) > 0 AS has_ring, p_name LIKE 'red%' AS starts_red, regexp_replace(p_brand, '[^0-9]', '', 'g') AS plain FROM {part}")(
    lambda c: c["part"].select("p_partkey", F.contains("p_name", F.lit("ring")).alias("has_ring"), F.col("p_name").like("red%").alias("starts_red"), F.regexp_replace("p_brand", "[^0-9]", "").alias("plain")))
query("fn_hash", "o_orderkey:i key:s", "SELECT o_orderkey, substr(sha256(o_orderkey || '|' || o_custkey), 1, 32) AS key FROM {orders}")(lambda c: c["orders"].select("o_orderkey", line_key("o_orderkey", "o_custkey").alias("key")))
query("fn_date_parse", "account_id:s opened:d n:i", "SELECT account_id, TRY_CAST(opened_on AS DATE) AS opened, count(*) AS n FROM {src_accounts} GROUP BY 1, 2")(
    lambda c: c["src_accounts"].groupBy("account_id", parse_date("opened_on", "yyyy-MM-dd").alias("opened")).agg(F.count("*").alias("n")))
query("fn_timestamp_parse", "txn_ts:s parsed:t n:i", "SELECT txn_ts, TRY_CAST(txn_ts AS TIMESTAMP) AS parsed, count(*) AS n FROM {src_txns} GROUP BY 1, 2")(
    lambda c: c["src_txns"].groupBy("txn_ts", parse_timestamp("txn_ts").alias("parsed")).agg(F.count("*").alias("n")))
query("fn_date_math", "o_orderkey:i age:i", "SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS age FROM {orders}")(
    lambda c: c["orders"].select("o_orderkey", F.datediff(F.lit("2002-01-01").cast("date"), "o_orderdate").alias("age")))
query("fn_date_parts", "o_orderkey:i ym:s month_start:d", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS ym, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM {orders}")(
    lambda c: c["orders"].select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("ym"), F.trunc("o_orderdate", "month").alias("month_start")))
query("fn_seconds", "event_id:i s:i hr:i", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s, hour(ts) AS hr FROM {events}")(
    lambda c: c["events"].select("event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"), F.hour("ts").alias("hr")))
query("fn_math", "c_custkey:i dist:f capped:f rest:i neg:f", "SELECT c_custkey, abs(c_acctbal) AS dist, least(greatest(c_acctbal, 0), 5000) AS capped, c_custkey % 7 AS rest, -c_acctbal AS neg FROM {customer}")(
    lambda c: c["customer"].select("c_custkey", F.abs("c_acctbal").alias("dist"), F.least(F.greatest("c_acctbal", F.lit(0.0)), F.lit(5000.0)).alias("capped"), (F.col("c_custkey") % 7).alias("rest"), (-F.col("c_acctbal")).alias("neg")))
query("fn_null", "account_id:s branch:s balance:f n:i", "SELECT account_id, coalesce(branch_code, 'UNKNOWN') AS branch, coalesce(opening_balance, 0) AS balance, count(*) AS n FROM {src_accounts} GROUP BY 1, 2, 3")(
    lambda c: c["src_accounts"].na.fill({"opening_balance": 0.0}).groupBy("account_id", F.coalesce("branch_code", F.lit("UNKNOWN")).alias("branch"), F.col("opening_balance").alias("balance")).agg(F.count("*").alias("n")))
query("fn_cast", "VALUE:s number:f n:i", "SELECT VALUE, TRY_CAST(CASE WHEN regexp_matches(replace(VALUE, ',', ''), '^[0-9.]+$') THEN replace(VALUE, ',', '') END AS DOUBLE) AS number, count(*) AS n FROM {src_crops} GROUP BY 1, 2")(
    lambda c: c["src_crops"].groupBy("VALUE", parse_number("VALUE").alias("number")).agg(F.count("*").alias("n")))
query("fn_nested", "r_regionkey:i doc:s", """SELECT r_regionkey, '{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name || '"}' AS doc FROM {region}""")(
    lambda c: c["region"].select("r_regionkey", F.to_json(F.struct("r_regionkey", "r_name")).alias("doc")))
query("fn_banding", "band:s customers:i", "SELECT CASE WHEN c_acctbal >= 7500 THEN 'HIGH' WHEN c_acctbal >= 2500 THEN 'MID' ELSE 'LOW' END AS band, count(*) AS customers FROM {customer} GROUP BY 1")(
    lambda c: c["customer"].groupBy(F.when(F.col("c_acctbal") < 2500, "LOW").when(F.col("c_acctbal") < 7500, "MID").otherwise("HIGH").alias("band")).agg(F.count("*").alias("customers")))
query("fn_weighted_score", "event_id:i score:i", "SELECT event_id, CASE WHEN event_type = 'error' THEN 30 ELSE 0 END + CASE WHEN value > 300 THEN 25 ELSE 0 END + CASE WHEN hour(ts) < 6 THEN 10 ELSE 0 END AS score FROM {events}")(
    lambda c: c["events"].select("event_id", reduce(lambda a, b: a + b, (F.when(cond, w).otherwise(0) for cond, w in (
        (F.col("event_type") == "error", 30), (F.col("value") > 300, 25), (F.hour("ts") < 6, 10)))).alias("score")))
query("fn_flag_count", "p_promo_sk:i media:i", "SELECT p_promo_sk, CAST(p_channel_email = 'Y' AS INT) + CAST(p_channel_tv = 'Y' AS INT) + CAST(p_channel_radio = 'Y' AS INT) AS media FROM {src_promotion}")(
    lambda c: c["src_promotion"].select("p_promo_sk", reduce(lambda a, b: a + b, ((F.col(f"p_channel_{m}") == "Y").cast("int") for m in ("email", "tv", "radio"))).alias("media")))
