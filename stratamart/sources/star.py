"""The supplied star-schema tables, reshaped into the feeds the jobs expect.

Every feed is one SQL text over the tables that Spark and the checking database
both understand (a few date functions differ and go through ``Dialect``). Feeds
carry deliberate defects decided by arithmetic on keys: replayed rows, NULLs,
wrong signs, odd casing, unknown references. They read whole tables.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from stratamart.sinks.scratch import settle

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@dataclass(frozen=True)
class Dialect:
    name: str

    def days(self, later: str, earlier: str) -> str:
        return f"datediff({later}, {earlier})" if self.name == "spark" else f"date_diff('day', {earlier}, {later})"

    def plus_days(self, date: str, n: str) -> str:
        return f"date_add({date}, CAST({n} AS INT))" if self.name == "spark" else f"({date} + CAST({n} AS INT))"

    def twice_where(self, cond: str) -> str:
        """FROM-clause tail that repeats a row when the condition holds."""
        if self.name == "spark":
            return f"LATERAL VIEW explode(CASE WHEN {cond} THEN array(1, 2) ELSE array(1) END) r AS copy_no"
        return f", UNNEST(CASE WHEN {cond} THEN [1, 2] ELSE [1] END) r(copy_no)"

    def daynum(self, date: str) -> str:
        return self.days(date, "DATE '1900-01-01'")


SPARK, DUCK = Dialect("spark"), Dialect("duck")

DATE_SK_BASE = 2415022  # surrogate key of 1900-01-02 is 2415023, and so on by day


def _line(d: Dialect) -> str:
    sold = f"{d.daynum('CAST(o_orderdate AS DATE)')} + {DATE_SK_BASE}"
    ship = f"{d.daynum('CAST(l_shipdate AS DATE)')} + {DATE_SK_BASE}"
    return f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus, o_custkey, p_type,
  l_suppkey % 3 AS feed, CAST({sold} AS INT) AS sold_sk, CAST({ship} AS INT) AS ship_sk,
  CAST(l_quantity AS INT) AS qty,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS gross,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS disc,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS tax,
  CAST(p_retailprice AS DECIMAL(12,2)) AS price,
  CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.60 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS cost,
  CASE WHEN l_linenumber % 4 = 0 THEN CAST(5.00 AS DECIMAL(12,2)) END AS coupon
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey"""


def _sales(d: Dialect, feed: int, p: str, cust: str, addr: str, cdemo: str, hdemo: str, order: str, extra: str) -> str:
    return f"""
SELECT CASE WHEN (l_orderkey * 31 + l_partkey) % 251 <> 0 THEN sold_sk END AS {p}_sold_date_sk,
  CAST((l_orderkey * 37) % 86400 AS INT) AS {p}_sold_time_sk,
  CASE WHEN (l_orderkey + l_partkey * 7) % 503 <> 0 THEN l_partkey END AS {p}_item_sk,
  CASE WHEN l_orderkey % 97 <> 0 THEN o_custkey END AS {p}_{cust},
  o_custkey AS {p}_{addr}, o_custkey % 40 AS {p}_{cdemo}, o_custkey % 20 AS {p}_{hdemo},
  {extra}
  CASE WHEN p_type = 'PROMO' OR l_partkey % 11 = 0 THEN l_partkey % 25 END AS {p}_promo_sk,
  l_orderkey AS {p}_{order},
  CASE WHEN (l_orderkey * 13 + l_linenumber) % 509 = 0 THEN -qty ELSE qty END AS {p}_quantity,
  cost AS {p}_wholesale_cost, price AS {p}_list_price,
  CAST(price - disc * CAST(0.02 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS {p}_sales_price,
  CASE WHEN l_partkey % 29 <> 0 THEN disc END AS {p}_ext_discount_amt, gross - disc AS {p}_ext_sales_price,
  CASE WHEN l_partkey % 83 <> 0 THEN CAST(cost * qty AS DECIMAL(12,2)) END AS {p}_ext_wholesale_cost,
  gross AS {p}_ext_list_price, tax AS {p}_ext_tax, coupon AS {p}_coupon_amt,
  CASE WHEN (l_orderkey * 17 + l_partkey) % 241 <> 0 THEN gross - disc END AS {p}_net_paid,
  gross - disc + tax AS {p}_net_paid_inc_tax,
  CAST(gross - disc - cost * qty AS DECIMAL(12,2)) AS {p}_net_profit
FROM {{src_line}} {d.twice_where('(l_orderkey * 7 + l_linenumber) % 67 = 0')} WHERE feed = {feed}"""


def _returns(d: Dialect, feed: int, p: str, names: dict[str, str], extra: str) -> str:
    n = names
    amount = "CAST((gross - disc) * CAST(0.50 AS DECIMAL(3,2)) AS DECIMAL(12,2))"
    third = "CAST((gross - disc) * CAST(0.15 AS DECIMAL(3,2)) AS DECIMAL(12,2))"
    return f"""
SELECT CASE WHEN (l_orderkey * 3 + l_partkey) % 199 <> 0 THEN ship_sk END AS {p}_returned_date_sk,
  CAST((l_orderkey * 41) % 86400 AS INT) AS {p}_{n['time']},
  CASE WHEN (l_orderkey + l_partkey * 5) % 307 <> 0 THEN l_partkey END AS {p}_item_sk,
  CASE WHEN l_orderkey % 89 <> 0 THEN o_custkey END AS {p}_{n['customer']}, o_custkey AS {p}_{n['addr']},
  {extra}
  CAST(l_linenumber AS INT) AS {p}_reason_sk, l_orderkey AS {p}_{n['order']},
  CASE WHEN qty > 5 THEN 5 ELSE qty END AS {p}_return_quantity,
  {amount} AS {p}_{n['amount']}, tax AS {p}_return_tax, {amount} + tax AS {p}_return_amt_inc_tax,
  CAST(1.50 AS DECIMAL(12,2)) AS {p}_fee, CAST(l_linenumber AS DECIMAL(12,2)) AS {p}_return_ship_cost,
  CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 4 = 0 THEN {amount} ELSE {third} END AS {p}_refunded_cash,
  CASE WHEN l_partkey % 4 = 1 THEN {amount} WHEN l_partkey % 13 = 0 THEN NULL ELSE {third} END AS {p}_reversed_charge,
  CASE WHEN l_partkey % 4 = 2 THEN {amount} END AS {p}_{n['credit']},
  {third} + CAST(1.50 AS DECIMAL(12,2)) AS {p}_net_loss
FROM {{src_line}} {d.twice_where('(l_orderkey * 11 + l_linenumber) % 71 = 0')} WHERE feed = {feed} AND l_returnflag = 'R'"""


def _calendar(d: Dialect) -> str:
    n = d.daynum("dt")
    return f"""
SELECT n + {DATE_SK_BASE} AS d_date_sk, CAST(dt AS STRING) AS d_date_id, dt AS d_date, y AS d_year, m AS d_moy,
  CAST(EXTRACT(DAY FROM dt) AS INT) AS d_dom, (n + 1) % 7 AS d_dow, q AS d_qoy,
  CASE (n + 1) % 7 WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday'
    WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' ELSE 'Saturday' END AS d_day_name,
  CAST(y AS STRING) || 'Q' || CAST(q AS STRING) AS d_quarter_name, (y - 1900) * 12 + m - 1 AS d_month_seq,
  CAST(floor((n + 7) / 7) AS INT) AS d_week_seq, y AS d_fy_year,
  CASE WHEN m = 12 AND EXTRACT(DAY FROM dt) = 25 THEN 'Y' ELSE 'N' END AS d_holiday,
  CASE WHEN (n + 1) % 7 IN (0, 6) THEN 'Y' ELSE 'N' END AS d_weekend
FROM (SELECT dt, CAST({n} AS INT) AS n, CAST(EXTRACT(YEAR FROM dt) AS INT) AS y, CAST(EXTRACT(MONTH FROM dt) AS INT) AS m,
        CAST(floor((EXTRACT(MONTH FROM dt) - 1) / 3) AS INT) + 1 AS q
      FROM (SELECT CAST(o_orderdate AS DATE) AS dt FROM {{orders}}
            UNION SELECT CAST(l_shipdate AS DATE) AS dt FROM {{lineitem}}))"""


def _text_key(prefix: str, col: str) -> str:
    return f"'{prefix}' || lpad(CAST({col} AS STRING), 9, '0')"


@lru_cache
def feeds(d: Dialect) -> dict[str, str]:
    """name -> SQL; {placeholders} are supplied tables or other feeds."""
    f: dict[str, str] = {"src_line": _line(d)}

    # --- retail: sales and returns of three channels ---------------------------
    f["src_store_sales"] = _sales(
        d, 0, "ss", "customer_sk", "addr_sk", "cdemo_sk", "hdemo_sk", "ticket_number",
        "l_suppkey AS ss_store_sk,")
    shipping = "ship_sk AS {p}_ship_date_sk, o_custkey AS {p}_ship_customer_sk, CAST(l_linenumber AS INT) AS {p}_ship_mode_sk, l_suppkey AS {p}_warehouse_sk, CAST(qty * CAST(0.50 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS {p}_ext_ship_cost,"
    f["src_catalog_sales"] = _sales(
        d, 1, "cs", "bill_customer_sk", "bill_addr_sk", "bill_cdemo_sk", "bill_hdemo_sk", "order_number",
        shipping.replace("{p}", "cs") + " l_suppkey % 5 AS cs_call_center_sk, l_partkey % 50 AS cs_catalog_page_sk,")
    f["src_web_sales"] = _sales(
        d, 2, "ws", "bill_customer_sk", "bill_addr_sk", "bill_cdemo_sk", "bill_hdemo_sk", "order_number",
        shipping.replace("{p}", "ws") + " l_suppkey % 7 AS ws_web_site_sk, l_partkey % 30 AS ws_web_page_sk,")
    f["src_store_returns"] = _returns(
        d, 0, "sr", dict(time="return_time_sk", customer="customer_sk", addr="addr_sk", order="ticket_number", amount="return_amt", credit="store_credit"),
        "l_suppkey AS sr_store_sk,")
    f["src_catalog_returns"] = _returns(
        d, 1, "cr", dict(time="returned_time_sk", customer="refunded_customer_sk", addr="refunded_addr_sk", order="order_number", amount="return_amount", credit="store_credit"),
        "o_custkey AS cr_returning_customer_sk, l_suppkey % 5 AS cr_call_center_sk, l_partkey % 50 AS cr_catalog_page_sk, CAST(l_linenumber AS INT) AS cr_ship_mode_sk, l_suppkey AS cr_warehouse_sk,")
    f["src_web_returns"] = _returns(
        d, 2, "wr", dict(time="returned_time_sk", customer="refunded_customer_sk", addr="refunded_addr_sk", order="order_number", amount="return_amt", credit="account_credit"),
        "o_custkey AS wr_returning_customer_sk, l_partkey % 30 AS wr_web_page_sk,")
    f["src_inventory"] = """
SELECT CASE WHEN (l_partkey + l_suppkey) % 211 <> 0 THEN sold_sk END AS inv_date_sk, l_partkey AS inv_item_sk,
  l_suppkey AS inv_warehouse_sk,
  CASE WHEN (l_partkey * 3 + l_suppkey) % 97 = 0 THEN NULL ELSE CAST(SUM(qty) AS INT) * (l_partkey % 25) - l_suppkey % 4 END AS inv_quantity_on_hand
FROM {src_line} GROUP BY sold_sk, l_partkey, l_suppkey"""

    # --- retail: dimensions -------------------------------------------------------
    f["src_date_dim"] = _calendar(d)
    f["src_time_dim"] = """
SELECT h * 3600 + mi * 60 AS t_time_sk, h AS t_hour, mi AS t_minute, CASE WHEN h < 12 THEN 'AM' ELSE 'PM' END AS t_am_pm,
  CASE WHEN h < 8 THEN 'third' WHEN h < 16 THEN 'first' ELSE 'second' END AS t_shift,
  CASE WHEN h BETWEEN 6 AND 8 THEN 'breakfast' WHEN h BETWEEN 17 AND 20 THEN 'dinner' END AS t_meal_time
FROM (SELECT CAST(EXTRACT(HOUR FROM ts) AS INT) AS h, CAST(EXTRACT(MINUTE FROM ts) AS INT) AS mi FROM {events})"""
    f["src_customer_address"] = f"""
WITH a AS (SELECT c_custkey AS ca_address_sk, {_text_key('ADDR', 'c_custkey')} AS ca_address_id,
  CAST(c_custkey % 900 + 1 AS STRING) AS ca_street_number, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'Oak ' || CAST(c_nationkey AS STRING) END AS ca_street_name,
  'Ave' AS ca_street_type, CASE WHEN c_custkey % 3 = 0 THEN 'Suite ' || CAST(c_custkey % 90 AS STRING) END AS ca_suite_number,
  CASE c_custkey % 4 WHEN 0 THEN ' san mateo' WHEN 1 THEN 'OAK GROVE ' WHEN 2 THEN 'Fairview' ELSE 'mount olive' END AS ca_city,
  CASE c_custkey % 3 WHEN 0 THEN 'WALKER county' WHEN 1 THEN 'ziebach County ' ELSE 'Bronx County' END AS ca_county,
  CASE WHEN c_custkey % 5 = 0 THEN lower(st) ELSE st END AS ca_state,
  CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 9 = 0 THEN ' ' || CAST(c_custkey % 999 AS STRING) WHEN c_custkey % 31 = 0 THEN '123456789' ELSE lpad(CAST(c_custkey % 99999 AS STRING), 5, '3') END AS ca_zip,
  CASE c_custkey % 6 WHEN 0 THEN 'USA' WHEN 1 THEN ' us' WHEN 2 THEN 'United States' WHEN 3 THEN 'canada ' WHEN 4 THEN NULL ELSE 'UNITED STATES' END AS ca_country,
  CAST(-5.00 - c_custkey % 4 AS DECIMAL(5,2)) AS ca_gmt_offset, CASE c_custkey % 2 WHEN 0 THEN 'apartment ' ELSE 'condo' END AS ca_location_type
  FROM (SELECT *, CASE c_custkey % 9 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX' WHEN 3 THEN 'OH' WHEN 4 THEN 'WA' WHEN 5 THEN 'GA' WHEN 6 THEN 'ZZ' WHEN 7 THEN 'IL' ELSE 'PA' END AS st FROM {{customer}}))
SELECT * FROM a UNION ALL SELECT * FROM a WHERE ca_address_sk % 47 = 0"""
    f["src_customer"] = f"""
WITH c AS (SELECT c_custkey AS c_customer_sk, {_text_key('CUST', 'c_custkey')} AS c_customer_id,
  CASE c_custkey % 5 WHEN 0 THEN 'maria   ' WHEN 1 THEN 'JOHN' WHEN 2 THEN 'Ann' WHEN 3 THEN NULL ELSE 'li wei' END AS c_first_name,
  CASE WHEN c_custkey % 8 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_last_name,
  CASE c_custkey % 3 WHEN 0 THEN 'Mr. ' WHEN 1 THEN 'Ms.' ELSE NULL END AS c_salutation,
  CASE WHEN c_custkey % 33 = 0 THEN NULL WHEN c_custkey % 50 = 1 THEN 'not-an-address' ELSE ' User' || CAST(c_custkey AS STRING) || '@Example.COM' END AS c_email_address,
  CASE c_custkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE NULL END AS c_preferred_cust_flag,
  CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE CAST(1930 + c_custkey % 70 AS INT) END AS c_birth_year,
  n_name AS c_birth_country, CAST(2450000 + c_custkey % 700 AS INT) AS c_first_sales_date_sk,
  CASE WHEN c_custkey % 59 = 0 THEN NULL ELSE c_custkey END AS c_current_addr_sk,
  CASE WHEN c_custkey % 61 = 0 THEN NULL ELSE c_custkey % 40 END AS c_current_cdemo_sk, c_custkey % 20 AS c_current_hdemo_sk
  FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey)
SELECT * FROM c UNION ALL SELECT * FROM c WHERE c_customer_sk % 53 = 0"""
    f["src_customer_demographics"] = """
SELECT DISTINCT c_custkey % 40 AS cd_demo_sk, CASE c_custkey % 2 WHEN 0 THEN 'M' ELSE 'F' END AS cd_gender,
  CASE c_custkey % 5 WHEN 0 THEN 'S' WHEN 1 THEN 'M' WHEN 2 THEN 'D' WHEN 3 THEN 'W' ELSE 'U' END AS cd_marital_status,
  CASE c_custkey % 4 WHEN 0 THEN 'College' WHEN 1 THEN 'Primary' WHEN 2 THEN 'Secondary' ELSE 'Unknown' END AS cd_education_status,
  CASE c_custkey % 8 WHEN 0 THEN 'Good' WHEN 1 THEN 'Low Risk' ELSE 'High Risk' END AS cd_credit_rating,
  CAST(500 * (c_custkey % 40) AS INT) AS cd_purchase_estimate, CAST(c_custkey % 10 AS INT) AS cd_dep_count FROM {customer}"""
    f["src_household_demographics"] = """
SELECT DISTINCT c_custkey % 20 AS hd_demo_sk, CASE WHEN c_custkey % 20 = 19 THEN NULL ELSE c_custkey % 20 % 6 END AS hd_income_band_sk,
  CASE c_custkey % 4 WHEN 0 THEN ' >10000' WHEN 1 THEN '0-500' WHEN 2 THEN '501-1000' ELSE 'Unknown' END AS hd_buy_potential,
  CAST(c_custkey % 10 AS INT) AS hd_dep_count, CAST(c_custkey % 5 AS INT) AS hd_vehicle_count FROM {customer}"""
    f["src_income_band"] = """
SELECT DISTINCT c_custkey % 6 AS ib_income_band_sk, CAST((c_custkey % 6) * 10000 AS INT) AS ib_lower_bound,
  CAST((c_custkey % 6) * 10000 + 10000 AS INT) AS ib_upper_bound FROM {customer}"""
    f["src_item"] = f"""
WITH i AS (SELECT p_partkey AS i_item_sk, {_text_key('ITEM', 'p_partkey')} AS i_item_id, ' ' || p_name AS i_product_name, 'Item ' || p_name || ' ' AS i_item_desc,
  CASE WHEN p_partkey % 401 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN ' ' || lower(p_type) ELSE p_type END AS i_category, CAST(p_partkey % 6 AS INT) AS i_category_id,
  lower(p_type) || CAST(p_size % 3 AS STRING) AS i_class, CAST(p_size % 3 AS INT) AS i_class_id, p_brand || ' ' AS i_brand, CAST(p_partkey % 25 AS INT) AS i_brand_id,
  'Maker ' || CAST(p_partkey % 40 AS STRING) AS i_manufact, CAST(p_partkey % 90 AS INT) AS i_manager_id, CASE p_size % 3 WHEN 0 THEN 'small ' WHEN 1 THEN 'medium' ELSE NULL END AS i_size,
  split_part(p_name, ' ', 1) AS i_color, 'Each ' AS i_units, 'Unknown' AS i_container,
  CASE WHEN p_partkey % 101 = 0 THEN NULL ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) - 895 + CASE WHEN p_size > 40 THEN 100 ELSE 0 END AS DECIMAL(7,2)) END AS i_current_price,
  CAST(CAST(p_retailprice AS DECIMAL(12,2)) - 897 AS DECIMAL(7,2)) AS i_wholesale_cost,
  DATE '1997-10-27' AS i_rec_start_date, CASE WHEN p_partkey % 5 = 0 THEN DATE '2000-10-26' END AS i_rec_end_date FROM {{part}})
SELECT * FROM i UNION ALL SELECT * FROM i WHERE i_item_sk % 66 = 0"""
    f["src_store"] = f"""
WITH s AS (SELECT s_suppkey AS s_store_sk, {_text_key('STOR', 's_suppkey')} AS s_store_id, CASE WHEN s_suppkey % 3 = 0 THEN s_name || ' ' ELSE s_name END AS s_store_name,
  CASE WHEN s_suppkey % 23 = 0 THEN 0 ELSE CAST(50 + s_suppkey % 200 AS INT) END AS s_number_employees, CAST(2000 + (s_suppkey * 37) % 9000 AS INT) AS s_floor_space,
  ' Manager ' || CAST(s_nationkey AS STRING) AS s_manager, CAST(s_suppkey % 10 AS INT) AS s_market_id, 'Market ' || n_name AS s_market_desc, 'Unknown ' AS s_geography_class,
  ' Division ' || CAST(n_regionkey AS STRING) AS s_division_name, 'Company' AS s_company_name, CASE s_suppkey % 2 WHEN 0 THEN 'midway ' ELSE 'FAIRVIEW' END AS s_city,
  CASE s_suppkey % 3 WHEN 0 THEN 'tn' WHEN 1 THEN ' CA' ELSE 'NY' END AS s_state, ' ' || lpad(CAST(s_suppkey AS STRING), 5, '1') AS s_zip, CAST(0.03 AS DECIMAL(5,2)) AS s_tax_percentage,
  CASE WHEN s_suppkey % 2 = 0 THEN DATE '1997-03-13' ELSE DATE '1999-03-14' END AS s_rec_start_date, CASE WHEN s_suppkey % 6 = 0 THEN DATE '2001-03-12' END AS s_rec_end_date
  FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey)
SELECT * FROM s UNION ALL SELECT s_store_sk, s_store_id, s_store_name, s_number_employees, s_floor_space + 1, s_manager, s_market_id, s_market_desc, s_geography_class,
  s_division_name, s_company_name, s_city, s_state, s_zip, s_tax_percentage, DATE '2002-01-01', s_rec_end_date FROM s WHERE s_store_sk % 17 = 0"""
    f["src_web_site"] = """
SELECT s_suppkey % 7 AS web_site_sk, 'SITE' || CAST(s_suppkey % 7 AS STRING) AS web_site_id, ' site_' || CAST(s_suppkey % 7 AS STRING) AS web_name, 'Unknown ' AS web_class,
  'Manager ' || CAST(min(s_nationkey) AS STRING) AS web_manager, 'Class' AS web_mkt_class, ' pri' AS web_company_name, CASE WHEN s_suppkey % 7 < 3 THEN 'tn ' ELSE 'IL' END AS web_state,
  CAST(0.05 AS DECIMAL(5,2)) AS web_tax_percentage, DATE '1997-08-16' AS web_rec_start_date, CASE WHEN s_suppkey % 7 = 3 THEN DATE '1999-08-16' END AS web_rec_end_date FROM {supplier} GROUP BY s_suppkey % 7"""
    f["src_web_page"] = """
SELECT p_partkey % 30 AS wp_web_page_sk, 'PAGE' || CAST(p_partkey % 30 AS STRING) AS wp_web_page_id, ' http://shop.example.com/' || CAST(p_partkey % 30 AS STRING) AS wp_url,
  CASE WHEN p_partkey % 30 < 10 THEN 'order ' ELSE 'general' END AS wp_type, CASE WHEN p_partkey % 30 % 4 = 0 THEN 'Y' ELSE 'N' END AS wp_autogen_flag,
  CAST(sum(p_size) AS INT) AS wp_char_count, CAST(max(p_size) AS INT) AS wp_link_count, CAST(min(p_size) AS INT) AS wp_image_count, DATE '1997-09-03' AS wp_rec_start_date FROM {part} GROUP BY p_partkey % 30"""
    f["src_call_center"] = """
SELECT s_suppkey % 5 AS cc_call_center_sk, 'CC' || CAST(s_suppkey % 5 AS STRING) AS cc_call_center_id, ' center ' || CAST(s_suppkey % 5 AS STRING) AS cc_name, 'large ' AS cc_class,
  CAST(count(*) AS INT) AS cc_employees, 'Bob ' AS cc_manager, 'able' AS cc_division_name, 'tn' AS cc_state, CAST(0.11 AS DECIMAL(5,2)) AS cc_tax_percentage, DATE '1998-01-01' AS cc_rec_start_date FROM {supplier} GROUP BY s_suppkey % 5"""
    f["src_catalog_page"] = """
SELECT DISTINCT p_partkey % 50 AS cp_catalog_page_sk, 'CP' || CAST(p_partkey % 50 AS STRING) AS cp_catalog_page_id, 'DEPARTMENT ' AS cp_department, CAST(p_partkey % 50 % 4 AS INT) AS cp_catalog_number,
  CAST(p_partkey % 50 AS INT) AS cp_catalog_page_number, CASE WHEN p_partkey % 50 % 2 = 0 THEN 'bi-annual' ELSE ' quarterly' END AS cp_type, CAST(2450815 AS INT) AS cp_start_date_sk, CAST(2450905 AS INT) AS cp_end_date_sk FROM {part}"""
    f["src_warehouse"] = """
SELECT s_suppkey AS w_warehouse_sk, 'WH' || CAST(s_suppkey AS STRING) AS w_warehouse_id, CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE ' Depot ' || CAST(s_suppkey AS STRING) END AS w_warehouse_name,
  CAST(50000 + s_suppkey % 900 AS INT) AS w_warehouse_sq_ft, 'oak GROVE ' AS w_city, CASE WHEN s_suppkey % 2 = 0 THEN 'tn' ELSE 'ca ' END AS w_state, ' 38370' AS w_zip FROM {supplier}"""
    flags = ", ".join(
        f"CASE WHEN p_partkey % 25 % {k} = 0 THEN 'Y' ELSE 'N' END AS p_channel_{c}"
        for k, c in zip((2, 3, 4, 5, 6, 7, 11), ("email", "dmail", "catalog", "tv", "radio", "press", "event"))
    )
    f["src_promotion"] = f"""
SELECT DISTINCT p_partkey % 25 AS p_promo_sk, 'PROMO' || CAST(p_partkey % 25 AS STRING) AS p_promo_id, CASE WHEN p_partkey % 25 = 7 THEN NULL ELSE ' promo ' || CAST(p_partkey % 25 AS STRING) END AS p_promo_name,
  CASE WHEN p_partkey % 25 = 9 THEN NULL ELSE CAST(1000.00 AS DECIMAL(15,2)) END AS p_cost, p_partkey % 25 AS p_item_sk, CAST(2450815 AS INT) AS p_start_date_sk, CAST(2450905 AS INT) AS p_end_date_sk,
  'unknown ' AS p_purpose, CASE WHEN p_partkey % 25 % 2 = 0 THEN 'Y' ELSE 'N' END AS p_discount_active, {flags} FROM {{part}} WHERE p_partkey % 25 <> 24"""
    f["src_ship_mode"] = """
SELECT l_linenumber AS sm_ship_mode_sk, 'SM' || CAST(l_linenumber AS STRING) AS sm_ship_mode_id, CASE WHEN l_linenumber % 2 = 0 THEN 'express ' ELSE 'LIBRARY' END AS sm_type,
  ' AIR' AS sm_code, 'CARRIER ' AS sm_carrier FROM {lineitem} GROUP BY l_linenumber"""
    f["src_reason"] = """
SELECT CAST(l_linenumber AS INT) AS r_reason_sk, 'RE' || CAST(l_linenumber AS STRING) AS r_reason_id, CASE WHEN l_linenumber < 3 THEN 'Did not fit ' WHEN l_linenumber = 5 THEN NULL ELSE ' Reason ' || CAST(l_linenumber AS STRING) END AS r_reason_desc
FROM {lineitem} GROUP BY l_linenumber"""

    # --- banking ----------------------------------------------------------------
    f["src_accounts"] = """
WITH a AS (SELECT CASE WHEN c_custkey % 211 = 7 THEN NULL ELSE 'ACC-' || CAST(c_custkey AS STRING) END AS account_id,
  CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE 'CUST-' || CAST(c_custkey AS STRING) END AS customer_id,
  CASE WHEN c_custkey % 3 = 0 THEN ' ' || lower(c_mktsegment) ELSE c_mktsegment END AS account_type,
  CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE 'BR-' || CAST(c_nationkey AS STRING) END AS branch_code,
  CASE c_custkey % 4 WHEN 0 THEN 'usd' WHEN 1 THEN 'EUR ' ELSE 'INR' END AS currency,
  CASE WHEN c_custkey % 67 = 0 THEN NULL ELSE c_acctbal END AS opening_balance,
  CASE c_custkey % 7 WHEN 0 THEN 'active' WHEN 1 THEN 'DORMANT' WHEN 2 THEN 'CLOSED ' WHEN 3 THEN 'frozen' WHEN 4 THEN 'PENDING' ELSE 'ACTIVE' END AS status,
  CASE WHEN c_custkey % 301 = 0 THEN '2020-13-45' ELSE '20' || lpad(CAST(10 + c_custkey % 14 AS STRING), 2, '0') || '-0' || CAST(1 + c_custkey % 9 AS STRING) || '-' || lpad(CAST(1 + c_custkey % 28 AS STRING), 2, '0') END AS opened_on,
  CASE WHEN c_custkey % 61 = 0 THEN NULL ELSE CAST(1 + c_custkey % 5 AS INT) END AS risk_band FROM {customer})
SELECT * FROM a UNION ALL
SELECT account_id, customer_id, account_type, branch_code, currency, opening_balance + 1, status, opened_on, risk_band FROM a WHERE account_id LIKE '%7'"""
    f["src_txns"] = """
WITH t AS (SELECT CASE WHEN event_id % 173 = 0 THEN NULL ELSE 'TXN-' || CAST(event_id AS STRING) END AS txn_id,
  CASE WHEN event_id % 119 = 0 THEN 'ACC-X9' WHEN user_id % 3 = 0 THEN 'ACC-0' ELSE 'ACC-' || CAST(user_id AS STRING) END AS account_id,
  CASE WHEN event_id % 331 = 0 THEN 'soon' ELSE CAST(date_trunc('second', ts) AS STRING) END AS txn_ts,
  CASE WHEN event_id % 241 = 0 THEN NULL WHEN event_id % 199 = 0 THEN -value WHEN event_id % 197 = 0 THEN 0.0 ELSE value * 3 END AS amount,
  CASE WHEN event_id % 251 = 0 THEN NULL WHEN event_id % 151 = 0 THEN 'XXX' WHEN event_id % 13 = 0 THEN 'usd' WHEN event_id % 17 = 0 THEN 'GBP ' ELSE 'INR' END AS currency,
  CASE WHEN event_type IN ('signup', 'view') THEN 'credit' ELSE 'DEBIT' END AS direction, event_type AS channel, 'M' || CAST(event_id % 40 AS STRING) AS merchant,
  CASE event_id % 9 WHEN 0 THEN 'US' WHEN 1 THEN 'DE' WHEN 2 THEN NULL ELSE 'IN' END AS country FROM {events})
SELECT * FROM t UNION ALL
SELECT txn_id, account_id, txn_ts, amount, currency, direction, channel, 'RETRY', country FROM t WHERE txn_id LIKE '%3'"""

    # --- verticals ---------------------------------------------------------------
    f["src_taxi"] = """
SELECT CAST(1 + event_id % 2 AS INT) AS VendorID, ts AS tpep_pickup_datetime, event_id AS trip_no,
  CASE WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 7 AS INT) END AS passenger_count, CAST(CAST(value AS DECIMAL(12,2)) * CAST(0.10 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS trip_distance,
  CAST(user_id AS INT) AS PULocationID, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 ELSE 5 END AS payment_type,
  CAST(value AS DECIMAL(12,2)) AS fare_amount, CAST(value * CAST(event_id % 4 AS DOUBLE) AS DECIMAL(12,2)) AS tip_amount, CAST(value + 3 AS DECIMAL(12,2)) AS total_amount FROM {events}"""
    f["src_cards"] = """
SELECT CAST((EXTRACT(DAY FROM ts) - 1) * 86400 + EXTRACT(HOUR FROM ts) * 3600 + EXTRACT(MINUTE FROM ts) * 60 AS DOUBLE) AS Time,
  CASE WHEN event_id % 5 = 0 THEN value / 10 ELSE value * 2 END AS Amount, CASE WHEN event_id % 37 = 0 THEN '1' ELSE '0' END AS Class FROM {events}"""
    f["src_trials"] = """
SELECT 'NCT' || lpad(CAST(o_orderkey AS STRING), 8, '0') AS nct_id, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS phase,
  CASE WHEN o_orderstatus = 'F' THEN 'COMPLETED' WHEN o_orderstatus = 'P' THEN 'TERMINATED' WHEN o_orderkey % 2 = 0 THEN 'RECRUITING' WHEN o_orderkey % 3 = 0 THEN 'NOT_YET_RECRUITING' ELSE NULL END AS overall_status,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(floor(o_totalprice / 1000) AS BIGINT) END AS enrollment_count FROM {orders}"""
    discharge = d.plus_days("CAST(o_orderdate AS DATE)", "o_orderkey % 9")

    def ymd(e: str) -> str:
        return f"CAST(EXTRACT(YEAR FROM {e}) * 10000 + EXTRACT(MONTH FROM {e}) * 100 + EXTRACT(DAY FROM {e}) AS INT)"

    f["src_claims"] = f"""
SELECT CASE WHEN o_custkey % 3 = 0 THEN 'B0' ELSE 'B' || CAST(o_custkey AS STRING) END AS DESYNPUF_ID, o_orderkey AS CLM_ID,
  {ymd('o_orderdate')} AS CLM_ADMSN_DT, CASE WHEN o_orderkey % 43 = 0 THEN 20011399 ELSE {ymd(discharge)} END AS NCH_BENE_DSCHRG_DT,
  substr(o_orderpriority, 1, 1) || o_orderstatus AS ICD9_DGNS_CD_1, CAST(o_totalprice AS DECIMAL(12,2)) AS CLM_PMT_AMT FROM {{orders}}"""
    f["src_crops"] = """
SELECT 'CENSUS' AS SOURCE_DESC, CASE WHEN pk % 10 = 9 THEN 'ANIMALS' ELSE 'CROPS' END AS SECTOR_DESC, CASE WHEN yr = 2001 THEN 'COUNTY' ELSE 'STATE' END AS AGG_LEVEL_DESC,
  p_type AS COMMODITY_DESC, CASE flag WHEN 'A' THEN 'AREA HARVESTED' WHEN 'N' THEN 'PRODUCTION' WHEN 'R' THEN 'YIELD' ELSE 'SALES' END AS STATISTICCAT_DESC, 'ACRES' AS UNIT_DESC,
  'S' || CAST(pk AS STRING) AS STATE_ALPHA, 'STATE ' || CAST(pk AS STRING) AS STATE_NAME, CAST(yr AS STRING) AS YEAR,
  CASE WHEN q % 17 = 0 THEN '(D)' WHEN q % 19 = 0 THEN ' (Z)' WHEN q % 23 = 0 THEN '1.2.3' WHEN q % 29 = 0 THEN '0' WHEN q >= 1000 THEN CAST(CAST(floor(q / 1000) AS BIGINT) AS STRING) || ',' || lpad(CAST(q % 1000 AS STRING), 3, '0') ELSE CAST(q AS STRING) END AS VALUE
FROM (SELECT p_type, l_partkey % 50 AS pk, CAST(EXTRACT(YEAR FROM l_shipdate) AS INT) AS yr, l_returnflag AS flag, CAST(sum(l_quantity) AS BIGINT) AS q
      FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4
      UNION ALL SELECT p_type, l_partkey % 50, CAST(EXTRACT(YEAR FROM l_shipdate) AS INT), 'X', count(*) FROM {lineitem} JOIN {part} ON l_partkey = p_partkey GROUP BY 1, 2, 3)"""
    f["src_orders_sheet"] = """
SELECT CASE WHEN o_orderkey % 21 = 0 THEN 'C' || CAST(o_orderkey AS STRING) ELSE CAST(o_orderkey AS STRING) END AS `Invoice`, 'SKU' || CAST(l_partkey AS STRING) AS `StockCode`, 'thing' AS `Description`,
  CASE WHEN l_orderkey % 47 = 0 THEN -CAST(l_quantity AS INT) ELSE CAST(l_quantity AS INT) END AS `Quantity`, o_orderdate AS `InvoiceDate`,
  CASE WHEN l_partkey % 77 = 0 THEN 0.0 ELSE l_discount * 100 + l_linenumber END AS `Price`, CASE WHEN o_custkey % 31 = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(o_custkey AS DOUBLE) END AS `Customer ID`,
  'Country ' || CAST((o_custkey + l_linenumber) % 12 AS STRING) AS `Country` FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""
    f["src_adverse"] = """
SELECT CAST(o_orderkey AS STRING) AS safety_report_id, CAST(EXTRACT(YEAR FROM o_orderdate) * 10000 + EXTRACT(MONTH FROM o_orderdate) * 100 + EXTRACT(DAY FROM o_orderdate) AS BIGINT) AS receive_date,
  CASE WHEN o_orderstatus = 'F' THEN '1' WHEN o_orderstatus = 'P' THEN '2' END AS serious, CASE WHEN o_orderkey % 15 = 0 THEN '1' END AS seriousness_death,
  CASE WHEN o_custkey % 10 = 3 THEN NULL ELSE 'DRUG ' || CAST(o_custkey % 10 AS STRING) END AS drug_name, 'REACTION ' || CAST(l_partkey % 20 AS STRING) AS reaction_term
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""
    if d.name == "duck":
        f["src_orders_sheet"] = f["src_orders_sheet"].replace("`", '"')
    return f


class Star:
    """Feeds of one test-data folder as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._lines: DataFrame | None = None
        self._lock = threading.Lock()

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def lines(self) -> DataFrame:
        """The joined lines behind ten feeds, written once, also when feeds are read side by side."""
        with self._lock:
            if self._lines is None:
                self._lines = settle(self.feed("src_line"), "src_line")
        return self._lines

    def feed(self, name: str) -> DataFrame:
        text = feeds(SPARK)[name]
        wanted = [n for n in (*TABLES, *feeds(SPARK)) if "{" + n + "}" in text]
        return self.spark.sql(text, **{n: self.lines() if n == "src_line" else self[n] for n in wanted})

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name) if name in TABLES else self.feed(name)
