"""Retail queries: dimensions, facts, ledger, marts and reports with their expected results."""

from __future__ import annotations

from stratamart.plans.retail import facts, reports
from stratamart.plans.retail.dims import DIMENSIONS, REGIONS
from stratamart.plans.retail.layers import MARTS
from stratamart.registry.core import div_, divn_, latest_, mean_, pct_, pctn_, query, relation, rnd


def _title(x: str) -> str:
    """initcap, which the checking database lacks."""
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


def _region(col: str) -> str:
    whens = " ".join(f"WHEN {col} IN ({', '.join(repr(s) for s in codes.split())}) THEN '{r}'" for r, codes in REGIONS.items())
    return f"CASE {whens} ELSE 'UNKNOWN' END"


# --- dimensions -----------------------------------------------------------------------

_DIM_SQL: dict[str, tuple[str, str]] = {
    "dim_date": (
        "date_sk:i date_id:s calendar_date:d calendar_year:i month_of_year:i day_of_month:i day_of_week:i quarter_of_year:i day_name:s "
        "quarter_name:s month_seq:i week_seq:i fiscal_year:i is_holiday:b is_weekend:b year_month:s month_start:d is_business_day:b",
        """SELECT d_date_sk AS date_sk, d_date_id AS date_id, d_date AS calendar_date, d_year AS calendar_year, d_moy AS month_of_year,
        d_dom AS day_of_month, d_dow AS day_of_week, d_qoy AS quarter_of_year, d_day_name AS day_name, d_quarter_name AS quarter_name,
        d_month_seq AS month_seq, d_week_seq AS week_seq, d_fy_year AS fiscal_year, d_holiday = 'Y' AS is_holiday, d_weekend = 'Y' AS is_weekend,
        strftime(d_date, '%Y-%m') AS year_month, CAST(date_trunc('month', d_date) AS DATE) AS month_start,
        d_holiday <> 'Y' AND d_weekend <> 'Y' AS is_business_day FROM {src_date_dim}"""),
    "dim_time": (
        "time_sk:i hour_of_day:i minute_of_hour:i am_pm:s shift_name:s meal_time:s day_part:s",
        """SELECT DISTINCT t_time_sk AS time_sk, t_hour AS hour_of_day, t_minute AS minute_of_hour, t_am_pm AS am_pm, t_shift AS shift_name, t_meal_time AS meal_time,
        CASE WHEN t_hour >= 5 AND t_hour < 12 THEN 'MORNING' WHEN t_hour >= 12 AND t_hour < 17 THEN 'AFTERNOON' WHEN t_hour >= 17 AND t_hour < 22 THEN 'EVENING' ELSE 'OVERNIGHT' END AS day_part
        FROM {src_time_dim}"""),
    "dim_address": (
        "address_sk:i address_id:s street_address:s city:s county:s state_code:s country:s postal_code:s gmt_offset:f location_type:s is_zip_missing:b region:s",
        f"""SELECT *, postal_code = '00000' AS is_zip_missing, {_region('state_code')} AS region FROM (
        SELECT DISTINCT ca_address_sk AS address_sk, ca_address_id AS address_id,
        trim(concat_ws(' ', ca_street_number, ca_street_name, ca_street_type, ca_suite_number)) AS street_address,
        {_title('trim(ca_city)')} AS city, {_title('trim(ca_county)')} AS county, upper(trim(ca_state)) AS state_code,
        CASE WHEN ca_country IS NULL THEN 'Unknown' WHEN upper(trim(ca_country)) IN ('USA', 'US', 'UNITED STATES') THEN 'United States' ELSE {_title('trim(ca_country)')} END AS country,
        lpad(coalesce(trim(ca_zip), ''), 5, '0') AS postal_code, ca_gmt_offset AS gmt_offset, upper(trim(ca_location_type)) AS location_type
        FROM {{src_customer_address}})"""),
    "dim_item": (
        "item_sk:i item_id:s product_name:s product_description:s category:s category_id:i product_class:s class_id:i brand:s brand_id:i manufacturer:s manager_id:i "
        "size:s color:s unit_of_measure:s container:s list_price:f wholesale_cost:f valid_from:d valid_to:d is_current:b is_price_missing:b unit_margin:f margin_pct:f price_tier:s",
        f"""SELECT DISTINCT i_item_sk AS item_sk, i_item_id AS item_id, trim(i_product_name) AS product_name, trim(i_item_desc) AS product_description,
        upper(trim(i_category)) AS category, i_category_id AS category_id, upper(trim(i_class)) AS product_class, i_class_id AS class_id, trim(i_brand) AS brand,
        i_brand_id AS brand_id, trim(i_manufact) AS manufacturer, i_manager_id AS manager_id, trim(i_size) AS size, trim(i_color) AS color,
        trim(i_units) AS unit_of_measure, trim(i_container) AS container, i_current_price AS list_price, i_wholesale_cost AS wholesale_cost,
        i_rec_start_date AS valid_from, i_rec_end_date AS valid_to, i_rec_end_date IS NULL AS is_current, i_current_price IS NULL AS is_price_missing,
        i_current_price - i_wholesale_cost AS unit_margin,
        CASE WHEN i_current_price > 0 THEN {pct_('(i_current_price - i_wholesale_cost)', 'i_current_price', 2)} END AS margin_pct,
        CASE WHEN i_current_price >= 150 THEN 'LUXURY' WHEN i_current_price >= 50 THEN 'PREMIUM' WHEN i_current_price >= 10 THEN 'STANDARD' WHEN i_current_price IS NOT NULL THEN 'VALUE' ELSE 'UNPRICED' END AS price_tier
        FROM {{src_item}}"""),
    "dim_store": (
        "store_sk:i store_id:s store_name:s employee_count:i floor_space_sqft:i store_manager:s market_id:i market_description:s geography_class:s division_name:s "
        "company_name:s city:s state_code:s postal_code:s tax_percentage:f valid_from:d valid_to:d is_current:b size_band:s",
        f"""SELECT s_store_sk AS store_sk, s_store_id AS store_id, trim(s_store_name) AS store_name, s_number_employees AS employee_count, s_floor_space AS floor_space_sqft,
        trim(s_manager) AS store_manager, s_market_id AS market_id, trim(s_market_desc) AS market_description, trim(s_geography_class) AS geography_class,
        trim(s_division_name) AS division_name, trim(s_company_name) AS company_name, {_title('trim(s_city)')} AS city, upper(trim(s_state)) AS state_code,
        trim(s_zip) AS postal_code, s_tax_percentage AS tax_percentage, s_rec_start_date AS valid_from, s_rec_end_date AS valid_to, s_rec_end_date IS NULL AS is_current,
        CASE WHEN s_floor_space <= 4000 THEN 'SMALL' WHEN s_floor_space <= 8000 THEN 'MEDIUM' ELSE 'LARGE' END AS size_band
        FROM ({latest_('{src_store}', 's_store_sk', 's_rec_start_date')})"""),
    "dim_web_site": (
        "web_site_sk:i web_site_id:s site_name:s site_class:s site_manager:s market_class:s company_name:s state_code:s tax_percentage:f valid_from:d valid_to:d is_current:b",
        """SELECT web_site_sk, web_site_id, trim(web_name) AS site_name, trim(web_class) AS site_class, trim(web_manager) AS site_manager, trim(web_mkt_class) AS market_class,
        trim(web_company_name) AS company_name, upper(trim(web_state)) AS state_code, web_tax_percentage AS tax_percentage, web_rec_start_date AS valid_from,
        web_rec_end_date AS valid_to, web_rec_end_date IS NULL AS is_current FROM {src_web_site}"""),
    "dim_web_page": (
        "web_page_sk:i web_page_id:s page_url:s page_type:s is_autogenerated:b char_count:i link_count:i image_count:i",
        """SELECT wp_web_page_sk AS web_page_sk, wp_web_page_id AS web_page_id, trim(wp_url) AS page_url, upper(trim(wp_type)) AS page_type,
        wp_autogen_flag = 'Y' AS is_autogenerated, wp_char_count AS char_count, wp_link_count AS link_count, wp_image_count AS image_count FROM {src_web_page}"""),
    "dim_call_center": (
        "call_center_sk:i call_center_id:s call_center_name:s call_center_class:s employee_count:i manager:s division_name:s state_code:s tax_percentage:f",
        """SELECT cc_call_center_sk AS call_center_sk, cc_call_center_id AS call_center_id, trim(cc_name) AS call_center_name, trim(cc_class) AS call_center_class,
        cc_employees AS employee_count, trim(cc_manager) AS manager, trim(cc_division_name) AS division_name, upper(trim(cc_state)) AS state_code,
        cc_tax_percentage AS tax_percentage FROM {src_call_center}"""),
    "dim_catalog_page": (
        "catalog_page_sk:i catalog_page_id:s department:s catalog_number:i page_number:i catalog_type:s start_date_sk:i end_date_sk:i",
        """SELECT cp_catalog_page_sk AS catalog_page_sk, cp_catalog_page_id AS catalog_page_id, trim(cp_department) AS department, cp_catalog_number AS catalog_number,
        cp_catalog_page_number AS page_number, upper(trim(cp_type)) AS catalog_type, cp_start_date_sk AS start_date_sk, cp_end_date_sk AS end_date_sk FROM {src_catalog_page}"""),
    "dim_warehouse": (
        "warehouse_sk:i warehouse_id:s warehouse_name:s warehouse_sqft:i city:s state_code:s postal_code:s",
        f"""SELECT w_warehouse_sk AS warehouse_sk, w_warehouse_id AS warehouse_id, trim(w_warehouse_name) AS warehouse_name, w_warehouse_sq_ft AS warehouse_sqft,
        {_title('trim(w_city)')} AS city, upper(trim(w_state)) AS state_code, trim(w_zip) AS postal_code FROM {{src_warehouse}}"""),
    "dim_promotion": (
        "promo_sk:i promo_id:s promo_name:s promo_cost:f promoted_item_sk:i start_date_sk:i end_date_sk:i promo_purpose:s is_discount_active:b channel_email:b channel_direct_mail:b "
        "channel_catalog:b channel_tv:b channel_radio:b channel_press:b channel_event:b media_channel_count:i is_multichannel:b",
        """SELECT *, media_channel_count > 1 AS is_multichannel FROM (SELECT p_promo_sk AS promo_sk, p_promo_id AS promo_id, trim(p_promo_name) AS promo_name, p_cost AS promo_cost,
        p_item_sk AS promoted_item_sk, p_start_date_sk AS start_date_sk, p_end_date_sk AS end_date_sk, upper(trim(p_purpose)) AS promo_purpose, p_discount_active = 'Y' AS is_discount_active,
        p_channel_email = 'Y' AS channel_email, p_channel_dmail = 'Y' AS channel_direct_mail, p_channel_catalog = 'Y' AS channel_catalog, p_channel_tv = 'Y' AS channel_tv,
        p_channel_radio = 'Y' AS channel_radio, p_channel_press = 'Y' AS channel_press, p_channel_event = 'Y' AS channel_event,
        len(replace(p_channel_email || p_channel_dmail || p_channel_catalog || p_channel_tv || p_channel_radio || p_channel_press || p_channel_event, 'N', '')) AS media_channel_count
        FROM {src_promotion})"""),
    "dim_ship_mode": (
        "ship_mode_sk:i ship_mode_id:s ship_type:s ship_code:s carrier:s",
        """SELECT sm_ship_mode_sk AS ship_mode_sk, sm_ship_mode_id AS ship_mode_id, upper(trim(sm_type)) AS ship_type, trim(sm_code) AS ship_code, trim(sm_carrier) AS carrier FROM {src_ship_mode}"""),
    "dim_return_reason": (
        "reason_sk:i reason_id:s reason_description:s",
        "SELECT r_reason_sk AS reason_sk, r_reason_id AS reason_id, trim(r_reason_desc) AS reason_description FROM {src_reason}"),
    "dim_household": (
        "household_demo_sk:i income_band_sk:i buy_potential:s dependent_count:i vehicle_count:i",
        """SELECT hd_demo_sk AS household_demo_sk, hd_income_band_sk AS income_band_sk, trim(hd_buy_potential) AS buy_potential, hd_dep_count AS dependent_count,
        hd_vehicle_count AS vehicle_count FROM {src_household_demographics}"""),
    "dim_customer": (
        "customer_sk:i customer_id:s first_name:s last_name:s salutation:s email_address:s is_preferred:b birth_year:i birth_country:s first_sales_date_sk:i address_sk:i gender:s "
        "marital_status:s education_status:s credit_rating:s purchase_estimate:i dependent_count:i buy_potential:s vehicle_count:i income_lower_bound:i income_upper_bound:i city:s "
        "state_code:s postal_code:s country:s region:s full_name:s has_valid_email:b age_years:i age_band:s income_band_label:s",
        f"""SELECT *, concat_ws(' ', first_name, last_name) AS full_name, coalesce(email_address LIKE '%@%', false) AS has_valid_email,
        CASE WHEN age_years IS NULL THEN 'UNKNOWN' WHEN age_years >= 65 THEN '65+' WHEN age_years >= 55 THEN '55-64' WHEN age_years >= 45 THEN '45-54' WHEN age_years >= 35 THEN '35-44'
             WHEN age_years >= 25 THEN '25-34' ELSE '18-24' END AS age_band,
        CASE WHEN income_lower_bound IS NULL THEN 'UNKNOWN' ELSE '$' || (income_lower_bound // 1000) || 'k-$' || (income_upper_bound // 1000) || 'k' END AS income_band_label
        FROM (SELECT c_customer_sk AS customer_sk, c_customer_id AS customer_id, {_title('trim(c_first_name)')} AS first_name, {_title('trim(c_last_name)')} AS last_name,
        trim(c_salutation) AS salutation, lower(trim(c_email_address)) AS email_address, c_preferred_cust_flag = 'Y' AS is_preferred, c_birth_year AS birth_year,
        c_birth_country AS birth_country, c_first_sales_date_sk AS first_sales_date_sk, c_current_addr_sk AS address_sk, cd_gender AS gender, cd_marital_status AS marital_status,
        cd_education_status AS education_status, cd_credit_rating AS credit_rating, cd_purchase_estimate AS purchase_estimate, cd_dep_count AS dependent_count,
        hd_buy_potential AS buy_potential, hd_vehicle_count AS vehicle_count, ib_lower_bound AS income_lower_bound, ib_upper_bound AS income_upper_bound,
        city, state_code, postal_code, country, region, 2003 - c_birth_year AS age_years
        FROM (SELECT DISTINCT * FROM {{src_customer}}) LEFT JOIN {{src_customer_demographics}} ON c_current_cdemo_sk = cd_demo_sk
        LEFT JOIN {{src_household_demographics}} ON c_current_hdemo_sk = hd_demo_sk LEFT JOIN {{src_income_band}} ON hd_income_band_sk = ib_income_band_sk
        LEFT JOIN {{r_dim_address}} a ON c_current_addr_sk = a.address_sk)"""),
}

for _name, (_shape, _sql) in _DIM_SQL.items():
    relation(f"r_{_name}", _sql)
    query(_name, _shape, _sql)(lambda ctx, n=_name: ctx.retail.fresh(n))
assert set(_DIM_SQL) == {*DIMENSIONS, "dim_customer"}

# --- facts ----------------------------------------------------------------------------


def _cols(shape: list[tuple[str, str]], mapping: dict[str, str], channel: str, source: str) -> str:
    parts = [f"{mapping.get(n, 'NULL')} AS {n}" for n, _ in shape]
    return f"SELECT {', '.join(parts)}, '{channel}' AS channel FROM {{{source}}}"


def _prefixed(prefix: str, names: str, **renamed: str) -> dict[str, str]:
    return {n: f"{prefix}_{n}" for n in names.split()} | {k: f"{prefix}_{v}" for k, v in renamed.items()}


_MEASURES = ("quantity wholesale_cost list_price sales_price ext_discount_amt ext_sales_price ext_wholesale_cost ext_list_price "
             "ext_tax coupon_amt net_paid net_paid_inc_tax net_profit sold_date_sk sold_time_sk item_sk promo_sk")
_BILL = dict(customer_sk="bill_customer_sk", address_sk="bill_addr_sk", cdemo_sk="bill_cdemo_sk", hdemo_sk="bill_hdemo_sk")
_SHIP = " ship_date_sk ship_customer_sk ship_mode_sk warehouse_sk ext_ship_cost order_number"
relation("r_raw_sales", " UNION ALL ".join([
    _cols(facts.SALES_SHAPE, _prefixed("ss", _MEASURES + " customer_sk cdemo_sk hdemo_sk store_sk", address_sk="addr_sk", order_number="ticket_number"), "STORE", "src_store_sales"),
    _cols(facts.SALES_SHAPE, _prefixed("cs", _MEASURES + _SHIP + " call_center_sk catalog_page_sk", **_BILL), "CATALOG", "src_catalog_sales"),
    _cols(facts.SALES_SHAPE, _prefixed("ws", _MEASURES + _SHIP + " web_site_sk web_page_sk", **_BILL), "WEB", "src_web_sales"),
]))
_RET = "returned_date_sk item_sk reason_sk return_quantity return_tax return_amt_inc_tax return_ship_cost refunded_cash reversed_charge net_loss"
_REFUND = dict(customer_sk="refunded_customer_sk", address_sk="refunded_addr_sk", return_fee="fee", order_number="order_number", returned_time_sk="returned_time_sk")
relation("r_raw_returns", " UNION ALL ".join([
    _cols(facts.RETURNS_SHAPE, _prefixed("sr", _RET + " customer_sk store_sk store_credit", returned_time_sk="return_time_sk", address_sk="addr_sk", order_number="ticket_number", return_amount="return_amt", return_fee="fee"), "STORE", "src_store_returns"),
    _cols(facts.RETURNS_SHAPE, _prefixed("cr", _RET + " returning_customer_sk call_center_sk catalog_page_sk ship_mode_sk warehouse_sk store_credit return_amount", **_REFUND), "CATALOG", "src_catalog_returns"),
    _cols(facts.RETURNS_SHAPE, _prefixed("wr", _RET + " returning_customer_sk web_page_sk", **_REFUND, return_amount="return_amt", store_credit="account_credit"), "WEB", "src_web_returns"),
]))


def _rest(shape: list[tuple[str, str]], *without: str) -> str:
    return " ".join(n for n, _ in shape if n not in without)


_KEY = "channel, order_number, item_sk"
relation("r_flagged", f"""SELECT *, CASE WHEN sold_date_sk IS NULL THEN 'MISSING_SOLD_DATE' WHEN item_sk IS NULL THEN 'MISSING_ITEM'
    WHEN net_paid IS NULL THEN 'UNSETTLED_AMOUNT' WHEN quantity <= 0 THEN 'NON_POSITIVE_QUANTITY' END AS reject_reason
    FROM ({latest_('{r_raw_sales}', _KEY, 'sold_date_sk', _rest(facts.SALES_SHAPE, 'sold_date_sk', 'order_number', 'item_sk'))})""")
relation("r_sales", f"""SELECT *, CASE WHEN net_paid > 0 THEN {pct_('gross_margin', 'net_paid', 2)} END AS margin_pct,
    CASE WHEN ext_list_price > 0 THEN {pct_('discount_amount', 'ext_list_price', 2)} END AS discount_pct,
    promo_sk IS NOT NULL AND discount_amount > 0 AS is_promotional
    FROM (SELECT f.*, calendar_date AS sold_date, calendar_year AS sold_year, month_of_year AS sold_month, year_month AS sold_year_month, week_seq AS sold_week_seq,
      substr(sha256(channel || '|' || order_number || '|' || item_sk), 1, 32) AS sales_line_sk, ext_sales_price AS gross_revenue, net_paid AS net_revenue,
      ext_wholesale_cost AS cost_of_goods, coalesce(ext_discount_amt, 0) + coalesce(coupon_amt, 0) AS discount_amount,
      net_paid - coalesce(ext_wholesale_cost, 0) AS gross_margin, ship_date_sk IS NOT NULL AS is_shipped, ship_date_sk - sold_date_sk AS days_to_ship
      FROM {{r_flagged}} f JOIN {{r_dim_date}} ON sold_date_sk = date_sk WHERE reject_reason IS NULL)""")
relation("r_returns", f"""SELECT r.*, calendar_date AS returned_date, calendar_year AS returned_year, year_month AS returned_year_month,
    substr(sha256(channel || '|' || order_number || '|' || item_sk), 1, 32) AS return_line_sk,
    coalesce(refunded_cash, 0) + coalesce(reversed_charge, 0) + coalesce(store_credit, 0) AS total_refund,
    CASE WHEN refunded_cash >= coalesce(reversed_charge, 0) AND refunded_cash >= coalesce(store_credit, 0) THEN 'CASH'
         WHEN reversed_charge >= coalesce(store_credit, 0) THEN 'CARD_REVERSAL' ELSE 'STORE_CREDIT' END AS refund_method
    FROM ({latest_('{r_raw_returns}', _KEY, 'returned_date_sk', _rest(facts.RETURNS_SHAPE, 'returned_date_sk', 'order_number', 'item_sk'))}) r
    JOIN {{r_dim_date}} ON returned_date_sk = date_sk WHERE item_sk IS NOT NULL""")
relation("r_inventory", """SELECT *, quantity_on_hand <= 0 AS is_out_of_stock,
    CASE WHEN quantity_on_hand >= 500 THEN 'OVERSTOCKED' WHEN quantity_on_hand >= 100 THEN 'HEALTHY' WHEN quantity_on_hand > 0 THEN 'LOW' ELSE 'OUT_OF_STOCK' END AS stock_band
    FROM (SELECT inv_date_sk AS snapshot_date_sk, inv_item_sk AS item_sk, inv_warehouse_sk AS warehouse_sk, coalesce(inv_quantity_on_hand, 0) AS quantity_on_hand,
      calendar_date AS snapshot_date, calendar_year AS snapshot_year, week_seq AS snapshot_week_seq FROM {src_inventory} JOIN {r_dim_date} ON inv_date_sk = date_sk)""")


def _typed(shape: list[tuple[str, str]]) -> str:
    return " ".join(f"{n}:{'f' if t.startswith('decimal') else 'i'}" for n, t in shape) + " channel:s "


query("fct_sales", _typed(facts.SALES_SHAPE) + "sold_date:d sold_year:i sold_month:i sold_year_month:s sales_line_sk:s gross_revenue:f net_revenue:f cost_of_goods:f discount_amount:f "
      "gross_margin:f is_shipped:b days_to_ship:i margin_pct:f discount_pct:f is_promotional:b", "SELECT * FROM {r_sales}")(
    lambda ctx: facts.fct_sales(facts.flagged_sales(ctx.retail.raw_sales()), ctx.retail.fresh("dim_date")))
query("dq_rejects_sales", _typed(facts.SALES_SHAPE) + "reject_reason:s", "SELECT * FROM {r_flagged} WHERE reject_reason IS NOT NULL")(
    lambda ctx: facts.sales_rejects(facts.flagged_sales(ctx.retail.raw_sales())))
query("dq_reject_split", "outcome:s lines:i amount:f", """SELECT coalesce(reject_reason, 'CLEAN') AS outcome, count(*) AS lines, sum(net_paid) AS amount FROM {r_flagged} GROUP BY 1""")(
    lambda ctx: facts.flagged_sales(ctx.retail.raw_sales()).selectExpr("coalesce(reject_reason, 'CLEAN') AS outcome", "net_paid")
    .groupBy("outcome").agg({"*": "count", "net_paid": "sum"}).withColumnsRenamed({"count(1)": "lines", "sum(net_paid)": "amount"}))
query("fct_returns", _typed(facts.RETURNS_SHAPE) + "returned_date:d returned_year:i returned_year_month:s return_line_sk:s total_refund:f refund_method:s", "SELECT * FROM {r_returns}")(
    lambda ctx: facts.fct_returns(ctx.retail.raw_returns(), ctx.retail.fresh("dim_date")))
query("fct_inventory", "snapshot_date_sk:i item_sk:i warehouse_sk:i quantity_on_hand:i snapshot_date:d snapshot_year:i snapshot_week_seq:i is_out_of_stock:b stock_band:s", "SELECT * FROM {r_inventory}")(
    lambda ctx: facts.fct_inventory(ctx.retail.raw_inventory(), ctx.retail.fresh("dim_date")))
query("sales_by_channel_year", "channel:s sold_year:i lines:i net_revenue_musd:f",
      f"SELECT channel, sold_year, count(*) AS lines, {rnd('CAST(sum(net_revenue) AS DOUBLE) / 1e6', 1)} AS net_revenue_musd FROM {{r_sales}} GROUP BY 1, 2")(
    lambda ctx: facts.sales_by_channel_year(ctx.retail.silver("fct_sales")))

# --- ledger ---------------------------------------------------------------------------


def _line(table: str, rule: str, scope: str, sql: str) -> str:
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{scope}' AS scope, CAST(({sql}) AS BIGINT) AS metric_value"


def _dups(feed: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {{{feed}}} GROUP BY {key} HAVING count(*) > 1)"


_N = "SELECT count(*) FROM "
relation("r_ledger", " UNION ALL ".join([
    _line("dim_address", "bronze rows", "in", _N + "{src_customer_address}"),
    _line("dim_address", "duplicate address keys", "in", _dups("src_customer_address", "ca_address_sk")),
    _line("dim_address", "lower-case state codes", "in", _N + "{src_customer_address} WHERE ca_state <> upper(ca_state)"),
    _line("dim_address", "null zip", "in", _N + "{src_customer_address} WHERE ca_zip IS NULL"),
    _line("dim_address", "distinct country spellings", "in", _N + "(SELECT DISTINCT ca_country FROM {src_customer_address})"),
    _line("dim_address", "rows published", "out", _N + "{r_dim_address}"),
    _line("dim_address", "country spellings after", "out", "SELECT count(DISTINCT country) FROM {r_dim_address}"),
    _line("dim_customer", "bronze rows", "in", _N + "{src_customer}"),
    _line("dim_customer", "duplicate customer keys", "in", _dups("src_customer", "c_customer_sk")),
    _line("dim_customer", "missing email", "in", _N + "{src_customer} WHERE c_email_address IS NULL"),
    _line("dim_customer", "untrimmed first name", "in", _N + "{src_customer} WHERE c_first_name <> trim(c_first_name)"),
    _line("dim_customer", "rows published", "out", _N + "{r_dim_customer}"),
    _line("dim_customer", "valid email", "out", _N + "{r_dim_customer} WHERE has_valid_email"),
    _line("dim_customer", "demographics matched", "out", _N + "{r_dim_customer} WHERE gender IS NOT NULL"),
    _line("dim_item", "bronze rows", "in", _N + "{src_item}"),
    _line("dim_item", "duplicate item keys", "in", _dups("src_item", "i_item_sk")),
    _line("dim_item", "missing price", "in", _N + "{src_item} WHERE i_current_price IS NULL"),
    _line("dim_item", "untrimmed category", "in", _N + "{src_item} WHERE i_category <> trim(i_category)"),
    _line("dim_item", "rows published", "out", _N + "{r_dim_item}"),
    _line("dim_item", "current records", "out", _N + "{r_dim_item} WHERE is_current"),
    _line("fct_sales", "bronze rows (3 channels)", "in", _N + "{r_raw_sales}"),
    _line("fct_sales", "duplicate lines removed", "clean", "SELECT (SELECT count(*) FROM {r_raw_sales}) - (SELECT count(*) FROM {r_flagged})"),
    "SELECT 'fct_sales', 'rejected: ' || reject_reason, 'reject', count(*) FROM {r_flagged} WHERE reject_reason IS NOT NULL GROUP BY reject_reason",
    _line("fct_sales", "rows published", "out", _N + "{r_sales}"),
]))
relation("r_ledger_two", " UNION ALL ".join([
    _line("fct_returns", "bronze rows (3 channels)", "in", _N + "{r_raw_returns}"),
    _line("fct_returns", "duplicate lines removed", "clean", f"SELECT (SELECT count(*) FROM {{r_raw_returns}}) - (SELECT count(*) FROM (SELECT DISTINCT {_KEY} FROM {{r_raw_returns}}))"),
    _line("fct_returns", "rows published", "out", _N + "{r_returns}"),
    _line("fct_inventory", "bronze rows", "in", _N + "{src_inventory}"),
    _line("fct_inventory", "rows published", "out", _N + "{r_inventory}"),
    _line("fct_inventory", "out-of-stock snapshots", "out", _N + "{r_inventory} WHERE is_out_of_stock"),
]))
_LEDGER = "table_name:s rule:s scope:s metric_value:i"
query("dq_ledger", _LEDGER, "SELECT * FROM {r_ledger}")(lambda ctx: ctx.retail.ledger_part_one())
query("dq_ledger_rules", _LEDGER, "SELECT * FROM {r_ledger_two}")(lambda ctx: ctx.retail.ledger_part_two())

# --- marts ----------------------------------------------------------------------------

_OK = "channel || '|' || order_number"
_SUMS = "sum(quantity) AS units_sold, sum(net_revenue) AS net_revenue, sum(gross_margin) AS gross_margin, sum(discount_amount) AS discount_given"
relation("m_kpi_daily_executive", f"""
WITH s AS (SELECT sold_date, sold_year, sold_year_month, count(DISTINCT {_OK}) AS orders, count(*) AS order_lines, count(DISTINCT customer_sk) AS active_customers,
    sum(gross_revenue) AS gross_revenue, {_SUMS}, count(*) FILTER (is_promotional) AS promotional_lines FROM {{r_sales}} GROUP BY 1, 2, 3),
  r AS (SELECT returned_date, count(*) AS return_lines, sum(return_quantity) AS units_returned, sum(total_refund) AS refund_amount, sum(net_loss) AS return_net_loss FROM {{r_returns}} GROUP BY 1),
  k AS (SELECT s.*, coalesce(return_lines, 0) AS return_lines, coalesce(units_returned, 0) AS units_returned, coalesce(refund_amount, 0) AS refund_amount, return_net_loss,
    day_name, is_weekend, is_holiday, quarter_name FROM s LEFT JOIN r ON sold_date = returned_date LEFT JOIN {{r_dim_date}} ON sold_date = calendar_date)
SELECT *, net_revenue - refund_amount AS net_revenue_after_returns, {div_('net_revenue', 'orders', 2)} AS average_order_value, {divn_('units_sold', 'orders', 2)} AS units_per_order,
  {pctn_('units_returned', 'units_sold', 2)} AS return_rate_pct, {pct_('gross_margin', 'net_revenue', 2)} AS margin_pct, {pct_('discount_given', 'gross_revenue', 2)} AS discount_rate_pct,
  {rnd('CAST(sum(net_revenue) OVER w AS DOUBLE) / count(*) OVER w', 2, 9)} AS net_revenue_7d_avg, {rnd('CAST(sum(orders) OVER w AS DOUBLE) / count(*) OVER w', 1)} AS orders_7d_avg
FROM k WINDOW w AS (ORDER BY sold_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""")


def _trend_sql(base: str, group: str, year_ago: str, share: str) -> str:
    at = "CAST(substr({t}.sold_year_month, 1, 4) AS INT) * 12 + CAST(substr({t}.sold_year_month, 6, 2) AS INT)"
    return f"""
SELECT *, {pct_('(net_revenue - prev_month_revenue)', 'prev_month_revenue', 2)} AS mom_growth_pct, {pct_(f'(net_revenue - {year_ago})', year_ago, 2)} AS yoy_growth_pct,
  {pct_('net_revenue', 'month_total', 2)} AS {share}
FROM (SELECT a.*, y.net_revenue AS {year_ago}, lag(a.net_revenue) OVER (PARTITION BY a.{group} ORDER BY a.sold_year_month) AS prev_month_revenue,
        sum(a.net_revenue) OVER (PARTITION BY a.sold_year_month) AS month_total
      FROM ({base}) a LEFT JOIN ({base}) y ON a.{group} IS NOT DISTINCT FROM y.{group} AND {at.format(t='a')} = {at.format(t='y')} + 12)"""


_CHANNEL_BASE = f"""SELECT channel, sold_year, sold_year_month, count(DISTINCT {_OK}) AS orders, count(*) AS order_lines, count(DISTINCT customer_sk) AS active_customers, {_SUMS},
  {div_('sum(net_revenue)', f'count(DISTINCT {_OK})', 2)} AS average_order_value, {pct_('sum(gross_margin)', 'sum(net_revenue)', 2)} AS margin_pct FROM {{r_sales}} GROUP BY 1, 2, 3"""
relation("m_agg_sales_by_channel_month", _trend_sql(_CHANNEL_BASE, "channel", "same_month_last_year_revenue", "channel_revenue_share_pct"))
_CATEGORY_BASE = f"""SELECT category, sold_year, sold_year_month, count(DISTINCT {_OK}) AS orders, count(DISTINCT customer_sk) AS active_customers, {_SUMS},
  {pct_('sum(gross_margin)', 'sum(net_revenue)', 2)} AS margin_pct, {pct_('sum(discount_amount)', 'sum(net_revenue)', 2)} AS discount_rate_pct
  FROM {{r_sales}} LEFT JOIN {{r_dim_item}} USING (item_sk) GROUP BY 1, 2, 3"""
_CATEGORY_BASE = _CATEGORY_BASE.replace("FROM {r_sales} LEFT JOIN {r_dim_item} USING (item_sk)", "FROM {r_sales} LEFT JOIN (SELECT item_sk, category FROM {r_dim_item}) USING (item_sk)")
relation("m_agg_category_trend_month", f"""SELECT *, CASE WHEN yoy_growth_pct IS NULL THEN 'NO_BASELINE' WHEN yoy_growth_pct > 10 THEN 'GROWING' WHEN yoy_growth_pct < -10 THEN 'DECLINING' ELSE 'FLAT' END AS trend
  FROM ({_trend_sql(_CATEGORY_BASE, 'category', 'last_year_revenue', 'category_share_pct')})""")
relation("m_agg_store_performance_month", f"""
WITH m AS (SELECT store_sk, sold_year, sold_year_month, count(DISTINCT {_OK}) AS transactions, sum(quantity) AS units_sold, count(DISTINCT customer_sk) AS unique_customers,
    sum(net_revenue) AS net_revenue, sum(gross_margin) AS gross_margin FROM {{r_sales}} WHERE channel = 'STORE' AND store_sk IS NOT NULL GROUP BY 1, 2, 3)
SELECT m.*, store_name, state_code, city, floor_space_sqft, employee_count, size_band, market_description, division_name,
  {div_('net_revenue', 'transactions', 2)} AS basket_size, {divn_('units_sold', 'transactions', 2)} AS units_per_transaction, {pct_('gross_margin', 'net_revenue', 2)} AS margin_pct,
  {div_('net_revenue', 'floor_space_sqft', 2)} AS revenue_per_sqft, {div_('net_revenue', 'employee_count', 2)} AS revenue_per_employee,
  rank() OVER (PARTITION BY sold_year_month ORDER BY net_revenue DESC) AS revenue_rank_in_month,
  {rnd('percent_rank() OVER (PARTITION BY sold_year_month ORDER BY net_revenue) * 100', 1)} AS revenue_percentile
FROM m LEFT JOIN {{r_dim_store}} USING (store_sk)""")
relation("m_agg_product_performance", f"""
WITH s AS (SELECT item_sk, sold_year, count(*) AS order_lines, count(DISTINCT customer_sk) AS unique_buyers, count(DISTINCT {_OK}) AS orders, {_SUMS},
    count(*) FILTER (is_promotional) AS promotional_lines FROM {{r_sales}} GROUP BY 1, 2),
  r AS (SELECT item_sk, returned_year AS sold_year, sum(return_quantity) AS units_returned, sum(total_refund) AS refund_amount FROM {{r_returns}} GROUP BY 1, 2),
  p AS (SELECT s.*, coalesce(r.units_returned, 0) AS units_returned, coalesce(r.refund_amount, 0) AS refund_amount, product_name, category, product_class, brand, manufacturer, list_price,
    wholesale_cost, price_tier, i.margin_pct AS catalog_margin_pct FROM s LEFT JOIN r USING (item_sk, sold_year) LEFT JOIN {{r_dim_item}} i USING (item_sk)),
  q AS (SELECT *, net_revenue - refund_amount AS net_revenue_after_returns, {pctn_('units_returned', 'units_sold', 2)} AS return_rate_pct, {pct_('gross_margin', 'net_revenue', 2)} AS realised_margin_pct,
    {div_('net_revenue', 'units_sold', 2)} AS avg_selling_price, {pctn_('promotional_lines', 'order_lines', 2)} AS promo_line_share_pct,
    rank() OVER (PARTITION BY category, sold_year ORDER BY net_revenue DESC) AS rank_in_category, rank() OVER (PARTITION BY sold_year ORDER BY net_revenue DESC) AS rank_overall FROM p)
SELECT *, CASE WHEN rank_in_category <= 50 AND return_rate_pct < 5 THEN 'STAR' WHEN return_rate_pct > 15 THEN 'HIGH_RETURN_RISK' WHEN realised_margin_pct < 0 THEN 'LOSS_MAKING'
  WHEN units_sold < 10 THEN 'SLOW_MOVER' ELSE 'STEADY' END AS performance_flag FROM q""")
relation("m_dim_customer_rfm", f"""
WITH t AS (SELECT customer_sk, max(sold_date) AS last_purchase_date, min(sold_date) AS first_purchase_date, count(DISTINCT {_OK}) AS order_count, count(*) AS line_count,
    sum(quantity) AS units_bought, sum(net_revenue) AS lifetime_revenue, sum(gross_margin) AS lifetime_margin, sum(discount_amount) AS lifetime_discount,
    count(DISTINCT channel) AS channels_used, count(DISTINCT item_sk) AS distinct_items FROM {{r_sales}} WHERE customer_sk IS NOT NULL GROUP BY 1),
  r AS (SELECT customer_sk, count(*) AS return_count, sum(total_refund) AS lifetime_refunds FROM {{r_returns}} GROUP BY 1),
  b AS (SELECT t.*, coalesce(return_count, 0) AS return_count, coalesce(lifetime_refunds, 0) AS lifetime_refunds,
    date_diff('day', last_purchase_date, (SELECT max(sold_date) FROM {{r_sales}})) AS recency_days, date_diff('day', first_purchase_date, (SELECT max(sold_date) FROM {{r_sales}})) AS tenure_days,
    lifetime_revenue - coalesce(lifetime_refunds, 0) AS net_lifetime_value, {div_('lifetime_revenue', 'order_count', 2)} AS average_order_value,
    {pctn_('coalesce(return_count, 0)', 'line_count', 2)} AS return_rate_pct FROM t LEFT JOIN r USING (customer_sk)),
  n AS (SELECT *, 6 - ntile(5) OVER (ORDER BY recency_days, customer_sk) AS r_score, ntile(5) OVER (ORDER BY order_count, customer_sk) AS f_score,
    ntile(5) OVER (ORDER BY net_lifetime_value, customer_sk) AS m_score FROM b)
SELECT n.*, CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_score, r_score + f_score + m_score AS rfm_total,
  CASE WHEN least(r_score, f_score, m_score) >= 4 THEN 'CHAMPION' WHEN r_score >= 4 AND f_score >= 3 THEN 'LOYAL' WHEN r_score >= 4 AND f_score <= 2 THEN 'NEW_OR_PROMISING'
    WHEN r_score <= 2 AND m_score >= 4 THEN 'AT_RISK_HIGH_VALUE' WHEN r_score <= 2 AND f_score <= 2 THEN 'HIBERNATING' ELSE 'NEEDS_ATTENTION' END AS customer_segment,
  channels_used > 1 AS is_omnichannel, customer_id, full_name, email_address, age_band, gender, marital_status, income_band_label, buy_potential, credit_rating, state_code, region, is_preferred, has_valid_email
FROM n LEFT JOIN {{r_dim_customer}} USING (customer_sk)""")
relation("m_agg_customer_channel_mix", f"""
WITH c AS (SELECT customer_sk, channel, sum(net_revenue) AS channel_revenue, count(DISTINCT {_OK}) AS channel_orders FROM {{r_sales}} WHERE customer_sk IS NOT NULL GROUP BY 1, 2),
  x AS (SELECT *, sum(channel_revenue) OVER w AS total_revenue, sum(channel_orders) OVER w AS total_orders, count(*) OVER w AS channels_used,
    first_value(channel) OVER (PARTITION BY customer_sk ORDER BY channel_revenue DESC, channel) AS primary_channel FROM c WINDOW w AS (PARTITION BY customer_sk))
SELECT *, {pct_('channel_revenue', 'total_revenue', 2)} AS channel_revenue_share_pct, channel = primary_channel AS is_primary_channel,
  CASE WHEN channels_used >= 3 THEN 'TRI_CHANNEL' WHEN channels_used = 2 THEN 'OMNICHANNEL' ELSE 'SINGLE_CHANNEL' END AS shopper_type FROM x""")
relation("m_agg_promotion_effectiveness", f"""
WITH b AS (SELECT item_sk, CAST(CAST(CAST(sum(net_revenue) AS DOUBLE) / count(net_revenue) AS VARCHAR) AS DECIMAL(22,6)) AS per_line FROM {{r_sales}} WHERE NOT is_promotional GROUP BY 1),
  p AS (SELECT promo_sk, channel, item_sk, count(*) AS lines, sum(quantity) AS units, sum(net_revenue) AS revenue, sum(discount_amount) AS discount, sum(gross_margin) AS margin,
    count(DISTINCT customer_sk) AS customers FROM {{r_sales}} WHERE is_promotional GROUP BY 1, 2, 3),
  e AS (SELECT promo_sk, channel, count(DISTINCT item_sk) AS items_promoted, sum(lines) AS promoted_lines, sum(units) AS promoted_units, sum(revenue) AS promoted_revenue,
    sum(discount) AS discount_invested, sum(margin) AS promoted_margin, sum(customers) AS customers_reached,
    CAST(sum(per_line * CAST(lines AS DECIMAL(10,0))) AS DECIMAL(18,2)) AS expected_revenue_without_promo, count(*) - count(per_line) AS items_without_baseline
    FROM p LEFT JOIN b USING (item_sk) GROUP BY 1, 2),
  g AS (SELECT e.*, promo_name, promo_purpose, promo_cost, is_discount_active, media_channel_count, is_multichannel, channel_email, channel_tv, channel_catalog,
    promoted_revenue - expected_revenue_without_promo AS incremental_revenue, coalesce(promo_cost, 0) + discount_invested AS total_investment FROM e LEFT JOIN {{r_dim_promotion}} USING (promo_sk)),
  h AS (SELECT *, {pct_('incremental_revenue', 'expected_revenue_without_promo', 2)} AS revenue_lift_pct, {pct_('incremental_revenue', 'total_investment', 2)} AS roi_pct,
    {div_('promoted_revenue', 'customers_reached', 2)} AS revenue_per_customer FROM g)
SELECT *, CASE WHEN roi_pct IS NULL THEN 'INSUFFICIENT_DATA' WHEN roi_pct > 100 THEN 'STRONG_WINNER' WHEN roi_pct > 0 THEN 'MARGINAL' ELSE 'VALUE_DESTROYING' END AS verdict FROM h""")
relation("m_agg_returns_by_reason_month", f"""
WITH g AS (SELECT returned_year_month, returned_year, channel, reason_description, category, count(*) AS return_lines, sum(return_quantity) AS units_returned,
    count(DISTINCT customer_sk) AS returning_customers, sum(total_refund) AS refund_amount, sum(net_loss) AS net_loss, sum(return_ship_cost) AS return_shipping_cost
    FROM {{r_returns}} LEFT JOIN {{r_dim_return_reason}} USING (reason_sk) LEFT JOIN (SELECT item_sk, category FROM {{r_dim_item}}) USING (item_sk) GROUP BY 1, 2, 3, 4, 5)
SELECT *, {div_('refund_amount', 'units_returned', 2)} AS avg_refund_per_unit, {pctn_('units_returned', 'sum(units_returned) OVER (PARTITION BY returned_year_month)', 2)} AS share_of_month_returns_pct,
  rank() OVER (PARTITION BY returned_year_month ORDER BY units_returned DESC NULLS LAST) AS reason_rank_in_month FROM g""")
relation("m_agg_inventory_health_weekly", f"""
WITH k AS (SELECT snapshot_year, snapshot_week_seq, warehouse_sk, item_sk, avg(quantity_on_hand) AS avg_on_hand, min(quantity_on_hand) AS min_on_hand, max(quantity_on_hand) AS max_on_hand,
    count(*) FILTER (is_out_of_stock) AS stockout_snapshots, count(*) AS snapshots FROM {{r_inventory}} GROUP BY 1, 2, 3, 4),
  d AS (SELECT sold_year AS snapshot_year, sold_week_seq AS snapshot_week_seq, warehouse_sk, item_sk, sum(quantity) AS units_shipped, sum(net_revenue) AS week_revenue
    FROM {{r_sales}} WHERE warehouse_sk IS NOT NULL GROUP BY 1, 2, 3, 4),
  j AS (SELECT k.*, coalesce(units_shipped, 0) AS units_shipped, coalesce(week_revenue, 0) AS week_revenue FROM k LEFT JOIN d USING (snapshot_year, snapshot_week_seq, warehouse_sk, item_sk)),
  c AS (SELECT *, {divn_('avg_on_hand', 'units_shipped', 1)} AS weeks_of_cover, {pctn_('stockout_snapshots', 'snapshots', 1)} AS stockout_rate_pct FROM j)
SELECT c.*, CASE WHEN min_on_hand <= 0 THEN 'STOCKED_OUT' WHEN weeks_of_cover < 2 THEN 'REORDER_NOW' WHEN weeks_of_cover > 26 THEN 'EXCESS_STOCK' ELSE 'HEALTHY' END AS stock_status,
  warehouse_name, w.state_code, product_name, category, price_tier FROM c LEFT JOIN {{r_dim_warehouse}} w USING (warehouse_sk) LEFT JOIN {{r_dim_item}} USING (item_sk)""")
relation("m_agg_category_affinity", f"""
WITH b AS (SELECT DISTINCT {_OK} AS order_key, channel, category FROM {{r_sales}} JOIN (SELECT item_sk, category FROM {{r_dim_item}}) USING (item_sk)
    WHERE category IS NOT NULL AND sold_year = (SELECT max(sold_year) FROM {{r_sales}})),
  p AS (SELECT a.channel, a.category AS category_a, z.category AS category_b, count(*) AS baskets_together FROM b a JOIN b z ON a.order_key = z.order_key AND a.category < z.category GROUP BY 1, 2, 3),
  t AS (SELECT channel, category, count(*) AS n FROM b GROUP BY 1, 2),
  j AS (SELECT p.*, x.n AS baskets_a, y.n AS baskets_b, (SELECT max(sold_year) FROM {{r_sales}}) AS analysis_year, (SELECT count(DISTINCT order_key) FROM b) AS total_baskets
    FROM p JOIN t x ON p.channel = x.channel AND category_a = x.category JOIN t y ON p.channel = y.channel AND category_b = y.category),
  l AS (SELECT *, {pctn_('baskets_together', 'total_baskets', 4)} AS support_pct, {pctn_('baskets_together', 'baskets_a', 2)} AS confidence_a_to_b_pct,
    {divn_('(baskets_together * total_baskets)', '(baskets_a * baskets_b)', 3)} AS lift FROM j)
SELECT *, CASE WHEN lift > 1.2 THEN 'STRONG' WHEN lift > 1.0 THEN 'POSITIVE' ELSE 'NONE' END AS affinity_strength FROM l""")

_MART_SHAPES = {
    "kpi_daily_executive": "sold_date:d sold_year:i sold_year_month:s orders:i order_lines:i units_sold:i active_customers:i gross_revenue:f discount_given:f net_revenue:f gross_margin:f "
        "promotional_lines:i return_lines:i units_returned:i refund_amount:f return_net_loss:f day_name:s is_weekend:b is_holiday:b quarter_name:s net_revenue_after_returns:f "
        "average_order_value:f units_per_order:f return_rate_pct:f margin_pct:f discount_rate_pct:f net_revenue_7d_avg:f orders_7d_avg:f",
    "agg_sales_by_channel_month": "channel:s sold_year:i sold_year_month:s orders:i order_lines:i units_sold:i active_customers:i net_revenue:f gross_margin:f discount_given:f average_order_value:f "
        "margin_pct:f prev_month_revenue:f mom_growth_pct:f same_month_last_year_revenue:f yoy_growth_pct:f channel_revenue_share_pct:f",
    "agg_store_performance_month": "store_sk:i sold_year:i sold_year_month:s transactions:i units_sold:i unique_customers:i net_revenue:f gross_margin:f store_name:s state_code:s city:s "
        "floor_space_sqft:i employee_count:i size_band:s market_description:s division_name:s basket_size:f units_per_transaction:f margin_pct:f revenue_per_sqft:f revenue_per_employee:f "
        "revenue_rank_in_month:i revenue_percentile:f",
    "agg_product_performance": "item_sk:i sold_year:i order_lines:i units_sold:i unique_buyers:i orders:i net_revenue:f gross_margin:f discount_given:f promotional_lines:i units_returned:i refund_amount:f "
        "product_name:s category:s product_class:s brand:s manufacturer:s list_price:f wholesale_cost:f price_tier:s catalog_margin_pct:f net_revenue_after_returns:f return_rate_pct:f "
        "realised_margin_pct:f avg_selling_price:f promo_line_share_pct:f rank_in_category:i rank_overall:i performance_flag:s",
    "agg_category_trend_month": "category:s sold_year:i sold_year_month:s units_sold:i orders:i active_customers:i net_revenue:f gross_margin:f discount_given:f margin_pct:f discount_rate_pct:f "
        "prev_month_revenue:f mom_growth_pct:f last_year_revenue:f yoy_growth_pct:f category_share_pct:f trend:s",
    "dim_customer_rfm": "customer_sk:i last_purchase_date:d first_purchase_date:d order_count:i line_count:i units_bought:i lifetime_revenue:f lifetime_margin:f lifetime_discount:f channels_used:i "
        "distinct_items:i return_count:i lifetime_refunds:f recency_days:i tenure_days:i net_lifetime_value:f average_order_value:f return_rate_pct:f r_score:i f_score:i m_score:i rfm_score:s "
        "rfm_total:i customer_segment:s is_omnichannel:b customer_id:s full_name:s email_address:s age_band:s gender:s marital_status:s income_band_label:s buy_potential:s credit_rating:s "
        "state_code:s region:s is_preferred:b has_valid_email:b",
    "agg_customer_channel_mix": "customer_sk:i channel:s channel_revenue:f channel_orders:i total_revenue:f total_orders:i channels_used:i primary_channel:s channel_revenue_share_pct:f is_primary_channel:b shopper_type:s",
    "agg_promotion_effectiveness": "promo_sk:i channel:s items_promoted:i promoted_lines:i promoted_units:i promoted_revenue:f discount_invested:f promoted_margin:f customers_reached:i "
        "expected_revenue_without_promo:f items_without_baseline:i promo_name:s promo_purpose:s promo_cost:f is_discount_active:b media_channel_count:i is_multichannel:b channel_email:b channel_tv:b "
        "channel_catalog:b incremental_revenue:f revenue_lift_pct:f total_investment:f roi_pct:f revenue_per_customer:f verdict:s",
    "agg_returns_by_reason_month": "returned_year_month:s returned_year:i channel:s reason_description:s category:s return_lines:i units_returned:i returning_customers:i refund_amount:f net_loss:f "
        "return_shipping_cost:f avg_refund_per_unit:f share_of_month_returns_pct:f reason_rank_in_month:i",
    "agg_inventory_health_weekly": "snapshot_year:i snapshot_week_seq:i warehouse_sk:i item_sk:i avg_on_hand:f min_on_hand:i max_on_hand:i stockout_snapshots:i snapshots:i units_shipped:i week_revenue:f "
        "weeks_of_cover:f stockout_rate_pct:f stock_status:s warehouse_name:s state_code:s product_name:s category:s price_tier:s",
    "agg_category_affinity": "channel:s category_a:s category_b:s baskets_together:i baskets_a:i baskets_b:i analysis_year:i total_baskets:i support_pct:f confidence_a_to_b_pct:f lift:f affinity_strength:s",
}
for _mart in MARTS:
    query(_mart, _MART_SHAPES[_mart], f"SELECT * FROM {{m_{_mart}}}")(lambda ctx, n=_mart: ctx.retail.mart(n))

# --- reports --------------------------------------------------------------------------

relation("m_dq_metrics", "SELECT * FROM {r_ledger} UNION ALL SELECT * FROM {r_ledger_two}")
relation("m_dq_rejects_sales", "SELECT * FROM {r_flagged} WHERE reject_reason IS NOT NULL")


def _musd(x: str, digits: int) -> str:
    return rnd(f"CAST(sum({x}) AS DOUBLE) / 1e6", digits)


_REPORTS = {
    "rpt_kpi_last10": ("sold_date:d orders:i units_sold:i net_revenue:f average_order_value:f return_rate_pct:f margin_pct:f",
        "SELECT * FROM {m_kpi_daily_executive} ORDER BY sold_date DESC LIMIT 10"),
    "rpt_channel_share": ("channel:s sold_year:i net_revenue:f avg_share_pct:f",
        f"SELECT channel, sold_year, sum(net_revenue) AS net_revenue, {mean_('channel_revenue_share_pct', 1)} AS avg_share_pct FROM {{m_agg_sales_by_channel_month}} GROUP BY 1, 2"),
    "rpt_product_flags": ("performance_flag:s products:i revenue_musd:f",
        f"SELECT performance_flag, count(*) AS products, {_musd('net_revenue', 1)} AS revenue_musd FROM {{m_agg_product_performance}} GROUP BY 1"),
    "rpt_rfm_segments": ("customer_segment:s customers:i ltv_musd:f avg_aov:f avg_recency_days:f",
        f"SELECT customer_segment, count(*) AS customers, {_musd('net_lifetime_value', 1)} AS ltv_musd, {mean_('average_order_value', 2)} AS avg_aov, {mean_('recency_days', 0)} AS avg_recency_days FROM {{m_dim_customer_rfm}} GROUP BY 1"),
    "rpt_shopper_type": ("shopper_type:s customers:i avg_total_revenue:f",
        f"SELECT shopper_type, count(DISTINCT customer_sk) AS customers, {mean_('total_revenue', 2)} AS avg_total_revenue FROM {{m_agg_customer_channel_mix}} GROUP BY 1"),
    "rpt_promo_verdict": ("verdict:s promo_channel_combos:i promoted_revenue_musd:f avg_lift_pct:f",
        f"SELECT verdict, count(*) AS promo_channel_combos, {_musd('promoted_revenue', 2)} AS promoted_revenue_musd, {mean_('revenue_lift_pct', 1)} AS avg_lift_pct FROM {{m_agg_promotion_effectiveness}} GROUP BY 1"),
    "rpt_top_return_reasons": ("reason_description:s units:i net_loss_musd:f",
        f"SELECT reason_description, sum(units_returned) AS units, {_musd('net_loss', 2)} AS net_loss_musd FROM {{m_agg_returns_by_reason_month}} GROUP BY 1 ORDER BY units DESC, reason_description NULLS LAST LIMIT 10"),
    "rpt_stock_status": ("stock_status:s item_weeks:i avg_weeks_cover:f",
        f"SELECT stock_status, count(*) AS item_weeks, {mean_('weeks_of_cover', 1)} AS avg_weeks_cover FROM {{m_agg_inventory_health_weekly}} GROUP BY 1"),
    "rpt_affinity_top": ("channel:s category_a:s category_b:s baskets_together:i lift:f affinity_strength:s",
        "SELECT * FROM {m_agg_category_affinity} ORDER BY lift DESC, channel, category_a, category_b LIMIT 15"),
    "rpt_best_month_categories": ("sold_year_month:s category:s net_revenue:f category_share_pct:f yoy_growth_pct:f trend:s",
        "SELECT * FROM {m_agg_category_trend_month} WHERE sold_year_month = (SELECT sold_year_month FROM {m_agg_category_trend_month} GROUP BY 1 ORDER BY sum(net_revenue) DESC, 1 LIMIT 1) ORDER BY net_revenue DESC, category NULLS LAST LIMIT 5"),
    "rpt_segment_ltv_share": ("customer_segment:s customers:i ltv_musd:f pct_of_ltv:f",
        f"SELECT customer_segment, count(*) AS customers, {_musd('net_lifetime_value', 2)} AS ltv_musd, {pct_('sum(net_lifetime_value)', '(SELECT sum(net_lifetime_value) FROM {m_dim_customer_rfm})', 1)} AS pct_of_ltv FROM {{m_dim_customer_rfm}} GROUP BY 1"),
    "rpt_channel_yoy": ("channel:s sold_year:i net_revenue_musd:f avg_margin_pct:f avg_yoy_growth_pct:f",
        f"SELECT channel, sold_year, {_musd('net_revenue', 1)} AS net_revenue_musd, {mean_('margin_pct', 2)} AS avg_margin_pct, {mean_('yoy_growth_pct', 1)} AS avg_yoy_growth_pct FROM {{m_agg_sales_by_channel_month}} GROUP BY 1, 2"),
    "rpt_top_customers": ("customer_sk:i full_name:s customer_segment:s order_count:i lifetime_revenue:f",
        f"SELECT customer_sk, full_name, customer_segment, order_count, {rnd('CAST(lifetime_revenue AS DOUBLE)', 0)} AS lifetime_revenue FROM (SELECT * FROM {{m_dim_customer_rfm}} ORDER BY lifetime_revenue DESC, customer_sk LIMIT 10)"),
    "rpt_value_destroying_promos": ("promo_sk:i channel:s promo_name:s promoted_units:i lift_pct:f roi_pct:f verdict:s",
        f"SELECT promo_sk, channel, promo_name, promoted_units, {rnd('revenue_lift_pct', 1)} AS lift_pct, roi_pct, verdict FROM {{m_agg_promotion_effectiveness}} WHERE verdict <> 'INSUFFICIENT_DATA' ORDER BY roi_pct, promo_sk, channel LIMIT 10"),
    "rpt_reorder_now": ("category:s item_weeks:i avg_cover:f",
        f"SELECT category, count(*) AS item_weeks, {mean_('weeks_of_cover', 1)} AS avg_cover FROM {{m_agg_inventory_health_weekly}} WHERE stock_status = 'REORDER_NOW' GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 10"),
    "rpt_dq_ledger": (_LEDGER, "SELECT * FROM {m_dq_metrics}"),
    "rpt_rejects_by_reason": ("reject_reason:s lines:i", "SELECT reject_reason, count(*) AS lines FROM {m_dq_rejects_sales} GROUP BY 1"),
}
assert set(_REPORTS) == set(reports.REPORTS)
for _name, (_shape, _sql) in _REPORTS.items():
    query(_name, _shape, _sql)(lambda ctx, n=_name: reports.report(ctx.spark, n, ctx.retail.published))
