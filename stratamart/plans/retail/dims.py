"""Conformed retail dimensions.

A dimension is a row in ``DIMENSIONS``: its raw feed, key, the columns that tell
which copy is newest, and its columns as SQL expressions. ``build`` turns any of
them into a DataFrame, so a change of source layout is a change of text here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.operators.keyed import latest_per_key

AS_OF_YEAR = 2003  # ages are counted to this year (fixed value)

# Census regions by state code (fixed values).
REGIONS = {
    "NORTHEAST": "CT ME MA NH RI VT NJ NY PA",
    "MIDWEST": "IL IN MI OH WI IA KS MN MO NE ND SD",
    "SOUTH": "DE FL GA MD NC SC VA DC WV AL KY MS TN AR LA OK TX",
    "WEST": "AZ CO ID MT NV NM UT WY AK CA HI OR WA",
}
US_SPELLINGS = ("USA", "US", "UNITED STATES")
MEDIA = "email direct_mail catalog tv radio press event".split()


@dataclass(frozen=True)
class Dimension:
    feed: str
    key: str
    columns: str
    newest_by: tuple[str, ...] = ()
    derived: dict[str, str] = field(default_factory=dict)
    comment: str = ""


def _exprs(block: str) -> list[str]:
    """'name: expression' lines to 'expression AS name'; a bare column may follow the colon."""
    out = []
    for line in block.strip().splitlines():
        name, _, expr = line.strip().partition(":")
        out.append(f"{expr.strip()} AS {name.strip()}")
    return out


def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_REGION_CASE = "CASE " + " ".join(
    f"WHEN state_code IN ({_in_list(codes.split())}) THEN '{name}'" for name, codes in REGIONS.items()
) + " ELSE 'UNKNOWN' END"

# --- the dimensions that need nothing but their own feed ---------------------------

DIMENSIONS: dict[str, Dimension] = {
    "dim_date": Dimension("date_dim", "d_date_sk", """
        date_sk: int(d_date_sk)
        date_id: d_date_id
        calendar_date: date(d_date)
        calendar_year: int(d_year)
        month_of_year: int(d_moy)
        day_of_month: int(d_dom)
        day_of_week: int(d_dow)
        quarter_of_year: int(d_qoy)
        day_name: d_day_name
        quarter_name: d_quarter_name
        month_seq: int(d_month_seq)
        week_seq: int(d_week_seq)
        fiscal_year: int(d_fy_year)
        is_holiday: d_holiday = 'Y'
        is_weekend: d_weekend = 'Y'
        """, derived={
            "year_month": "date_format(calendar_date, 'yyyy-MM')",
            "month_start": "date(trunc(calendar_date, 'month'))",
            "is_business_day": "NOT is_weekend AND NOT is_holiday",
        }, comment="Calendar with fiscal and business-day attributes"),
    "dim_time": Dimension("time_dim", "t_time_sk", """
        time_sk: int(t_time_sk)
        hour_of_day: int(t_hour)
        minute_of_hour: int(t_minute)
        am_pm: t_am_pm
        shift_name: t_shift
        meal_time: t_meal_time
        """, derived={
            "day_part": "CASE WHEN hour_of_day BETWEEN 5 AND 11 THEN 'MORNING' WHEN hour_of_day BETWEEN 12 AND 16 THEN 'AFTERNOON' "
                        "WHEN hour_of_day BETWEEN 17 AND 21 THEN 'EVENING' ELSE 'OVERNIGHT' END",
        }, comment="Time of day with retail day parts"),
    "dim_address": Dimension("customer_address", "ca_address_sk", """
        address_sk: int(ca_address_sk)
        address_id: ca_address_id
        street_address: trim(concat_ws(' ', ca_street_number, ca_street_name, ca_street_type, ca_suite_number))
        city: initcap(trim(ca_city))
        county: initcap(trim(ca_county))
        state_code: upper(trim(ca_state))
        country: CASE WHEN upper(trim(ca_country)) IN (%s) THEN 'United States' WHEN ca_country IS NULL THEN 'Unknown' ELSE initcap(trim(ca_country)) END
        postal_code: lpad(coalesce(trim(ca_zip), ''), 5, '0')
        gmt_offset: cast(ca_gmt_offset AS decimal(5,2))
        location_type: upper(trim(ca_location_type))
        """ % _in_list(US_SPELLINGS), ("ca_address_id",), {
            "is_zip_missing": "postal_code = '00000'", "region": _REGION_CASE,
        }, "Standardised postal address with census region"),
    "dim_item": Dimension("item", "i_item_sk", """
        item_sk: int(i_item_sk)
        item_id: i_item_id
        product_name: trim(i_product_name)
        product_description: trim(i_item_desc)
        category: upper(trim(i_category))
        category_id: int(i_category_id)
        product_class: upper(trim(i_class))
        class_id: int(i_class_id)
        brand: trim(i_brand)
        brand_id: int(i_brand_id)
        manufacturer: trim(i_manufact)
        manager_id: int(i_manager_id)
        size: trim(i_size)
        color: trim(i_color)
        unit_of_measure: trim(i_units)
        container: trim(i_container)
        list_price: cast(i_current_price AS decimal(18,2))
        wholesale_cost: cast(i_wholesale_cost AS decimal(18,2))
        valid_from: date(i_rec_start_date)
        valid_to: date(i_rec_end_date)
        """, ("i_rec_start_date",), {
            "is_current": "valid_to IS NULL",
            "is_price_missing": "list_price IS NULL",
            "unit_margin": "cast(list_price - wholesale_cost AS decimal(18,2))",
            "margin_pct": "CASE WHEN list_price > 0 THEN round((list_price - wholesale_cost) / list_price * 100, 2) END",
            "price_tier": "CASE WHEN list_price IS NULL THEN 'UNPRICED' WHEN list_price < 10 THEN 'VALUE' WHEN list_price < 50 THEN 'STANDARD' "
                          "WHEN list_price < 150 THEN 'PREMIUM' ELSE 'LUXURY' END",
        }, "Product master with margin, price tier and validity window"),
    "dim_store": Dimension("store", "s_store_sk", """
        store_sk: int(s_store_sk)
        store_id: s_store_id
        store_name: trim(s_store_name)
        employee_count: int(s_number_employees)
        floor_space_sqft: int(s_floor_space)
        store_manager: trim(s_manager)
        market_id: int(s_market_id)
        market_description: trim(s_market_desc)
        geography_class: trim(s_geography_class)
        division_name: trim(s_division_name)
        company_name: trim(s_company_name)
        city: initcap(trim(s_city))
        state_code: upper(trim(s_state))
        postal_code: trim(s_zip)
        tax_percentage: cast(s_tax_percentage AS decimal(5,2))
        valid_from: date(s_rec_start_date)
        valid_to: date(s_rec_end_date)
        """, ("s_rec_start_date",), {
            "is_current": "valid_to IS NULL",
            "size_band": "CASE WHEN floor_space_sqft > 8000 THEN 'LARGE' WHEN floor_space_sqft > 4000 THEN 'MEDIUM' ELSE 'SMALL' END",
        }, "Physical stores"),
    "dim_web_site": Dimension("web_site", "web_site_sk", """
        web_site_sk: int(web_site_sk)
        web_site_id: web_site_id
        site_name: trim(web_name)
        site_class: trim(web_class)
        site_manager: trim(web_manager)
        market_class: trim(web_mkt_class)
        company_name: trim(web_company_name)
        state_code: upper(trim(web_state))
        tax_percentage: cast(web_tax_percentage AS decimal(5,2))
        valid_from: date(web_rec_start_date)
        valid_to: date(web_rec_end_date)
        """, ("web_rec_start_date",), {"is_current": "valid_to IS NULL"}, "Storefronts"),
    "dim_web_page": Dimension("web_page", "wp_web_page_sk", """
        web_page_sk: int(wp_web_page_sk)
        web_page_id: wp_web_page_id
        page_url: trim(wp_url)
        page_type: upper(trim(wp_type))
        is_autogenerated: wp_autogen_flag = 'Y'
        char_count: int(wp_char_count)
        link_count: int(wp_link_count)
        image_count: int(wp_image_count)
        """, ("wp_rec_start_date",), comment="Web pages"),
    "dim_call_center": Dimension("call_center", "cc_call_center_sk", """
        call_center_sk: int(cc_call_center_sk)
        call_center_id: cc_call_center_id
        call_center_name: trim(cc_name)
        call_center_class: trim(cc_class)
        employee_count: int(cc_employees)
        manager: trim(cc_manager)
        division_name: trim(cc_division_name)
        state_code: upper(trim(cc_state))
        tax_percentage: cast(cc_tax_percentage AS decimal(5,2))
        """, ("cc_rec_start_date",), comment="Call centres"),
    "dim_catalog_page": Dimension("catalog_page", "cp_catalog_page_sk", """
        catalog_page_sk: int(cp_catalog_page_sk)
        catalog_page_id: cp_catalog_page_id
        department: trim(cp_department)
        catalog_number: int(cp_catalog_number)
        page_number: int(cp_catalog_page_number)
        catalog_type: upper(trim(cp_type))
        start_date_sk: int(cp_start_date_sk)
        end_date_sk: int(cp_end_date_sk)
        """, comment="Catalogue pages"),
    "dim_warehouse": Dimension("warehouse", "w_warehouse_sk", """
        warehouse_sk: int(w_warehouse_sk)
        warehouse_id: w_warehouse_id
        warehouse_name: trim(w_warehouse_name)
        warehouse_sqft: int(w_warehouse_sq_ft)
        city: initcap(trim(w_city))
        state_code: upper(trim(w_state))
        postal_code: trim(w_zip)
        """, comment="Distribution centres"),
    "dim_promotion": Dimension("promotion", "p_promo_sk", """
        promo_sk: int(p_promo_sk)
        promo_id: p_promo_id
        promo_name: trim(p_promo_name)
        promo_cost: cast(p_cost AS decimal(18,2))
        promoted_item_sk: int(p_item_sk)
        start_date_sk: int(p_start_date_sk)
        end_date_sk: int(p_end_date_sk)
        promo_purpose: upper(trim(p_purpose))
        is_discount_active: p_discount_active = 'Y'
        channel_email: p_channel_email = 'Y'
        channel_direct_mail: p_channel_dmail = 'Y'
        channel_catalog: p_channel_catalog = 'Y'
        channel_tv: p_channel_tv = 'Y'
        channel_radio: p_channel_radio = 'Y'
        channel_press: p_channel_press = 'Y'
        channel_event: p_channel_event = 'Y'
        """, derived={
            "media_channel_count": " + ".join(f"int(channel_{m})" for m in MEDIA),
            "is_multichannel": "media_channel_count > 1",
        }, comment="Promotions with media mix"),
    "dim_ship_mode": Dimension("ship_mode", "sm_ship_mode_sk", """
        ship_mode_sk: int(sm_ship_mode_sk)
        ship_mode_id: sm_ship_mode_id
        ship_type: upper(trim(sm_type))
        ship_code: trim(sm_code)
        carrier: trim(sm_carrier)
        """, comment="Shipping methods"),
    "dim_return_reason": Dimension("reason", "r_reason_sk", """
        reason_sk: int(r_reason_sk)
        reason_id: r_reason_id
        reason_description: trim(r_reason_desc)
        """, comment="Return reasons"),
    "dim_household": Dimension("household_demographics", "hd_demo_sk", """
        household_demo_sk: int(hd_demo_sk)
        income_band_sk: int(hd_income_band_sk)
        buy_potential: trim(hd_buy_potential)
        dependent_count: int(hd_dep_count)
        vehicle_count: int(hd_vehicle_count)
        """, comment="Household profile"),
}


def build(name: str, feed: DataFrame) -> DataFrame:
    """One dimension from its raw feed: newest copy per key, typed, cleaned, derived."""
    spec = DIMENSIONS[name]
    rows = feed.where(f"{spec.key} IS NOT NULL") if name == "dim_date" else feed
    df = latest_per_key(rows, [spec.key], spec.newest_by).selectExpr(*_exprs(spec.columns))
    for column, expr in spec.derived.items():
        df = df.withColumn(column, F.expr(expr))
    return df


# --- customer: five feeds in one dimension ------------------------------------------

_CUSTOMER = """
    customer_sk: int(c_customer_sk)
    customer_id: c_customer_id
    first_name: initcap(trim(c_first_name))
    last_name: initcap(trim(c_last_name))
    salutation: trim(c_salutation)
    email_address: lower(trim(c_email_address))
    is_preferred: c_preferred_cust_flag = 'Y'
    birth_year: int(c_birth_year)
    birth_country: c_birth_country
    first_sales_date_sk: int(c_first_sales_date_sk)
    address_sk: int(c_current_addr_sk)
    gender: cd_gender
    marital_status: cd_marital_status
    education_status: cd_education_status
    credit_rating: cd_credit_rating
    purchase_estimate: int(cd_purchase_estimate)
    dependent_count: int(cd_dep_count)
    buy_potential: hd_buy_potential
    vehicle_count: int(hd_vehicle_count)
    income_lower_bound: int(ib_lower_bound)
    income_upper_bound: int(ib_upper_bound)
    city: city
    state_code: state_code
    postal_code: postal_code
    country: country
    region: region
"""

_CUSTOMER_DERIVED = {
    "full_name": "concat_ws(' ', first_name, last_name)",
    "has_valid_email": "email_address IS NOT NULL AND contains(email_address, '@')",
    "age_years": f"{AS_OF_YEAR} - birth_year",
    "age_band": "CASE WHEN age_years IS NULL THEN 'UNKNOWN' WHEN age_years < 25 THEN '18-24' WHEN age_years < 35 THEN '25-34' "
                "WHEN age_years < 45 THEN '35-44' WHEN age_years < 55 THEN '45-54' WHEN age_years < 65 THEN '55-64' ELSE '65+' END",
    "income_band_label": "CASE WHEN income_lower_bound IS NULL THEN 'UNKNOWN' "
                         "ELSE concat('$', income_lower_bound div 1000, 'k-$', income_upper_bound div 1000, 'k') END",
}


def build_customer(
    customer: DataFrame, demographics: DataFrame, household: DataFrame, income: DataFrame, address: DataFrame,
) -> DataFrame:
    """Customer with demographics, household, income band and the standardised address."""
    where = address.select(F.col("address_sk").alias("__a"), "city", "state_code", "postal_code", "country", "region")
    wide = (
        latest_per_key(customer, ["c_customer_sk"], ["c_customer_id"])
        .join(demographics, F.col("c_current_cdemo_sk") == F.col("cd_demo_sk"), "left")
        .join(household, F.col("c_current_hdemo_sk") == F.col("hd_demo_sk"), "left")
        .join(income, F.col("hd_income_band_sk") == F.col("ib_income_band_sk"), "left")
        .join(where, F.col("c_current_addr_sk") == F.col("__a"), "left")
    )
    df = wide.selectExpr(*_exprs(_CUSTOMER))
    for column, expr in _CUSTOMER_DERIVED.items():
        df = df.withColumn(column, F.expr(expr))
    return df
