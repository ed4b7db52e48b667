"""Industry summaries, trip reports and dashboard lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from stratamart.plans import taxi, verticals as v
from stratamart.registry.core import Context, mean_, query, relation, rnd
from stratamart.sources.shapes import normalise_orders, state_crop_rows


def channel(ctx: Context):
    return v.channel_revenue_summary(*(ctx[f"src_{n}"] for n in ("store_sales", "catalog_sales", "web_sales", "date_dim", "promotion")))


def crops(ctx: Context):
    return state_crop_rows(ctx["src_crops"])


def orders(ctx: Context):
    return normalise_orders(ctx["src_orders_sheet"])


def segments(ctx: Context):
    return ctx.retail.once("rfm_segments", lambda: v.customer_rfm_segments(orders(ctx)))


def _rate(a: str, b: str, digits: int) -> str:
    return rnd(f"CAST({a} AS DOUBLE) * 100.0::DOUBLE / {b}", digits)


# --- expected -----------------------------------------------------------------------------
relation("v_channel", f"""SELECT channel, d_year, count(*) AS line_item_count, sum(price) AS total_revenue, sum(profit) AS total_profit,
  {rnd('CAST(sum(profit) AS DOUBLE) * 100 / CAST(sum(price) AS DOUBLE)', 1, 9)} AS profit_margin_pct,
  {rnd('CAST(sum(CASE WHEN p_promo_sk IS NOT NULL THEN price ELSE 0 END) AS DOUBLE) * 100 / CAST(sum(price) AS DOUBLE)', 1, 9)} AS promo_revenue_share_pct
  FROM (SELECT 'store' AS channel, ss_sold_date_sk AS dsk, ss_promo_sk AS psk, ss_ext_sales_price AS price, ss_net_profit AS profit FROM {{src_store_sales}}
    UNION ALL SELECT 'catalog', cs_sold_date_sk, cs_promo_sk, cs_ext_sales_price, cs_net_profit FROM {{src_catalog_sales}}
    UNION ALL SELECT 'web', ws_sold_date_sk, ws_promo_sk, ws_ext_sales_price, ws_net_profit FROM {{src_web_sales}})
  LEFT JOIN {{src_date_dim}} ON dsk = d_date_sk LEFT JOIN {{src_promotion}} ON psk = p_promo_sk GROUP BY 1, 2""")
relation("v_crop_rows", """SELECT * FROM {src_crops} WHERE SECTOR_DESC = 'CROPS' AND AGG_LEVEL_DESC = 'STATE' AND SOURCE_DESC = 'CENSUS'
  AND STATISTICCAT_DESC IN ('AREA HARVESTED', 'PRODUCTION', 'YIELD')""")
relation("v_crop", f"""SELECT *, {rnd('(yield_per_acre - prior_census_yield) * 100.0::DOUBLE / nullif(prior_census_yield, 0)', 1)} AS yield_change_pct FROM (
  SELECT *, lag(yield_per_acre) OVER (PARTITION BY state, commodity ORDER BY census_year) AS prior_census_yield FROM (
    SELECT STATE_ALPHA AS state, COMMODITY_DESC AS commodity, YEAR AS census_year, max(CASE WHEN STATISTICCAT_DESC = 'AREA HARVESTED' THEN n END) AS area_harvested_acres,
      max(CASE WHEN STATISTICCAT_DESC = 'PRODUCTION' THEN n END) AS production, max(CASE WHEN STATISTICCAT_DESC = 'YIELD' THEN n END) AS yield_per_acre
    FROM (SELECT *, TRY_CAST(CASE WHEN regexp_matches(replace(VALUE, ',', ''), '^[0-9.]+$') THEN replace(VALUE, ',', '') END AS DOUBLE) AS n FROM {{v_crop_rows}}) GROUP BY 1, 2, 3))""")
relation("v_orders", """SELECT Invoice AS invoice_no, StockCode AS stock_code, Description AS description, Quantity AS quantity, InvoiceDate AS invoice_date, Price AS unit_price,
  CASE WHEN NOT isnan("Customer ID") THEN CAST("Customer ID" AS BIGINT) END AS customer_id, Country AS country FROM {src_orders_sheet}""")
relation("v_segments", """WITH clean AS (SELECT * FROM {v_orders} WHERE invoice_no NOT LIKE 'C%' AND customer_id IS NOT NULL AND quantity > 0 AND unit_price > 0),
  c AS (SELECT customer_id, date_diff('day', CAST(max(invoice_date) AS DATE), CAST((SELECT max(invoice_date) FROM clean) AS DATE)) AS recency_days, count(DISTINCT invoice_no) AS frequency,
    CAST(round(sum(CAST(CAST(CAST(quantity * unit_price AS VARCHAR) AS DECIMAL(28,12)) AS DECIMAL(18,4))), 2) AS DOUBLE) AS monetary, first(country ORDER BY invoice_date DESC, country) AS country FROM clean GROUP BY 1),
  s AS (SELECT *, 6 - ntile(5) OVER (ORDER BY recency_days, customer_id) AS recency_score, ntile(5) OVER (ORDER BY frequency, customer_id) AS frequency_score,
    ntile(5) OVER (ORDER BY monetary, customer_id) AS monetary_score FROM c)
  SELECT *, recency_score + frequency_score + monetary_score AS rfm_score, CASE WHEN recency_score + frequency_score + monetary_score >= 13 THEN 'Champions'
    WHEN recency_score + frequency_score + monetary_score >= 10 THEN 'Loyal Customers' WHEN recency_score + frequency_score + monetary_score >= 7 THEN 'Potential Loyalists'
    WHEN recency_score + frequency_score + monetary_score >= 4 THEN 'At Risk' ELSE 'Lost' END AS segment FROM s""")
relation("v_drug", f"""SELECT drug_name, reaction_term, count(*) AS report_count, count(*) FILTER (serious = '1') AS serious_count, count(*) FILTER (seriousness_death = '1') AS death_count,
  {_rate("count(*) FILTER (serious = '1')", 'count(*)', 1)} AS serious_rate_pct FROM {{src_adverse}} GROUP BY 1, 2""")
relation("v_fraud", f"""SELECT amount_bucket, hour_of_day, count(*) AS transaction_count, count(*) FILTER (fraud) AS fraud_count, coalesce(CAST(round(sum(CAST(Amount AS DECIMAL(28,6))) FILTER (fraud), 2) AS DOUBLE), 0) AS total_flagged_amount,
  {_rate('count(*) FILTER (fraud)', 'count(*)', 3)} AS fraud_rate_pct FROM (SELECT *, Class = '1' AS fraud, CAST(floor(Time) AS BIGINT) % 86400 // 3600 AS hour_of_day,
    CASE WHEN Amount >= 500 THEN '500+' WHEN Amount >= 100 THEN '100-500' WHEN Amount >= 50 THEN '50-100' WHEN Amount >= 10 THEN '10-50' ELSE '0-10' END AS amount_bucket FROM {{src_cards}}) GROUP BY 1, 2""")
relation("v_readmission", f"""SELECT code AS primary_diagnosis_code, count(*) AS total_admissions, count(*) FILTER (gap <= 30) AS readmissions_within_30d, {mean_('pay', 2)} AS avg_claim_payment,
  {_rate('count(*) FILTER (gap <= 30)', 'count(*)', 1)} AS readmission_rate_pct FROM (
  SELECT ICD9_DGNS_CD_1 AS code, CLM_PMT_AMT AS pay, date_diff('day', CAST(try_strptime(CAST(prior AS VARCHAR), '%Y%m%d') AS DATE), CAST(try_strptime(CAST(CLM_ADMSN_DT AS VARCHAR), '%Y%m%d') AS DATE)) AS gap
  FROM (SELECT *, lag(NCH_BENE_DSCHRG_DT) OVER (PARTITION BY DESYNPUF_ID ORDER BY CLM_ADMSN_DT, NCH_BENE_DSCHRG_DT, CLM_ID) AS prior FROM {{src_claims}})) GROUP BY 1""")
relation("v_trials", f"""SELECT phase, count(*) AS trial_count, {mean_('enrollment_count', 1)} AS avg_enrollment, count(*) FILTER (overall_status = 'TERMINATED') AS terminated_count,
  count(*) FILTER (overall_status = 'COMPLETED') AS completed_count, count(*) FILTER (overall_status IN ('RECRUITING', 'NOT_YET_RECRUITING')) AS active_recruiting_count,
  {_rate("count(*) FILTER (overall_status = 'TERMINATED')", 'count(*)', 1)} AS termination_rate_pct FROM {{src_trials}} GROUP BY 1""")

# --- summaries ------------------------------------------------------------------------------
_CHANNEL = "channel:s d_year:i line_item_count:i total_revenue:f total_profit:f profit_margin_pct:f promo_revenue_share_pct:f"
_CROP = "state:s commodity:s census_year:s area_harvested_acres:f production:f yield_per_acre:f prior_census_yield:f yield_change_pct:f"
_SEGMENT = "customer_id:i country:s recency_days:i frequency:i monetary:f recency_score:i frequency_score:i monetary_score:i rfm_score:i segment:s"
_DRUG = "drug_name:s reaction_term:s report_count:i serious_count:i death_count:i serious_rate_pct:f"
_FRAUD = "amount_bucket:s hour_of_day:i transaction_count:i fraud_count:i total_flagged_amount:f fraud_rate_pct:f"
_READMIT = "primary_diagnosis_code:s total_admissions:i readmissions_within_30d:i avg_claim_payment:f readmission_rate_pct:f"
_TRIALS = "phase:s trial_count:i avg_enrollment:f terminated_count:i completed_count:i active_recruiting_count:i termination_rate_pct:f"
SUMMARIES = {
    "channel_revenue_summary": (_CHANNEL, "v_channel", channel),
    "crop_yield_trend": (_CROP, "v_crop", lambda ctx: v.crop_yield_trend(crops(ctx))),
    "customer_rfm_segments": (_SEGMENT, "v_segments", lambda ctx: v.customer_rfm_segments(orders(ctx))),
    "drug_safety_signal": (_DRUG, "v_drug", lambda ctx: v.drug_safety_signal(ctx["src_adverse"])),
    "fraud_risk_by_bucket": (_FRAUD, "v_fraud", lambda ctx: v.fraud_risk_by_bucket(ctx["src_cards"])),
    "readmission_risk": (_READMIT, "v_readmission", lambda ctx: v.readmission_risk(ctx["src_claims"])),
    "trial_pipeline_health": (_TRIALS, "v_trials", lambda ctx: v.trial_pipeline_health(ctx["src_trials"])),
}
for _name, (_shape, _rel, _build) in SUMMARIES.items():
    query(_name, _shape, f"SELECT * FROM {{{_rel}}}")(_build)
_SQL_SOURCE = {"crop_yield_trend": crops, "drug_safety_signal": lambda c: c["src_adverse"], "fraud_risk_by_bucket": lambda c: c["src_cards"], "trial_pipeline_health": lambda c: c["src_trials"]}
for _name, _source in _SQL_SOURCE.items():
    query(f"{_name}_sql", SUMMARIES[_name][0], f"SELECT * FROM {{{SUMMARIES[_name][1]}}}")(
        lambda ctx, n=_name, s=_source: v.sql_form(ctx.spark, n, source=s(ctx)))
query("channel_revenue_summary_sql", _CHANNEL, "SELECT * FROM {v_channel}")(lambda ctx: v.sql_form(
    ctx.spark, "channel_revenue_summary", store=ctx["src_store_sales"], catalog=ctx["src_catalog_sales"], web=ctx["src_web_sales"],
    dates=ctx["src_date_dim"], promotions=ctx["src_promotion"]))


def _verify(ctx: Context):
    out = None
    for name, (_, _, build) in SUMMARIES.items():
        rows = v.verify_vertical(segments(ctx) if name == "customer_rfm_segments" else build(ctx), name)
        out = rows if out is None else out.unionByName(rows)
    return out


query("verify_vertical", "summary:s total_rows:i", " UNION ALL ".join(f"SELECT '{n}' AS summary, count(*) AS total_rows FROM {{{r}}}" for n, (_, r, _) in SUMMARIES.items()))(_verify)



def _leaders(ctx: Context):
    return reduce(DataFrame.unionByName, (
        v.leading_rows(segments(ctx) if name == "customer_rfm_segments" else build(ctx), name) for name, (_, _, build) in SUMMARIES.items()))


def _leading(name: str, rel: str) -> str:
    labels, figure, k = v.LEADERS[name]
    source = "(SELECT segment, count(*) AS customers FROM {v_segments} GROUP BY 1)" if name == "customer_rfm_segments" else f"{{{rel}}}"
    names = ", ".join(f"{c} NULLS FIRST" for c in labels)
    order, kept = (names, "") if k is None else (f"{figure} DESC, {names}", f"WHERE {figure} IS NOT NULL QUALIFY place <= {k}")
    label = " || ' / ' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in labels)
    return f"SELECT '{name}' AS summary, row_number() OVER (ORDER BY {order}) AS place, {label} AS row_name, {figure} AS figure FROM {source} {kept}"


query("verify_vertical_leaders", "summary:s place:i row_name:s figure:f", " UNION ALL ".join(f"SELECT * FROM ({_leading(n, r)})" for n, (_, r, _) in SUMMARIES.items()))(_leaders)

# --- dashboards -----------------------------------------------------------------------------
query("dash_top_diagnoses", _READMIT, "SELECT * FROM {v_readmission} ORDER BY total_admissions DESC, primary_diagnosis_code LIMIT 15")(
    lambda ctx: v.top_diagnoses(v.readmission_risk(ctx["src_claims"])))
query("dash_top_signals", _DRUG + " drug_reaction:s", "SELECT *, drug_name || ' → ' || reaction_term AS drug_reaction FROM {v_drug} ORDER BY report_count DESC, drug_name NULLS FIRST, reaction_term LIMIT 15")(
    lambda ctx: v.top_signals(v.drug_safety_signal(ctx["src_adverse"])))
query("dash_yield_movers", _CROP + " state_commodity:s",
      "SELECT *, state || ' — ' || commodity AS state_commodity FROM {v_crop} WHERE yield_change_pct IS NOT NULL ORDER BY abs(yield_change_pct) DESC, state, commodity, census_year LIMIT 15")(
    lambda ctx: v.yield_movers(v.crop_yield_trend(crops(ctx))))
query("dash_fraud_by_bucket", "amount_bucket:s transaction_count:i fraud_count:i fraud_rate_pct:f",
      f"SELECT amount_bucket, sum(transaction_count) AS transaction_count, sum(fraud_count) AS fraud_count, {_rate('sum(fraud_count)', 'sum(transaction_count)', 3)} AS fraud_rate_pct FROM {{v_fraud}} GROUP BY 1")(
    lambda ctx: v.fraud_by_bucket(v.fraud_risk_by_bucket(ctx["src_cards"])))
query("dash_segment_distribution", "segment:s customers:i avg_monetary:f", f"SELECT segment, count(*) AS customers, {mean_('monetary', 2)} AS avg_monetary FROM {{v_segments}} GROUP BY 1")(
    lambda ctx: v.segment_distribution(segments(ctx)))
query("dash_channel_totals", "channel:s total_revenue:f profit_margin_pct:f",
      f"SELECT channel, sum(total_revenue) AS total_revenue, {rnd('CAST(sum(CAST(profit_margin_pct AS DECIMAL(18,6))) AS DOUBLE) / count(*)', 10)} AS profit_margin_pct FROM {{v_channel}} GROUP BY 1")(
    lambda ctx: v.channel_totals(channel(ctx)))
query("live_top_reactions", "reaction_term:s report_count:i serious_count:i", """
  SELECT reaction_term, count(*) AS report_count, count(*) FILTER (serious = '1') AS serious_count FROM {src_adverse}
  WHERE safety_report_id IN (SELECT safety_report_id FROM (SELECT DISTINCT safety_report_id, receive_date FROM {src_adverse}) ORDER BY receive_date DESC, safety_report_id DESC LIMIT 100)
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")(lambda ctx: v.live_top_reactions(ctx["src_adverse"]))

# --- trips ----------------------------------------------------------------------------------
_TAXI = {
    "taxi_daily_revenue": ("trip_date:d total_revenue:f total_trips:i", "SELECT CAST(tpep_pickup_datetime AS DATE) AS trip_date, sum(total_amount) AS total_revenue, count(*) AS total_trips FROM {src_taxi} GROUP BY 1"),
    "taxi_payment_mix": ("payment_type:i trips:i revenue:f", "SELECT payment_type, count(*) AS trips, sum(total_amount) AS revenue FROM {src_taxi} GROUP BY 1"),
    "taxi_top_pickups": ("PULocationID:i trips:i revenue:f", "SELECT PULocationID, count(*) AS trips, sum(total_amount) AS revenue FROM {src_taxi} GROUP BY 1 ORDER BY revenue DESC, 1 LIMIT 20"),
    "taxi_hourly_volume": ("pickup_hour:i total_trips:i", "SELECT hour(tpep_pickup_datetime) AS pickup_hour, count(*) AS total_trips FROM {src_taxi} GROUP BY 1"),
    "taxi_distance_by_passengers": ("passenger_count:i avg_distance:f trips:i", f"SELECT passenger_count, {mean_('trip_distance', 2)} AS avg_distance, count(*) AS trips FROM {{src_taxi}} GROUP BY 1"),
    "taxi_top_tips": ("VendorID:i trip_distance:f fare_amount:f tip_amount:f total_amount:f", "SELECT * FROM {src_taxi} ORDER BY tip_amount DESC, total_amount DESC, fare_amount DESC, trip_distance DESC, VendorID LIMIT 20"),
    "taxi_hourly_fare": ("hour_of_day:i avg_fare:f", f"SELECT hour(tpep_pickup_datetime) AS hour_of_day, {mean_('fare_amount', 2)} AS avg_fare FROM {{src_taxi}} GROUP BY 1"),
    "taxi_long_trips": ("VendorID:i trip_distance:f fare_amount:f total_amount:f", "SELECT VendorID, trip_distance, fare_amount, total_amount FROM {src_taxi} WHERE trip_distance > 20"),
}
assert set(_TAXI) == set(taxi.TAXI_REPORTS)
for _name, (_shape, _sql) in _TAXI.items():
    query(_name, _shape, _sql)(lambda ctx, n=_name: taxi.taxi_report(ctx.spark, n, ctx["src_taxi"]))
