"""Report queries over the marts, as SQL. ``{mart}`` is the DataFrame a report reads.

Every top-k carries a unique tie-break; means are taken over decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _mean(col: str, digits: int) -> str:
    return f"round(avg(cast({col} AS decimal(28,6))), {digits})"


def _millions(col: str, digits: int) -> str:
    return f"round(double(sum({col})) / 1e6, {digits})"


REPORTS: dict[str, tuple[str, str]] = {
    "rpt_kpi_last10": ("kpi_daily_executive", """
        SELECT sold_date, orders, units_sold, net_revenue, average_order_value, return_rate_pct, margin_pct
        FROM {mart} ORDER BY sold_date DESC LIMIT 10"""),
    "rpt_channel_share": ("agg_sales_by_channel_month", f"""
        SELECT channel, sold_year, sum(net_revenue) AS net_revenue, {_mean('channel_revenue_share_pct', 1)} AS avg_share_pct
        FROM {{mart}} GROUP BY channel, sold_year"""),
    "rpt_product_flags": ("agg_product_performance", f"""
        SELECT performance_flag, count(*) AS products, {_millions('net_revenue', 1)} AS revenue_musd
        FROM {{mart}} GROUP BY performance_flag"""),
    "rpt_rfm_segments": ("dim_customer_rfm", f"""
        SELECT customer_segment, count(*) AS customers, {_millions('net_lifetime_value', 1)} AS ltv_musd,
               {_mean('average_order_value', 2)} AS avg_aov, {_mean('recency_days', 0)} AS avg_recency_days
        FROM {{mart}} GROUP BY customer_segment"""),
    "rpt_shopper_type": ("agg_customer_channel_mix", f"""
        SELECT shopper_type, count(DISTINCT customer_sk) AS customers, {_mean('total_revenue', 2)} AS avg_total_revenue
        FROM {{mart}} GROUP BY shopper_type"""),
    "rpt_promo_verdict": ("agg_promotion_effectiveness", f"""
        SELECT verdict, count(*) AS promo_channel_combos, {_millions('promoted_revenue', 2)} AS promoted_revenue_musd,
               {_mean('revenue_lift_pct', 1)} AS avg_lift_pct
        FROM {{mart}} GROUP BY verdict"""),
    "rpt_top_return_reasons": ("agg_returns_by_reason_month", f"""
        SELECT reason_description, sum(units_returned) AS units, {_millions('net_loss', 2)} AS net_loss_musd
        FROM {{mart}} GROUP BY reason_description ORDER BY units DESC, reason_description NULLS LAST LIMIT 10"""),
    "rpt_stock_status": ("agg_inventory_health_weekly", f"""
        SELECT stock_status, count(*) AS item_weeks, {_mean('weeks_of_cover', 1)} AS avg_weeks_cover
        FROM {{mart}} GROUP BY stock_status"""),
    "rpt_affinity_top": ("agg_category_affinity", """
        SELECT channel, category_a, category_b, baskets_together, lift, affinity_strength
        FROM {mart} ORDER BY lift DESC, channel, category_a, category_b LIMIT 15"""),
    "rpt_best_month_categories": ("agg_category_trend_month", """
        SELECT sold_year_month, category, net_revenue, category_share_pct, yoy_growth_pct, trend
        FROM {mart}
        WHERE sold_year_month = (SELECT sold_year_month FROM {mart} GROUP BY sold_year_month
                                 ORDER BY sum(net_revenue) DESC, sold_year_month LIMIT 1)
        ORDER BY net_revenue DESC, category NULLS LAST LIMIT 5"""),
    "rpt_segment_ltv_share": ("dim_customer_rfm", f"""
        SELECT customer_segment, count(*) AS customers, {_millions('net_lifetime_value', 2)} AS ltv_musd,
               round(sum(net_lifetime_value) * 100 / sum(sum(net_lifetime_value)) OVER (), 1) AS pct_of_ltv
        FROM {{mart}} GROUP BY customer_segment"""),
    "rpt_channel_yoy": ("agg_sales_by_channel_month", f"""
        SELECT channel, sold_year, {_millions('net_revenue', 1)} AS net_revenue_musd, {_mean('margin_pct', 2)} AS avg_margin_pct,
               {_mean('yoy_growth_pct', 1)} AS avg_yoy_growth_pct
        FROM {{mart}} GROUP BY channel, sold_year"""),
    "rpt_top_customers": ("dim_customer_rfm", """
        SELECT customer_sk, full_name, customer_segment, order_count, round(double(lifetime_revenue), 0) AS lifetime_revenue
        FROM {mart} m ORDER BY m.lifetime_revenue DESC, customer_sk LIMIT 10"""),
    "rpt_value_destroying_promos": ("agg_promotion_effectiveness", """
        SELECT promo_sk, channel, promo_name, promoted_units, round(revenue_lift_pct, 1) AS lift_pct, roi_pct, verdict
        FROM {mart} WHERE verdict <> 'INSUFFICIENT_DATA' ORDER BY roi_pct, promo_sk, channel LIMIT 10"""),
    "rpt_reorder_now": ("agg_inventory_health_weekly", f"""
        SELECT category, count(*) AS item_weeks, {_mean('weeks_of_cover', 1)} AS avg_cover
        FROM {{mart}} WHERE stock_status = 'REORDER_NOW' GROUP BY category
        ORDER BY item_weeks DESC, category NULLS LAST LIMIT 10"""),
    "rpt_dq_ledger": ("dq_metrics", "SELECT table_name, rule, scope, metric_value FROM {mart} ORDER BY table_name, scope, rule"),
    "rpt_rejects_by_reason": ("dq_rejects_sales", "SELECT reject_reason, count(*) AS lines FROM {mart} GROUP BY reject_reason"),
}


def report(spark: SparkSession, name: str, mart: Callable[[str], DataFrame]) -> DataFrame:
    table, text = REPORTS[name]
    return spark.sql(text, mart=mart(table))
