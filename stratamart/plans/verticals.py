"""Industry summaries. All have a DataFrame form; those whose windows scale also have a SQL form with the same rows.

Written tables keep no order, so nothing is sorted here: reports sort on read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratamart.functions import exact_mean, exact_sum, nz, parse_date, parse_number, rounded_sum
from stratamart.operators.ranking import ntile_scores
from stratamart.operators.sequence import previous_value
from stratamart.sinks.scratch import settle
from stratamart.sources.shapes import CROP_CATEGORIES


def _share(part: str, whole: str, digits: int) -> Column:
    return F.round(F.col(part) * 100.0 / nz(whole), digits)


def _count_where(cond: Column) -> Column:
    return F.count_if(cond)


# --- commerce ----------------------------------------------------------------------------

def channel_revenue_summary(store: DataFrame, catalog: DataFrame, web: DataFrame, dates: DataFrame, promotions: DataFrame) -> DataFrame:
    """Revenue, profit, margin and promotion share by channel and year, from unrounded sums.

    Lines are first summed per (channel, date, promotion): the two joins then see
    a few rows per day instead of every line.
    """
    def per_day(feed: DataFrame, p: str, channel: str) -> DataFrame:
        return feed.groupBy(F.lit(channel).alias("channel"), F.col(f"{p}_sold_date_sk").alias("d_date_sk"), F.col(f"{p}_promo_sk").alias("p_promo_sk")).agg(
            F.count("*").alias("lines"), exact_sum(f"{p}_ext_sales_price").alias("revenue"), exact_sum(f"{p}_net_profit").alias("profit"))

    feeds = [per_day(store, "ss", "store"), per_day(catalog, "cs", "catalog"), per_day(web, "ws", "web")]
    promoted = promotions.select("p_promo_sk").distinct().withColumn("on_promo", F.lit(True))
    rows = (
        reduce(DataFrame.unionByName, feeds)
        .join(dates.select("d_date_sk", "d_year"), "d_date_sk", "left")
        .join(promoted, "p_promo_sk", "left")
    )
    sums = rows.groupBy("channel", "d_year").agg(
        F.sum("lines").alias("line_item_count"), exact_sum("revenue").alias("total_revenue"), exact_sum("profit").alias("total_profit"),
        exact_sum(F.when(F.col("on_promo"), F.col("revenue")).otherwise(0)).alias("promo_revenue"),
    )
    return sums.withColumns({
        "profit_margin_pct": F.round(F.col("total_profit") * 100 / nz("total_revenue"), 1),
        "promo_revenue_share_pct": F.round(F.col("promo_revenue") * 100 / nz("total_revenue"), 1),
    }).drop("promo_revenue")


# --- agriculture --------------------------------------------------------------------------

_CROP_NAMES = dict(zip(CROP_CATEGORIES, ("area_harvested_acres", "production", "yield_per_acre")))


def crop_yield_trend(crops: DataFrame) -> DataFrame:
    """Statistics as columns and the yield against the census before; a group has one row per census."""
    keys = {"STATE_ALPHA": "state", "COMMODITY_DESC": "commodity", "YEAR": "census_year"}
    cleaned = crops.select(*(F.col(c).alias(n) for c, n in keys.items()), "STATISTICCAT_DESC", parse_number("VALUE").alias("value"))
    wide = cleaned.groupBy(*keys.values()).pivot("STATISTICCAT_DESC", list(CROP_CATEGORIES)).agg(F.max("value")).withColumnsRenamed(_CROP_NAMES)
    before = F.lag("yield_per_acre").over(Window.partitionBy("state", "commodity").orderBy("census_year"))
    change = (F.col("yield_per_acre") - F.col("prior_census_yield")) * 100.0 / nz("prior_census_yield")
    return wide.withColumn("prior_census_yield", before).withColumn("yield_change_pct", F.round(change, 1))


# --- retail orders -------------------------------------------------------------------------

def _valid_orders(orders: DataFrame) -> DataFrame:
    return orders.where(
        ~F.startswith("invoice_no", F.lit("C")) & F.col("customer_id").isNotNull() & (F.col("quantity") > 0) & (F.col("unit_price") > 0))


def customer_rfm_segments(orders: DataFrame) -> DataFrame:
    """Recency, frequency and monetary quintiles over all customers and the segment of their sum.

    The country is the one on the customer's latest invoice; on a tie the first by name.
    """
    valid = _valid_orders(orders)
    newest = valid.agg(F.max("invoice_date")).scalar()
    amount = (F.col("quantity") * F.col("unit_price")).cast("decimal(18,4)")
    # invoices first: the distinct count and the sums then run over invoices, not lines
    invoices = valid.groupBy("customer_id", "invoice_no").agg(
        F.max("invoice_date").alias("at"), F.sum(amount).alias("spent"), F.min(F.struct(-F.unix_micros(F.col("invoice_date").cast("timestamp")), "country")).alias("where"))
    customers = invoices.groupBy("customer_id").agg(
        F.max("at").alias("last"), F.count("*").alias("frequency"), F.round(F.sum("spent"), 2).cast("double").alias("monetary"), F.min("where")["country"].alias("country"))
    base = customers.select("customer_id", "country", F.datediff(newest, "last").alias("recency_days"), "frequency", "monetary")
    scored = ntile_scores(settle(base), "customer_id", {"__r": "recency_days", "frequency_score": "frequency", "monetary_score": "monetary"}, 5)
    total = F.col("rfm_score")
    return (
        scored.withColumn("recency_score", 6 - F.col("__r")).drop("__r")
        .withColumn("rfm_score", F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"))
        .withColumn("segment", F.when(total >= 13, "Champions").when(total >= 10, "Loyal Customers").when(total >= 7, "Potential Loyalists")
                    .when(total >= 4, "At Risk").otherwise("Lost"))
    )


# --- life sciences ---------------------------------------------------------------------------

def drug_safety_signal(events: DataFrame) -> DataFrame:
    return events.groupBy("drug_name", "reaction_term").agg(
        F.count("*").alias("report_count"), _count_where(F.col("serious") == "1").alias("serious_count"),
        _count_where(F.col("seriousness_death") == "1").alias("death_count"),
    ).withColumn("serious_rate_pct", _share("serious_count", "report_count", 1))


def trial_pipeline_health(trials: DataFrame) -> DataFrame:
    status = F.col("overall_status")
    return trials.groupBy("phase").agg(
        F.count("*").alias("trial_count"), exact_mean("enrollment_count", 1).alias("avg_enrollment"),
        _count_where(status == "TERMINATED").alias("terminated_count"), _count_where(status == "COMPLETED").alias("completed_count"),
        _count_where(status.isin("RECRUITING", "NOT_YET_RECRUITING")).alias("active_recruiting_count"),
    ).withColumn("termination_rate_pct", _share("terminated_count", "trial_count", 1))


# --- payments --------------------------------------------------------------------------------

AMOUNT_BUCKETS = ((10, "0-10"), (50, "10-50"), (100, "50-100"), (500, "100-500"))


def fraud_risk_by_bucket(cards: DataFrame) -> DataFrame:
    bucket = F.lit("500+")
    for top, name in reversed(AMOUNT_BUCKETS):
        bucket = F.when(F.col("Amount") < top, name).otherwise(bucket)
    fraud = F.col("Class") == "1"
    hour = F.floor(F.pmod(F.floor("Time"), F.lit(86400)) / 3600).cast("int")
    return cards.groupBy(bucket.alias("amount_bucket"), hour.alias("hour_of_day")).agg(
        F.count("*").alias("transaction_count"), _count_where(fraud).alias("fraud_count"),
        rounded_sum(F.when(fraud, F.col("Amount")).otherwise(0.0)).cast("double").alias("total_flagged_amount"),
    ).withColumn("fraud_rate_pct", _share("fraud_count", "transaction_count", 3))


# --- health ----------------------------------------------------------------------------------

READMISSION_DAYS = 30


def readmission_risk(claims: DataFrame) -> DataFrame:
    """Readmission within 30 days of the discharge before, by primary diagnosis.

    A beneficiary's stays are ordered by admission, then discharge and claim id. The
    look-back is cut by admission day. An overlapping stay has a negative gap and counts.
    """
    order = ["CLM_ADMSN_DT", "NCH_BENE_DSCHRG_DT", "CLM_ID"]
    stays = claims.select("DESYNPUF_ID", *order, "ICD9_DGNS_CD_1", "CLM_PMT_AMT")
    with_prior = previous_value(stays, "DESYNPUF_ID", order, "NCH_BENE_DSCHRG_DT", F.col("CLM_ADMSN_DT"), "prior_discharge_dt")
    gap = F.datediff(parse_date("CLM_ADMSN_DT", "yyyyMMdd"), parse_date("prior_discharge_dt", "yyyyMMdd"))
    return with_prior.groupBy(F.col("ICD9_DGNS_CD_1").alias("primary_diagnosis_code")).agg(
        F.count("*").alias("total_admissions"), _count_where(gap <= READMISSION_DAYS).alias("readmissions_within_30d"),
        exact_mean("CLM_PMT_AMT", 2).alias("avg_claim_payment"),
    ).withColumn("readmission_rate_pct", _share("readmissions_within_30d", "total_admissions", 1))


# --- SQL forms -------------------------------------------------------------------------------

SQL_FORMS = {
    "drug_safety_signal": """
        SELECT *, round(serious_count * 100.0D / report_count, 1) AS serious_rate_pct FROM (
          SELECT drug_name, reaction_term, count(*) AS report_count, count_if(serious = '1') AS serious_count, count_if(seriousness_death = '1') AS death_count
          FROM {source} GROUP BY ALL)""",
    "trial_pipeline_health": """
        SELECT *, round(terminated_count * 100.0D / trial_count, 1) AS termination_rate_pct FROM (
          SELECT phase, count(*) AS trial_count, round(avg(cast(enrollment_count AS decimal(28,6))), 1) AS avg_enrollment,
            count_if(overall_status = 'TERMINATED') AS terminated_count, count_if(overall_status = 'COMPLETED') AS completed_count,
            count_if(overall_status IN ('RECRUITING', 'NOT_YET_RECRUITING')) AS active_recruiting_count
          FROM {source} GROUP BY phase)""",
    "fraud_risk_by_bucket": """
        SELECT *, round(fraud_count * 100.0D / transaction_count, 3) AS fraud_rate_pct FROM (
          SELECT CASE WHEN Amount < 10 THEN '0-10' WHEN Amount < 50 THEN '10-50' WHEN Amount < 100 THEN '50-100' WHEN Amount < 500 THEN '100-500' ELSE '500+' END AS amount_bucket,
            int(bigint(Time) % 86400 div 3600) AS hour_of_day, count(*) AS transaction_count, count_if(Class = '1') AS fraud_count,
            double(round(sum(CASE WHEN Class = '1' THEN cast(Amount AS decimal(28,6)) ELSE 0 END), 2)) AS total_flagged_amount
          FROM {source} GROUP BY ALL)""",
    "crop_yield_trend": """
        WITH cleaned AS (
          SELECT STATE_ALPHA AS state, COMMODITY_DESC AS commodity, YEAR AS census_year, STATISTICCAT_DESC AS stat, replace(VALUE, ',', '') AS digits FROM {source}),
        wide AS (
          SELECT state, commodity, census_year,
            max(try_cast(digits AS double)) FILTER (WHERE stat = 'AREA HARVESTED' AND digits RLIKE '^[0-9.]+$') AS area_harvested_acres,
            max(try_cast(digits AS double)) FILTER (WHERE stat = 'PRODUCTION' AND digits RLIKE '^[0-9.]+$') AS production,
            max(try_cast(digits AS double)) FILTER (WHERE stat = 'YIELD' AND digits RLIKE '^[0-9.]+$') AS yield_per_acre
          FROM cleaned GROUP BY state, commodity, census_year),
        back AS (SELECT *, lag(yield_per_acre) OVER (PARTITION BY state, commodity ORDER BY census_year) AS prior_census_yield FROM wide)
        SELECT *, round((yield_per_acre - prior_census_yield) * 100.0D / nullif(prior_census_yield, 0), 1) AS yield_change_pct FROM back""",
}


SQL_FORMS["channel_revenue_summary"] = """
    WITH lines AS (
      SELECT 'store' AS channel, ss_sold_date_sk AS date_sk, ss_promo_sk AS promo_sk, ss_ext_sales_price AS price, ss_net_profit AS profit FROM {store}
      UNION ALL SELECT 'catalog', cs_sold_date_sk, cs_promo_sk, cs_ext_sales_price, cs_net_profit FROM {catalog}
      UNION ALL SELECT 'web', ws_sold_date_sk, ws_promo_sk, ws_ext_sales_price, ws_net_profit FROM {web}),
    daily AS (
      SELECT channel, date_sk, promo_sk, count(*) AS n, sum(price) AS price, sum(profit) AS profit FROM lines GROUP BY channel, date_sk, promo_sk),
    yearly AS (
      SELECT channel, d_year, sum(n) AS line_item_count, sum(price) AS total_revenue, sum(profit) AS total_profit,
        sum(CASE WHEN p_promo_sk IS NOT NULL THEN price ELSE 0 END) AS promo_revenue
      FROM daily LEFT JOIN {dates} ON date_sk = d_date_sk LEFT JOIN {promotions} ON promo_sk = p_promo_sk GROUP BY channel, d_year)
    SELECT channel, d_year, line_item_count, total_revenue, total_profit, round(total_profit * 100 / nullif(total_revenue, 0), 1) AS profit_margin_pct,
      round(promo_revenue * 100 / nullif(total_revenue, 0), 1) AS promo_revenue_share_pct FROM yearly"""


def sql_form(spark: SparkSession, name: str, **sources: DataFrame) -> DataFrame:
    return spark.sql(SQL_FORMS[name], **sources)


# --- checks and dashboards ---------------------------------------------------------------------

def verify_vertical(summary: DataFrame, name: str) -> DataFrame:
    return summary.agg(F.count("*").alias("total_rows")).select(F.lit(name).alias("summary"), "total_rows")


#: What leads each summary: the columns that name a row, its figure, and how many rows (None: all, in the order of the names).
LEADERS = {
    "channel_revenue_summary": (("d_year", "channel"), "total_revenue", None),
    "crop_yield_trend": (("state", "commodity", "census_year"), "yield_change_pct", 10),
    "customer_rfm_segments": (("segment",), "customers", 10),
    "drug_safety_signal": (("drug_name", "reaction_term"), "report_count", 10),
    "fraud_risk_by_bucket": (("amount_bucket", "hour_of_day"), "fraud_count", 10),
    "readmission_risk": (("primary_diagnosis_code",), "total_admissions", 10),
    "trial_pipeline_health": (("phase",), "trial_count", 10),
}


def leading_rows(summary: DataFrame, name: str) -> DataFrame:
    """The rows that lead a summary, numbered, in one shape: (summary, place, row_name, figure).

    Rows without a figure do not lead. Places are given after the cut, so the window sees a fixed number of rows, or one
    a channel and year. Customers are counted by segment first.
    """
    labels, figure, k = LEADERS[name]
    if name == "customer_rfm_segments":
        summary = summary.groupBy("segment").agg(F.count("*").alias("customers"))
    names = [F.col(c).asc_nulls_first() for c in labels]
    held, order = (summary, names) if k is None else (
        top_rows(summary.where(F.col(figure).isNotNull()), F.col(figure), k, *names), [F.col(figure).desc(), *names])
    row_name = F.concat_ws(" / ", *(F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in labels))
    return held.select(
        F.lit(name).alias("summary"), F.row_number().over(Window.orderBy(*order)).alias("place"), row_name.alias("row_name"), F.col(figure).cast("double").alias("figure"))


def top_rows(df: DataFrame, by: Column, k: int, *ties: str | Column) -> DataFrame:
    """The k largest by a measure, ties settled by columns; planned as a per-task top-k."""
    return df.orderBy(by.desc_nulls_last(), *ties).limit(k)


def top_diagnoses(readmissions: DataFrame) -> DataFrame:
    return top_rows(readmissions, F.col("total_admissions"), 15, "primary_diagnosis_code")


def top_signals(signals: DataFrame) -> DataFrame:
    label = F.concat("drug_name", F.lit(" → "), "reaction_term")
    return top_rows(signals, F.col("report_count"), 15, "drug_name", "reaction_term").withColumn("drug_reaction", label)


def yield_movers(trend: DataFrame) -> DataFrame:
    moved = trend.where("yield_change_pct IS NOT NULL").withColumn("state_commodity", F.concat_ws(" — ", "state", "commodity"))
    return top_rows(moved, F.abs("yield_change_pct"), 15, "state", "commodity", "census_year")


def fraud_by_bucket(summary: DataFrame) -> DataFrame:
    """The rate from the summed counts, not the mean of hourly rates."""
    return summary.groupBy("amount_bucket").agg(
        F.sum("transaction_count").alias("transaction_count"), F.sum("fraud_count").alias("fraud_count"),
    ).withColumn("fraud_rate_pct", _share("fraud_count", "transaction_count", 3))


def segment_distribution(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count("*").alias("customers"), exact_mean("monetary", 2).alias("avg_monetary"))


def channel_totals(summary: DataFrame) -> DataFrame:
    return summary.groupBy("channel").agg(
        exact_sum("total_revenue").alias("total_revenue"), F.avg(F.col("profit_margin_pct").cast("decimal(18,6)")).cast("double").alias("profit_margin_pct"))


def live_top_reactions(reactions: DataFrame, newest: int = 100, k: int = 15) -> DataFrame:
    """Leading reaction terms of the newest reports."""
    reports = reactions.select("safety_report_id", "receive_date").distinct()
    latest = reports.orderBy(F.col("receive_date").desc(), F.col("safety_report_id").desc()).limit(newest).select("safety_report_id")
    hits = reactions.join(latest, "safety_report_id", "left_semi").groupBy("reaction_term").agg(
        F.count("safety_report_id").alias("report_count"), _count_where(F.col("serious") == "1").alias("serious_count"))
    return top_rows(hits, F.col("report_count"), k, "reaction_term")
