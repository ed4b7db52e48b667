"""Conformed sales, returns and inventory facts with their rejects and ledger lines.

Amounts are decimal(18,2) throughout: the narrower type of the feeds raises on
overflow under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions import exact_sum, in_key_slice, line_key, pct
from stratamart.functions.numbers import MONEY
from stratamart.operators.keyed import conform, first_failure, latest_per_key
from stratamart.operators.quality import measure, repeated_key_count

LINE_KEY = ["order_number", "item_sk", "channel"]  # most selective first: it leads the sort


def _shape(ints: str, longs: str, amounts: str) -> list[tuple[str, str]]:
    return [
        *((c, "int") for c in ints.split()), *((c, "bigint") for c in longs.split()), *((c, MONEY) for c in amounts.split())
    ]


SALES_SHAPE = _shape(
    "sold_date_sk sold_time_sk ship_date_sk item_sk customer_sk ship_customer_sk address_sk cdemo_sk hdemo_sk store_sk "
    "call_center_sk catalog_page_sk web_site_sk web_page_sk ship_mode_sk warehouse_sk promo_sk quantity",
    "order_number",
    "wholesale_cost list_price sales_price ext_discount_amt ext_sales_price ext_wholesale_cost ext_list_price ext_tax "
    "coupon_amt ext_ship_cost net_paid net_paid_inc_tax net_profit",
)
RETURNS_SHAPE = _shape(
    "returned_date_sk returned_time_sk item_sk customer_sk returning_customer_sk address_sk store_sk call_center_sk "
    "catalog_page_sk web_page_sk ship_mode_sk warehouse_sk reason_sk return_quantity",
    "order_number",
    "return_amount return_tax return_amt_inc_tax return_fee return_ship_cost refunded_cash reversed_charge store_credit net_loss",
)

# A feed column is the canonical name behind the feed's prefix, except these (fixed values).
BILLED = {"customer_sk": "bill_customer_sk", "address_sk": "bill_addr_sk", "cdemo_sk": "bill_cdemo_sk", "hdemo_sk": "bill_hdemo_sk"}
REFUNDED = {"customer_sk": "refunded_customer_sk", "address_sk": "refunded_addr_sk", "return_fee": "fee"}
SALES_FEEDS = {
    "STORE": ("store_sales", "ss", {"address_sk": "addr_sk", "order_number": "ticket_number"}),
    "CATALOG": ("catalog_sales", "cs", BILLED),
    "WEB": ("web_sales", "ws", BILLED),
}
RETURN_FEEDS = {
    "STORE": ("store_returns", "sr", {
        "returned_time_sk": "return_time_sk", "address_sk": "addr_sk", "order_number": "ticket_number",
        "return_amount": "return_amt", "return_fee": "fee"}),
    "CATALOG": ("catalog_returns", "cr", REFUNDED),
    "WEB": ("web_returns", "wr", {**REFUNDED, "return_amount": "return_amt", "store_credit": "account_credit"}),
}


def stack_feeds(bronze: Callable[[str], DataFrame], feeds: dict, shape: list[tuple[str, str]]) -> DataFrame:
    """All channels on one shape."""
    parts = []
    for channel, (table, prefix, renamed) in feeds.items():
        source_of = {name: f"{prefix}_{renamed.get(name, name)}" for name, _ in shape}
        parts.append(conform(bronze(table), shape, source_of, channel=channel))
    return reduce(DataFrame.unionByName, parts)


def sliced(df: DataFrame, keys: list[str], keep_pct: int) -> DataFrame:
    """The whole input at 100; otherwise a stable share of its keys."""
    return df if keep_pct >= 100 else df.where(in_key_slice(keys, keep_pct))


# --- sales ----------------------------------------------------------------------

def raw_sales(bronze: Callable[[str], DataFrame], keep_pct: int = 100) -> DataFrame:
    return sliced(stack_feeds(bronze, SALES_FEEDS, SALES_SHAPE), LINE_KEY, keep_pct)


def flagged_sales(raw: DataFrame) -> DataFrame:
    """One row per sales line with the first contract it breaks, if any."""
    return latest_per_key(raw, LINE_KEY, ["sold_date_sk"]).withColumn("reject_reason", first_failure(
        ("MISSING_SOLD_DATE", F.col("sold_date_sk").isNull()),
        ("MISSING_ITEM", F.col("item_sk").isNull()),
        ("UNSETTLED_AMOUNT", F.col("net_paid").isNull()),
        ("NON_POSITIVE_QUANTITY", F.col("quantity") <= 0),
    ))


def sales_rejects(flagged: DataFrame) -> DataFrame:
    return flagged.where("reject_reason IS NOT NULL").withColumn("rejected_at", F.current_timestamp())


def fct_sales(flagged: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Clean lines with calendar columns and line measures; a line outside the calendar is dropped."""
    calendar = dim_date.where("calendar_year IS NOT NULL").select(
        F.col("date_sk").alias("sold_date_sk"), F.col("calendar_date").alias("sold_date"),
        F.col("calendar_year").alias("sold_year"), F.col("month_of_year").alias("sold_month"),
        F.col("year_month").alias("sold_year_month"), F.col("week_seq").alias("sold_week_seq"),
    )
    zero = F.lit(0).cast(MONEY)
    clean = flagged.where("reject_reason IS NULL").drop("reject_reason")
    # a left join followed by "year is not NULL" is an inner join
    return clean.join(calendar, "sold_date_sk").withColumns({
        "sales_line_sk": line_key("channel", "order_number", "item_sk"),
        "gross_revenue": F.col("ext_sales_price"),
        "net_revenue": F.col("net_paid"),
        "cost_of_goods": F.col("ext_wholesale_cost"),
        "discount_amount": (F.coalesce("ext_discount_amt", zero) + F.coalesce("coupon_amt", zero)).cast(MONEY),
        "gross_margin": (F.col("net_paid") - F.coalesce("ext_wholesale_cost", zero)).cast(MONEY),
        "is_shipped": F.col("ship_date_sk").isNotNull(),
        "days_to_ship": F.col("ship_date_sk") - F.col("sold_date_sk"),
    }).withColumns({
        "margin_pct": F.when(F.col("net_paid") > 0, pct("gross_margin", "net_paid", 2)),
        "discount_pct": F.when(F.col("ext_list_price") > 0, pct("discount_amount", "ext_list_price", 2)),
        "is_promotional": F.col("promo_sk").isNotNull() & (F.col("discount_amount") > 0),
    })


def sales_by_channel_year(sales: DataFrame) -> DataFrame:
    return sales.groupBy("channel", "sold_year").agg(
        F.count("*").alias("lines"), F.round(exact_sum("net_revenue").cast("double") / 1e6, 1).alias("net_revenue_musd"),
    )


# --- returns --------------------------------------------------------------------

def raw_returns(bronze: Callable[[str], DataFrame], keep_pct: int = 100) -> DataFrame:
    return sliced(stack_feeds(bronze, RETURN_FEEDS, RETURNS_SHAPE), LINE_KEY, keep_pct)


def fct_returns(raw: DataFrame, dim_date: DataFrame) -> DataFrame:
    calendar = dim_date.where("calendar_year IS NOT NULL").select(
        F.col("date_sk").alias("returned_date_sk"), F.col("calendar_date").alias("returned_date"),
        F.col("calendar_year").alias("returned_year"), F.col("year_month").alias("returned_year_month"),
    )
    zero = F.lit(0).cast(MONEY)
    cash, card, credit = F.col("refunded_cash"), F.col("reversed_charge"), F.coalesce("store_credit", zero)
    card0 = F.coalesce(card, zero)
    return (
        latest_per_key(raw, LINE_KEY, ["returned_date_sk"])
        .where("returned_date_sk IS NOT NULL AND item_sk IS NOT NULL")
        .join(calendar, "returned_date_sk")
        .withColumns({
            "return_line_sk": line_key("channel", "order_number", "item_sk"),
            "total_refund": (F.coalesce(cash, zero) + card0 + credit).cast(MONEY),
            # NULL cash is not zero: such a row falls through to the card test
            "refund_method": F.when(cash >= F.greatest(card0, credit), "CASH")
                              .when(card >= credit, "CARD_REVERSAL").otherwise("STORE_CREDIT"),
        })
    )


# --- inventory ------------------------------------------------------------------

INVENTORY_KEY = ["inv_item_sk", "inv_warehouse_sk", "inv_date_sk"]


def raw_inventory(bronze: Callable[[str], DataFrame], keep_pct: int = 100) -> DataFrame:
    return sliced(bronze("inventory"), INVENTORY_KEY, keep_pct)


def fct_inventory(raw: DataFrame, dim_date: DataFrame) -> DataFrame:
    calendar = dim_date.where("calendar_year IS NOT NULL").select(
        F.col("date_sk").alias("snapshot_date_sk"), F.col("calendar_date").alias("snapshot_date"),
        F.col("calendar_year").alias("snapshot_year"), F.col("week_seq").alias("snapshot_week_seq"),
    )
    return (
        raw.where("inv_item_sk IS NOT NULL").selectExpr(
            "int(inv_date_sk) AS snapshot_date_sk", "int(inv_item_sk) AS item_sk", "int(inv_warehouse_sk) AS warehouse_sk",
            "coalesce(int(inv_quantity_on_hand), 0) AS quantity_on_hand",
        )
        .join(calendar, "snapshot_date_sk")
        .withColumns({
            "is_out_of_stock": F.col("quantity_on_hand") <= 0,
            "stock_band": F.expr("CASE WHEN quantity_on_hand <= 0 THEN 'OUT_OF_STOCK' WHEN quantity_on_hand < 100 THEN 'LOW' "
                                 "WHEN quantity_on_hand < 500 THEN 'HEALTHY' ELSE 'OVERSTOCKED' END"),
        })
    )


# --- ledger ---------------------------------------------------------------------

def _n() -> Column:
    return F.count("*")


def dimension_ledger(bronze: Callable[[str], DataFrame], silver: Callable[[str], DataFrame]) -> DataFrame:
    """What address, customer and item arrived with and what was published."""
    c = F.col
    parts = [
        measure(bronze("customer_address"), "dim_address", [
            ("bronze rows", "in", _n()),
            ("lower-case state codes", "in", F.count_if(c("ca_state") != F.upper("ca_state"))),
            ("null zip", "in", F.count_if(c("ca_zip").isNull())),
            # NULL counts as one spelling, as in a distinct listing
            ("distinct country spellings", "in", F.count_distinct("ca_country") + F.max(c("ca_country").isNull().cast("int"))),
        ]),
        repeated_key_count(bronze("customer_address"), ["ca_address_sk"], "dim_address", "duplicate address keys"),
        measure(silver("dim_address"), "dim_address", [
            ("rows published", "out", _n()), ("country spellings after", "out", F.count_distinct("country")),
        ]),
        measure(bronze("customer"), "dim_customer", [
            ("bronze rows", "in", _n()),
            ("missing email", "in", F.count_if(c("c_email_address").isNull())),
            ("untrimmed first name", "in", F.count_if(c("c_first_name") != F.trim("c_first_name"))),
        ]),
        repeated_key_count(bronze("customer"), ["c_customer_sk"], "dim_customer", "duplicate customer keys"),
        measure(silver("dim_customer"), "dim_customer", [
            ("rows published", "out", _n()), ("valid email", "out", F.count_if("has_valid_email")),
            ("demographics matched", "out", F.count_if(c("gender").isNotNull())),
        ]),
        measure(bronze("item"), "dim_item", [
            ("bronze rows", "in", _n()),
            ("missing price", "in", F.count_if(c("i_current_price").isNull())),
            ("untrimmed category", "in", F.count_if(c("i_category") != F.trim("i_category"))),
        ]),
        repeated_key_count(bronze("item"), ["i_item_sk"], "dim_item", "duplicate item keys"),
        measure(silver("dim_item"), "dim_item", [
            ("rows published", "out", _n()), ("current records", "out", F.count_if("is_current")),
        ]),
    ]
    return reduce(DataFrame.unionByName, parts)


def sales_ledger(raw: DataFrame, flagged: DataFrame, published: DataFrame) -> DataFrame:
    """Lines in, replays removed, rejects by reason, lines out.

    Every raw line belongs to one key, so the replays removed are raw lines less
    keys; both come from one grouped pass over the raw lines.
    """
    per_key = raw.groupBy(*LINE_KEY).agg(_n().alias("copies"))
    arrived = measure(per_key, "fct_sales", [
        ("bronze rows (3 channels)", "in", F.coalesce(F.sum("copies"), F.lit(0))),
        ("duplicate lines removed", "clean", F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))),
    ])
    rejected = flagged.where("reject_reason IS NOT NULL").groupBy("reject_reason").agg(_n().alias("metric_value")).select(
        F.lit("fct_sales").alias("table_name"), F.concat(F.lit("rejected: "), "reject_reason").alias("rule"),
        F.lit("reject").alias("scope"), "metric_value",
    )
    out = measure(published, "fct_sales", [("rows published", "out", _n())])
    return arrived.unionByName(rejected).unionByName(out)


def returns_inventory_ledger(raw_ret: DataFrame, returns: DataFrame, raw_inv: DataFrame, inventory: DataFrame) -> DataFrame:
    per_key = raw_ret.groupBy(*LINE_KEY).agg(_n().alias("copies"))
    parts = [
        measure(per_key, "fct_returns", [
            ("bronze rows (3 channels)", "in", F.coalesce(F.sum("copies"), F.lit(0))),
            ("duplicate lines removed", "clean", F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))),
        ]),
        measure(returns, "fct_returns", [("rows published", "out", _n())]),
        measure(raw_inv, "fct_inventory", [("bronze rows", "in", _n())]),
        measure(inventory, "fct_inventory", [
            ("rows published", "out", _n()), ("out-of-stock snapshots", "out", F.count_if("is_out_of_stock")),
        ]),
    ]
    return reduce(DataFrame.unionByName, parts)


def defect_report(bronze: Callable[[str], DataFrame]) -> DataFrame:
    """What the raw feeds carry; one pass per table plus one per repeated-key count."""
    c = F.col
    parts = [
        repeated_key_count(bronze("customer"), ["c_customer_sk"], "customer", "duplicate customer keys"),
        measure(bronze("customer"), "customer", [
            ("missing email", "in", F.count_if(c("c_email_address").isNull())),
            ("untrimmed first name", "in", F.count_if(c("c_first_name") != F.trim("c_first_name"))),
        ]),
        measure(bronze("customer_address"), "customer_address", [
            ("country spelling variants", "in", F.count_distinct("ca_country")),
            ("lower-case state codes", "in", F.count_if(c("ca_state") != F.upper("ca_state"))),
            ("missing zip", "in", F.count_if(c("ca_zip").isNull())),
        ]),
        measure(bronze("item"), "item", [("missing price", "in", F.count_if(c("i_current_price").isNull()))]),
        measure(bronze("store_sales"), "store_sales", [
            ("null net_paid", "in", F.count_if(c("ss_net_paid").isNull())),
            ("negative quantity", "in", F.count_if(c("ss_quantity") < 0)),
        ]),
        repeated_key_count(bronze("store_sales"), ["ss_item_sk", "ss_ticket_number"], "store_sales", "duplicate (item,ticket)"),
    ]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.select(c("table_name").alias("tbl"), c("rule").alias("defect"), c("metric_value").alias("n"))
