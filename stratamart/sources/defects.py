"""Make clean extracts as dirty as real feeds are.

The damage is a table of rules: feed, column, kind of damage, rows per 10,000. Each column of a row draws one number, and
the rules of the column take consecutive slices of it, so a value is damaged in one way at most. The draw is a hash of the
whole row and the column's name: the same rows are hit whatever the partitioning, and after a lost executor too.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 10_000

# What each kind of damage makes of a value.
KINDS: dict[str, Callable[[Column], Column]] = {
    "missing": lambda c: F.lit(None),
    "negative": lambda c: -F.abs(c),
    "trailing blanks": lambda c: F.concat(c, F.lit("   ")),
    "leading blank": lambda c: F.concat(F.lit(" "), c),
    "upper case": F.upper,
    "lower case": F.lower,
    "spelt USA": lambda c: F.lit("USA"),
    "spelt us": lambda c: F.lit("us"),
}


class Rule(NamedTuple):
    feed: str
    column: str
    kind: str
    rate: int


# Columns, kinds and rates.
SALES = {"store_sales": "ss", "catalog_sales": "cs", "web_sales": "ws"}
RETURNS = {"store_returns": "sr", "catalog_returns": "cr", "web_returns": "wr"}
RULES = [
    *(Rule(feed, f"{p}_net_paid", "missing", 40) for feed, p in SALES.items()),
    *(Rule(feed, f"{p}_quantity", "negative", 20) for feed, p in SALES.items()),
    *(Rule(feed, f"{p}_net_loss", "missing", 40) for feed, p in RETURNS.items()),
    *(Rule(feed, f"{p}_return_quantity", "negative", 20) for feed, p in RETURNS.items()),
    Rule("customer", "c_email_address", "missing", 300),
    Rule("customer", "c_first_name", "trailing blanks", 1800),
    Rule("customer", "c_first_name", "upper case", 1476),
    Rule("customer", "c_last_name", "lower case", 1200),
    Rule("customer_address", "ca_state", "lower case", 2500),
    Rule("customer_address", "ca_zip", "missing", 200),
    Rule("customer_address", "ca_country", "spelt USA", 2000),
    Rule("customer_address", "ca_country", "spelt us", 800),
    Rule("item", "i_current_price", "missing", 100),
    Rule("item", "i_category", "leading blank", 1500),
    Rule("store", "s_store_name", "trailing blanks", 3000),
]
REPLAYS = {"customer": 200, "customer_address": 200, "item": 150, **dict.fromkeys([*SALES, *RETURNS], 150)}


def draw(row: list[str], what: str) -> Column:
    """A number from 0 to SCALE - 1 for each row."""
    return F.pmod(F.xxhash64(F.lit(what), *row), F.lit(SCALE))


def slices(feed: str) -> list[tuple[Rule, int]]:
    """The feed's rules with where their slice of the column's draw begins."""
    start: dict[str, int] = {}
    out = []
    for rule in RULES:
        if rule.feed == feed:
            out.append((rule, start.get(rule.column, 0)))
            start[rule.column] = out[-1][1] + rule.rate
    return out


def hit(row: list[str], rule: Rule, start: int) -> Column:
    return draw(row, rule.column).between(start, start + rule.rate - 1)


def inject_defects(name: str, df: DataFrame) -> DataFrame:
    """The feed with its defects; a replayed row goes out twice, both times with the same damage."""
    row = list(df.columns)
    values = {c: F.col(c) for c in row}
    for rule, start in slices(name):
        if rule.column in values:
            values[rule.column] = F.when(hit(row, rule, start), KINDS[rule.kind](F.col(rule.column))).otherwise(values[rule.column])
    times = F.when(draw(row, "replay") < REPLAYS.get(name, 0), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    dirty = df.select(*(v.alias(c) for c, v in values.items()), times.alias("__times"))
    return dirty.withColumn("__time", F.explode("__times")).drop("__times", "__time")
