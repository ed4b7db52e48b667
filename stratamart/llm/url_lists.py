"""URL lists with dates, joined to captures as of their fetch time.

A list's history is a table of changes (list_name, verdict, pattern, change, at). Changes become validity intervals: an
addition holds until the next removal. A pattern is a host or domain, which covers what lies below it, or a host with a
path, which covers that path and what lies below it. Hosts of patterns are normalised as those of URLs are (case, www., port,
final dot) before changes are paired; paths keep their case; a pattern of one label covers a top-level domain. A capture is looked up under every domain and path prefix of its URL,
joined to the intervals that hold at its fetch time; the longest pattern decides, and at equal length ``block``.

Edge cases, all defined: changes with a NULL in list, pattern, change or time are skipped; of changes at the same instant
a removal counts; repeated additions and removals change nothing; captures with a NULL URL or time, or without a host, are
kept with no pattern; repeated captures are judged alike; an empty history keeps everything; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.ranges import next_value

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without a leading www., NULL if there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"^www\.|\.$", "")
    return F.when(F.length(host) > 0, host)


def keys_of(url: Column, depth: Column) -> Column:
    """All patterns that would cover a URL: its host, the domains above it up to the top level, and path prefixes up to depth segments."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    parts = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda p: F.length(p) > 0)
    deep = F.least(F.size(parts), depth)
    paths = F.when(deep < 1, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(deep, F.lit(1))), lambda k: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, k), "/"))))
    return F.when(host.isNotNull(), F.array_distinct(F.concat(domains, paths)))


def normal_pattern(pattern: Column) -> Column:
    """A pattern as URLs are looked up: host in lower case without www., port or final dot, the path's case kept; NULL without a host."""
    bare = F.regexp_replace(pattern, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/?#]*)", 1)), r":[0-9]*$", ""), r"^www\.|\.$", "")
    parts = F.filter(F.split(F.regexp_extract(bare, r"^[^/?#]*([^?#]*)", 1), "/"), lambda p: F.length(p) > 0)
    return F.when(F.length(host) > 0, F.array_join(F.concat(F.array(host), parts), "/"))


def intervals(changes: DataFrame) -> DataFrame:
    """(list_name, verdict, pattern, valid_from, valid_to): when an entry holds; valid_to is NULL while it still does."""
    known = changes.withColumn("pattern", normal_pattern(F.col("pattern"))).filter("list_name is not null and pattern is not null and at is not null and change in ('add', 'remove')")
    # one change for each instant; a removal wins
    at_once = known.groupBy("list_name", "pattern", "at").agg(F.max("change").alias("change"), F.max("verdict").alias("verdict"))
    group = F.concat_ws("\u0001", "list_name", "pattern")
    # an addition ends at the next change: either a removal, or an addition whose interval goes on from there
    ended = next_value(at_once, group, [F.col("at")], F.col("at"))
    return ended.filter("change = 'add'").select("list_name", "verdict", "pattern", F.col("at").alias("valid_from"), F.col("following").alias("valid_to"))


def judge(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """Per capture (page_id, url, fetched_at): host, verdict (block, allow or keep), and the list, pattern and start that decided."""
    held = intervals(changes)
    deepest = held.select(F.coalesce(F.max(F.size(F.split("pattern", "/")) - 1), F.lit(0)).alias("depth"))
    depth = F.lit(deepest.first()["depth"])
    rows = captures.select("page_id", F.col("url").cast("string").alias("url"), "fetched_at").withColumn("c_row", F.monotonically_increasing_id())
    looked = rows.withColumn("c_key", F.explode_outer(keys_of(F.col("url"), depth)))
    # the hot domains of captures split, as their intervals are few
    matched = looked.join(held, (F.col("c_key") == F.col("pattern")) & (F.col("fetched_at") >= F.col("valid_from"))
                          & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))), "left")
    best = F.max(F.when(F.col("pattern").isNotNull(), F.struct(F.length("pattern").alias("size"), (F.col("verdict") == "block").alias("block"), "list_name", "pattern", "valid_from", "verdict")))
    judged = matched.groupBy("c_row").agg(F.first("page_id").alias("page_id"), F.first("url").alias("url"), F.first("fetched_at").alias("fetched_at"), best.alias("best"))
    return judged.select("page_id", "url", "fetched_at", host_of(F.col("url")).alias("host"), F.coalesce("best.verdict", F.lit("keep")).alias("verdict"),
                         F.col("best.list_name").alias("list_name"), F.col("best.pattern").alias("pattern"), F.col("best.valid_from").alias("valid_from"))


# --- a history and fetch times out of the pages themselves -----------------------------------------------------------

def _number(text: Column, at: int) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), at, 6), 16, 10).cast("long")


def _day(n: Column) -> Column:
    return F.timestamp_seconds(F.lit(1_704_067_200) + n * 86_400)


def fetched(pages: DataFrame) -> DataFrame:
    """Pages with a fetch time in 2024, drawn from their id."""
    n = _number(F.coalesce(F.col("page_id").cast("string"), F.lit("")), 1)
    return pages.select("page_id", "url", F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(n, F.lit(31_622_400))).alias("fetched_at"))


def history(pages: DataFrame) -> DataFrame:
    """Changes of three lists, drawn from the hosts of the pages: blocked hosts, allowed sections, and whole domains."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).filter("host is not null").distinct()
    day, gap = F.pmod(_number(F.col("host"), 1), F.lit(300)), F.pmod(_number(F.col("host"), 7), F.lit(120)) + 1
    pick = F.pmod(_number(F.col("host"), 13), F.lit(4))
    change = lambda name, verdict, pattern, what, when: F.struct(F.lit(name).alias("list_name"), F.lit(verdict).alias("verdict"), pattern.alias("pattern"), F.lit(what).alias("change"), when.alias("at"))
    of_host = F.array(change("spam", "block", F.col("host"), "add", _day(day)), change("spam", "block", F.col("host"), "remove", _day(day + gap)),
                      change("spam", "block", F.col("host"), "add", _day(day + 2 * gap)))
    of_path = F.array(change("sections", "allow", F.concat("host", F.lit("/en")), "add", _day(gap)), change("sections", "allow", F.concat("host", F.lit("/en")), "remove", _day(gap + day)))
    own = hosts.select(F.explode(F.when(pick == 0, of_host).when(pick == 1, of_path)).alias("c")).select("c.*")
    domains = hosts.select(F.substring_index("host", ".", -2).alias("d")).distinct()
    d_day = F.pmod(_number(F.col("d"), 1), F.lit(200))
    whole = domains.select(F.explode(F.array(change("domains", "block", F.col("d"), "add", _day(d_day)), change("domains", "block", F.col("d"), "remove", _day(d_day + 30)))).alias("c")).select("c.*")
    return own.unionByName(whole)


OP8_SQL = r"""
WITH urls AS (
  SELECT page_id, url, regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\.|\.$', '') AS host,
    list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: length(x) > 0) AS parts,
    make_timestamp((1704067200 + ('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 6))::BIGINT % 31622400) * 1000000) AS fetched_at
  FROM pages),
hosts AS (
  SELECT host, ('0x' || substr(md5(host), 1, 6))::BIGINT % 300 AS d, ('0x' || substr(md5(host), 7, 6))::BIGINT % 120 + 1 AS g,
    ('0x' || substr(md5(host), 13, 6))::BIGINT % 4 AS pick FROM (SELECT DISTINCT host FROM urls WHERE host <> '')),
domains AS (
  SELECT s, ('0x' || substr(md5(s), 1, 6))::BIGINT % 200 AS d FROM (SELECT DISTINCT array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS s FROM hosts)),
held AS (
  SELECT 'spam' AS list_name, 'block' AS verdict, host AS pattern, d AS a, d + g AS b FROM hosts WHERE pick = 0
  UNION ALL SELECT 'spam', 'block', host, d + 2 * g, NULL FROM hosts WHERE pick = 0
  UNION ALL SELECT 'sections', 'allow', host || '/en', g, g + d FROM hosts WHERE pick = 1 AND d > 0
  UNION ALL SELECT 'domains', 'block', s, d, d + 30 FROM domains),
dated AS (
  SELECT list_name, verdict, pattern, make_timestamp((1704067200 + a * 86400) * 1000000) AS valid_from, make_timestamp((1704067200 + b * 86400) * 1000000) AS valid_to FROM held),
hits AS (
  SELECT u.page_id, h.* FROM urls u JOIN dated h ON u.fetched_at >= h.valid_from AND (h.valid_to IS NULL OR u.fetched_at < h.valid_to)
    AND (u.host = h.pattern OR ends_with(u.host, '.' || h.pattern) OR (len(u.parts) > 0 AND u.host || '/' || u.parts[1] = h.pattern))),
best AS (
  SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, verdict = 'block' DESC, list_name DESC, pattern DESC, valid_from DESC) = 1)
SELECT u.page_id, CASE WHEN u.host <> '' THEN u.host END AS host, strftime(u.fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at, coalesce(b.verdict, 'keep') AS verdict,
  b.list_name, b.pattern, strftime(b.valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from
FROM urls u LEFT JOIN best b USING (page_id)
"""
