"""Operators against brute force, on skewed input and with several partition counts."""

import itertools
import random

import pytest
from pyspark.sql import Window, functions as F

from stratamart.functions import exact_sum, in_key_slice, parse_date, parse_number, pct, rounded_sum
from stratamart.operators import baskets, keyed, quality
from stratamart.operators.ranking import Ranking, ntile_scores, rank_within, rankings
from stratamart.operators.sequence import dense_months, events_in_trailing_window, previous_value
from stratamart.sources.defects import inject_defects


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key and a third under one value."""
    rnd = random.Random(7)
    data = [
        (i, "hot" if i % 3 == 0 else f"k{rnd.randrange(40)}", 0 if i % 3 == 1 else rnd.randrange(500), rnd.randrange(5000) if i % 50 else None)
        for i in range(3000)
    ]
    return spark.createDataFrame(data, "id long, key string, val int, at long").repartition(8)


@pytest.fixture(params=[1, 4, 64])
def width(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rank_equals_window(skewed, width):
    w = Window.partitionBy("key").orderBy(F.desc("val"))
    up = Window.partitionBy("key").orderBy("val")
    want = skewed.select("id", F.rank().over(w).alias("r"), F.percent_rank().over(up).alias("p"))
    got = rank_within(skewed, ["key"], "val", "r", percent_rank_as="p").select("id", "r", "p")
    assert rows(got) == rows(want)


@pytest.mark.parametrize("n", [0, 1, 3, 5, 11, 3000])
def test_ntile_equals_window(skewed, n):
    some = skewed.where(F.col("id") < n)
    want = some.select("id", F.ntile(5).over(Window.orderBy("val", "id")).alias("a"), F.ntile(5).over(Window.orderBy("at", "id")).alias("b"))
    got = ntile_scores(some, "id", {"a": "val", "b": "at"}, 5).select("id", "a", "b")
    assert rows(got) == rows(want)


def test_previous_value_equals_lag(skewed, width):
    want = skewed.select("id", F.lag("val").over(Window.partitionBy("key").orderBy("at", "id")).alias("p"))
    got = previous_value(skewed, "key", ["at", "id"], "val", F.floor(F.col("at") / 300), "p").select("id", "p")
    assert rows(got) == rows(want)


def test_trailing_window_equals_range_frame(skewed, width):
    want = skewed.select("id", F.count("*").over(Window.partitionBy("key").orderBy("at").rangeBetween(-60, 0)).alias("n"))
    got = events_in_trailing_window(skewed, "key", F.col("at"), 60, "n").select("id", "n")
    assert rows(got) == rows(want)


def test_dedup_keeps_one_row_whatever_the_layout(skewed, width):
    once = keyed.latest_per_key(skewed, ["key"], ["val"])
    assert once.count() == skewed.select("key").distinct().count()
    assert rows(keyed.latest_per_key(once, ["key"], ["val"])) == rows(once)
    assert rows(keyed.latest_per_key(skewed.repartition(3, "id"), ["key"], ["val"])) == rows(once)


def test_dedup_trims_before_the_shuffle(skewed):
    plan = keyed.latest_per_key(skewed, ["key"], ["val"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_pairs_equal_self_join(spark):
    rnd = random.Random(3)
    data = [("c", i % 90 if i % 3 else 0, f"m{rnd.randrange(6)}") for i in range(900)]
    df = spark.createDataFrame(data, "ch string, basket int, m string")
    members = {}
    for _, b, m in data:
        members.setdefault(b, set()).add(m)
    want = {}
    for s in members.values():
        for a, b in itertools.combinations(sorted(s), 2):
            want[(a, b)] = want.get((a, b), 0) + 1
    sets = baskets.basket_signatures(df, ["ch", "basket"], "m")
    got = {(r.a, r.b): r.n for r in baskets.pair_counts(sets, "ch", "a", "b", "n").collect()}
    assert got == want
    singles = {r.m: r.n for r in baskets.member_counts(sets, "ch", "m", "n").collect()}
    assert singles == {m: sum(m in s for s in members.values()) for m in singles}


def test_conform_fills_and_tolerates(spark):
    df = spark.createDataFrame([("7", "x"), ("bad", "y")], "a string, b string")
    out = keyed.conform(df, [("n", "int"), ("label", "string"), ("none", "decimal(7,2)")], {"n": "a", "label": "b", "none": "zz"}, feed="F")
    assert out.dtypes == [("n", "int"), ("label", "string"), ("none", "decimal(7,2)"), ("feed", "string")]
    assert [tuple(r) for r in out.collect()] == [(7, "x", None, "F"), (None, "y", None, "F")]


def test_slice_and_parsers_survive_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("1,234",), ("(D)",), ("1.2.3",), ("2020-13-45",), ("2020-02-03",)], "s string")
    assert [r[0] for r in df.select(parse_number("s")).collect()] == [1234.0, None, None, None, None]
    assert [str(r[0]) for r in df.select(parse_date("s", "yyyy-MM-dd")).collect()][3:] == ["None", "2020-02-03"]
    assert spark.range(1).select(pct(F.lit(1), F.lit(0), 2)).head()[0] is None
    assert spark.range(5000).where(in_key_slice(["id"], 100)).count() == 5000


def test_dense_months(spark):
    df = spark.createDataFrame([("a", "2020-11"), ("a", "2021-02"), ("b", "2020-01")], "g string, m string")
    assert rows(dense_months(df, ["g"], "m")) == [("a", "2020-11"), ("a", "2020-12"), ("a", "2021-01"), ("a", "2021-02"), ("b", "2020-01")]


def test_defects_do_not_depend_on_layout(spark):
    df = spark.range(20000).selectExpr("id AS ss_item_sk", "id % 90 AS ss_ticket_number", "int(5) AS ss_quantity", "cast(9.5 AS decimal(7,2)) AS ss_net_paid")
    assert rows(inject_defects("store_sales", df)) == rows(inject_defects("store_sales", df.repartition(13)))


def test_profile_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", None)], "s string, n int")
    got = {r.column_name: (r.null_count, r.null_pct, r.distinct_count) for r in quality.profile(df, "t", "b", "d").collect()}
    assert got == {"s": (1, 33.33, 2), "n": (1, 33.33, -1)}


def test_variance_tolerance(spark):
    df = spark.createDataFrame([(100.4, 100.0), (100.6, 100.0), (1.0, 0.0)], "a double, b double")
    assert [r.status for r in quality.variance_check(df, "a", "b", 0.5).collect()] == ["PASS", "FAIL", "FAIL"]


def test_sums_are_rounded_once_and_may_be_large(spark):
    cents = spark.createDataFrame([(0.004,)] * 5, "a double")
    assert cents.select(rounded_sum("a").cast("double")).first()[0] == 0.02
    large = spark.createDataFrame([(9e15,)] * 4, "a double").select(exact_sum("a").alias("s"))
    assert large.select(exact_sum("s")).first()[0] == 36_000_000_000_000_000


def test_rankings_share_one_sort_and_one_join(skewed):
    """Two rankings, one of them within finer groups; one shuffle by range beyond the counting, and the rows joined once."""
    wanted = [Ranking(("key", "bucket"), "fine"), Ranking(("key",), "coarse", "share")]
    df = skewed.withColumn("bucket", F.col("id") % 3)
    got = rankings(df, "val", wanted)
    down = F.col("val").desc_nulls_last()
    want = df.select("id", F.rank().over(Window.partitionBy("key", "bucket").orderBy(down)).alias("fine"), F.rank().over(Window.partitionBy("key").orderBy(down)).alias("coarse"),
                     F.percent_rank().over(Window.partitionBy("key").orderBy(F.col("val").asc_nulls_first())).alias("share"))
    assert rows(got.select("id", "fine", "coarse", "share")) == rows(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and "rangepartitioning" not in plan


def test_previous_value_reads_its_input_once(skewed):
    got = previous_value(skewed, "key", ["at", "id"], "val", F.col("at"), "p")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan and "LocalRelation" not in plan  # only what was written after the one shuffle is read
