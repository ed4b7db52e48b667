import datetime as dt

from pyspark.sql import functions as F

from stratamart.llm import url_lists as U


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def test_as_of(spark):
    changes = spark.createDataFrame([
        ("a", "block", "spam.org", "add", day(10)), ("a", "block", "spam.org", "add", day(15)), ("a", "block", "spam.org", "remove", day(20)), ("a", "block", "spam.org", "add", day(30)),
        ("b", "allow", "spam.org/ok", "add", day(0)), ("a", "block", "tie.org", "add", day(5)), ("a", "block", "tie.org", "remove", day(5)), (None, "block", "x.org", "add", day(1)),
        ("a", "block", "n.org", "add", None), ("c", "block", "org.uk", "add", day(0)), ("d", "allow", "eq.net", "add", day(0)), ("e", "block", "eq.net", "add", day(0))],
        "list_name string, verdict string, pattern string, change string, at timestamp")
    rows = [(1, "http://spam.org/", day(9), "keep"), (2, "https://www.SPAM.org:80/x", day(10), "block"), (3, "http://a.b.spam.org", day(19), "block"), (4, "http://spam.org", day(20), "keep"),
            (5, "http://spam.org/ok/deep?q", day(31), "allow"), (6, "http://spam.org/okay", day(31), "block"), (7, "http://notspam.org", day(31), "keep"), (8, "http://tie.org", day(6), "keep"),
            (9, None, day(6), "keep"), (10, "http://spam.org", None, "keep"), (11, "no url", day(6), "keep"), (None, "http://x.org.uk", day(6), "block"), (2, "https://www.SPAM.org:80/x", day(10), "block"),
            (12, "http://eq.net", day(3), "block"), (13, "http://u:p@spam.org/" + "s/" * 5000, day(12), "block")]
    captures = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, fetched_at timestamp")
    got = U.judge(captures.selectExpr("*", "'theirs' as pattern", "1 as c_row"), changes)
    assert sorted((str(r["page_id"]), r["verdict"]) for r in got.collect()) == sorted((str(r[0]), r[3]) for r in rows)
    assert U.judge(captures.limit(0), changes).count() == 0
    assert {r["verdict"] for r in U.judge(captures, changes.limit(0)).collect()} == {"keep"}


def test_intervals_over_many_ranges(spark):
    rows = [("l", "block", "hot.org", "add" if k % 2 == 0 else "remove", day(0) + dt.timedelta(hours=k)) for k in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = U.intervals(spark.createDataFrame(rows, "list_name string, verdict string, pattern string, change string, at timestamp")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(got) == 1000 and all(r["valid_to"] - r["valid_from"] == dt.timedelta(hours=1) for r in got)


def test_patterns_are_normalised_as_urls_are(spark):
    at = lambda day: f"2024-01-{day:02d} 00:00:00"
    changes = spark.createDataFrame([
        ("l", "block", "www.x.org", "add", at(1)), ("l", "block", "y.org/Ads", "add", at(1)), ("l", "block", "zip", "add", at(1)),
        ("l", "block", "A.com", "add", at(1)), ("l", "block", "a.com", "remove", at(5)), ("l", "block", "http://Q.net:80//b/", "add", at(1))],
        "list_name string, verdict string, pattern string, change string, at string").withColumn("at", F.col("at").cast("timestamp"))
    urls = {1: "http://www.x.org/", 2: "http://y.org/Ads/1", 3: "http://y.org/ads/1", 4: "http://evil.zip/a", 5: "http://a.com/", 6: "http://q.net/b/c"}
    captures = spark.createDataFrame([(k, u) for k, u in urls.items()], "page_id long, url string").withColumn("fetched_at", F.lit(at(9)).cast("timestamp"))
    got = {r["page_id"]: r["verdict"] for r in U.judge(captures, changes).collect()}
    assert got == {1: "block", 2: "block", 3: "keep", 4: "block", 5: "keep", 6: "block"}
