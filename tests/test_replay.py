"""Digests of multisets, replay by day and writes that replace partitions."""

import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F

from stratamart.operators import quality
from stratamart.plans import flows
from stratamart.session import scratch_path
from stratamart.sinks import tables as t


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _same(spark, left, right, schema="k string, v string"):
    a, b = (spark.createDataFrame(x, schema).agg(quality.multiset_digest(["k", "v"]).alias("d")).head().d for x in (left, right))
    return a == b


def test_digest_sees_pairs_nulls_and_copies_but_no_order(spark):
    x, y, z = ("a", "1"), ("b", "2"), ("c", "3")
    assert _same(spark, [x, y, z, z], [z, x, z, y])
    assert not _same(spark, [x, x, z], [y, y, z])  # the exclusive or of hashes alone is the same on both sides
    assert not _same(spark, [x, z], [x, x, x, z])
    assert not _same(spark, [("a", None)], [(None, "a")])
    assert not _same(spark, [("a", "1")], [])


@pytest.mark.parametrize("buckets", [1, 64, 4096])
def test_differing_rows_are_located(spark, buckets):
    base = spark.range(5000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("v")).unionByName(
        spark.range(2000).select(F.lit(-1).cast("bigint").alias("id"), F.lit(None).cast("string").alias("v")))  # a hot row
    swapped = base.where("id NOT IN (10, 11)").unionByName(spark.createDataFrame([(10, "x"), (10, "x"), (11, "4"), (11, "4")], "id bigint, v string"))
    got = quality.differing_rows(base, swapped.select("v", "id"), ["id"], buckets)
    assert rows(got) == sorted([(10, "3", 1, 0), (10, "x", 0, 2), (11, "4", 1, 2)], key=repr)
    assert rows(quality.differing_rows(base, base, ["id"], buckets)) == []
    none = base.where("false")
    assert quality.differing_rows(none, base, ["id"], buckets).agg(F.sum("right_copies")).head()[0] == 7000
    assert rows(quality.differing_rows(none, none, ["id"], buckets)) == []


@pytest.fixture
def lab(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    t.create_database(spark, name, "", scratch_path(spark, name))
    return name


def _days(spark, n=40):
    return spark.range(n).select("id", F.col("id").cast("double").alias("v"), F.date_add(F.lit("2024-02-27").cast("date"), (F.col("id") % 4).cast("int")).alias("day"))


def test_replay_verifies_before_it_merges(spark, lab):
    source, table, stage = _days(spark), f"{lab}.held", f"{lab}.one_day"
    last = date(2024, 3, 1)
    old = source.where("day < '2024-03-01'").withColumn("v", F.when(F.col("id") == 5, -1.0).otherwise(F.col("v"))).unionByName(
        spark.createDataFrame([(99, 0.0, date(2023, 1, 1)), (98, 0.0, None)], "id bigint, v double, day date"))
    t.overwrite_partitioned(old, table, "day")
    asked = []

    def read(day, spoilt=()):
        asked.append(day)
        return source.where(F.col("day") == F.lit(day)).where(F.col("id") > 3 if day in spoilt else F.lit(True))

    first = flows.replay_days(source, lambda d: read(d, (last,)), table, "day", stage)
    assert rows(first) == sorted([(None, 0, "SKIPPED"), (date(2023, 1, 1), 0, "EXTRA"), (date(2024, 2, 28), 10, "MERGED"), (last, 10, "FAILED")], key=repr)
    assert asked == [date(2024, 2, 28), last]  # days that agree are not read
    assert spark.table(table).where("day = '2024-03-01'").count() == 0
    again = flows.replay_days(source, read, table, "day", stage)
    assert {(r.day, r.status) for r in again.collect()} == {(None, "SKIPPED"), (date(2023, 1, 1), "EXTRA"), (last, "MERGED")}
    assert rows(spark.table(table).where("day >= '2024-01-01'").select("id", "v", "day")) == rows(source)
    assert not spark.catalog.tableExists(stage)


def test_replay_reads_one_day_of_the_files(spark, lab, tmp_path):
    """The day reaches the scan as a filter on partitions: only that day's files are listed."""
    _days(spark).write.partitionBy("day").parquet(str(tmp_path / "src"))
    source = spark.read.parquet(str(tmp_path / "src")).select("id", "v", "day")
    plan = source.where(F.col("day") == F.lit(date(2024, 2, 28)))
    assert {f.split("day=")[1][:10] for f in plan.inputFiles()} >= {"2024-02-28"}
    assert "PartitionFilters: [isnotnull(day" in plan._jdf.queryExecution().executedPlan().toString()


def test_two_writers_replace_their_own_partitions(spark, lab):
    table = f"{lab}.shared"
    t.overwrite(_days(spark), table, ["day"])
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")

    def write(day):
        for k in range(3):
            t.replace_partitions(_days(spark).where(F.col("day") == day).withColumn("v", F.lit(float(k))), table)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(write, ["2024-02-27", "2024-02-29"]))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode == "STATIC"
    spark.catalog.refreshTable(table)
    want = _days(spark).withColumn("v", F.when(F.col("day").isin("2024-02-27", "2024-02-29"), 2.0).otherwise(F.col("v")))
    assert rows(spark.table(table).select("id", "v", "day")) == rows(want)


def test_new_partitions_and_narrow_types(spark, lab):
    """A partition that the table lacks is added; values take the table's types and its order of columns."""
    table = f"{lab}.typed"
    t.overwrite(spark.createDataFrame([(1, "x", "b1", "p")], "n int, s string, batch_id string, part string"), table, ["batch_id", "part"])
    t.replace_partitions(spark.createDataFrame([("b2", "q/1 é", "y", 7)], "batch_id string, part string, s string, n bigint"), table)
    assert rows(spark.table(table)) == [(1, "x", "b1", "p"), (7, "y", "b2", "q/1 é")]
    assert spark.table(table).schema["n"].dataType.simpleString() == "int"
    flat = f"{lab}.flat"
    t.overwrite(spark.range(3), flat)
    with pytest.raises(ValueError, match="no partitions"):
        t.replace_partitions(spark.range(1), flat)
