import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from stratamart.registry.core import Context
from stratamart.session import application_folder, scratch_path
from stratamart.sinks import scratch
from stratamart.sinks.manifest import Manifest
from stratamart.sinks.scratch import settle
from stratamart.sources import star


def shuffled(spark):
    """Bytes by name of the shuffle files that are there."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f.getName(): f.length() for f in map(files.apply, range(files.size())) if f.getName().startswith("shuffle_")}


def left(spark, before):
    """Bytes of new shuffle files, once they have had the time to go."""
    for _ in range(50):
        more = sum(n for name, n in shuffled(spark).items() if name not in before)
        if more < 5_000:
            break
        time.sleep(0.2)
    return more


def scattered(spark, n=4000):
    """Rows of two years, both in each of 8 tasks."""
    return spark.range(0, n, 1, 8).withColumn("year", (F.col("id") % 2 + 1990).cast("int"))


def test_what_a_write_shuffled_goes_with_it(spark):
    wide = scattered(spark, 40_000).repartition(8, "id")
    before = shuffled(spark)
    settle(wide)
    Manifest(spark, scratch_path(spark, "manifest")).write(wide, "b1", "silver", "a")
    assert left(spark, before) < 5_000  # a count of rows out of the footers shuffles a number a task


def test_the_setting_is_restored_by_the_last_write(spark):
    name = scratch._CLEANUP
    before = spark.conf.get(name, None)
    with pytest.raises(ValueError), scratch.shuffles_dropped(spark):
        with scratch.shuffles_dropped(spark):
            assert spark.conf.get(name) == "true"
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name, None) == before


def test_a_partitioned_table_is_written_where_its_rows_are(spark):
    m = Manifest(spark, scratch_path(spark, "manifest"))
    m.write(scattered(spark), "b1", "silver", "facts", "year")
    for table in (m.read("silver", "facts", "b1"), settle(scattered(spark), "part", "year")):
        files = table.withColumn("file", F.input_file_name()).groupBy("year").agg(F.count_distinct("file").alias("files"), F.count("*").alias("n"), F.min("file").alias("one")).collect()
        assert [(r.files, r.n) for r in files] == [(8, 2000), (8, 2000)] and all(".zstd." in r.one for r in files)


def test_lines_asked_for_side_by_side_are_written_once(spark, monkeypatch):
    written, feeds = [], star.Star(spark, "/nowhere")
    monkeypatch.setattr(star, "settle", lambda df, label: (time.sleep(0.1), written.append(label), df)[2])
    monkeypatch.setattr(feeds, "feed", lambda name: object())
    start = threading.Barrier(6)
    with ThreadPoolExecutor(6) as pool:
        got = [*pool.map(lambda _: (start.wait(), feeds.lines())[1], range(6))]
    assert written == ["src_line"] and len({id(x) for x in got}) == 1


def test_raw_feeds_are_not_copied(spark, folder):
    ctx = Context(spark, folder)
    assert ctx.bronze("web_sales").count() == ctx["src_web_sales"].count()
    top = application_folder(spark).removeprefix("file:")
    assert not [x for x in os.listdir(top) if x.startswith("bronze_")]
