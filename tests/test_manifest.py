import pytest
from pyspark.sql import functions as F

from stratamart.plans.retail import flow as retail
from stratamart.plans.retail.flow import RetailFlow
from stratamart.registry.core import context
from stratamart.session import scratch_path
from stratamart.sinks.manifest import FAILED, KEPT, WRITTEN, Manifest, Outcome, side_by_side_jobs


def ids(spark, n, tag):
    return spark.range(n).withColumn("tag", F.lit(tag))


def test_readers_see_a_batch_as_a_whole_or_the_one_before(spark):
    m = Manifest(spark, scratch_path(spark, "manifest"))
    assert m.sealed("gold") is None
    with pytest.raises(LookupError):
        m.read("gold", "a")
    for name in "ab":
        m.write(ids(spark, 3, "one"), "b1", "gold", name)
    assert m.seal("b1", "gold", "ab")
    m.write(ids(spark, 5, "two"), "b2", "gold", "a")
    assert not m.seal("b2", "gold", "ab")  # b is missing
    assert [m.read("gold", n).count() for n in "ab"] == [3, 3]
    m.write(ids(spark, 7, "two"), "b2", "gold", "b")
    assert m.seal("b2", "gold", "ab")
    assert [m.read("gold", n).count() for n in "ab"] == [5, 7]
    assert not m.seal("b1", "gold", "ab")  # an older batch that runs again does not take over
    assert Manifest(spark, m.root).sealed("gold") == "b2"
    assert m.read("gold", "a", "b1").count() == 3


def test_an_attempt_without_a_commit_is_swept_and_never_read(spark):
    m = Manifest(spark, scratch_path(spark, "manifest"))
    m.write(ids(spark, 3, "one"), "b1", "silver", "a")
    m.write(ids(spark, 9, "stage"), "b1", "silver", "_stg_a")
    ids(spark, 100, "killed").write.parquet(f"{m.root}/silver/a/b1-deadbeef")
    ids(spark, 100, "other batch").write.parquet(f"{m.root}/silver/a/b2-deadbeef")
    assert m.sweep("b1", "silver", ["a"]) == 2
    assert m.read("silver", "a", "b1").count() == 3
    assert spark.read.parquet(f"{m.root}/silver/a/b2-deadbeef").count() == 100


def test_partitioned_tables_and_comments_in_the_catalog(spark):
    m = Manifest(spark, scratch_path(spark, "manifest"))
    m.write(ids(spark, 40, "x").withColumn("year", (F.col("id") % 4 + 1990).cast("int")), "b1", "silver", "facts", "year")
    m.seal("b1", "silver", ["facts"])
    for _ in range(2):
        m.expose("silver", "manifest_test_silver", ["facts"], {"facts": "It's the facts"})
    table = spark.table("manifest_test_silver.facts")
    assert table.where("year = 1991").count() == 10 and table.count() == 40
    assert spark.catalog.getTable("manifest_test_silver.facts").description == "It's the facts"


def test_jobs_side_by_side_report_their_own_errors(spark):
    def job(k):
        if k == 3:
            raise ValueError("no such feed\nmore")
        return Outcome("bronze", str(k), WRITTEN, spark.range(k).count())

    done = side_by_side_jobs(spark, {str(k): (lambda k=k: job(k)) for k in range(6)}, "bronze", 4)
    assert [(o.table_name, o.status, o.rows) for o in done] == [(str(k), FAILED if k == 3 else WRITTEN, None if k == 3 else k) for k in range(6)]
    assert done[3].detail == "no such feed"


def test_a_killed_landing_resumes_and_silver_waits(spark, folder, monkeypatch):
    ctx = context(spark, folder)
    names = ["income_band", "reason", "ship_mode", "warehouse"]
    monkeypatch.setattr(retail, "SYSTEMS", {n: retail.SYSTEMS[n] for n in names})
    monkeypatch.setitem(retail.LAYERS, "bronze", names)
    asked = []

    def killed(name):
        asked.append(name)
        if name == "ship_mode":
            raise KeyboardInterrupt
        return ctx[f"src_{name}"]

    root = scratch_path(spark, "flow")
    first = RetailFlow(spark, root, "flow_killed", killed, "b1", width=1)
    with pytest.raises(KeyboardInterrupt):
        first.land()
    with pytest.raises(RuntimeError):
        first.build_silver()
    assert first.manifest.sealed("bronze") is None
    second = RetailFlow(spark, root, "flow_killed", lambda n: ctx[f"src_{n}"], "b1")
    done = {o.table_name: o.status for o in second.land()}
    assert done["ship_mode"] == WRITTEN and {done[n] for n in asked if n != "ship_mode"} <= {KEPT, WRITTEN} and done["income_band"] == KEPT
    assert second.manifest.sealed("bronze") == "b1"
    assert {o.status for o in RetailFlow(spark, root, "flow_killed", lambda n: ctx[f"src_{n}"], "b1").land()} == {KEPT}
    assert spark.table("flow_killed_bronze.reason").where("_batch_id = 'b1' AND _source_system = 'ref_data'").count() == ctx["src_reason"].count()


def test_few_marts_at_a_time(spark, monkeypatch):
    widths = []
    monkeypatch.setattr(retail, "side_by_side_jobs", lambda spark, jobs, layer, width: widths.append((layer, width)) or [])
    flow = RetailFlow(spark, scratch_path(spark, "flow"), "flow_widths", lambda n: None, "b1")
    monkeypatch.setattr(flow, "_require", lambda layer: None)
    flow.build_gold()
    flow.build_silver()
    assert widths == [("gold", retail.MARTS_AT_ONCE), *[("silver", 8)] * len(retail.WAVES)]
