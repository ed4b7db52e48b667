from collections import defaultdict

import pytest

from stratamart.llm import mixing


def water(sizes, weights):
    """Targets by resharing again and again."""
    total, full = sum(sizes), set()
    while True:
        rest = total - sum(3 * sizes[k] for k in full)
        open_weight = sum(w for k, w in enumerate(weights) if k not in full)
        level = rest / open_weight if open_weight else 0
        over = {k for k in range(len(sizes)) if k not in full and weights[k] * level >= 3 * sizes[k]}
        if not over:
            return [3.0 * s if k in full else weights[k] * level for k, s in enumerate(sizes)]
        full |= over


def test_targets_and_cuts(spark, frame):
    rows = [(k, "w " * (k % 13), f"s{k % 7 if k % 3 else 0}") for k in range(400)] + [(None, "a b", None), (7, None, None), (3, "w w w", "s0"), (3, "w w w", "s0"), (900, "é", "é")]
    got = mixing.mixed_rows(frame(rows)).collect()
    assert len(got) == len(rows)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    order = sorted(size, key=lambda s: (s is None, s or ""))
    want = water([size[s] for s in order], [k % 3 + 1 for k in range(len(order))])
    assert [target[s] for s in order] == pytest.approx(want)
    assert all(target[s] - 3 < taken[s] <= target[s] for s in order)  # units of two rows may leave a word
    assert sorted(map(str, got)) == sorted(map(str, mixing.mixed_rows(frame(rows, 5)).collect()))


def test_one_hot_source_over_many_ranges_and_empty_table(spark, frame):
    rows = [(k, "w " * (1 + k % 5), "hot" if k % 3 else f"s{k % 4}") for k in range(3000)]
    docs = frame(rows, 8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = mixing.mixed_rows(docs).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hot = [r for r in got if r["source"] == "hot"]
    assert sum(r["taken"] for r in hot) == int(hot[0]["target"])
    assert mixing.mixed_rows(frame([])).count() == 0
    assert mixing.mixed_rows(frame([(1, None), (2, "")])).select("taken").distinct().collect() == [(0,)]


def test_apply_keeps_texts_and_totals(spark, frame):
    rows = [(k, "w " * (k % 9), f"s{k % 4}") for k in range(200)] + [(5, "x y", "s1"), (5, "x y", "s1")]
    docs = frame(rows)
    mixed = mixing.apply_mix(docs.withColumn("u_size", docs.n_chars)).collect()
    plan = [r for r in mixing.mixed_rows(docs).collect() if r["taken"]]
    assert sorted((r["doc_id"], r["taken"]) for r in mixed) == sorted((r["doc_id"], r["taken"]) for r in plan)
    assert all(r["taken"] == r["epochs"] * r["size"] + r["tail_words"] and r["text"] is not None for r in mixed)


def test_native(spark, frame):
    plan = mixing.mixed_rows(frame([(1, "a b", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))
