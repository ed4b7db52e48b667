import importlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from stratamart.llm import decontaminate, mixing, ngram_join, queries, secrets, toxicity
from tests.llm.test_ngram_join import sets_of


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in P.STAGES:
        new, _ = P.settle_at(stage(spark, docs, folder), f"test-{name}")
        out.append((docs, new))
        docs = new
    return out


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_each_stage_against_its_input(spark, folder, stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_join", "decontamination", "secrets", "mixing"]
    for before, after in stages[:-1]:
        assert after.columns == before.columns
    (a, b), (_, c), (_, d), (_, e), (_, f) = stages
    lexicon = toxicity.fit(a, spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic"), F.lit(True))
    assert set(rows_of(b)) == {k for k, r in rows_of(a).items() if lexicon.score(r["text"]) < toxicity.THRESHOLD} < set(rows_of(a))
    # near duplicates: one of each component by brute force over all pairs
    rows = [(r["doc_id"], r["text"]) for r in b.collect()]
    sets, kept = sets_of(rows, 5), rows_of(c)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i) if sets[i] else ("blank", i), []).append(r[0])
    assert set(kept) == {min(g) for g in groups.values()}
    # decontamination: every item against every document
    items = [p for block in decontaminate.blocks_of(spark.read.parquet(f"{folder}/benchmark.parquet")) for p in block]
    leaks = {k for k, r in kept.items() if any(decontaminate.found_in(p, w := decontaminate.words_in(r["text"]), 0, len(w)) for p in items)}
    assert set(rows_of(d)) == set(kept) - leaks and leaks
    # secrets: none of the base patterns is left, texts without secrets are unchanged
    before, after = rows_of(d), rows_of(e)
    assert set(before) == set(after) and not any(secrets.base_spans(r["text"] or "") for r in after.values())
    assert all(after[k]["text"] == r["text"] for k, r in before.items() if secrets.MASK not in (after[k]["text"] or ""))
    plan = {r["doc_id"]: r["taken"] for r in mixing.mixed_rows(e).collect() if r["taken"]}
    assert {k: r["taken"] for k, r in rows_of(f).items()} == plan


def test_run_equals_its_stages(spark, folder, stages):
    got = P.run(spark, folder)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages[-1][1].collect()))
    assert ngram_join.keep_one(spark.read.parquet(f"{folder}/documents.parquet").limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, folder, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = queries.QUERIES[name](spark, folder)
    want = db.execute(queries.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {f"{x.split('_')[0]}_" for x in names if x.startswith("op")} and "pipeline" in names
