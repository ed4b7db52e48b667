import random

import pytest
from pyspark.sql import functions as F

from stratamart.llm import decontaminate as D


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            last, row[k + 1] = row[k + 1], (last + 1 if x == y else max(row[k], row[k + 1]))
    return row[-1]


def test_common_subsequence_equals_table():
    rnd = random.Random(1)
    for _ in range(200):
        a, b = ([bytes([97 + rnd.randrange(5)]) for _ in range(rnd.randrange(1, 60))] for _ in range(2))
        assert D.common(D._masks(a), len(a), b) == lcs(a, b)


@pytest.fixture
def planted(spark, frame):
    rnd = random.Random(8)
    vocab = [f"w{k}" for k in range(1500)]
    text = lambda n: " ".join(rnd.choices(vocab, weights=[30 / (k + 3) for k in range(1500)], k=n))
    items = [(k, f"{text(rnd.choice([12, 25, 40]))}. {text(6)}.") for k in range(40)] + [(40, text(250)), (41, None), (42, "too short"), (None, text(30))]
    rows, truth = [], set()
    for k in range(400):
        words = text(rnd.choice([20, 150, 600])).split()
        if k % 5 == 0:
            item, body = items[k // 5 % 41]
            piece = body.split()
            if k % 3 == 0:  # a paraphrase: some words changed, the answer kept
                for _ in range(len(piece) // 5):
                    piece[rnd.randrange(len(piece) - 6)] = rnd.choice(vocab)
            at = rnd.randrange(len(words))
            words[at:at] = piece
            truth.add((k, item))
        rows.append((k, " ".join(words)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return frame([*rows, (1000, None), (1001, "")], 4), benchmark, truth


def test_finds_planted_items_and_leaves_the_rest(planted):
    docs, benchmark, truth = planted
    got = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, benchmark).collect()}
    assert len(got & truth) >= 0.95 * len(truth) and len(got - truth) <= 2
    clash = docs.withColumn("hit", F.lit("theirs"))
    kept = D.drop_leaks(clash, benchmark)
    assert kept.columns == clash.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - {k for k, _ in got}


def test_candidates_recall_against_brute_force(planted):
    docs, benchmark, _ = planted
    passages = next(D.blocks_of(benchmark))
    space = D.fit_space(docs, passages)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["text"]]
    every = {(k, p.item) for k, t in rows for p in passages if D.found_in(p, w := D.words_in(t), 0, len(w))}
    found = {(k, h[0]) for k, t in rows for h in space.search(t)}
    assert len(every) > 50 and len(found & every) >= 0.95 * len(every)
    assert (space.singular[:-1] >= space.singular[1:] - 1e-9).all()


def test_every_verbatim_copy_is_found(spark, frame):
    """Whatever stands around an item, and also if all its words are stop terms of the benchmark."""
    rnd = random.Random(4)
    vocab = [f"w{k}" for k in range(300)]
    draw = lambda n: rnd.choices(vocab, weights=[30 / (k + 3) for k in range(300)], k=n)
    items = [(k, " ".join(draw(rnd.choice([8, 10, 18, 41, 150])))) for k in range(120)]
    rows = []
    for k, text in items:
        around = (["ndin"] * 80, draw(120), [text.split()[0]] * 90, [])[k % 4]
        rows.append((k, " ".join([*around[:len(around) // 2], text, *around[len(around) // 2:]])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(frame(rows), benchmark).collect()}
    assert {(k, k) for k, _ in items} <= got
    same = spark.createDataFrame([(k, " ".join(rnd.sample(vocab[:9], 9))) for k in range(60)], "item_id long, text string")
    docs = frame([(r["item_id"], "before " + r["text"] + " after") for r in same.collect()])
    assert {(k, k) for k in range(60)} <= {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, same).collect()}
    assert D.drop_leaks(docs, same).count() == 0


def test_blocks_and_edges(planted, frame, monkeypatch, spark):
    docs, benchmark, truth = planted
    monkeypatch.setattr(D, "BLOCK_PASSAGES", 16)
    monkeypatch.setattr(D.blocks_of, "__defaults__", (16,))
    got = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, benchmark).collect()}
    assert len(got & truth) >= 0.95 * len(truth)
    assert D.find_leaks(frame([]), benchmark).count() == 0
    nothing = benchmark.limit(0)
    assert D.find_leaks(docs, nothing).count() == 0 and D.drop_leaks(docs, nothing).count() == 402


def test_short_items_and_scripts_without_blanks(spark, frame):
    benchmark = spark.createDataFrame([(1, "what is the capital of france paris"), (2, "\u5317\u4eac\u662f\u4e2d\u56fd\u7684\u9996\u90fd\u4e5f\u662f\u6700\u5927\u7684\u57ce\u5e02"), (3, "two words")], "item_id long, text string")
    docs = frame([(1, "noise before. What is the capital of France? Paris! and after " * 2), (2, "the capital of france is what paris is"), (3, "x" * 50 + " \u5317\u4eac\u662f\u4e2d\u56fd\u7684\u9996\u90fd\u4e5f\u662f\u6700\u5927\u7684\u57ce\u5e02\u3002 y"), (4, "two words")])
    assert {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, benchmark).collect()} == {(1, 1), (3, 2)}
