import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import ngram_join as J


def sets_of(rows, width):
    def one(text):
        words = (text or "").encode().lower().split()
        if len(words) < width:
            return frozenset([tuple(words)]) if words else frozenset()
        return frozenset(tuple(words[k:k + width]) for k in range(len(words) - width + 1))
    return [one(r[1]) for r in rows]


def brute(rows, width, percent):
    sets, parent = sets_of(rows, width), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    rows, n = [], 0
    shared = [" ".join(rnd.choices(vocab, k=25)) for _ in range(3)]
    for _ in range(40):
        words = rnd.choices(vocab, k=rnd.choice([3, 8, 12, 30, 90, 200]))
        for _ in range(rnd.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            text = " ".join(copy)
            rows.append((n, f"{text} {rnd.choice(shared)}" if rnd.random() < .3 else text))
            n += 1
    return rows


@pytest.mark.parametrize("seed,width,percent,bits,limit", [(1, 4, 85, 20, None), (2, 5, 80, 4, None), (3, 4, 85, 6, 0), (4, 3, 60, 6, 0)])
def test_equals_brute_force(spark, frame, monkeypatch, seed, width, percent, bits, limit):
    rows = corpus(seed)
    if limit is not None:  # everything is frequent: only combinations are indexed
        plain = J._postings
        monkeypatch.setattr(J, "_postings", lambda w, p, b, table, _: plain(w, p, b, table, 0))
    got = J.join_documents(frame(rows), width, percent, bits).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, width, percent)


@pytest.mark.parametrize("percent", [60, 80, 85])
def test_signatures_meet_wherever_sets_are_similar(percent):
    rnd = np.random.default_rng(5)
    for _ in range(400):
        n = int(rnd.integers(6, 300))
        a = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64))
        lost = int(rnd.integers(0, max(1, len(a) * (100 - percent) // 100)))
        b = np.unique(np.concatenate([a[lost:], rnd.integers(0, 2**63, int(rnd.integers(0, 3)), dtype=np.uint64)]))
        if not J.similar(a, b, percent) or np.array_equal(a, b):
            continue
        for limit in (-1, 20, 100):
            count = lambda h: (h % np.uint64(40)).astype(np.uint16)
            small, large = sorted((a, b), key=len)
            sigs, least = J.signatures(small, count(small), limit, percent)
            assert np.intersect1d(sigs[least], J.signatures(large, count(large), limit, percent)[0]).size


def test_edges_and_one_of_each(spark, frame):
    long = " ".join(f"t{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c d e f g h"), (5, "A B c d e f g h"), (5, "A B c d e f g h"), (7, "x y"), (8, "x  Y"), (9, long), (10, long + " more"),
            (None, "alone with no number at all here"), (11, "q r s t u v w x y")]
    got = J.join_documents(frame(rows), 4, 85).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 4, 85)
    docs = frame(rows).withColumn("cls", F.lit("theirs")).withColumn("root", F.lit(1)).withColumn("k_doc", F.lit(2))
    kept = J.keep_one(docs, 4, 85)
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect() if r["text"] and r["text"].strip()) == sorted(
        [("5", "A B c d e f g h"), ("7", "x y"), ("9", long), ("None", "alone with no number at all here"), ("11", "q r s t u v w x y")])
    assert sum(not (r["text"] or "").strip() for r in kept.collect()) == 3
    assert J.join_documents(frame([]), 4, 85).count() == 0 and J.keep_one(frame([])).count() == 0


def test_a_large_group_of_near_copies_needs_few_comparisons(spark, frame, monkeypatch):
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(400):
        copy = list(words)
        copy[rnd.randrange(120)] = f"x{k}"
        rows.append((k, " ".join(copy)))
    seen = []
    plain = J._verified

    def counted(pairs, sets, percent):
        seen.append(pairs.count())
        return plain(pairs, sets, percent)

    monkeypatch.setattr(J, "_verified", counted)
    got = J.join_documents(frame(rows), 5, 80).select("component_id").distinct().collect()
    assert [r[0] for r in got] == [0] and sum(seen) < 4 * len(rows)


def test_signatures_of_one_class_are_not_shuffled_again(spark, frame):
    """Beside those of several classes, the join sees only what falls on the same marks; few bits cost time, never a link."""
    rows = [(k, " ".join(f"t{k}x{j}" for j in range(60))) for k in range(300)]
    rows += [(1000 + k, " ".join(["x", *(f"c{j}" for j in range(60))][k:])) for k in range(2)]
    table = np.zeros(1 << 12, dtype=np.int64)
    made = frame(rows).select("text").mapInPandas(J._postings(4, 85, 12, table, 1), "sig long, least boolean, cls long, n long, first long")
    want = {tuple(r) for r in made.collect()}
    by_sig = {}
    for r in want:
        by_sig.setdefault(r[0], set()).add(r[2])
    want = {r for r in want if len(by_sig[r[0]]) > 1}
    assert want
    for bits in (26, 4):
        got, _ = J._in_several(made, bits)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    marks = J._marks(spark.createDataFrame([(5,), (-1,), (5 + 2**30,)], "sig long"), 26)
    assert marks.size == 1 << 23 and np.unpackbits(marks).sum() == 2
    got = J.join_documents(frame(rows), 4, 85).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 4, 85)


def test_counts_of_a_profile_rule_out_what_the_profile_does(spark):
    rnd = np.random.default_rng(2)
    sets = [np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64)) for n in (5, 300, 300, 9_000, 60_000)]
    sets.append(np.unique(np.concatenate([sets[1][3:], sets[0][:2]])))
    rows = [(k, len(h), bytearray(J.profile(h).tobytes())) for k, h in enumerate(sets)]
    made = J._counts_of(spark.createDataFrame(rows, "cls long, size long, profile binary")).collect()
    assert all(list(r["held"]) == [min(x, J.FULL) for x in J.profile(sets[r["cls"]]).tolist()] for r in made)
