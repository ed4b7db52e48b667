import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.llm import negatives, vector_blocks

SHAPE = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("anchor_id", T.StringType())])


def brute(rows, every):
    used = {}
    for ident, vector, label, *_ in rows:
        if ident is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        one = ([math.floor(256 * x) for x in vector], label)
        used[ident] = min(used.get(ident, one), one)
    out = []
    for a, (v, label) in used.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), c, k) for c, (w, k) in used.items() if c != a)
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            p_score = -s
            inside = [(c, -t) for t, c, k in scored if k != label and 30 * p_score <= -100 * t <= 90 * p_score]
            out += [(a, p, r + 1, c, p_score, t) for r, (c, t) in enumerate(inside[:10])]
    return sorted(out)


def mined(spark, rows, every=10, parts=3):
    df = spark.createDataFrame(rows, SHAPE).repartition(parts)
    return sorted(map(tuple, negatives.mine(negatives.labelled(df, "vec_id", "embedding", F.col("label"), 256), F.col("vec_id") % every == 0).collect()))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 50)
    monkeypatch.setattr(negatives, "GROUP", 6)
    monkeypatch.setattr(vector_blocks, "STRETCH", 2)


def test_equals_brute_force(spark, small_blocks):
    rng = random.Random(7)
    big = (1 << 60) + 10 - (1 << 60) % 10
    rows = [(big + k, [rng.gauss(0.1, 0.2) for _ in range(6)], rng.randrange(4), "x") for k in range(300)]
    rows += [(3000 + k, rows[0][1], k % 2, "copy") for k in range(150)]  # one vector in a third of the rows
    rows += [(-30 + k, [0.25, 0.5], 3, "negative id") for k in range(20)]
    rows += [(None, [1.0], 1, None), (10, None, 1, None), (20, [1.0], None, None), (30, [None, 1.0], 2, None), (40, [float("nan")], 2, None), (50, [], 1, None), rows[4], (big, [0.0] * 6, 1, None)]
    assert mined(spark, rows) == brute(rows, 10)


def test_windows_of_zero_and_below_and_few_rows(spark):
    rows = [(0, [1.0, 0.0], 1, "a"), (1, [0.0, 1.0], 1, "zero"), (2, [-1.0, 0.0], 1, "below"), (3, [0.0, 2.0], 2, "zero"), (4, [-0.5, 0.0], 2, "below"), (5, [0.0, 3.0], 3, "zero"), (6, [0.5, 0.0], 2, "above")]
    assert mined(spark, rows, 100) == brute(rows, 100) == [(0, 1, 1, 3, 0, 0), (0, 1, 2, 5, 0, 0)]
    assert mined(spark, rows[:1], 100) == [] == mined(spark, [], 100)


def test_keys_sort_by_anchor_descending_score_positives_first():
    rng = random.Random(1)
    parts = [(rng.choice([-5, 0, 9, 1 << 60]), rng.choice([-(1 << 62), -1, 0, 7, 1 << 62]), rng.random() < 0.5, rng.choice([-3, 2, (1 << 60) + 1])) for _ in range(300)]
    keys = sorted(negatives.pack_key(*p) for p in parts)
    assert [negatives.unpack_key(k) for k in keys] == sorted(parts, key=lambda p: (p[0], -p[1], p[2], p[3]))
