import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.llm import topk, vector_blocks

SHAPE = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("score", T.StringType()), T.StructField("v", T.IntegerType())])


def whole(vector):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(64 * x) for x in vector]


def brute(rows, k, every):
    used = {}
    for ident, vector, *_ in rows:
        v = whole(vector)
        if ident is not None and v is not None:
            used[ident] = min(used.get(ident, v), v)
    out = []
    for q in used:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(used[q], used[c], strict=False)), c) for c in used if c != q)
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, rows, k=20, every=20, parts=3):
    df = spark.createDataFrame(rows, SHAPE).repartition(parts)
    return sorted(map(tuple, topk.top_k(topk.vectors(df, "vec_id", "embedding", 64), F.col("vec_id") % every == 0, k).collect()))


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 60)
    monkeypatch.setattr(topk, "GROUP", 7)
    monkeypatch.setattr(topk, "FEW", 5)
    monkeypatch.setattr(vector_blocks, "STRETCH", 2)


def test_equals_brute_force_over_many_blocks(spark, small_blocks):
    rng = random.Random(2)
    base = (1 << 60) + 20 - (1 << 60) % 20
    rows = [(base + k, [math.ldexp(round(rng.gauss(0, 1), 3), -3) for _ in range(24)], "x", 1) for k in range(400)]
    rows += [(5000 + k, rows[0][1], "copy", 2) for k in range(150)]  # one vector in a third of the rows: ties everywhere
    rows += [(None, rows[3][1], None, None), (40, None, None, None), (60, [1.0, None], None, None), (80, [float("nan")], None, None), (100, [float("inf"), 1.0], None, None)]
    rows += [(120, [], "empty", 0), (140, [0.5], "short", 0), (160, [-0.0] * 24, "zero", 0), (7, [300.0] * 40, "long", 0), rows[0], (base + 1, [0.0] * 24, "second", 0)]
    assert found(spark, rows) == brute(rows, 20, 20)


def test_waves_stop_by_proof_and_few_rows(spark, small_blocks):
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(16)] for _ in range(8)]
    rows = [(k, [c + rng.gauss(0, 0.05) for c in centres[k % 8]], "x", 0) for k in range(500)]
    assert found(spark, rows, 5, 10) == brute(rows, 5, 10)
    assert found(spark, rows[:4], 20, 1) == brute(rows[:4], 20, 1)
    assert found(spark, []) == []
    assert found(spark, [(20, [1.0], "alone", 0)]) == []


def test_large_components_stay_exact(spark):
    rows = [(k, [2.0 ** 23 + k, -(2.0 ** 18) * k, 3.0], "x", 0) for k in range(40)]
    assert found(spark, rows, 10, 10) == brute(rows, 10, 10)
