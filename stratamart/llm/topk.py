"""Exact top-k by inner product over an impact-ordered index, score at a time.

Each component of a vector is a posting of its dimension. Its impact is quantised to a multiple of a step, and postings of
one impact form the segments that are worked off together, the highest impacts first, in three waves. The index keeps, for
each block of vectors, the segments of each wave laid out by dimension and vector, and for each vector the length of what no
wave up to then holds. After a wave, the sum so far plus (length of the query) * (length of the rest) bounds a score from
above by Cauchy and Schwarz. A query stops when that bound proves that only few vectors can still be among its best, and
after the last wave at any rate; all that can be are scored exactly.

Defined results: rows whose id is NULL or whose vector is NULL or holds a NULL or a number that is not finite take no part.
Of several rows of one id the one with the least vector counts. A shorter vector is filled with zeros, so an empty one has a
score of 0. Ties go to the smaller id. An empty table gives no rows. Other columns are not read. Scores must fit in a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import settle_at
from stratamart.llm.vector_blocks import BLOCK, EXACT32, GROUP, Best, dumps, integer_vector, loads, meet, pack, products, slim, wider

#: Lowest quantised impact of each wave, in steps; what is below the last one is in no segment.
WAVES = (5, 3, 1)
#: A step is this share of the root mean square of a block's components.
STEP = 0.5
#: A query stops its waves when no more vectors of a block than this can be among its best.
FEW = 256
#: Queries worked on together.
TOGETHER = 256
#: Rounding of the sums in float32 and of the lengths.
SLACK = 1e-4


def vectors(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """One (vec_id, v) a vector that takes part, v of whole numbers."""
    whole = rows.select(F.col(key).alias("vec_id"), integer_vector(F.col(vector), scale).alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    return whole.groupBy("vec_id").agg(F.min("v").alias("v"))


def segments(m: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The quantised impacts of each wave by vector and dimension, and the length of each vector's rest after each wave."""
    step = max(1, round(STEP * float(np.sqrt(np.mean(np.square(m, dtype=np.float64))))) if m.size else 1)
    level = (np.abs(m) + step // 2) // step
    impact = np.sign(m) * level * step
    rest, panels, lengths, above = m.astype(np.float64), [], [], np.iinfo(np.int64).max
    for lowest in WAVES:
        now = np.where((level >= lowest) & (level < above), impact, 0)
        above = lowest
        rest = rest - now
        panels.append(slim(now))
        lengths.append((np.sqrt(np.square(rest).sum(axis=1)) * (1 + SLACK)).astype(np.float32))
    return panels, lengths


def build_index(found: DataFrame) -> tuple[DataFrame, int]:
    """The index of all vectors (written before), in the shared folder: a row a block."""
    def make(columns: dict) -> bytes:
        m = columns["v"]
        return dumps(columns["vec_id"], slim(m), *segments(m))

    blocks, n = pack(found, "vec_id", BLOCK, ["vec_id", "v"], make)
    return settle_at(blocks, "index")[0], n


def _best_of_group(k: int):
    def work(group: bytes, blocks: Iterator[bytes]) -> pa.RecordBatch | None:
        idents, queries = loads(group)
        best = Best(len(idents), k)
        for body in blocks:
            ids, exact, panels, lengths = loads(body)
            width = max(queries.shape[1], exact.shape[1])
            q, x = wider(queries, width).astype(np.int64), wider(exact, width)
            panels = [wider(p, width) for p in panels]
            most = width * int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0))
            kind = np.float32 if most < EXACT32 else np.float64
            panels = [p.astype(kind).T for p in panels]
            for at in range(0, len(q), TOGETHER):
                _waves(q[at:at + TOGETHER], idents[at:at + TOGETHER], at, best, ids, x, panels, lengths, kind)
        rows = [(i, r) for r, i in enumerate(idents.tolist()) if len(best.lists[r][0])]
        if not rows:
            return None
        counts = [len(best.lists[r][0]) for _, r in rows]
        return pa.RecordBatch.from_pydict({
            "query_id": np.repeat(np.array([i for i, _ in rows], np.int64), counts), "vec_id": np.concatenate([best.lists[r][1] for _, r in rows]),
            "score": np.concatenate([best.lists[r][0] for _, r in rows])})
    return work


def _waves(q: np.ndarray, idents: np.ndarray, at: int, best: Best, ids: np.ndarray, x: np.ndarray, panels: list, lengths: list, kind: type) -> None:
    """Work off the segments of one block for a few queries; what can be among their best goes to ``best``."""
    k, open_, length = best.k, np.arange(len(q)), np.sqrt(np.square(q.astype(np.float64)).sum(axis=1)) * (1 + SLACK)
    sums = np.zeros((len(q), len(ids)), kind)
    weights = q.astype(kind)
    for nr, (panel, rest) in enumerate(zip(panels, lengths, strict=True)):
        sums = sums + weights[open_] @ panel
        still = []
        for row, j in enumerate(open_):
            reach = length[j] * rest
            total = sums[row].astype(np.float64)
            # k vectors reach at least this score here, so a vector below it has k before it; another k+1st makes up for the query's own
            proven = np.partition(total - reach, len(ids) - k - 1)[len(ids) - k - 1] if len(ids) > k else -np.inf
            known = best.least(at + j)
            least = max(proven, known if known is not None else -np.inf)
            able = np.flatnonzero(total + reach >= least - SLACK * (1 + abs(least)) if np.isfinite(least) else np.ones(len(ids), bool))
            if len(able) > max(FEW, k) and nr + 1 < len(panels):
                still.append(row)
                continue
            able = able[ids[able] != idents[j]]
            best.add(at + j, products(q[j:j + 1], x[able])[0], ids[able])
        if not still:
            return
        open_, sums = open_[still], sums[still]


def top_k(found: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The k vectors of highest inner product of each query among all vectors but its own: query_id, rank, vec_id, score."""
    found, _ = settle_at(found, "vectors")
    index, n_blocks = build_index(found)
    groups, n_groups = pack(found.where(is_query), "vec_id", GROUP, ["vec_id", "v"], lambda c: dumps(c["vec_id"], slim(c["v"])))
    near = meet(groups, n_groups, index, n_blocks, _best_of_group(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


OP11_SQL = """
WITH used AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 64) AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY 1),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM used q JOIN used c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""
