"""Hard negatives: for each anchor and each of its nearest positives, the best-scored rows of other labels in a window.

Scores are integer inner products. Anchors are compared with all rows block by block; the first pass keeps the nearest
positives of each anchor. The second knows their windows and keeps, for each stretch of blocks, the first rows of every
window, which include all that can be among the first of the whole table. A kept pair becomes a key of 25 bytes: anchor,
descending score, positives before negatives, id. The keys are dealt by anchor and sorted inside their partitions, and one
pass over a partition opens a window at each positive, hands negatives to the open windows and closes those that are full or
left behind. It holds the open windows of one anchor, at most as many as positives are asked for.

Defined results: rows with a NULL id or label, a NULL vector or a component that is NULL or not finite take no part; of
several rows of one id the one with the least (vector, label) counts. A shorter vector is filled with zeros. A window whose
positive scores below 0 is empty, and that of a positive of score 0 holds the scores of 0. Ties go to smaller ids. An empty
table, an anchor without another row of its label and one without rows in a window give no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import settle_at
from stratamart.llm.vector_blocks import BLOCK, GROUP, Best, dumps, integer_vector, loads, meet, pack, products, slim, wider

POSITIVES, NEGATIVES = 5, 10
#: Of a positive's score, in hundredths: where its window begins and ends.
LOW, HIGH = 30, 90
KEY = ">QQBQ"
TOP = 1 << 63


def labelled(rows: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """One (vec_id, label, v) a row that takes part."""
    whole = rows.select(F.col(key).alias("vec_id"), label.cast("long").alias("label"), integer_vector(F.col(vector), scale).alias("v"))
    one = whole.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("r"))
    return one.select("vec_id", "r.label", "r.v")


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    width = max(queries.shape[1], rows.shape[1])
    return products(wider(queries, width), wider(rows, width))


def _pairs(best: Best, anchors: np.ndarray) -> pa.RecordBatch | None:
    counts = [len(s) for s, _ in best.lists]
    if not sum(counts):
        return None
    return pa.RecordBatch.from_pydict({"anchor_id": np.repeat(anchors, counts), "other_id": np.concatenate([i for _, i in best.lists]), "score": np.concatenate([s for s, _ in best.lists])})


def _nearest(group: bytes, blocks: Iterator[bytes]) -> pa.RecordBatch | None:
    """The nearest rows of an anchor's label in a stretch."""
    anchors, labels, queries, _ = loads(group)
    best = Best(len(anchors), POSITIVES)
    for body in blocks:
        ids, kinds, rows = loads(body)
        scores = _scores(queries, rows)
        for a in range(len(anchors)):
            same = np.flatnonzero((kinds == labels[a]) & (ids != anchors[a]))
            best.add(a, scores[a, same], ids[same])
    return _pairs(best, anchors)


def _in_windows(group: bytes, blocks: Iterator[bytes]) -> pa.RecordBatch | None:
    """The first rows of each window of each anchor in a stretch."""
    anchors, labels, queries, windows = loads(group)
    best = [Best(len(anchors), NEGATIVES) for _ in range(POSITIVES)]
    for body in blocks:
        ids, kinds, rows = loads(body)
        scores = _scores(queries, rows)
        for a in range(len(anchors)):
            for nr, p in enumerate(windows[a]):
                if p < 0:
                    continue
                s = scores[a]
                inside = np.flatnonzero((100 * s >= LOW * p) & (100 * s <= HIGH * p) & (kinds != labels[a]))
                best[nr].add(a, s[inside], ids[inside])
    for a in range(len(anchors)):  # a row in several windows is one pair
        s, i = (np.concatenate([b.lists[a][k] for b in best]) for k in (0, 1))
        _, first = np.unique(i, return_index=True)
        best[0].lists[a] = s[first], i[first]
    return _pairs(best[0], anchors)


def pack_key(anchor: int, score: int, negative: bool, ident: int) -> bytes:
    """Bytes that sort as (anchor, descending score, positives first, id)."""
    return struct.pack(KEY, anchor + TOP, TOP - 1 - score, negative, ident + TOP)


def unpack_key(key: bytes) -> tuple[int, int, bool, int]:
    anchor, score, negative, ident = struct.unpack(KEY, key)
    return anchor - TOP, TOP - 1 - score, bool(negative), ident - TOP


def emit(pairs: Iterator[tuple[bytes, None]]) -> Iterator[tuple]:
    """The rows of the result out of sorted keys."""
    anchor, windows = None, []
    for key, _ in pairs:
        now, score, negative, ident = unpack_key(key)
        if now != anchor:
            anchor, windows = now, []
        if not negative:
            if score >= 0:
                windows.append([ident, score, 0])
            continue
        windows = [w for w in windows if w[2] < NEGATIVES and 100 * score >= LOW * w[1]]
        for w in windows:
            if 100 * score <= HIGH * w[1]:
                w[2] += 1
                yield anchor, w[0], w[2], ident, w[1], score


def mine(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of rows made by labelled()."""
    spark = rows.sparkSession
    rows, _ = settle_at(rows, "labelled")
    blocks, n_blocks = pack(rows, "vec_id", BLOCK, ["vec_id", "label", "v"], lambda c: dumps(c["vec_id"], c["label"], slim(c["v"])))
    blocks, _ = settle_at(blocks, "blocks")

    def groups(anchors: DataFrame) -> tuple[DataFrame, int]:
        return pack(anchors, "vec_id", GROUP, ["vec_id", "label", "v", "windows"], lambda c: dumps(c["vec_id"], c["label"], slim(c["v"]), c["windows"]))

    pair = "anchor_id long, other_id long, score long"
    anchors = rows.where(is_anchor)
    near = meet(*groups(anchors.withColumn("windows", F.array().cast("array<long>"))), blocks, n_blocks, _nearest, pair)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    positives, _ = settle_at(near.withColumn("p_rank", F.row_number().over(order)).where(F.col("p_rank") <= POSITIVES).drop("p_rank"), "positives")

    # five scores an anchor at most; a place that is not taken holds -1
    ends = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list("score"), asc=False).alias("p"))
    known, _ = settle_at(anchors.join(ends, "vec_id").withColumn("windows", F.transform(F.sequence(F.lit(1), F.lit(POSITIVES)), lambda k: F.coalesce(F.try_element_at("p", k), F.lit(-1).cast("long")))).drop("p"), "anchors")
    inside = meet(*groups(known), blocks, n_blocks, _in_windows, pair)

    kept = positives.withColumn("negative", F.lit(False)).unionByName(inside.withColumn("negative", F.lit(True)))
    keys = kept.rdd.map(lambda r: (pack_key(r["anchor_id"], r["score"], r["negative"], r["other_id"]), None))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keys.repartitionAndSortWithinPartitions(parts, lambda key: zlib.crc32(key[:8]))
    return spark.createDataFrame(dealt.mapPartitions(emit), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long", verifySchema=False)


OP13_SQL = """
WITH used AS (
  SELECT vec_id, min({'v': list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS DOUBLE)),
                      'label': CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT)}) AS r FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY 1),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.r.label = b.r.label AS same, CAST(list_inner_product(a.r.v, b.r.v) AS BIGINT) AS score
  FROM used a JOIN used b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
near AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS nr FROM scored WHERE same),
inside AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank
  FROM near p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score WHERE p.nr <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM inside WHERE rank <= 10"""
