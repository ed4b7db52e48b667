"""Integer vectors in blocks, and query groups that meet the blocks one after another inside a task.

A block is a few thousand vectors packed into one row. A query group is sent to every stretch of blocks and sorted before
them, so a task holds one group and one block at a time, and what it keeps for a query is a short list.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 16_384
GROUP = 1_024
#: Blocks that a query group meets in one task at most.
STRETCH = 64
#: Sums of products below these are whole numbers in float32 and float64.
EXACT32, EXACT64 = 1 << 24, 1 << 53


def integer_vector(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x as double; NULL where the vector or a component is NULL or not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long")))


def matrix(lists: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of int64; shorter vectors are filled with zeros, which add nothing to a product."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy()
    flat, sizes = lists.values.to_numpy(zero_copy_only=False), np.diff(offsets)
    width = max(int(sizes.max(initial=0)), width or 0)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    if width:
        at = np.arange(width)[None, :] < sizes[:, None]
        out[at] = flat[offsets[0]:offsets[-1]]
    return out


def wider(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] >= width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def slim(m: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest integers that hold them."""
    most = int(np.abs(m).max(initial=0))
    return m.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(t).max))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows: in float32 or float64 where these hold every partial sum, in int64 otherwise."""
    most = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most < EXACT64:
        kind = np.float32 if most < EXACT32 else np.float64
        return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def pack(rows: DataFrame, key: str, size: int, columns: list[str], make: Callable[[dict], bytes]) -> tuple[DataFrame, int]:
    """Rows, written before, in blocks of about ``size`` by hash of the key: (block, body), and the number of blocks.

    body is what ``make`` builds out of {column: numpy array or matrix}. A block is built in one task from a stream of rows.
    """
    blocks = max(1, -(-rows.count() // size))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")).repartition("block").sortWithinPartitions("block")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def packed() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held)
            body = make({c: matrix(whole[c]) if pa.types.is_list(whole[c].type) or pa.types.is_large_list(whole[c].type) else whole[c].to_numpy() for c in columns})
            return pa.RecordBatch.from_pydict({"block": pa.array([now], pa.int32()), "body": pa.array([body], pa.binary())})

        for batch in batches:
            which = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(which)) + 1).tolist(), len(which)]
            for at, end in zip(cuts, cuts[1:], strict=False):
                if end == at:
                    continue
                if now is not None and which[at] != now:
                    yield packed()
                    held = []
                now = int(which[at])
                held.append(batch.slice(at, end - at).select(columns))
        if held:
            yield packed()

    return dealt.select("block", *columns).mapInArrow(build, "block int, body binary"), blocks


def meet(groups: DataFrame, n_groups: int, blocks: DataFrame, n_blocks: int, work: Callable[[bytes, Iterator[bytes]], pa.RecordBatch | None], schema: str) -> DataFrame:
    """work(group, blocks) for every query group and stretch of blocks; the blocks come one at a time.

    Stretches are short enough that all tasks of the cluster have work, and STRETCH blocks long at most.
    """
    width = groups.sparkSession.sparkContext.defaultParallelism
    stretches = min(n_blocks, max(-(-n_blocks // STRETCH), -(-width // n_groups)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sent = groups.select(F.col("block").alias("grp"), every(stretches).alias("stretch"), F.lit(-1).alias("nr"), "body")
    met = blocks.select(every(n_groups).alias("grp"), F.pmod("block", F.lit(stretches)).cast("int").alias("stretch"), F.col("block").alias("nr"), "body")
    dealt = sent.unionByName(met).repartition(stretches * n_groups, "grp", "stretch").sortWithinPartitions("grp", "stretch", "nr")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                keys = [batch.column(c).to_pylist() for c in ("grp", "stretch", "nr")]
                for k, key in enumerate(zip(*keys, strict=True)):
                    yield (*key, batch.column("body")[k].as_py())

        stream = rows()
        row = next(stream, None)
        while row:
            here, body = row[:2], row[3] if row[2] < 0 else None
            ahead = [next(stream, None) if body is not None else row]

            def inside() -> Iterator[bytes]:
                while ahead[0] and ahead[0][:2] == here:
                    yield ahead[0][3]
                    ahead[0] = next(stream, None)

            if body is not None and (out := work(body, inside())) is not None:
                yield out
            for _ in inside():  # a stretch without queries, or what work left
                pass
            row = ahead[0]

    return dealt.mapInArrow(run, schema)


def dumps(*arrays) -> bytes:
    return pickle.dumps(arrays, protocol=5)


def loads(body: bytes) -> tuple:
    return pickle.loads(body)


class Best:
    """The k best (score, id) of each query so far, higher scores and then smaller ids first."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.lists: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in range(n)]

    def add(self, row: int, score: np.ndarray, ident: np.ndarray) -> None:
        s, i = self.lists[row]
        s, i = np.concatenate([s, score]), np.concatenate([i, ident])
        if len(s) > 4 * self.k:  # keep those that can be among the first k, all ties included, before sorting
            keep = s >= np.partition(s, len(s) - self.k)[len(s) - self.k]
            s, i = s[keep], i[keep]
        first = np.lexsort((i, -s))[:self.k]
        self.lists[row] = s[first], i[first]

    def least(self, row: int) -> int | None:
        """The score a newcomer must reach; None while there are fewer than k."""
        s = self.lists[row][0]
        return int(s[-1]) if len(s) == self.k else None
