"""Jaccard join of documents on their word n-grams, by token-combination prefixes.

Texts become sets of hashed shingles; equal sets are one class from then on. A partner of a set of n shingles misses at
most m = n - ceil(t n) of them. All sets are put in one global order, rare shingles first, and a set's prefix reaches as
far as its signatures withstand m losses:

* each rare shingle is a signature of its own and withstands one loss;
* frequent shingles are dealt by hash into subclasses, and every pair inside a subclass is a signature, so a subclass of
  c shingles withstands c - 1 losses. Pairs of frequent shingles are rare again.

Two sets above the threshold therefore share a signature. The smaller set of two can lose less than m, so it only needs to
bring the first part of its signatures (``least``), and pairs that share others alone are no candidates; of equal sizes
the one with more rare shingles takes that part. The number of subclasses follows the size of a set, by levels;
a set near a level's edge is indexed under both. How frequent a shingle is comes from a count of all shingles of all
documents in a table of fixed size: it steers cost, never the result.

Signatures that only one class has are dropped, and of signatures that the same classes have, one stays. On the rest, each
class is compared with the hub of each of its signatures, first by counts in buckets, which bound what two sets share,
then exactly; connected classes are joined, and what lies in different components and still shares a signature is compared
in the last round pair by pair. So a group of near copies costs about as many comparisons as it has members, and no link
between components is lost.

Edge cases, all defined: NULL or blank texts have an empty set and no partner; texts shorter than a shingle are one
shingle; sets of fewer than 1 / (1 - t) - 1 shingles can only equal each other; repeated rows and repeated ids fall into
the class of their text; a NULL doc_id takes part, and a group of NULL ids only has a NULL component_id; an empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import as_given, as_text, free, settle_at, words_of

SKETCH_BITS = 22  # counters of the frequency table; its size does not follow the data
BLOCK_BITS = 14
FIRST_LEVEL = 6
MARK_BITS = 26  # bits of the table that tells which signatures several classes may have
PROFILE = 256  # buckets of a set's profile
FULL = 127  # what a bucket's count is cut to inside the last round's join; more may lie in it
TEXT_BUCKETS = 1 << 20  # bound of what is broadcast to find the texts of candidates
_U = np.uint64
_M = _U(0x9E3779B97F4A7C15)
_M2 = _U(0xC2B2AE3D27D4EB4F)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _WordHashes()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _M2
    return h ^ (h >> _U(29))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams; the whole sequence if it is shorter."""
    words = words_of(text)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], dtype=_U) if words else np.empty(0, dtype=_U)
    w = np.fromiter(map(_words.__getitem__, words), dtype=_U, count=len(words))
    n = len(w) - width + 1
    h = w[:n].copy()
    for k in range(1, width):
        h *= _M
        h += w[k:n + k]
    return np.unique(_mix(h))


def class_of(h: np.ndarray) -> int | None:
    """The class of a set: a 64-bit digest of all its shingles."""
    return int(np.int64(_U(xxhash.xxh3_64_intdigest(h.tobytes())))) if len(h) else None


def needed(n: int, percent: int) -> int:
    """Shingles that a partner of a set of n must share at least."""
    return (percent * n + 99) // 100


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def profile(h: np.ndarray) -> np.ndarray:
    """How many shingles of a set fall into each bucket, at most 255 a bucket."""
    return np.minimum(np.bincount((h >> _U(32)).astype(np.int64) % PROFILE, minlength=PROFILE), 255).astype(np.uint8)


def may_be_similar(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, percent: int) -> bool:
    """False only if the profiles leave too little to share: of each bucket, at most the smaller count is common."""
    low = np.minimum(a, b).astype(np.int64)
    shared = int(low.sum()) if low.max(initial=0) < 255 else min(n_a, n_b)  # a full bucket may hold more
    return (100 + percent) * shared >= percent * (n_a + n_b)


def _level(n: int) -> int:
    return max(0, (n // FIRST_LEVEL).bit_length() - 1)


def signatures(h: np.ndarray, counts: np.ndarray, limit: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of a set's prefix, and which of them stand where the partner is not smaller.

    counts: how often each shingle's counter was hit; a shingle is frequent beyond limit.
    """
    n = len(h)
    losses = n - needed(n, percent)
    if losses == 0 and 100 * n < percent * (n + 1):
        return np.empty(0, dtype=_U), np.empty(0, dtype=bool)  # one more or less is too much already: such a set only equals its copies
    few = n - (2 * percent * n + 99 + percent) // (100 + percent)  # losses to a partner of the same size or larger
    rare = counts <= limit
    alone, often = h[rare], h[~rare]
    alone = alone[np.argsort(counts[rare], kind="stable")]
    if len(alone) > losses:
        return _mix(alone[:losses + 1]), np.arange(losses + 1) <= few
    parts, flags = [_mix(alone)], [np.arange(len(alone)) <= few]
    spread = _mix(often * _M)
    for level in {_level(needed(n, percent)), _level(n), _level(100 * n // percent)}:
        classes = max(1, (FIRST_LEVEL << level) // 2)
        sub = spread % _U(classes)
        order = np.argsort(sub, kind="stable")
        sub, token = sub[order], often[order]
        covered = np.cumsum(sub[1:] == sub[:-1])
        end = int(np.searchsorted(covered, losses + 1 - len(alone))) + 2
        short = int(np.searchsorted(covered, few + 1 - len(alone))) + 2 if len(alone) <= few else 0
        sub, token = sub[:end], token[:end]
        for k in range(1, len(token)):
            pairs = np.flatnonzero(sub[k:] == sub[:-k])
            if not len(pairs):
                break
            parts.append(_mix((token[pairs] * _M) ^ (token[pairs + k] * _M2) ^ _U(level + 1)))
            flags.append(pairs + k < short)
    return np.concatenate(parts), np.concatenate(flags)


def _sets_and_counts(width: int, bits: int):
    """Per document its id, text hash, size, class and profile; at a task's end, blocks of the counts of all its shingles."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(1 << bits, dtype=np.uint32)
        for batch in batches:
            sizes, classes, profiles = [], [], []
            for text in batch["text"]:
                h = shingles(text, width)
                sizes.append(len(h))
                classes.append(class_of(h))
                profiles.append(profile(h).tobytes())
                np.add.at(counts, (h & _U((1 << bits) - 1)).astype(np.int64), np.uint32(1))
            yield pd.DataFrame({"doc_id": as_given(batch["doc_id"]), "text_hash": batch["text_hash"].astype("Int64"), "n": pd.Series(sizes, dtype="Int64"),
                                "cls": pd.Series(classes, dtype="Int64"), "profile": profiles, "block": pd.Series([None] * len(batch), dtype="Int32"), "counts": None})
        step = 1 << min(BLOCK_BITS, bits)
        rows = [(k, zlib.compress(part.tobytes(), 1)) for k, part in enumerate(counts.reshape(-1, step)) if part.any()]
        if rows:
            out = pd.DataFrame({"block": pd.Series([k for k, _ in rows], dtype="Int32"), "counts": [c for _, c in rows]}).assign(doc_id=None)
            yield out.reindex(columns=["doc_id", "text_hash", "n", "cls", "profile", "block", "counts"]).astype({c: "Int64" for c in ("text_hash", "n", "cls")})
    return run


def _add_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Add up the blocks of one partition, row by row."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch["block"], batch["counts"], strict=True):
            part = np.frombuffer(zlib.decompress(counts), dtype=np.uint32).astype(np.int64)
            total[block] = total[block] + part if block in total else part
    yield pd.DataFrame({"block": pd.Series(list(total), dtype="int32"), "counts": [zlib.compress(c.tobytes(), 1) for c in total.values()]})


def _frequencies(sets: DataFrame, bits: int) -> np.ndarray:
    """The table of counts over all documents; 2^bits numbers, whatever the input."""
    blocks = sets.filter("block is not null").select("block", "counts")
    summed = blocks.repartition("block").mapInPandas(_add_blocks, "block int, counts binary")
    table = np.zeros(1 << bits, dtype=np.int64)
    step = 1 << min(BLOCK_BITS, bits)
    for row in summed.collect():
        table[row["block"] * step:(row["block"] + 1) * step] += np.frombuffer(zlib.decompress(bytes(row["counts"])), dtype=np.int64)
    return table


def _postings(width: int, percent: int, bits: int, table: np.ndarray, limit: int):
    scale = limit // 30_000 + 1  # two bytes a counter, at any size of the corpus
    packed = zlib.compress(np.minimum(table // scale, 65_535).astype(np.uint16), 1)  # it passes through the driver's heap
    cut = limit // scale

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mask, short = _U((1 << bits) - 1), np.frombuffer(zlib.decompress(packed), dtype=np.uint16)
        for batch in batches:
            sigs, flags, classes, sizes, held = [], [], [], [], 0
            for text in batch["text"]:
                h = shingles(text, width)
                if not len(h):
                    continue
                counts = short[(h & mask).astype(np.int64)]
                found, flag = signatures(h, counts, cut, percent)
                sigs.append(found)
                flags.append(flag)
                classes.append((class_of(h), len(found)))
                sizes.append((len(h), (len(h) << 31) - int((counts <= cut).sum())))
                held += len(found)
                if held > 250_000:
                    yield _posting_frame(sigs, flags, classes, sizes)
                    sigs, flags, classes, sizes, held = [], [], [], [], 0
            if held:
                yield _posting_frame(sigs, flags, classes, sizes)
    return run


def _posting_frame(sigs: list[np.ndarray], flags: list[np.ndarray], classes: list[tuple[int, int]], sizes: list[tuple[int, int]]) -> pd.DataFrame:
    times = [k for _, k in classes]
    return pd.DataFrame({"sig": np.concatenate(sigs).view(np.int64), "least": np.concatenate(flags), "cls": np.repeat(np.array([c for c, _ in classes], dtype=np.int64), times),
                         "n": np.repeat(np.array([n for n, _ in sizes], dtype=np.int64), times), "first": np.repeat(np.array([f for _, f in sizes], dtype=np.int64), times)})


def _marks(sigs: DataFrame, bits: int) -> np.ndarray:
    """2^bits bits, of which those are set that a signature of sigs falls on; the table's size does not follow the data."""
    step = 1 << min(BLOCK_BITS, bits - 3)

    def blocks(table: np.ndarray) -> pd.DataFrame:
        rows = [(k, zlib.compress(part.tobytes(), 1)) for k, part in enumerate(table.reshape(-1, step)) if part.any()]
        return pd.DataFrame({"block": pd.Series([k for k, _ in rows], dtype="int32"), "marks": [m for _, m in rows]})

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for batch in batches:
            at = _mark_of(batch["sig"], bits)
            np.bitwise_or.at(table, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))
        yield blocks(table)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, marks in zip(batch["block"], batch["marks"], strict=True):
                part = np.frombuffer(zlib.decompress(marks), dtype=np.uint8)
                total[block] = total[block] | part if block in total else part
        yield pd.DataFrame({"block": pd.Series(list(total), dtype="int32"), "marks": [zlib.compress(m.tobytes(), 1) for m in total.values()]})

    out = np.zeros(1 << (bits - 3), dtype=np.uint8)
    schema = "block int, marks binary"
    for row in sigs.select("sig").mapInPandas(mark, schema).repartition("block").mapInPandas(merge, schema).collect():
        out[row["block"] * step:(row["block"] + 1) * step] = np.frombuffer(zlib.decompress(bytes(row["marks"])), dtype=np.uint8)
    return out


def _mark_of(sigs: pd.Series, bits: int) -> np.ndarray:
    return (sigs.to_numpy(dtype=np.int64).view(_U) & _U((1 << bits) - 1)).astype(np.int64)


def _in_several(made: DataFrame, bits: int = MARK_BITS) -> tuple[DataFrame, str]:
    """The distinct postings of signatures that several classes have, settled; and the table's path.

    Most signatures have one class. They are found by their smallest and largest class alone, and what is set aside by marks
    in a table of fixed size is not shuffled again; the join on the signatures decides.
    """
    spark = made.sparkSession
    several, path = settle_at(made.groupBy("sig").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).filter("low < high").select("sig"), "several")
    packed = zlib.compress(_marks(several, bits), 1)

    def marked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = np.frombuffer(zlib.decompress(packed), dtype=np.uint8)
        for batch in batches:
            at = _mark_of(batch["sig"], bits)
            yield batch[(marks[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)]

    found = settle_at(made.mapInPandas(marked, made.schema).join(several, "sig", "left_semi").distinct(), "shared")
    free(spark, path)
    return found


def components(edges: DataFrame) -> DataFrame:
    """(u, root) of every vertex of the edges (u, v) but the roots: alternating large and small stars until nothing moves."""
    at, path, last = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), None, None
    while True:
        both = at.select("u", "v").union(at.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        new, new_path = settle_at(moved.distinct(), "stars")
        mark = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if path:
            free(edges.sparkSession, path)
        at, path = new, new_path
        if mark == last:
            return at.select("u", F.col("v").alias("root"))
        last = mark


def _counts_of(profiles: DataFrame) -> DataFrame:
    """(cls, held): the counts of each profile as an array, at most FULL a bucket."""
    @F.pandas_udf("array<tinyint>")
    def counts(packed: pd.Series) -> pd.Series:
        return pd.Series([np.minimum(np.frombuffer(x, dtype=np.uint8), FULL).astype(np.int8) for x in packed], dtype="object")

    return profiles.select("cls", counts("profile").alias("held"))


def _counts_allow(a: Column, b: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    """What may_be_similar says, as an expression."""
    low = F.zip_with(a, b, lambda x, y: F.least(x, y))
    shared = F.aggregate(low, F.lit(0).cast("long"), lambda s, x: F.when((s < 0) | (x == FULL), F.lit(-1).cast("long")).otherwise(s + x))
    return (F.when(shared < 0, F.least(n_a, n_b)).otherwise(shared) * (100 + percent)) >= percent * (n_a + n_b)


def _likely(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose profiles do not rule out the threshold."""
    @F.pandas_udf("boolean")
    def may(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        return pd.Series([may_be_similar(np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8), m, n, percent)
                          for x, y, m, n in zip(a, b, n_a, n_b, strict=True)], dtype="bool")

    side = lambda name: profiles.select(F.col("cls").alias(name), F.col("size").alias(f"n_{name}"), F.col("profile").alias(f"p_{name}"))
    return pairs.join(side("v"), "v").join(side("u"), "u").filter(may("p_u", "p_v", "n_u", "n_v")).select("u", "v")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets reach the threshold."""
    @F.pandas_udf("boolean")
    def reach(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similar(np.frombuffer(x, dtype=_U), np.frombuffer(y, dtype=_U), percent) for x, y in zip(a, b, strict=True)], dtype="bool")

    side = lambda name: sets.select(F.col("cls").alias(name), F.col("shingles").alias(f"s_{name}"))
    return pairs.join(side("v"), "v").join(side("u"), "u").filter(reach("s_u", "s_v")).select("u", "v")


def _from_texts(docs: DataFrame, members: DataFrame, classes: DataFrame, width: int, make, schema: str, label: str) -> tuple[DataFrame, str]:
    """A settled table with what make() says of each class's shingles, from the text of one member; and its path."""
    spark = docs.sparkSession
    chosen, chosen_path = settle_at(members.join(classes, "cls").select("doc_id", "text_hash").distinct(), "chosen")
    # first by a bucket of the text's hash, at most TEXT_BUCKETS numbers, so that most texts are not shuffled
    bucket = F.pmod(F.col("text_hash"), F.lit(TEXT_BUCKETS))
    near = docs.withColumn("bucket", bucket).join(F.broadcast(chosen.select(bucket.alias("bucket")).distinct()), "bucket", "left_semi")
    key = F.coalesce("doc_id", F.lit(-(2**63))).alias("key")  # never NULL, so that join and dropDuplicates share one shuffle
    texts = near.select(key, "text", "text_hash").join(chosen.select(key, "text_hash"), ["key", "text_hash"]).dropDuplicates(["key", "text_hash"]).select("text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(t, width) for t in batch["text"]]
            yield pd.DataFrame({"cls": [class_of(h) for h in found], **make(found)})

    made = settle_at(texts.mapInPandas(run, f"cls long, {schema}"), label)
    free(spark, chosen_path)
    return made


def class_links(docs: DataFrame, sets: DataFrame, width: int, percent: int, bits: int) -> DataFrame | None:
    """(u, root) of all classes that are connected to a smaller one; None if there is no candidate."""
    spark = docs.sparkSession
    table = _frequencies(sets, bits)
    mean = float(table.mean())
    limit = int(2 * mean + 4 * mean ** 0.5 + 8)  # a counter hit clearly more often than chance holds a frequent shingle
    made, made_path = settle_at(docs.select("text").mapInPandas(_postings(width, percent, bits, table, limit), "sig long, least boolean, cls long, n long, first long"), "postings")
    del table
    several, several_path = _in_several(made)
    free(spark, made_path)
    if several.isEmpty():
        free(spark, several_path)
        return None
    # Signatures with the same classes propose the same pairs: one of them stays, with their number as its weight.
    mark, other = F.xxhash64("cls", "least"), F.xxhash64("cls", "least", F.lit(3))
    low32 = lambda c: F.sum(c.bitwiseAND(F.lit(0xFFFFFFFF)))  # noqa: E731  stays below 2^63 for two billion rows a signature
    shared = several.groupBy("sig").agg(F.min("cls").alias("low"), F.max("cls").alias("high"), low32(mark).alias("d0"), low32(F.shiftrightunsigned(mark, 32)).alias("d1"), low32(other).alias("d2"))
    distinct = shared.groupBy("low", "high", "d0", "d1", "d2").agg(F.min("sig").alias("sig"), F.count("*").alias("weight")).select("sig", "weight")
    found, found_path = settle_at(several.join(distinct, "sig"), "candidates")
    free(spark, several_path)
    # A hub is the class that shares most: the text that its near copies were made from, if it is there.
    central = found.join(found.groupBy("sig").agg(F.count("*").alias("m")), "sig").groupBy("cls").agg(F.sum(F.col("weight") * F.col("m")).alias("central"))
    active, active_path = settle_at(found.join(central, "cls"), "active")
    free(spark, found_path)

    # one document of each class that has a candidate
    members, _ = settle_at(sets.filter("cls is not null").select("cls", "doc_id", "text_hash").join(active.select("cls").distinct(), "cls").groupBy("cls").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("d")).select("cls", "d.*"), "members")
    profiles, profiles_path = settle_at(sets.filter("cls is not null").join(active.select("cls").distinct(), "cls").groupBy("cls").agg(
        F.first("n").alias("size"), F.first("profile").alias("profile")), "profiles")
    roots, roots_path, counts_path = None, None, None
    for step in ("central hubs", "other hubs", "pairs"):
        if roots is None:
            here = active.withColumn("comp", F.col("cls"))
        else:
            here = active.join(roots.select(F.col("u").alias("cls"), "root"), "cls", "left").select("sig", "cls", "n", "first", "least", "central", F.coalesce("root", "cls").alias("comp"))
        split = here.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                        F.min(F.struct((F.xxhash64("cls", F.lit(7)) if step == "other hubs" else -F.col("central")).alias("order"), "cls", "n", "comp")).alias("hub"), F.max("least").alias("any")).filter("low < high")
        if step == "pairs":
            open_, _ = settle_at(here.join(split.filter("any").select("sig"), "sig"), "open")
            if open_.isEmpty():
                break
            counts, counts_path = settle_at(_counts_of(profiles.join(open_.select("cls").distinct(), "cls", "left_semi")), "counts")
            counted = open_.join(counts, "cls")
            side = lambda x: counted.select("sig", F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("first").alias(f"f_{x}"), F.col("least").alias(f"l_{x}"), F.col("comp").alias(f"c_{x}"), F.col("held").alias(f"h_{x}"))
            # the first of two brings a signature it must have: the smaller, or of equal ones that with more rare shingles;
            # a pair that its profiles rule out never leaves the join
            pairs = side("a").filter("l_a").join(side("b"), "sig").filter(
                (F.col("f_a") <= F.col("f_b")) & (F.col("c_a") != F.col("c_b")) & (100 * F.col("n_a") >= percent * F.col("n_b"))
                & _counts_allow(F.col("h_a"), F.col("h_b"), F.col("n_a"), F.col("n_b"), percent)).select(
                F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()
        else:
            near = here.join(split.select("sig", F.col("hub.cls").alias("u"), F.col("hub.n").alias("n_u"), F.col("hub.comp").alias("c_u")), "sig").filter(
                (F.col("comp") != F.col("c_u")) & (100 * F.least("n", "n_u") >= percent * F.greatest("n", "n_u")))
            pairs = near.select("u", F.col("cls").alias("v")).distinct()
        likely, likely_path = settle_at(_likely(pairs, profiles, percent), "likely")
        whole, whole_path = _from_texts(docs, members, likely.select(F.explode(F.array("u", "v")).alias("cls")).distinct(), width,
                                        lambda found: {"shingles": [h.tobytes() for h in found]}, "shingles binary", "sets")
        links = _verified(likely, whole, percent)
        links = links if roots is None else links.union(roots.select("u", F.col("root").alias("v")))
        joined, joined_path = settle_at(links, "links")
        new, new_path = settle_at(components(joined), "roots")
        for path in (likely_path, whole_path, joined_path, roots_path, counts_path):
            if path:
                free(spark, path)
        roots, roots_path = new, new_path
    for path in (active_path, profiles_path):
        free(spark, path)
    return roots


def join_documents(docs: DataFrame, width: int = 5, percent: int = 80, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, text_hash, n_shingles, cls, component_id, and whether its text represents its component."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    made = docs.withColumn("doc_id", as_text("doc_id")).mapInPandas(_sets_and_counts(width, sketch_bits), "doc_id string, text_hash long, n long, cls long, profile binary, block int, counts binary")
    sets, _ = settle_at(made.withColumn("doc_id", F.col("doc_id").cast("long")), "classes")
    roots = class_links(docs, sets, width, percent, sketch_bits)
    rows = sets.filter("block is null").select("doc_id", "text_hash", "n", "cls")
    least = F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("order"), "doc_id", "text_hash"))
    classes = rows.filter("cls is not null").groupBy("cls").agg(least.alias("first"))
    if roots is not None:
        classes = classes.join(roots.select(F.col("u").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
        firsts = classes.groupBy("root").agg(F.min("first").alias("least"))
        classes = classes.join(firsts, "root").select("cls", F.col("least").alias("first"))
    joined = rows.join(classes, "cls", "left")
    alone = F.col("cls").isNull()
    return joined.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "cls", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
                         (alone | (F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.text_hash") == F.col("text_hash")))).alias("represents"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of similar ones, the smallest id, with all its columns; blank texts all stay."""
    chosen = join_documents(docs, width, percent).filter("represents").select(F.col("doc_id").alias("k_doc"), F.col("text_hash").alias("k_hash"), F.col("cls").isNull().alias("k_blank")).distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("k_row"), F.xxhash64(F.col("text").cast("string")).alias("k_text"), F.col("doc_id").cast("long").alias("k_id"))
    kept = rows.join(chosen, rows.k_id.eqNullSafe(chosen.k_doc) & rows.k_text.eqNullSafe(chosen.k_hash))
    once = kept.filter("not k_blank").groupBy("k_doc", "k_hash").agg(F.first("k_row").alias("k_row")).select("k_row.*")
    return once.unionByName(kept.filter("k_blank").select("k_row.*"))
