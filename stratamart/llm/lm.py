"""A log-bilinear language model, trained with noise-contrastive estimation in numpy, that scores whole texts.

Tokens are words and one end per text, in a tree of two levels. The ``SHORTLIST`` most frequent ones are classes of their
own; all others are classed by their endings, in a number of classes that grows with the vocabulary. The class of the next
token is predicted from the two classes before it: q = C1 * r(w-1) + C2 * r(w-2), logit = q . s(w) + b(w). Inside its
class, every word of the training texts, however rare, has a vector and a bias of its own, by which the class before it
tells how likely it is (``learn_words``).

All training texts train: each task runs mini-batches over the texts of its partition, from the same start, against noise
from the unigram distribution, and the parameters are averaged by tokens. As the logits are a sum of one term for each
context word, the normaliser of every context pair is one matrix product of exponentials, and that of the words inside the
classes is one table by class and class before, so every score is a normalised log probability.

Counts and word vectors cover all training texts. The ``HEAD`` most frequent tokens go to every task with theirs; those of
the others are joined to the texts by a shuffle, so no table that follows the vocabulary is sent around.

Edge cases, all defined: NULL and blank texts are the end alone; a NULL id counts as an empty text in the fold; unseen
words get the probability of a count of 0 in the class of their ending; with no training text every count is 0 and the model is the uniform one over
one class; repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import add_vectors, as_text, settle_at

END = "\n"  # no word holds it
SHORTLIST = 1_500
HEAD = 100_000
WIDTH = 24
NOISE = 32
BATCH = 1_024
RATE = 0.15
SMOOTH = 0.1
PRIOR = 20  # occurrences that the mean of its class counts for in a word's own mean
ENDING = 3  # characters
HELD_WORDS = 400_000  # that a task holds before it hands them on
ROWS = 20_000  # that a batch on its way out of a task holds
PIECE = 512  # rows of a product with all classes that stay near the processor


def tokens_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The tokens of a batch of texts: the distinct ones, the place of each token among them, and where each text ends.

    Words are those of words_of: Arrow's ASCII white space and letters are the same. What follows looks a word up once a
    batch, not once an occurrence.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = lists.flatten().dictionary_encode()
    words, at, n = coded.dictionary, coded.indices.to_numpy(), np.diff(lists.offsets.to_numpy())
    blank = pc.index(words, pa.scalar("", words.type)).as_py()  # before, behind and instead of words
    if blank >= 0:
        keep = at != blank
        n = np.bincount(np.repeat(np.arange(len(n)), n)[keep], minlength=len(n))
        at = at[keep]
        at -= at > blank
        words = pa.concat_arrays([words[:blank], words[blank + 1:]])
    ends = np.cumsum(n + 1)
    out = np.full(len(at) + len(n), len(words), dtype=np.int32)
    word = np.ones(len(out), dtype=bool)
    word[ends - 1] = False
    out[word] = at
    return pa.concat_arrays([words, pa.array([END], words.type)]) if len(n) else words, out, ends


def count_tokens(docs: DataFrame) -> DataFrame:
    """(token, c) over all texts of docs; counted in the tasks first."""
    def added(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("c", "sum")]).select(["token", "c_sum"]).rename_columns(["token", "c"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            words, at, _ = tokens_in(batch["text"])
            held.append(pa.table({"token": words, "c": np.bincount(at, minlength=len(words))}))
            size += len(words)
            if size > 4 * HELD_WORDS:
                held = [added(held)]
                size = held[0].num_rows
                if size > HELD_WORDS:
                    yield from held[0].to_batches(ROWS)
                    held, size = [], 0
        if size:
            yield from added(held).to_batches(ROWS)

    return docs.select("text").mapInArrow(count, "token string, c long").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Counts:
    """Totals of the training tokens and the counts of the most frequent ones."""

    total: int
    distinct: int
    head: dict[bytes, int]
    groups: tuple[int, ...] = ()  # tokens outside the shortlist by ending; none: all in one class

    @property
    def shortlist(self) -> list[bytes]:
        return list(self.head)[:SHORTLIST]

    def class_size(self) -> tuple[int, int]:
        """Tokens and distinct tokens outside the shortlist."""
        short = self.shortlist
        return self.total - sum(self.head[w] for w in short), self.distinct - len(short)


def group_of(word: bytes, groups: int) -> int:
    return crc32(word.decode("utf-8", "replace")[-ENDING:].encode()) % groups if groups > 1 else 0


def groups_in(words: pa.Array, groups: int) -> np.ndarray:
    """What group_of gives for each of the words."""
    endings = pc.utf8_slice_codeunits(words, -ENDING).dictionary_encode()
    return np.array([group_of(w.encode(), groups) for w in endings.dictionary.to_pylist()], dtype=np.int32)[endings.indices.to_numpy()]


def numbers_in(words: pa.Array, known: pa.Array, groups: int) -> np.ndarray:
    """The place of each of the words among the known ones; of the others, the group after them."""
    out = np.array(pc.fill_null(pc.index_in(words, value_set=known), -1))
    other = np.flatnonzero(out < 0)
    out[other] = len(known) + groups_in(words.take(pa.array(other)), groups)
    return out


def group_column(token: Column, groups: int) -> Column:
    """What group_of gives."""
    return F.pmod(F.crc32(F.right(token, F.lit(ENDING)).cast("binary")), F.lit(groups)).cast("int")


def read_counts(counts: DataFrame, head: int = HEAD) -> Counts:
    """Totals, and the tokens whose counts reach the lowest step of a fixed scale at which there are at most ``head`` of them."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    step = F.floor(F.log2("c") * 64).cast("int")  # 64 steps a doubling: at most a few thousand
    cut, held = None, 0
    for at, n in sorted(((r["step"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True):
        held += n
        if held > head:
            break
        cut = at
    rows = counts.filter(step >= cut).collect() if cut is not None else []  # at most `head` words
    out = Counts(total[0], total[1], {r["token"].encode(): r["c"] for r in sorted(rows, key=lambda r: (-r["c"], r["token"]))})
    groups = max(1, int(out.class_size()[1] ** 0.5 / 8))
    tokens = [0] * groups
    for r in counts.groupBy(group_column(F.col("token"), groups).alias("g")).agg(F.sum("c").alias("c")).collect():
        tokens[r["g"]] = r["c"]
    for w in out.shortlist:
        tokens[group_of(w, groups)] -= out.head[w]
    out.groups = tuple(tokens)
    return out


def contexts(ids: np.ndarray, ends: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """(far, near): the two classes before each token of joined texts that end at ``ends``."""
    begin = np.r_[0, ends][:-1]
    near, far = np.empty_like(ids), np.empty_like(ids)
    for before, of in ((near, ids), (far, near)):
        before[1:] = of[:-1]
        before[begin] = start
    return far, near


@dataclass
class Model:
    """Parameters of the log-bilinear model over the shortlist, the classes of the other words and, as context only, the start."""

    words: list[bytes]
    context: np.ndarray  # (classes + start) x width
    target: np.ndarray  # classes x width
    bias: np.ndarray
    near: np.ndarray
    far: np.ndarray
    _tables: tuple | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_tables": None}

    @property
    def classes(self) -> int:
        return len(self.bias)

    @property
    def groups(self) -> int:
        return self.classes - len(self.words)

    def ids_of(self, words: pa.Array) -> np.ndarray:
        """The class of each of the words."""
        return numbers_in(words, pa.array([w.decode() for w in self.words], words.type), self.groups)

    def ids(self, tokens: list[bytes]) -> np.ndarray:
        return self.ids_of(pa.array([w.decode("utf-8", "replace") for w in tokens], pa.string()))

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits by nearer context (bias included) and by farther context, and the log normaliser of each pair."""
        if self._tables is None:
            a = (self.context * self.near) @ self.target.T + self.bias
            b = (self.context * self.far) @ self.target.T
            top_a, top_b = a.max(axis=1, keepdims=True), b.max(axis=1, keepdims=True)
            z = np.exp(a - top_a) @ np.exp(b - top_b).T
            np.log(np.maximum(z, 1e-37, out=z), out=z)
            z += top_a
            z += top_b.T
            self._tables = tuple(x.astype(np.float32, copy=False) for x in (a, b, z))
        return self._tables

    def log_probabilities(self, ids: np.ndarray) -> np.ndarray:
        """Natural log probability of each class in a text of classes, given the two before it."""
        return self.log_odds(*contexts(ids, np.array([len(ids)]), self.classes), ids)

    def log_odds(self, far: np.ndarray, near: np.ndarray, ids: np.ndarray) -> np.ndarray:
        a, b, z = self.tables()
        return a[near, ids] + b[far, ids] - z[near, far]


def start_model(counts: Counts, width: int = WIDTH, seed: int = 5) -> Model:
    words = counts.shortlist
    rng = np.random.default_rng(seed)
    groups = counts.groups or (counts.class_size()[0],)
    share = np.array([*(counts.head[w] for w in words), *groups], dtype=np.float64) + SMOOTH
    n = len(words) + len(groups)
    return Model(words, rng.normal(0, 0.1, (n + 1, width)).astype(np.float32), rng.normal(0, 0.1, (n, width)).astype(np.float32),
                 np.log(share / share.sum()).astype(np.float32), np.ones(width, dtype=np.float32), np.full(width, 0.5, dtype=np.float32))


def _row_sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, and the sum of the values of each; two neighbours are added at once, as one complex number."""
    pairs = values if values.shape[1] % 2 else values.view(np.result_type(values.dtype, np.complex64))
    width, met = pairs.shape[1], np.bincount(rows)
    at, summed = np.flatnonzero(met), np.zeros((len(met), width), dtype=pairs.dtype)
    np.add.at(summed.reshape(-1), (rows[:, None] * width + np.arange(width)).ravel(), pairs.ravel())
    return at, summed.take(at, axis=0).view(values.dtype)


class Trainer:
    """Mini-batches of noise-contrastive estimation with Adagrad; a step costs by the rows it meets, not by the model's size."""

    def __init__(self, model: Model, seed: int = 9):
        self.m, self.rng = model, np.random.default_rng(seed)
        self.params = [model.context, model.target, model.bias, model.near, model.far]
        self.memory = [np.full_like(p, 1e-3) for p in self.params]
        self.noise_log = model.bias.astype(np.float64).copy()
        p = np.exp(self.noise_log)
        self.edges = np.cumsum(p / p.sum())

    def step(self, far: np.ndarray, near: np.ndarray, target: np.ndarray) -> None:
        m, n = self.m, len(target)
        noise = np.minimum(np.searchsorted(self.edges, self.rng.random(NOISE)), m.classes - 1)
        c1, c2 = m.context.take(near, axis=0), m.context.take(far, axis=0)
        q = c1 * m.near
        q += c2 * m.far
        right, wrong = m.target.take(target, axis=0), m.target.take(noise, axis=0)
        shift = np.log(NOISE)
        # the share of a token among the noise moves to its bias, so that all stays in four bytes
        lift = (m.bias - (self.noise_log + shift)).astype(np.float32)
        plus = np.einsum("ij,ij->i", q, right) + lift[target]
        minus = q @ wrong.T
        minus += lift[noise]
        g_plus = -1 / (1 + np.exp(np.clip(plus, -30, 30)))
        g_minus = np.exp(np.negative(np.clip(minus, -30, 30, out=minus), out=minus), out=minus)
        g_minus += 1
        np.reciprocal(g_minus, out=g_minus)
        dq = g_minus @ wrong
        dq += g_plus[:, None] * right
        # A row without a gradient moves neither its parameters nor its memory, so only the others are looked at.
        drawn, up = np.concatenate([target, noise]), np.empty((n + NOISE, q.shape[1]), dtype=np.float32)
        np.multiply(q, g_plus[:, None], out=up[:n])
        np.matmul(g_minus.T, q, out=up[n:])
        met, sums = _row_sums(drawn, up)
        bias = np.bincount(drawn, weights=np.concatenate([g_plus, g_minus.sum(axis=0)]))[met].astype(np.float32)
        both = np.empty((2 * n, q.shape[1]), dtype=np.float32)
        np.multiply(dq, m.near, out=both[:n])
        np.multiply(dq, m.far, out=both[n:])
        near_far, context = _row_sums(np.concatenate([near, far]), both)
        whole = slice(None)
        for p, at, g, memory in zip(self.params, (near_far, met, met, whole, whole), (context, sums, bias, np.einsum("ij,ij->j", dq, c1), np.einsum("ij,ij->j", dq, c2)), self.memory, strict=True):
            g /= np.float32(n)
            held = g * g
            held += memory[at]
            memory[at] = held
            g *= np.float32(RATE)
            g /= np.sqrt(held, out=held)
            p[at] -= g


def _batches(model: Model, texts: pa.Array) -> Iterator[np.ndarray]:
    """(far, near, target) of the texts in mini-batches, mixed within blocks of whole texts."""
    words, at, ends = tokens_in(texts)
    ids = model.ids_of(words)[at]
    joined = np.stack([*contexts(ids, ends, model.classes), ids])
    begin = 0
    while begin < len(ids):
        end = ends[min(np.searchsorted(ends, begin + 64 * BATCH), len(ends) - 1)]
        mixed = joined[:, begin + np.random.default_rng(end - begin).permutation(end - begin)].astype(np.intp)
        for k in range(0, end - begin, BATCH):
            yield mixed[:, k:k + BATCH]
        begin = end


VECTORS = "row int, n long, part binary"


def _vector_rows(rows: list[int], n: int, parts: list[bytes]) -> pa.RecordBatch:
    """Rows for add_vectors, of which the first holds the count."""
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array([n, *repeat(0, len(rows) - 1)], pa.int64()), pa.array(parts, pa.binary())], names=["row", "n", "part"])


def train(docs: DataFrame, counts: Counts) -> Model:
    """The model after one pass over all texts of docs; each partition starts from the same parameters."""
    begin = start_model(counts)
    shapes = [p.shape for p in (begin.context, begin.target, begin.bias, begin.near, begin.far)]
    piece = 1 << 14

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, n = Trainer(start_model(counts)), 0
        for batch in batches:
            for far, near, target in _batches(trainer.m, batch["text"]):
                trainer.step(far, near, target)
                n += len(target)
        if n:
            flat = np.concatenate([p.ravel() for p in trainer.params]).astype(np.float32) * np.float32(n)
            parts = [flat[k:k + piece].tobytes() for k in range(0, len(flat), piece)]
            yield _vector_rows([-1, *range(len(parts))], n, [b"", *parts])

    n, parts = add_vectors(docs.select("text").mapInArrow(run, VECTORS))
    if not n:
        return begin
    flat = np.concatenate([parts[k] for k in sorted(parts)]) / n
    params, at = [], 0
    for shape in shapes:
        size = int(np.prod(shape))
        params.append(flat[at:at + size].reshape(shape).astype(np.float32))
        at += size
    return Model(begin.words, *params)


@dataclass
class Words:
    """The words inside the classes: log P(word | class g, class before) = u . s + b - log_z, u the vector of the class before.

    A linear discriminant: the vectors u that stand before a word are taken as normal about its mean, so s and b follow from
    the word's count and the sum of its u. Any number of words is learnt in one pass, and no layout of the data changes it.
    """

    before: np.ndarray  # (classes + start) x width, whitened by the frequencies of the classes
    means: np.ndarray  # groups x width
    log_z: np.ndarray  # groups x (classes + start)

    def vectors(self, c: np.ndarray, sums: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(s, b) of words by count, sum of the u before them, and group."""
        mean = self.means[g]
        s = (sums - c[:, None] * mean) / (c[:, None] + PRIOR)
        return s.astype(np.float32), np.log(c + SMOOTH) - 0.5 * (s * s).sum(axis=1) - (mean * s).sum(axis=1)


def before_vectors(model: Model, counts: Counts) -> np.ndarray:
    """The vectors of the nearer context, with mean 0 and covariance 1 over the training tokens."""
    u = (model.context * model.near).astype(np.float64)
    share = np.array([*(counts.head[w] for w in model.words), *(counts.groups or (counts.class_size()[0],)), 0], dtype=np.float64) + SMOOTH
    share /= share.sum()
    u -= share @ u
    size, axes = np.linalg.eigh((u * share[:, None]).T @ u)
    return (u @ (axes / np.sqrt(np.maximum(size, 0) + 1e-3 * max(size.max(), 1e-12)))).astype(np.float32)


FEW = 48  # classes of two bytes take no more room than a vector of WIDTH floats


def _binaries(data, lengths: np.ndarray) -> pa.Array:
    """The pieces of these lengths that lie behind each other in data."""
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pa.py_buffer(data)])


def _data(packed: pa.Array, at: np.ndarray, kind: type) -> np.ndarray:
    """The bytes of some pieces behind each other, as numbers of a kind."""
    some = packed.take(pa.array(at)).cast(pa.binary())
    edge = np.frombuffer(some.buffers()[1], dtype=np.int32, count=len(some) + 1, offset=4 * some.offset)
    return np.frombuffer(some.buffers()[2] or b"", dtype=np.uint8)[edge[0]:edge[-1]].view(kind)


def pack(at: np.ndarray, near: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(word, how often, what stands before it): the classes themselves for FEW occurrences, the sum of their vectors for more."""
    both = at.astype(np.int64) << 16
    both |= near
    both.sort()
    at, near = both >> 16, (both & 0xFFFF).astype(np.uint16)
    begin = np.flatnonzero(np.r_[True, np.diff(at) != 0][:len(at)])
    n = np.diff(np.r_[begin, len(at)])
    few = n <= FEW
    rows = np.r_[np.flatnonzero(few), np.flatnonzero(~few)]
    sums = [before[near[k:k + c]].sum(axis=0, dtype=np.float64).astype(np.float32).tobytes() for k, c in zip(begin[~few].tolist(), n[~few].tolist(), strict=True)]
    return at[begin][rows], n[rows], _binaries(near[np.repeat(few, n)].tobytes() + b"".join(sums), np.where(few, 2 * n, 4 * before.shape[1])[rows])


def unpack(n: np.ndarray, packed: pa.Array | list[bytes], before: np.ndarray) -> np.ndarray:
    """The sums of vectors that pack stands for."""
    packed = packed if isinstance(packed, pa.Array) else pa.array(packed, pa.binary())
    out = np.zeros((len(n), before.shape[1]), dtype=np.float64)
    few, many = np.flatnonzero((n > 0) & (n <= FEW)), np.flatnonzero(n > FEW)
    for k in range(0, len(few), 4_000):
        some = few[k:k + 4_000]
        out[some] = np.add.reduceat(before[_data(packed, some, np.uint16)], np.r_[0, np.cumsum(n[some])[:-1]].astype(np.int64), axis=0)
    if len(many):
        out[many] = _data(packed, many, np.float32).reshape(len(many), -1)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in fewer batches."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def learn_words(docs: DataFrame, totals: Counts, model: Model) -> tuple[Words, DataFrame]:
    """The words of all training texts outside the shortlist: what is common to them, and (token, c, g, packed)."""
    before = before_vectors(model, totals)
    width, groups, first = before.shape[1], model.groups, len(model.words)

    def slices(out: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(out), ROWS):
            yield out.slice(k, ROWS)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def frame(held: list[tuple]) -> pa.RecordBatch:
            names, at, near = zip(*held, strict=True)
            coded = pa.concat_arrays(names).dictionary_encode()
            at, n, packed = pack(coded.indices.to_numpy()[np.concatenate(at)], np.concatenate(near), before)
            return pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(at)), pa.array(n, pa.int64()), packed], names=["token", "n", "packed"])

        held, met, size = [], 0, 0
        for batch in batches:
            names, at, ends = tokens_in(batch["text"])
            classes = model.ids_of(names)
            ids = classes[at]
            _, near = contexts(ids, ends, model.classes)
            own, others = np.flatnonzero(ids >= first), classes >= first
            if not len(own):
                continue
            held.append((names.filter(pa.array(others)), (np.cumsum(others, dtype=np.int32) + np.int32(met - 1))[at[own]], near[own].astype(np.uint16)))
            met, size = met + len(held[-1][0]), size + len(own)
            if met > 4 * HELD_WORDS or size > 10 * HELD_WORDS:
                yield from slices(frame(held))
                held, met, size = [], 0, 0
        if held:
            yield from slices(frame(held))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        pieces = pa.concat_batches(held)
        del held
        coded, n, packed = pieces["token"].dictionary_encode(), pieces["n"].to_numpy(), pieces["packed"]
        at = coded.indices.to_numpy()
        order = np.argsort(at, kind="stable")
        begin = np.flatnonzero(np.r_[True, np.diff(at[order]) != 0])
        c = np.add.reduceat(n[order], begin)
        few = c <= FEW
        pieces_of = np.diff(np.r_[begin, len(at)])
        joined, some = [_data(packed, order[np.repeat(few, pieces_of)], np.uint8)], order[np.repeat(~few, pieces_of)]
        if len(some):
            joined.append(np.add.reduceat(unpack(n[some], packed.take(pa.array(some)), before), np.r_[0, np.cumsum(pieces_of[~few])[:-1]], axis=0).astype(np.float32).ravel().view(np.uint8))
        rows = np.r_[np.flatnonzero(few), np.flatnonzero(~few)]
        out = pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(rows)), pa.array(c[rows], pa.int64()), _binaries(np.concatenate(joined), np.where(few, 2 * c, 4 * width)[rows])], names=["token", "c", "packed"])
        yield from slices(out)

    pieces = docs.select("text").mapInArrow(gather, "token string, n long, packed binary").repartition("token")
    learnt, _ = settle_at(pieces.mapInArrow(add, "token string, c long, packed binary").withColumn("g", group_column(F.col("token"), groups)), "words")
    means = np.zeros((groups, width))

    def add_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((groups, width + 1))
        for batch in _blocks(batches):
            c = batch["c"].to_numpy()
            np.add.at(total, batch["g"].to_numpy(), np.concatenate([unpack(c, batch["packed"], before), c[:, None]], axis=1))
        yield _vector_rows(list(range(groups)), 0, [x.astype(np.float32).tobytes() for x in total])

    for g, total in add_vectors(learnt.select("c", "g", "packed").mapInArrow(add_groups, VECTORS))[1].items():
        means[g] = total[:-1] / max(total[-1], 1)
    words = Words(before, means, np.zeros((groups, len(before))))

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_z, n = np.full((groups, len(before)), -np.inf), 0  # logarithms: a word that is sure to follow a class goes beyond exp()
        once = np.zeros((groups, len(before)), dtype=np.int64)  # words met once, by group and class before: alike in all that counts here

        wide = np.concatenate([before, np.ones((len(before), 1), dtype=np.float32)], axis=1).T

        def add_words(c: np.ndarray, sums: np.ndarray, g: np.ndarray, times: np.ndarray | int = 1) -> None:
            """Add ``times`` words of each kind, ordered by group."""
            s, b = words.vectors(c, sums, g)
            s = np.concatenate([s, (b + np.log(times))[:, None].astype(np.float32)], axis=1)
            edges = np.flatnonzero(np.diff(g, prepend=-1, append=-1)).tolist()
            for begin, end in zip(edges[:-1], edges[1:], strict=True):
                for k in range(begin, end, PIECE):
                    e = s[k:min(end, k + PIECE)] @ wide
                    top = e.max(axis=0)
                    e -= top
                    log_z[g[k]] = np.logaddexp(log_z[g[k]], np.log(np.exp(e, out=e).sum(axis=0)) + top)

        for batch in _blocks(batches, 3 * ROWS):
            n += len(batch)
            c, g = batch["c"].to_numpy(), batch["g"].to_numpy()
            alone, rest = np.flatnonzero(c == 1), np.flatnonzero(c > 1)
            np.add.at(once, (g[alone], _data(batch["packed"], alone, np.uint16)), 1)
            rest = rest[np.argsort(g[rest], kind="stable")]
            add_words(c[rest], unpack(c[rest], batch["packed"].take(pa.array(rest)), before), g[rest])
        for k in range(0, groups, 16):
            g, u = np.nonzero(once[k:k + 16])
            add_words(np.ones(len(g), dtype=np.int64), before[u].astype(np.float64), g + k, once[g + k, u])
        if n:
            yield _vector_rows([-1, *range(groups)], n, [b"", *(x.astype(np.float32).tobytes() for x in log_z)])

    words.log_z += np.log(SMOOTH)  # the unseen word of each class
    for g, more in add_vectors(learnt.select("c", "g", "packed").mapInArrow(normalise, VECTORS), np.logaddexp)[1].items():
        words.log_z[g] = np.logaddexp(words.log_z[g], more)
    return words, learnt


def score(docs: DataFrame, counts: DataFrame, totals: Counts, model: Model, held_out: Column) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    The words learnt from the rows that are not held out have their counts with them, so ``counts`` is not joined again.
    """
    base = totals.total + SMOOTH * (totals.distinct + 1)
    words, learnt = learn_words(docs.filter(~held_out), totals, model)
    first, n_head = len(model.words), len(totals.head)
    head_sums = np.zeros((n_head, words.before.shape[1]))
    head_at = {w: k for k, w in enumerate(totals.head)}
    least = min(totals.head.values(), default=0)
    if n_head > first:
        some = learnt.filter(F.col("c") >= least).toPandas()  # at most `HEAD` words
        head_sums[[head_at[w.encode()] for w in some["token"]]] = unpack(some["c"].to_numpy(), some["packed"].tolist(), words.before)

    count, known = np.array(list(totals.head.values()), dtype=np.float64), pa.array([w.decode() for w in totals.head], pa.string())
    group = np.r_[np.zeros(first, dtype=np.int32), groups_in(known[first:], model.groups)]
    s, b = words.vectors(count, head_sums, group)
    # head words have their place as number, the others come after them by group
    classes = np.r_[np.arange(first), first + group[first:], first + np.arange(model.groups)].astype(np.int32)
    base_log = np.r_[np.log10((count + SMOOTH) / base), np.zeros(model.groups)]
    before, log_z = words.before, words.log_z.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, place, ends = tokens_in(batch["text"])
            at = numbers_in(names, known.cast(names.type), model.groups)[place]
            ids = classes[at]
            far, near = contexts(ids, ends, model.classes)
            value = model.log_odds(far, near, ids).astype(np.float64)
            inside, tail = np.flatnonzero((at >= first) & (at < n_head)), np.flatnonzero(at >= n_head)
            for k in range(0, len(inside), 1 << 14):
                some = inside[k:k + (1 << 14)]
                w, u = at[some], near[some]
                value[some] += np.einsum("ij,ij->i", s[w], before[u]) + b[w] - log_z[group[w], u]
            begin, edges = np.r_[0, ends][:-1], np.searchsorted(tail, np.r_[0, ends]).astype(np.int32)
            n, known_n = np.diff(np.r_[0, ends]), np.diff(np.r_[0, ends]) - np.diff(edges)
            sums = lambda x: np.add.reduceat(x, begin) if len(begin) else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(n, pa.int64()), pa.array(known_n, pa.int64()), pa.array(sums(base_log[at])), pa.array(sums(value) / np.log(10)),
                 pa.ListArray.from_arrays(edges, names.take(pa.array(place[tail]))), pa.ListArray.from_arrays(edges, pa.array(near[tail], pa.int32()))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "tail", "near"])

    def score_tail(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            c, g, near = batch["c"].to_numpy(), batch["g"].to_numpy(), batch["near"].to_numpy()
            s, b = words.vectors(c, unpack(c, batch["packed"], words.before), g)  # 0 and log(SMOOTH) for unseen ones
            inner = (np.einsum("ij,ij->i", s, words.before[near]) + b - words.log_z[g, near]) / np.log(10)
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array((c > 0).astype(np.int64)), pa.array(np.log10((c + SMOOTH) / base)), pa.array(inner)], names=["row", "t_known", "t_base", "t_score"])

    rows = docs.select(as_text("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out"))
    schema = "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double, tail array<string>, near array<int>"
    scored, _ = settle_at(rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("tail", "near")).alias("t")).select("row", F.col("t.tail").alias("token"), F.col("t.near").alias("near"))
    met = tail.join(learnt.drop("g"), "token", "left").select("row", "near", group_column(F.col("token"), model.groups).alias("g"), F.coalesce("c", F.lit(0)).alias("c"), "packed")
    sums = met.mapInArrow(score_tail, "row long, t_known long, t_base double, t_score double").groupBy("row").agg(*(F.sum(x).alias(x) for x in ("t_known", "t_base", "t_score")))
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return scored.drop("tail", "near").join(sums, "row", "left").select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens", plus("n_known", "t_known"), F.lit(totals.total).cast("long").alias("train_tokens"),
                                                                        plus("base_score", "t_base"), plus("score", "t_score"))


def score_all(docs: DataFrame, held_out: Column) -> DataFrame:
    """Train on the rows that are not held out and score every row."""
    training = docs.filter(~held_out)
    counts, _ = settle_at(count_tokens(training), "counts")
    totals = read_counts(counts)
    return score(docs, counts, totals, train(training, totals), held_out)
