"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into passages and weighed by TF-IDF over the benchmark's vocabulary. A randomised
SVD gives the latent space: each task multiplies its passages once with a random sketch, the products add up over the
corpus, and a Nystroem step turns the sum into singular vectors. The same pass counts in how many passages each term
occurs. The benchmark's own passages enter with as much weight as the corpus, so that the space can tell them apart.

A second pass folds every window of every document into that space and takes all benchmark passages of high cosine as
candidates. So is every passage that shares ``RUN`` words in a row with a document, whatever stands around them, so that a
verbatim copy is always a candidate; the cosine of what only these find is NULL. A candidate counts if enough of the item is found in its order: by the longest common subsequence of words
alone for near copies, and with the item's answer (its last sentence) beside it for paraphrases.

Items are handled in blocks of ``BLOCK_PASSAGES``, each a pair of passes, so what is sent to the tasks has a bound that
does not follow the benchmark; no block drops anything.

Edge cases, all defined: NULL or blank documents and items match nothing; items of fewer than ``MIN_WORDS`` words count only
where all their words stand in a row, and those of fewer than ``RUN`` say too little and are skipped; a character of a script
that is written without blanks is a word of its own; an item with several passages is found if one of them is; long documents are searched to
their end; of several places of an item the first that is accepted gives its share; repeated rows are judged alike; an empty corpus or benchmark gives no hits and keeps every document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import add_vectors

HALF = 32  # words of half a window; windows overlap by it
PASSAGE = 96  # words of a benchmark passage at most
MIN_WORDS = 8
BLOCK_PASSAGES = 512
RANK = 256
OVERSAMPLE = 32
STOP_SHARE = 0.08  # terms of more benchmark passages than this tell nothing
MIN_COSINE = 0.4
RUN = 4  # words in a row; numbers of 16 bits make one of 64
SLOT_BITS = 18
NEAR_COPY = 0.75  # share of an item's words found in order
PARAPHRASE = 0.55  # with the answer beside it
ANSWER = 0.75

# Thai to Myanmar, Khmer, kana, ideographs and their extensions.
UNSPACED = re.compile("[\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")

# All bytes but those that begin the UTF-8 of these characters.
_NO_LEAD = bytes(b for b in range(256) if b not in (0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0))
_SPLIT = bytes(b if b >= 128 or chr(b).isalnum() and not chr(b).isupper() else ord(chr(b).lower()) if chr(b).isupper() else 32 for b in range(256))


def words_in(text: str | None) -> list[bytes]:
    """Words without ASCII punctuation, A-Z lower-cased; each character of a script without blanks is one."""
    if not text:
        return []
    data = text.encode("utf-8", "replace")
    if not text.isascii() and data.translate(None, _NO_LEAD):  # only then can such a character be there
        data = UNSPACED.sub(r" \g<0> ", text).encode("utf-8", "replace")
    return data.translate(_SPLIT).split()


@dataclass
class Passage:
    """A piece of a benchmark item: its words, how often it has each, their bit masks, and the words of its answer."""

    item: int | None
    words: list[bytes]
    counts: dict[bytes, int]
    masks: dict[bytes, int]
    answer: dict[bytes, int]
    answer_words: int


def _masks(words: list[bytes]) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << k
    return out


def passages_of(item: int | None, text: str | None) -> list[Passage]:
    words = words_in(text)
    if len(words) < RUN:
        return []
    if len(words) < MIN_WORDS:
        return [Passage(item, words, dict(Counter(words)), _masks(words), {}, 0)]
    sentences = [s for s in map(words_in, re.split(r"[.?!]\s|\n", text)) if s]
    answer = sentences[-1] if len(sentences) > 1 and 4 <= len(sentences[-1]) <= len(words) // 2 else words[-max(4, len(words) // 5):]
    n = -(-len(words) // PASSAGE)
    step = -(-len(words) // n)
    return [Passage(item, p, dict(Counter(p)), _masks(p), _masks(answer), len(answer)) for p in (words[k:k + step] for k in range(0, len(words), step)) if len(p) >= MIN_WORDS]


def common(masks: dict[bytes, int], length: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence with a text of the given masks, bit-parallel."""
    full = rest = (1 << length) - 1
    for w in words:
        if m := masks.get(w):
            hit = rest & m
            rest = ((rest + hit) | (rest - hit)) & full
    return length - rest.bit_count()


def found_in(passage: Passage, words: list[bytes], start: int, end: int) -> float:
    """The largest share of the passage found in order near words[start:end]; 0 where that is no contamination."""
    n = len(passage.words)
    start, end = max(0, start - n // 2), min(len(words), end + n // 2)
    region = set(words[start:end])
    if sum(c for w, c in passage.counts.items() if w in region) < PARAPHRASE * n:
        return 0.0  # a subsequence cannot be longer
    size, best = n + n // 2, 0.0
    for at in range(start, max(start + 1, end - size + max(1, n // 4)), max(1, n // 4)):
        share = common(passage.masks, n, words[at:at + size]) / n
        if share >= NEAR_COPY or share >= PARAPHRASE and common(passage.answer, passage.answer_words, words[at:at + 2 * size]) >= ANSWER * passage.answer_words:
            best = max(best, share)
    return best


def block_sums(terms: np.ndarray, ids: np.ndarray, first: np.ndarray, out: np.ndarray) -> None:
    """Sums of terms[ids] over the blocks that begin at ``first`` (HALF ids each at most), some blocks at a time in a small buffer."""
    edges, together = np.r_[first, len(ids)], 16
    held = np.empty((min(len(ids), together * HALF), terms.shape[1]), dtype=terms.dtype)
    for k in range(0, len(first), together):
        m = min(together, len(first) - k)
        a, b = edges[k], edges[k + m]
        np.take(terms, ids[a:b], axis=0, out=held[:b - a], mode="clip")
        own = np.repeat(np.arange(m), np.diff(edges[k:k + m + 1]))
        np.matmul((own[None, :] == np.arange(m)[:, None]).astype(terms.dtype), held[:b - a], out=out[k:k + m])


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _run_keys(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of all runs of RUN known words."""
    n = max(0, len(ids) - RUN + 1)
    known = ids >= 0
    begin = np.flatnonzero(np.logical_and.reduce([known[k:k + n] for k in range(RUN)]))
    keys = np.zeros(len(begin), dtype=np.uint64)
    for k in range(RUN):
        keys = (keys << np.uint64(16)) | ids[begin + k].astype(np.uint64)
    return begin, keys


@dataclass
class Space:
    """The latent space of one block of benchmark passages."""

    passages: list[Passage]
    vocab: dict[bytes, int]
    terms: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))  # term -> latent vector, IDF included
    queries: np.ndarray = field(default_factory=lambda: np.empty((0, 0)))
    singular: np.ndarray = field(default_factory=lambda: np.empty(0))
    _runs: tuple | None = field(default=None, repr=False)

    def runs(self) -> tuple[dict[bytes, int], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of all words of the passages, stop terms too; all their runs in order, with passage and place; the term of each
        number; and a table of the slots that the runs fall into."""
        if self._runs is None:
            numbers: dict[bytes, int] = {}
            rows = []
            for q, p in enumerate(self.passages):
                keys = _run_keys(np.array([numbers.setdefault(w, len(numbers)) for w in p.words]))[1]
                rows.append(np.stack([keys, np.full(len(keys), q, dtype=np.uint64), np.arange(len(keys), dtype=np.uint64)]))
            keys, q, at = np.concatenate(rows, axis=1)
            order = np.argsort(keys, kind="stable")
            terms = np.full(len(numbers) + 1, -1, dtype=np.int32)  # the last entry: no word of the passages
            for w, k in numbers.items():
                terms[k] = self.vocab.get(w, -1)
            marked = np.zeros(1 << SLOT_BITS, dtype=bool)
            marked[_slot(keys)] = True
            self._runs = numbers, keys[order], q[order].astype(np.int64), at[order].astype(np.int64), terms, marked
        return self._runs

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers, -1 for a word of no passage."""
        return np.fromiter(map(self.runs()[0].get, words, repeat(-1)), dtype=np.int32, count=len(words))

    def copies(self, numbers: np.ndarray) -> list[tuple[int, int]]:
        """(passage, where it would begin) of all runs shared with the passages; those close together once."""
        _, keys, passage, place, _, marked = self.runs()
        begin, mine = _run_keys(numbers)
        some = np.flatnonzero(marked[_slot(mine)])  # few runs pass the table, and only these are looked up
        begin, mine = begin[some], mine[some]
        low = np.searchsorted(keys, mine)
        n = np.searchsorted(keys, mine, side="right") - low
        if not n.any():
            return []
        hit = np.repeat(np.arange(len(mine)), n)
        at = np.arange(len(hit)) - np.repeat(np.cumsum(n) - n, n) + low[hit]
        q, first = passage[at], begin[hit] - place[at]
        step = np.array([max(1, len(p.words) // 4) for p in self.passages])[q]
        _, kept = np.unique(np.stack([q, first // step]), axis=1, return_index=True)
        return [(int(q[k]), int(first[k])) for k in kept]

    def candidates(self, numbers: np.ndarray) -> list[tuple[float, int, int]]:
        """(cosine, window, passage) of all pairs above the threshold, best first."""
        ids = self.runs()[4][numbers]
        hits = np.flatnonzero(ids >= 0)
        if not len(hits):
            return []
        block = hits // HALF
        first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        # only blocks with a known term, and the windows that hold one
        halves = np.zeros((len(first) + 1, self.terms.shape[1]), dtype=np.float32)
        block_sums(self.terms, ids[hits], first, halves)
        at = block[first]
        after = np.where(np.r_[at[1:] == at[:-1] + 1, False], np.arange(1, len(first) + 1), len(first))
        before = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])  # windows that begin one block earlier
        windows = np.concatenate([halves[:-1] + halves[after], halves[before]])
        starts = np.concatenate([at, at[before] - 1])
        norm = np.sqrt(np.einsum("ij,ij->i", windows, windows)) + 1e-9
        dots = windows @ self.queries
        w, q = np.nonzero(dots >= (MIN_COSINE * norm)[:, None])
        cosine = dots[w, q] / norm[w]
        order = np.argsort(-cosine, kind="stable")
        return list(zip(cosine[order].tolist(), starts[w[order]].tolist(), q[order].tolist(), strict=True))

    def search(self, text: str | None) -> list[tuple[int | None, float, float | None, int]]:
        """(item, share, cosine, first word) of each item found in a text."""
        words = words_in(text)
        if not words:
            return []
        best: dict[int | None, tuple[float, float | None, int]] = {}
        numbers = self.numbers(words)
        for cosine, window, q in self.candidates(numbers):
            item = self.passages[q].item
            if item in best:
                continue
            start = max(0, window * HALF)
            share = found_in(self.passages[q], words, start, (window + 2) * HALF) if len(self.passages[q].words) >= MIN_WORDS else 0.0
            if share:
                best[item] = (share, cosine, start)
        for q, start in self.copies(numbers):
            item, own = self.passages[q].item, self.passages[q].words
            if item in best:
                continue
            if len(own) < MIN_WORDS:  # too short for anything but its very words
                share = float(start >= 0 and words[start:start + len(own)] == own)
            else:
                share = found_in(self.passages[q], words, start, start + len(own))
            if share:
                best[item] = (share, None, max(0, start))
        return [(item, *what) for item, what in best.items()]


def _sketch(space: Space, omega_col: np.ndarray, omega_sign: np.ndarray, width: int):
    """Per task: the sum of T't T Omega over its passages, and in how many passages each term occurs."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(space.vocab)
        total, seen, n = np.zeros((size, width), dtype=np.float32), np.zeros(size), 0
        for batch in batches:
            held, held_blocks, base = [], [], 0
            for text in batch["text"]:
                words = words_in(text)
                ids = np.fromiter(map(space.vocab.get, words, repeat(-1)), dtype=np.int32, count=len(words))
                hits = np.flatnonzero(ids >= 0)
                held.append(ids[hits])
                held_blocks.append(hits // HALF + base)
                base += len(words) // HALF + 1
                if base > 20_000:
                    _add_products(np.concatenate(held), np.concatenate(held_blocks), omega_col, omega_sign, total, seen)
                    n += base
                    held, held_blocks, base = [], [], 0
            n += base
            if held:
                _add_products(np.concatenate(held), np.concatenate(held_blocks), omega_col, omega_sign, total, seen)
        if n:
            out = np.concatenate([seen[:, None], total], axis=1).astype(np.float32)
            step = max(1, (1 << 18) // (width + 1))
            rows = [(k, out[k:k + step].tobytes()) for k in range(0, size, step) if out[k:k + step, 0].any()]
            yield pd.DataFrame({"row": [-1, *(k for k, _ in rows)], "n": [n, *(0 for _ in rows)], "part": [b"", *(p for _, p in rows)]})
    return run


def _add_products(ids: np.ndarray, blocks: np.ndarray, col: np.ndarray, sign: np.ndarray, total: np.ndarray, seen: np.ndarray, weight: float = 1.0) -> None:
    """Add T'T Omega of the passages to total; Omega has one signed entry per term."""
    width = total.shape[1]
    chunk = 8_000  # bounds the products to a few tens of MB
    edge = 0
    while edge < len(ids):
        end = len(ids) if edge + chunk >= len(ids) else int(np.searchsorted(blocks, blocks[edge + chunk]))
        end = end if end > edge else int(np.searchsorted(blocks, blocks[edge], side="right"))
        i, b = ids[edge:end], blocks[edge:end] - blocks[edge]
        held = int(b[-1]) + 1
        product = np.bincount(b * width + col[i], weights=sign[i], minlength=held * width).reshape(held, width).astype(np.float32)
        order = np.argsort(i, kind="stable")
        start = np.flatnonzero(np.r_[True, np.diff(i[order]) != 0])
        total[i[order][start]] += weight * np.add.reduceat(product[b[order]], start, axis=0)
        term, at = i[order], b[order]  # each passage once a term: blocks ascend inside a term
        seen += np.bincount(term[np.r_[True, (np.diff(term) != 0) | (np.diff(at) != 0)]], minlength=len(seen))
        edge = end


def fit_space(docs: DataFrame, passages: list[Passage], rank: int = RANK, seed: int = 11) -> Space:
    """Counts and randomised SVD over all passages of docs (text) and of the benchmark."""
    often = Counter(w for p in passages for w in p.counts)
    stop = max(3, STOP_SHARE * len(passages))
    vocab = {w: k for k, w in enumerate(sorted(w for w, c in often.items() if c <= stop))}
    space = Space(passages, vocab)
    if not vocab:
        return space
    width = min(rank + OVERSAMPLE, len(vocab))
    rng = np.random.default_rng(seed)
    col = rng.integers(0, width, len(vocab))
    col[rng.permutation(len(vocab))[:width]] = np.arange(width)  # no empty column
    sign = rng.choice([-1.0, 1.0], len(vocab))
    made = docs.select("text").mapInPandas(_sketch(space, col, sign, width), "row int, n long, part binary")
    total, seen = np.zeros((len(vocab), width)), np.zeros(len(vocab))
    n, parts = add_vectors(made)  # vocabulary x width numbers in all
    for row, flat in parts.items():
        part = flat.reshape(-1, width + 1)
        seen[row:row + len(part)] += part[:, 0]
        total[row:row + len(part)] += part[:, 1:]
    idf = np.log((n + 2) / (seen + 1))

    ids = np.concatenate([[vocab[w] for w in p.words if w in vocab] for p in passages]).astype(np.int64)
    rows = np.concatenate([[k] * sum(w in vocab for w in p.words) for k, p in enumerate(passages)]).astype(np.int64)
    if not len(ids):
        return Space(passages, {})
    own, own_seen = np.zeros((len(vocab), width), dtype=np.float32), np.zeros(len(vocab))
    _add_products(ids, rows, col, sign, own, own_seen)
    # traces of the two Gram matrices, nearly: what each side weighs
    alpha = max(1.0, float((seen * idf**2).sum() / max((own_seen * idf**2).sum(), 1e-9)))
    total += alpha * own

    # Nystroem: M = D T'T D, sketched with D^-1 Omega, so that M Omega' = D (T'T Omega)
    y = idf[:, None] * total
    core = np.zeros((width, width))
    np.add.at(core, col, sign[:, None] * total)
    value, vector = np.linalg.eigh((core + core.T) / 2)
    keep = value > 1e-9 * max(value.max(), 1e-30)
    left, size, _ = np.linalg.svd(y @ (vector[:, keep] / np.sqrt(value[keep])), full_matrices=False)
    space.terms = np.ascontiguousarray(idf[:, None] * left[:, :rank], dtype=np.float32)
    space.singular = size[:rank]
    latent = np.zeros((len(passages), space.terms.shape[1]))
    np.add.at(latent, rows, space.terms[ids])
    norm = np.linalg.norm(latent, axis=1, keepdims=True)
    space.queries = np.ascontiguousarray((latent / np.maximum(norm, 1e-9)).T, dtype=np.float32)
    return space


def blocks_of(benchmark: DataFrame, size: int = BLOCK_PASSAGES) -> Iterator[list[Passage]]:
    """The benchmark's passages, a block at a time."""
    held: list[Passage] = []
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        held += passages_of(row[0], row[1])
        while len(held) >= size:
            yield held[:size]
            held = held[size:]
    if held:
        yield held


def spaces_of(docs: DataFrame, benchmark: DataFrame) -> Iterator[Space]:
    for passages in blocks_of(benchmark):
        yield fit_space(docs, passages)


HITS = "array<struct<item_id: bigint, share: double, cosine: double, first_word: bigint>>"


def hits_in(space: Space, text: Column) -> Column:
    """The benchmark items of a block that a text holds."""
    @F.pandas_udf(HITS)
    def benchmark_hits(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"item_id": i, "share": s, "cosine": c, "first_word": w} for i, s, c, w in space.search(t)] for t in texts], dtype="object")

    return benchmark_hits(text.cast("string"))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document and benchmark item found in it: doc_id, item_id, share, cosine, first_word."""
    found = None
    for space in spaces_of(docs, benchmark):
        hits = docs.select(F.col("doc_id"), F.explode(hits_in(space, F.col("text"))).alias("hit")).select("doc_id", "hit.*")
        found = hits if found is None else found.unionByName(hits)
    return docs.select("doc_id").limit(0).select("doc_id", F.lit(None).cast("bigint").alias("item_id"), F.lit(None).cast("double").alias("share"), F.lit(None).cast("double").alias("cosine"),
                                                 F.lit(None).cast("bigint").alias("first_word")) if found is None else found


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, all their columns unchanged."""
    kept = docs
    for space in spaces_of(docs, benchmark):
        kept = kept.filter(F.size(hits_in(space, kept["text"])) == 0)
    return kept
