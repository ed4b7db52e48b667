"""Re-Pair over short alphabets, and min-plus transfer matrices with audit ropes, one for each symbol and rule.

A sequence is a string of letters. A rule names two neighbouring symbols by a new one, in Unicode's private area. Its matrix
is the min-plus product of its parts' matrices: the entry (i, j) has the least cost from state i to state j and, among equal
costs, the least string of edits. Of two strings of one cost none begins the other (both edit the same rows, and each further
insertion costs), so the least whole is made of least parts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rounds of Re-Pair, and rules a round: the rules sent to tasks are at most their product, whatever the data.
ROUNDS, RULES = 8, 48
FIRST = 0xE000
MOD, BASE = (1 << 61) - 1, 1_000_003


class Rope:
    """A string made of two ropes or of one letter, with its length and a hash, so that equal parts are told at once."""

    __slots__ = ("hash", "left", "letter", "n", "power", "right")

    def __init__(self, letter: str, left: Rope | None = None, right: Rope | None = None):
        self.letter, self.left, self.right = letter, left, right
        if left is None or right is None:
            self.n, self.hash, self.power = len(letter), ord(letter) if letter else 0, BASE if letter else 1
        else:
            self.n, self.power = left.n + right.n, left.power * right.power % MOD
            self.hash = (left.hash * right.power + right.hash) % MOD

    def __add__(self, other: Rope) -> Rope:
        return other if not self.n else self if not other.n else Rope("", self, other)

    def __lt__(self, other: Rope) -> bool:
        mine, others = [self] if self.n else [], [other] if other.n else []
        while mine and others:
            a, b = mine.pop(), others.pop()
            if a.n == b.n and a.hash == b.hash:
                continue
            if a.n == 1 and b.n == 1:
                return a.letter < b.letter
            for rope, stack, longer in ((a, mine, a.n >= b.n), (b, others, b.n >= a.n)):
                stack.extend((rope.right, rope.left) if longer and rope.n > 1 else (rope,))
        return bool(others)

    def __str__(self) -> str:
        out, stack = [], [self]
        while stack:
            rope = stack.pop()
            if rope.left is None:
                out.append(rope.letter)
            else:
                stack += [rope.right, rope.left]
        return "".join(out)


def rope_of(text: str) -> Rope:
    """A balanced rope of a string."""
    if len(text) < 2:
        return Rope(text)
    half = len(text) // 2
    return rope_of(text[:half]) + rope_of(text[half:])


Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def better(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return a or b
    return a if a[0] < b[0] or a[0] == b[0] and a[1] < b[1] else b


def times(vector: list[Entry], matrix: Matrix) -> list[Entry]:
    """Min-plus product of a row of entries and a matrix."""
    out: list[Entry] = [None] * len(matrix)
    for i, entry in enumerate(vector):
        if entry is None:
            continue
        for j, step in enumerate(matrix[i]):
            if step is not None and (out[j] is None or entry[0] + step[0] <= out[j][0]):
                out[j] = better(out[j], (entry[0] + step[0], entry[1] + step[1]))
    return out


def product(a: Matrix, b: Matrix) -> Matrix:
    return [times(row, b) for row in a]


class Grammar:
    """Rules (two symbols each, in order) and the matrices of letters and rules, the rules' evaluated bottom-up once."""

    def __init__(self, letters: dict[str, Matrix], rules: list[str]):
        self.rules, self.matrices = rules, dict(letters)
        for k, pair in enumerate(rules):
            self.matrices[chr(FIRST + k)] = product(self.matrices[pair[0]], self.matrices[pair[1]])

    def compress(self, sequence: str) -> str:
        return compress(sequence, self.rules)

    def run(self, sequence: str, start: int) -> list[Entry]:
        """Least edits of a sequence from one state to each other."""
        size = len(next(iter(self.matrices.values())))
        vector: list[Entry] = [(0, Rope("")) if k == start else None for k in range(size)]
        for symbol in self.compress(sequence):
            vector = times(vector, self.matrices[symbol])
        return vector


def compress(sequence: str, rules: list[str]) -> str:
    for k, pair in enumerate(rules):
        if len(sequence) < 2:
            break
        sequence = sequence.replace(pair, chr(FIRST + k))
    return sequence


def pairs_of(sequence: str) -> Iterator[str]:
    """Neighbouring symbols; of overlapping equal pairs (aaa) every second one."""
    last, at = "", -2
    for k in range(len(sequence) - 1):
        pair = sequence[k:k + 2]
        if pair == last and at == k - 1:
            last = ""
            continue
        last, at = pair, k
        yield pair


def _counter(rules: list[str]):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: Counter[str] = Counter()  # as many as there are symbols squared at most
        for batch in batches:
            for sequence, n in zip(batch.column("seq").to_pylist(), batch.column("n").to_pylist(), strict=True):
                for pair in pairs_of(compress(sequence, rules)):
                    pairs[pair] += n
        yield pa.RecordBatch.from_pydict({"pair": pa.array(list(pairs), pa.string()), "n": pa.array(list(pairs.values()), pa.int64())})
    return count


def learn(sequences: DataFrame) -> list[str]:
    """Re-Pair rules of all sequences (seq, n): each round names the most frequent pairs that occur twice or more.

    Rules of one round are applied in the order of their counts, so where two overlap the more frequent one comes first.
    """
    rules: list[str] = []
    for _ in range(ROUNDS):
        counted = sequences.mapInArrow(_counter(list(rules)), "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        found = [r["pair"] for r in counted.where("n > 1").orderBy(F.desc("n"), "pair").limit(RULES).collect()]
        if not found:
            break
        rules += found
    return rules
