"""Toxicity by a weighted lexicon, matched with Aho-Corasick.

Texts are folded first: lower case, accents and look-alike letters of other scripts to plain Latin, digits and signs that
stand for letters (1d10t) to those letters, punctuation to blanks. Lexicon entries are whole words (" word ") or stems
(" stem", for languages whose insults are inflected). Their weights are log odds of labelled documents; the longest match
at a place counts, and a match inside an exception phrase counts nothing. The sum of weights, also per square root of the
length, goes through a logistic curve fitted to the same labelled documents.

Only labels are sampled: at most ``SAMPLE_ROWS`` labelled documents train the lexicon and the curve, chosen by hash. The
score reads nothing but the text, all of it.

Edge cases, all defined: NULL and empty texts get the score of a text without matches; NULL labels and ids without a
document train nothing; a document with several labels counts as toxic if one says so; with no usable label the lexicon is
empty and every text gets ``PRIOR``; repeated rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import free, settle_at

SAMPLE_ROWS = 20_000  # bound of the labelled documents that train
STEM_LENGTHS = (4, 5, 6, 7, 8)
MIN_TOXIC = 3  # toxic documents that an entry must occur in
MIN_LOG_ODDS = 2.5
MAX_ENTRIES = 5_000  # bound of what is sent to the tasks; the heaviest stay
PRIOR = 0.05
THRESHOLD = 0.7

# Look-alike letters of other scripts.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t",
    "у": "y", "х": "x", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ɡ": "g", "ł": "l", "ø": "o",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i"}  # only between letters
INVISIBLE = "­​‌‍⁠﻿"


def _folding_table() -> dict[int, str]:
    table: dict[int, str] = {}
    for cp in range(128):
        c = chr(cp)
        table[cp] = DIGITS.get(c, c.lower() if c.isalnum() else " ")
    for cp in [*range(0xAA, 0x250), *range(0x1E00, 0x1F00), *range(0xFF10, 0xFF5B)]:
        plain = unicodedata.normalize("NFKD", chr(cp).lower())
        plain = "".join(c for c in plain if not unicodedata.combining(c))
        table[cp] = plain if plain.isalnum() else (chr(cp).lower() if chr(cp).isalnum() else " ")
    for cp in range(0x300, 0x370):
        table[cp] = ""
    for cp in range(0x370, 0x530):
        c = chr(cp).lower()
        table[cp] = HOMOGLYPHS.get(c, c)
    for cp in [*range(0x2000, 0x2070), *range(0x3000, 0x3004)]:
        table[cp] = " "
    table.update({ord(c): to for c, to in HOMOGLYPHS.items()})
    table.update({ord(c): "" for c in INVISIBLE})
    return table


_TABLE = _folding_table()
_ASCII = bytes(ord(_TABLE[b]) if b < 128 else b for b in range(256))
_SIGN = re.compile(r"(?<=[^\W_])[@$!](?=[^\W_])")


def fold(text: str | None) -> str:
    """The folded text: words between single blanks, a blank at either end."""
    if not text:
        return " "
    if "@" in text or "$" in text or "!" in text:
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    flat = text.encode().translate(_ASCII).decode() if text.isascii() else text.translate(_TABLE)
    return f" {' '.join(flat.split())} "


@dataclass
class Lexicon:
    """Entries with weights, exception phrases, and the curve's three coefficients."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, ...] = ()
    _machine: object = field(default=None, repr=False)

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve, "_machine": None}

    def machine(self):
        if self._machine is None:
            found = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                found.add_word(entry, (entry, weight))
            for phrase in self.exceptions:
                found.add_word(f" {'  '.join(phrase.split())} ", (phrase, 0.0))
            if len(found):
                found.make_automaton()
            self._machine = found
        return self._machine

    def matches(self, folded: str) -> list[tuple[int, str, float]]:
        """Longest matches from the left, without overlap: (end, entry, weight)."""
        found = self.machine()
        if not len(found):
            return []
        # every word has blanks of its own on both sides, so neighbours both match
        return [(end, *what) for end, what in found.iter_long(folded.replace(" ", "  "))]

    def evidence(self, text: str | None) -> tuple[float, float]:
        folded = fold(text)
        total = sum(w for _, _, w in self.matches(folded))
        return min(total, 40.0) / 10, min(total / (1 + folded.count(" ")) ** 0.5, 10.0)

    def score(self, text: str | None) -> float:
        if not self.curve:
            return PRIOR
        a, b, c = self.curve
        x, y = self.evidence(text)
        return float(1 / (1 + np.exp(-np.clip(a + b * x + c * y, -30, 30))))


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, bound: int = SAMPLE_ROWS) -> DataFrame:
    """(text, toxic) of at most about ``bound`` labelled documents for which usable holds, chosen by hash of the id."""
    marked = labels.filter(usable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = marked.count()
    if n > bound:
        marked = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * bound / n))
    # at most about `bound` rows of two numbers, so it may be sent everywhere; the texts stay where they are
    return docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))


def _terms(folded: str) -> set[str]:
    out: set[str] = set()
    for word in set(folded.split()):
        if len(word) < 3 or len(word) > 40:
            continue
        out.add(f" {word} ")
        out.update(f" {word[:k]}" for k in STEM_LENGTHS if k < len(word))
    return out


def _count_terms(batches: Iterable[pd.DataFrame]):
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            counts[int(toxic)].update(_terms(fold(text)))
    if counts[0] or counts[1]:
        terms = list(counts[0].keys() | counts[1].keys())
        yield pd.DataFrame({"term": terms, "toxic": [counts[1][t] for t in terms], "clean": [counts[0][t] for t in terms]})


def _choose(found: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Entries and weights out of (term, toxic documents, clean documents)."""
    odds = {t: float(np.log((p + 0.5) / (n_toxic + 1)) - np.log((n + 0.5) / (n_clean + 1))) for t, p, n in found}
    stats = {t: (p, n) for t, p, n in found if odds[t] >= MIN_LOG_ODDS}
    # a stem that one longer entry explains gives way to it
    explained = {t[:k] for t, (p, _) in stats.items() for k in range(1 + min(STEM_LENGTHS), len(t)) if t[:k] in stats and p >= 0.9 * stats[t[:k]][0]}
    kept: dict[str, float] = {}
    for t in sorted(stats, key=lambda t: (len(t), t)):
        stems = [t[:k] for k in range(2, len(t)) if t[:k] in kept]
        if t not in explained and not any(stats[s][1] <= 0.05 * stats[s][0] for s in stems):
            kept[t] = odds[t]
    # an entry of few documents is weaker evidence
    weights = {t: w * stats[t][0] / (stats[t][0] + 5) for t, w in kept.items()}
    return dict(sorted(weights.items(), key=lambda x: (-x[1], x[0]))[:MAX_ENTRIES])


def fit(docs: DataFrame, labels: DataFrame, usable: Column, bound: int = SAMPLE_ROWS, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Learn lexicon, exception phrases and curve from labelled documents for which usable (of labels' columns) holds."""
    sample, path = settle_at(labelled_sample(docs, labels, usable, bound), "toxic-sample")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_toxic or not n_clean:
        free(docs.sparkSession, path)
        return Lexicon({}, exceptions)
    least = max(MIN_TOXIC, n_toxic // 400)
    found = sample.mapInPandas(_count_terms, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(
        (F.col("toxic") >= least) & (F.col("toxic") * n_clean >= F.col("clean") * n_toxic * 10))
    lexicon = Lexicon(_choose([tuple(r) for r in found.collect()], n_toxic, n_clean), exceptions)

    def contexts(batches):
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                folded = fold(text)
                hits = {what.split()[0] for _, what, _ in lexicon.matches(folded)}
                words = folded.split() if hits else []
                near = {f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if any(x.startswith(h) for h in hits for x in (a, b))}
                rows += [(phrase, toxic) for phrase in near]
            yield pd.DataFrame(rows, columns=["phrase", "toxic"])

    # phrases around a match that only clean documents have
    harmless = sample.mapInPandas(contexts, "phrase string, toxic int").groupBy("phrase").agg(
        F.sum("toxic").alias("toxic"), F.count("*").alias("n")).filter((F.col("toxic") == 0) & (F.col("n") >= 5)).orderBy(F.desc("n"), "phrase").limit(MAX_ENTRIES)
    lexicon = Lexicon(lexicon.weights, (*exceptions, *(r["phrase"] for r in harmless.collect())))

    def measured(batches):
        for batch in batches:
            pairs = [lexicon.evidence(t) for t in batch["text"]]
            yield pd.DataFrame({"x": [p[0] for p in pairs], "y": [p[1] for p in pairs], "toxic": batch["toxic"]})

    points = sample.mapInPandas(measured, "x double, y double, toxic int").toPandas()
    free(docs.sparkSession, path)
    return Lexicon(lexicon.weights, lexicon.exceptions, _logistic(points))


def _logistic(points: pd.DataFrame, ridge: float = 1e-2) -> tuple[float, ...]:
    """Coefficients of a ridge logistic curve, by Newton steps; the two slopes stay at 0 or above."""
    x = np.column_stack([np.ones(len(points)), points["x"], points["y"]])
    y = points["toxic"].to_numpy(dtype=float)
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * np.array([0, w[1], w[2]])
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(3)
        step = np.clip(np.linalg.solve(hess, grad), -3, 3)
        w = w - step
        w[1:] = np.maximum(w[1:], 0)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in w)


def scorer(lexicon: Lexicon):
    """A column function from text to score."""
    @F.pandas_udf("double")
    def toxic_score(texts: pd.Series) -> pd.Series:
        return pd.Series([lexicon.score(t) for t in texts], dtype="float64")

    return toxic_score


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, text, score) of every document."""
    return docs.select("doc_id", "text", scorer(lexicon)(F.col("text").cast("string")).alias("score"))


def reject_toxic(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, all their columns unchanged."""
    return docs.filter(scorer(lexicon)(docs["text"].cast("string")) < threshold)
