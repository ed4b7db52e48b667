"""Quality rules as a ledger of bits.

Every rule is evaluated once per document; its outcome is one bit of ``failed`` and its figures stay beside it. A policy
is a set of rule bits with a version, so a new policy is a mask over the ledger, not a new pass over the texts. How many
documents each rule takes away on its own, or would give back if left out, is one aggregate of bit tests.

Edge cases, all defined: a NULL or empty text has no words and figures of 0, and fails ``too_few_words``; any length is
read whole; repeated rows are judged alike; an empty table gives an empty ledger; only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import as_given, as_text

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclaims", "n_alpha_words", "n_upper", "n_letters")

# Bit of each rule, in order, and when a document fails it.
RULES: list[tuple[str, str]] = [
    ("too_few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > greatest(n_words, 1)"),
    ("exclaims", "5 * n_exclaims > greatest(n_words, 1)"),
    ("duplicate_lines", "100 * n_dup_lines > 40 * greatest(n_lines, 1)"),
    ("few_alphabetic_words", "100 * n_alpha_words < 60 * n_words"),
    ("capitals", "n_letters > 0 and 100 * n_upper > 50 * n_letters"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 16 * n_words"),
    ("many_repeats", "100 * n_repeat_words > 20 * n_words"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["too_few_words"] | BIT["repeated_windows"]
#: Versioned policies: the bits that reject a document.
POLICIES = {
    "base-1": BASE,
    "prose-1": BASE | BIT["symbols"] | BIT["exclaims"] | BIT["duplicate_lines"] | BIT["few_alphabetic_words"] | BIT["capitals"] | BIT["word_length"],
    "strict-1": sum(BIT.values()),
}


def repeated_words(words: list[str]) -> int:
    """Words inside 3-word windows that occur at least twice in the text, the first occurrence included."""
    if len(words) < 4:
        return 0
    ids: dict[str, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    if len(ids) > len(words) - 2:
        return 0
    pair = a[:-1] * len(ids) + a[1:]
    if len(ids) > 1_000_000:  # keeps the product below 2^63
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(ids) + a[2:]
    _, where, count = np.unique(window, return_inverse=True, return_counts=True)
    again = count[where] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k: len(again) + k] |= again
    return int(covered.sum())


def figures(text: str | None) -> tuple[int, ...]:
    """The figures of one text, in the order of FIGURES."""
    if not text:
        return (0,) * len(FIGURES)
    data = text.encode("utf-8", "replace")
    raw = data.split()
    count_of = lambda chars: len(data) - len(data.translate(None, chars))  # noqa: E731  how many bytes are of these
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            dup += line in seen
            seen.add(line)
    return (len(raw), len(text) - count_of(SPACES.encode()), count_of(SYMBOLS.encode()), dup, repeated_words(raw), lines,
            text.count("!"), sum(map(_has_letter, raw)), count_of(_UPPER), count_of(_UPPER + _UPPER.lower()))


_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LETTERS = bytes(b for b in range(256) if chr(b).isascii() and chr(b).isalpha() or b >= 128)


def _has_letter(word: bytes) -> bool:
    return len(word.translate(None, _LETTERS)) < len(word)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the figures, and ``failed``: the bits of all rules that the document fails."""
    def measure(batches):
        for batch in batches:
            rows = [figures(t) for t in batch["text"]]
            out = pd.DataFrame(rows, columns=list(FIGURES), dtype="int64")
            out.insert(0, "doc_id", as_given(batch["doc_id"]))
            yield out

    schema = "doc_id string, " + ", ".join(f"{c} long" for c in FIGURES)
    measured = docs.select(as_text("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInPandas(measure, schema).withColumn("doc_id", F.col("doc_id").cast("long"))
    bits = [F.when(F.expr(fails), F.lit(BIT[name])).otherwise(F.lit(0)) for name, fails in RULES]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn("failed", total.cast("long"))


def passes(policy: str) -> Column:
    """Whether a ledger row passes the policy."""
    return F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail nothing else, and kept if it were left out."""
    mask = POLICIES[policy]
    failed = F.col("failed").bitwiseAND(F.lit(mask))
    counted = book.groupBy(failed.alias("bits")).agg(F.count("*").alias("n"))  # at most one row per combination of rules
    rules = [(name, BIT[name]) for name, _ in RULES if BIT[name] & mask]
    totals = counted.agg(*(F.sum(F.when(F.col("bits").bitwiseAND(F.lit(b)) != 0, F.col("n")).otherwise(0)).alias(f"f_{r}") for r, b in rules),
                         *(F.sum(F.when(F.col("bits") == b, F.col("n")).otherwise(0)).alias(f"o_{r}") for r, b in rules),
                         F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("kept"))
    rows = F.array(*(F.struct(F.lit(r).alias("rule"), F.col(f"f_{r}").alias("failing"), F.col(f"o_{r}").alias("only_this"),
                              (F.col("kept") + F.col(f"o_{r}")).alias("kept_without")) for r, _ in rules))
    return totals.select(F.inline(rows))
