"""Secrets by patterns and by a linear-chain conditional random field.

The patterns are the base: assignments to telling names, access key ids, long hexadecimal runs. The random field adds what
they miss. Its tokens are runs of the characters that secrets are made of; tags are B (begins a secret), I (inside) and O.
A token that cannot be a secret by its shape (short, or letters only) may only be O, so the chain falls apart exactly at
such tokens, and Viterbi runs over the stretches between. Features: shape, length, character classes, the characters on
either side, neighbouring words, and what the file holds as a whole.

The field is trained here by maximum likelihood on weak labels: tokens under a base match of a bounded sample of documents
(``SAMPLE_DOCS``, chosen by hash), once with and once without the features of their surroundings, so that it also learns
shapes alone. Scanning covers every text to its end.

Edge cases, all defined: NULL and empty texts hold nothing; without any base match in the sample nothing is trained and
the patterns stand alone; a span of the field that touches a base span is dropped, so base spans stay as they are;
positions are code points, ends exclusive; repeated rows get equal spans; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_DOCS = 20_000
KINDS = ("assign", "access", "hex", "crf")
MASK = "[secret]"
LONGEST = 12  # tokens of a training example; longer stretches are several

# The base patterns.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

TOKEN = re.compile(r"(?<![A-Za-z0-9+/_.\-])[A-Za-z0-9+/_.\-]{8,}")
WORD_BEFORE = re.compile(r"[A-Za-z_]+")
HINTS = {"password": "pw", "passwd": "pw", "pwd": "pw", "passphrase": "pw", "secret": "secret", "token": "token", "bearer": "token", "auth": "token",
         "key": "key", "apikey": "key", "api_key": "key", "credential": "key", "private": "key", "access": "key"}
O, B, I = 0, 1, 2
OUTSIDE = ("left=", "right=", "before=", "after=", "file=")  # features of a token's surroundings


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the secret itself) of the base patterns, by start, then kind."""
    spans = []
    lower = text.lower()
    if any(n in lower for n in NAMES):
        spans += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def can_be_secret(token: str) -> bool:
    """Whether a token's shape lets it be B or I."""
    bare = token.strip("./-_")
    return len(bare) >= 8 and not bare.isalpha() and any(c.isdigit() for c in bare) and any(c.isalpha() for c in bare)


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of neighbouring tokens that may be secrets: at most two characters lie between them, no white space."""
    run: list[tuple[int, int]] = []
    for m in TOKEN.finditer(text):
        if not can_be_secret(m[0]):
            continue
        start = m.start() + len(m[0]) - len(m[0].lstrip("."))
        end = m.end() - (len(m[0]) - len(m[0].rstrip(".")))
        if run and not (start - run[-1][1] <= 2 and not text[run[-1][1]:start].isspace()):
            yield run
            run = []
        run.append((start, end))
    if run:
        yield run


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= e for e in edges)


def _side(c: str) -> str:
    return {"": "edge", '"': "quote", "'": "quote", "`": "quote", "=": "equals", ":": "colon", "@": "at", "\n": "line", " ": "blank", "\t": "blank"}.get(c, "letter" if c.isalpha() else "other")


def _hint(words: list[str]) -> str:
    for w in reversed(words):
        for name, kind in HINTS.items():
            if name in w.lower():
                return kind
    return "none"


def file_features(text: str) -> tuple[str, ...]:
    lower = text.lower()
    signs = sum(map(text.count, "={};")) * 50 > len(text)
    return (f"file=named:{any(n in lower for n in NAMES)}", f"file=code:{signs}")


def features(text: str, start: int, end: int, of_file: tuple[str, ...]) -> tuple[str, ...]:
    """The features of one token."""
    t = text[start:end]
    n = len(t)
    digits, upper, lower = sum(c.isdigit() for c in t), sum(c.isupper() for c in t), sum(c.islower() for c in t)
    changes = sum((a.isdigit(), a.isupper()) != (b.isdigit(), b.isupper()) for a, b in zip(t, t[1:], strict=False))
    classes = f"{'d' * (digits > 0)}{'u' * (upper > 0)}{'l' * (lower > 0)}{'+' * ('+' in t)}{'/' * ('/' in t)}{'_' * ('_' in t or '-' in t)}{'.' * ('.' in t)}"
    before, after = WORD_BEFORE.findall(text[max(0, start - 32):start]), WORD_BEFORE.findall(text[end:end + 24])
    left, right = text[start - 1:start], text[end:end + 1]
    return ("bias", f"length={_bucket(n, (10, 12, 16, 20, 24, 32, 40, 64))}", f"classes={classes}", f"hex={not t.strip('0123456789abcdef')}",
            f"digits={10 * digits // n}", f"changes={_bucket(100 * changes // n, (5, 15, 30, 45, 60))}", f"distinct={_bucket(len(set(t)), (5, 8, 11, 14, 18))}",
            f"dots={min(3, t.count('.'))}", f"slashes={min(3, t.count('/'))}", f"left={_side(left)}", f"right={_side(right)}",
            f"before={_hint(before[-3:])}", f"before=near:{_hint(before[-1:])}:{_side(left)}", f"after={_hint(after[:2])}", *of_file)


@dataclass
class Field:
    """Weights of the random field: per feature and tag, and between tags."""

    weights: dict[str, tuple[float, float, float]]
    moves: tuple[tuple[float, ...], ...]
    _seen: dict = field(default_factory=dict, repr=False)

    def emission(self, found: tuple[str, ...]) -> tuple[float, float, float]:
        score = self._seen.get(found)
        if score is None:
            if len(self._seen) > 50_000:
                self._seen.clear()
            rows = [self.weights[f] for f in found if f in self.weights]
            score = self._seen[found] = tuple(sum(r[k] for r in rows) for k in range(3))
        return score

    def tags(self, run: list[tuple[str, ...]]) -> list[int]:
        """The best tags of a stretch, by Viterbi; what lies before and after it is O."""
        if not run:
            return []
        score = [self.emission(run[0])[t] + self.moves[O][t] for t in range(3)]
        back: list[list[int]] = []
        for found in run[1:]:
            e = self.emission(found)
            back.append([max(range(3), key=lambda s, t=t: score[s] + self.moves[s][t]) for t in range(3)])
            score = [score[s] + self.moves[s][t] + e[t] for t, s in enumerate(back[-1])]
        path = [max(range(3), key=lambda t: score[t] + self.moves[t][O])]
        for best in reversed(back):
            path.append(best[path[-1]])
        return path[::-1]

    def spans(self, text: str) -> list[tuple[str, int, int, int]]:
        of_file, out = None, []
        for run in stretches(text):
            of_file = of_file or file_features(text)
            tags = self.tags([features(text, s, e, of_file) for s, e in run])
            for (s, e), tag in zip(run, tags, strict=True):
                if tag == B:
                    out.append(("crf", s, e, s))
                elif tag == I and out:
                    out[-1] = ("crf", out[-1][1], e, out[-1][1])
        return out


def find_secrets(text: str | None, model: Field | None) -> list[tuple[str, int, int, int]]:
    """All spans of a text: (kind, start, end, start of the secret)."""
    if not text:
        return []
    base = base_spans(text)
    if model is None:
        return base
    more = [s for s in model.spans(text) if all(s[2] <= b[1] or s[1] >= b[2] for b in base)]
    return sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0])))


def redact(text: str | None, model: Field | None) -> str | None:
    """The text with every secret masked; the name of an assignment stays."""
    spans = find_secrets(text, model)
    if not spans:
        return text
    parts, at = [], 0
    for _, _, end, value in spans:
        if value > at:
            parts += [text[at:value], MASK]
        elif not parts:
            parts.append(MASK)
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stretches as text (features by blank, tokens by line) with their weak tags."""
    for batch in batches:
        rows = []
        for text in batch["text"]:
            if not text:
                continue
            base, of_file = base_spans(text), file_features(text)
            for run in stretches(text):
                tags, last = [], None
                for s, e in run:
                    hit = next((b for b in base if b[3] < e and s < b[2]), None)
                    tags.append("O" if hit is None else "I" if hit is last else "B")
                    last = hit
                whole = [features(text, s, e, of_file) for s, e in run]
                for k in range(0, len(run), LONGEST):  # a long stretch is learnt from in pieces, all of it
                    found, tags_here = whole[k:k + LONGEST], tags[k:k + LONGEST]
                    if tags_here[0] == "I":
                        tags_here[0] = "B"
                    rows.append(("\n".join(" ".join(f) for f in found), "".join(tags_here)))
                    if "B" in tags_here:  # shapes alone
                        rows.append(("\n".join(" ".join(x for x in f if not x.startswith(OUTSIDE)) for f in found), "".join(tags_here)))
        yield pd.DataFrame(rows, columns=["run", "tags"])


def train(docs: DataFrame, bound: int = SAMPLE_DOCS) -> Field | None:
    """Fit the field to weak labels of about ``bound`` documents."""
    n = docs.count()
    sample = docs.select("text") if n <= bound else docs.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < max(1, int(1_000_000 * bound / n))).select("text")
    rows = sample.mapInPandas(_examples, "run string, tags string").groupBy("run", "tags").agg(F.count("*").alias("n")).toPandas()
    return fit_field(rows)


def fit_field(rows: pd.DataFrame, rounds: int = 200, ridge: float = 0.05) -> Field | None:
    """Maximum likelihood by forward-backward over all stretches at once, with Adam steps."""
    if not rows["tags"].str.contains("B").any():
        return None
    rows = rows.sort_values(["run", "tags"])
    runs = [[token.split(" ") for token in run.split("\n")] for run in rows["run"]]
    names = {f: k + 1 for k, f in enumerate(sorted({f for run in runs for token in run for f in token}))}  # 0: nothing
    length = np.array([len(r) for r in runs])
    wide = max(len(t) for r in runs for t in r)
    ids = np.zeros((len(runs), length.max(), wide), dtype=np.int64)
    gold = np.zeros((len(runs), length.max()), dtype=np.int64)
    for k, (run, tags) in enumerate(zip(runs, rows["tags"], strict=True)):
        for j, token in enumerate(run):
            ids[k, j, :len(token)] = [names[f] for f in token]
            gold[k, j] = "OBI".index(tags[j])
    count = np.log1p(rows["n"].to_numpy(dtype=float))  # repeated stretches count, but do not drown the rest
    live = np.arange(length.max())[None, :] < length[:, None]
    params = [np.zeros((len(names) + 1, 3)), np.zeros((3, 3))]
    wall = np.zeros((3, 3))
    wall[O, I] = -1e9  # a secret begins with B
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    one_hot = np.eye(3)
    for step in range(1, rounds + 1):
        weights, moves = params
        scores = weights[ids].sum(axis=2)
        t = moves + wall
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0] + t[O]
        for j in range(1, scores.shape[1]):
            forward[:, j] = np.logaddexp.reduce(forward[:, j - 1, :, None] + t[None], axis=1) + scores[:, j]
        final = np.tile(t[:, O], (len(runs), 1))
        backward[np.arange(len(runs)), length - 1] = final
        for j in range(scores.shape[1] - 2, -1, -1):
            inner = np.logaddexp.reduce(t[None] + (scores[:, j + 1] + backward[:, j + 1])[:, None, :], axis=2)
            backward[:, j] = np.where((j < length - 1)[:, None], inner, backward[:, j])
        z = np.logaddexp.reduce(forward[np.arange(len(runs)), length - 1] + final, axis=1)
        single = np.exp(np.clip(forward + backward - z[:, None, None], -700, 0)) * live[..., None]
        error = (single - one_hot[gold] * live[..., None]) * count[:, None, None]
        grad_w = np.zeros_like(weights)
        np.add.at(grad_w, ids.reshape(-1, wide), error.reshape(-1, 1, 3))
        grad_w[0] = 0
        grad_t = np.einsum("na,nb->ab", np.tile(one_hot[O], (len(runs), 1)), error[:, 0])
        for j in range(1, scores.shape[1]):
            both = np.exp(np.clip(forward[:, j - 1, :, None] + t[None] + (scores[:, j] + backward[:, j])[:, None, :] - z[:, None, None], -700, 0))
            seen = one_hot[gold[:, j - 1]][:, :, None] * one_hot[gold[:, j]][:, None, :]
            grad_t += ((both - seen) * (count * live[:, j])[:, None, None]).sum(axis=0)
        ends = np.exp(np.clip(forward[np.arange(len(runs)), length - 1] + final - z[:, None], -700, 0)) - one_hot[gold[np.arange(len(runs)), length - 1]]
        grad_t[:, O] += (ends * count[:, None]).sum(axis=0)
        for p, g, (m, v) in zip(params, (grad_w, grad_t), moments, strict=True):
            g = g / count.sum() + ridge * p / len(runs)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    moves = params[1] + wall
    return Field({f: tuple(float(x) for x in params[0][k]) for f, k in names.items()}, tuple(tuple(float(x) for x in row) for row in moves))


SPANS = "array<struct<kind: string, start: bigint, end: bigint, value_start: bigint>>"


def spans_in(model: Field | None, text: Column) -> Column:
    @F.pandas_udf(SPANS)
    def secret_spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": s, "end": e, "value_start": v} for k, s, e, v in find_secrets(t, model)] for t in texts], dtype="object")

    return secret_spans(text.cast("string"))


def scan(docs: DataFrame, model: Field | None) -> DataFrame:
    """(doc_id, spans) of every document."""
    return docs.select("doc_id", spans_in(model, F.col("text")).alias("spans"))


def mask_secrets(docs: DataFrame, model: Field | None) -> DataFrame:
    """All documents with secrets masked in text; n_chars, where there is one, follows."""
    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t, model) for t in texts], dtype="object")

    clean = docs.withColumn("text", masked(docs["text"].cast("string")))
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def joined(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of these kinds, comma-joined."""
    some = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


