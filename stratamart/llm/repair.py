"""Conversations whose roles alternate again, at the least cost, by a dynamic program over a grammar of their faults.

The rows of a conversation, by turn (NULLs first), then role and text, have a role class and a fault: blank, duplicate of an
earlier row, truncated, or none. Keep, Rerole, Delete and Insert turn them into ``(s?(ua)+)?``. Each row is a min-plus matrix
over the states of that pattern (nothing, system, user, assistant last). Re-Pair names frequent pairs of rows over all
conversations, and grammar.py has one matrix with an audit rope for each rule, which all conversations share.

Rows are range-sorted and cut into chunks of bounded size, so a conversation of any length is spread over tasks: its chunks
are matrices too, folded in order, and then each chunk is repaired by its own part of the edits. Equal rows of different
chunks are found by grouping them. Only the SHA-256 of a conversation, a serial function, sees all its text in one task, as a
stream.

Defined results: a NULL role or text is one space; a NULL conversation is one conversation; NULL turns come first and do not
count for gaps; a role that is empty or starts otherwise than s, u or a can only be changed or deleted. Equal rows are
duplicates of the first. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stratamart.llm.common import settle_at
from stratamart.llm.grammar import Entry, Grammar, Matrix, Rope, better, learn, product, rope_of, times

#: Rows and characters of a chunk, a last row beyond the characters included.
ROWS, CHARS = 512, 1 << 20
BLANKS = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: From a state (nothing, s, u, a last) by an initial to a state.
NEXT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
STATES, ENDS = 4, (0, 3)
FIGURES = "blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string"
MESSAGES = "messages array<struct<role:string,text:string>>"


def _none() -> Matrix:
    return [[None] * STATES for _ in range(STATES)]


def inserts() -> Matrix:
    """Any number of insertions, none included."""
    one, out = _none(), _none()
    for (initial, state), to in NEXT.items():
        if initial in "ua":
            one[state][to] = (INSERT, Rope("I"))
    for state in range(STATES):
        out[state][state] = (0, Rope(""))
    for _ in range(STATES):
        step = product(out, one)
        out = [[better(a, b) for a, b in zip(x, y, strict=True)] for x, y in zip(out, step, strict=True)]
    return out


def letters() -> dict[str, Matrix]:
    """Matrices of the rows: insertions, then the edit of a row. s u a o (other), capitals if truncated; b blank, d duplicate."""
    before, out = inserts(), {}
    for letter in "suaoSUAObd":
        m = _none()
        for state in range(STATES):
            m[state][state] = (DELETE, Rope("D"))
        if letter not in "bd":
            more = TRUNCATED * letter.isupper()
            for (initial, state), to in NEXT.items():
                if initial == letter.lower():
                    m[state][to] = better(m[state][to], (KEEP + more, Rope("K")))
                if initial in "ua":
                    m[state][to] = better(m[state][to], (REROLE + more, Rope("R")))
        out[letter] = product(before, m)
    return out


def initial_of(role: str) -> str:
    return role[0] if role[:1] in ("s", "u", "a") else "o"


def letter_of(role: str, text: str) -> str:
    """The letter of a row by itself, duplicates left aside."""
    solid = text.rstrip(BLANKS)
    if not solid:
        return "b"
    initial = initial_of(role)
    return initial if solid[-1] in ".!?" else initial.upper()


def edit(state: int, audit: str, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The messages that the edits leave of rows, from a state on."""
    out, at = [], 0
    for mark in audit:
        role, text = ("user" if state != 2 else "assistant"), ""
        if mark != "I":
            own, at = rows[at], at + 1
            if mark == "D":
                continue
            role, text = own if mark == "K" else (role, own[1])
        out.append((role, text))
        state = NEXT[initial_of(role), state]
    return out


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def _mode() -> Column:
    return F.crc32(F.concat(_blank("conv_id"), F.lit(":"), _blank("turn")).cast("binary")) % 20


def survivors(rows: DataFrame) -> DataFrame:
    """Every conversation, and whether damage() keeps a row of it."""
    return rows.groupBy("conv_id").agg(F.max(_mode() != 0).alias("kept"))


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as the contract of op12 spoils them; which ones follows from conversation and turn."""
    mode = _mode()
    text = F.when(mode == 1, "").when(mode == 2, F.regexp_replace(_blank("text"), "[.!?]", "")).otherwise(_blank("text"))
    copies = F.when(mode == 0, 0).when(mode == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", F.when(mode == 4, "user").otherwise(_blank("role")).alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(1), copies.cast("int"))).alias("copy")).drop("copy")


def _chunker(kind: pa.DataType):
    """Chunks out of the sorted rows of a partition."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, nr, first, conv, rows, size, cut = TaskContext.get().partitionId(), 0, True, None, [], 0, False

        def chunk(whole: bool) -> pa.RecordBatch:
            seen, marks, initials = set(), [], "".join(initial_of(r[1]) for r in rows)
            for _, role, text in rows:
                mark = letter_of(role, text)
                marks.append("d" if mark != "b" and (role, text) in seen else mark)
                seen.add((role, text))
            turns = [r[0] for r in rows if r[0] is not None]
            keys = [] if whole else [hashlib.blake2b(f"{len(r[1])}:{r[1]}{r[2]}".encode("utf-8", "replace"), digest_size=16).digest() for r in rows]
            illegal = sum(initials[k:k + 2] not in ("su", "ua", "au") for k in range(len(rows) - 1))
            return pa.RecordBatch.from_pydict({
                "pid": pa.array([pid], pa.int32()), "nr": pa.array([nr], pa.int32()), "conv_id": pa.array([conv], kind), "whole": [whole], "seq": ["".join(marks)],
                "ends": [initials[0] + initials[-1]], "illegal": pa.array([illegal], pa.int64()), "turns": pa.array([len(set(turns))], pa.int64()),
                "low": pa.array([turns[0] if turns else None], pa.int64()), "high": pa.array([turns[-1] if turns else None], pa.int64()),
                "keys": pa.array([keys], pa.list_(pa.binary())),
                "rows": pa.array([[{"role": r[1], "text": r[2]} for r in rows]], pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))})

        for batch in batches:
            for now, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True):
                if rows and now != conv:
                    yield chunk(whole=not first and not cut)
                    nr, rows, size, first, cut = nr + 1, [], 0, False, False
                elif rows and (len(rows) >= ROWS or size >= CHARS):
                    yield chunk(whole=False)
                    nr, rows, size, cut = nr + 1, [], 0, True
                conv = now
                rows.append((turn, role, text))
                size += len(text)
        if rows:
            yield chunk(whole=False)  # it may go on in the next range
    return build


def _chunks(rows: DataFrame) -> DataFrame:
    kind = rows.schema["conv_id"].dataType
    keyed = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    # equal rows may lie in several ranges: the last key tells them apart, and which is which does not matter
    order = [F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.sha2("text", 256), F.xxhash64(F.col("here"))]
    ranged = keyed.withColumn("here", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("here")
    made = ranged.mapInArrow(_chunker(to_arrow_type(kind)), f"""pid int, nr int, conv_id {kind.simpleString()}, whole boolean, seq string, ends string, illegal long, turns long, low long, high long,
        keys array<binary>, rows array<struct<role:string,text:string>>""")
    return settle_at(made, "chunks")[0]


def _marked(cut: DataFrame) -> DataFrame:
    """Chunks of conversations that may have several, with the duplicates of other chunks marked."""
    one = cut.select("pid", "nr", "conv_id", F.posexplode("keys").alias("pos", "key"))
    firsts = one.groupBy("conv_id", "key").agg(F.min(F.struct("pid", "nr", "pos")).alias("at")).groupBy("at.pid", "at.nr").agg(F.collect_set("at.pos").alias("firsts"))
    letter = lambda i: F.substring("seq", i + 1, F.lit(1))
    mark = F.transform(F.sequence(F.lit(0), F.length("seq") - 1), lambda i: F.when((letter(i) == "b") | F.array_contains("firsts", i), letter(i)).otherwise("d"))
    return cut.join(firsts.withColumnsRenamed({"pid": "f_pid", "nr": "f_nr"}), (F.col("pid") == F.col("f_pid")) & (F.col("nr") == F.col("f_nr")), "left").withColumn(
        "firsts", F.coalesce("firsts", F.array().cast("array<int>"))).withColumn("seq", F.array_join(mark, "")).drop("f_pid", "f_nr", "firsts")


def _counts(seq: str) -> list[int]:
    return [seq.count("b"), seq.count("d"), sum(c in "SUAO" for c in seq)]


def _span(low: int | None, high: int | None, turns: int) -> int:
    return min(high - low + 1 - turns, (1 << 63) - 1) if turns else 0


def _out(columns: dict[str, list], schema: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in schema.items()], names=list(schema))


def _whole_repairer(grammar: Grammar, kind: pa.DataType):
    """Conversations that are one chunk: figures and messages."""
    schema = {"conv_id": kind, **{c: pa.int64() for c in ("blank", "duplicate", "truncated", "illegal", "gaps", "cost")}, "audit": pa.string(),
              "messages": pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))}

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = inserts()
        for batch in batches:
            out: dict[str, list] = {c: [] for c in schema}
            for r in batch.to_pylist():
                end = times(grammar.run(r["seq"], 0), last)
                cost, rope = better(*(end[k] for k in ENDS))
                audit = str(rope)
                messages = [{"role": a, "text": b} for a, b in edit(0, audit, [(x["role"], x["text"]) for x in r["rows"]])]
                for c, v in zip(schema, (r["conv_id"], *_counts(r["seq"]), r["illegal"], _span(r["low"], r["high"], r["turns"]), cost, audit, messages), strict=True):
                    out[c].append(v)
            yield _out(out, schema)
    return repair


def _transfers(grammar: Grammar):
    """The matrix of a chunk: costs and audits, row by row, -1 where there is no way."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[e for start in range(STATES) for e in grammar.run(seq, start)] for seq in batch.column("seq").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("pid", "nr", "conv_id", "seq", "ends", "illegal", "turns", "low", "high")),
                pa.array([[-1 if e is None else e[0] for e in m] for m in found], pa.list_(pa.int64())),
                pa.array([["" if e is None else str(e[1]) for e in m] for m in found], pa.list_(pa.string()))],
                names=["pid", "nr", "conv_id", "seq", "ends", "illegal", "turns", "low", "high", "costs", "audits"])
    return make


class _Path(NamedTuple):
    """The best way to a state after some chunks: cost, its audit as a rope, and the steps back."""

    cost: int
    audit: Rope
    before: _Path | None
    state: int  # in which the last chunk was entered
    piece: str


def _folder(kind: pa.DataType):
    """Chunks in order to one row a conversation (pid -1) and one row a chunk with its share of the edits."""
    schema = {"head": pa.int64(), "pid": pa.int32(), "nr": pa.int32(), "state": pa.int32(), "piece": pa.string(), "conv_id": kind,
              **{c: pa.int64() for c in ("blank", "duplicate", "truncated", "illegal", "gaps", "cost")}, "audit": pa.string()}

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        closing = [["" if e is None else str(e[1]) for e in row] for row in inserts()], [[-1 if e is None else e[0] for e in row] for row in inserts()]
        state: dict = {}

        def step(paths: list[_Path | None], costs: list[list[int]], audits: list[list[str]]) -> list[_Path | None]:
            out: list[_Path | None] = [None] * STATES
            ropes: dict[str, Rope] = {}
            for i, path in enumerate(paths):
                for j in range(STATES if path else 0):
                    if costs[i][j] < 0 or out[j] and out[j].cost < path.cost + costs[i][j]:
                        continue
                    piece = audits[i][j]
                    rope = path.audit + ropes.setdefault(piece, rope_of(piece))
                    new = _Path(path.cost + costs[i][j], rope, path, i, piece)
                    if out[j] is None or (new.cost, new.audit) < (out[j].cost, out[j].audit):
                        out[j] = new
            return out

        def finish() -> pa.RecordBatch:
            s = state
            ends = [p for k, p in enumerate(step(s["paths"], closing[1], closing[0])) if k in ENDS and p]
            best = min(ends, key=lambda p: (p.cost, p.audit))
            rows: dict[str, list] = {c: [] for c in schema}
            figures = [s["blank"], s["duplicate"], s["truncated"], s["illegal"], _span(s["low"], s["high"], s["turns"]), best.cost, str(best.audit)]
            for c, v in zip(schema, (s["head"], -1, -1, None, None, s["conv"], *figures), strict=True):
                rows[c].append(v)
            tail, path = best.piece, best.before
            for pid, nr in reversed(s["chunks"]):
                for c, v in zip(schema, (s["head"], pid, nr, path.state, path.piece + tail, s["conv"], *[None] * 7), strict=True):
                    rows[c].append(v)
                tail, path = "", path.before
            return _out(rows, schema)

        for batch in batches:
            for r in batch.to_pylist():
                if not state or r["conv_id"] != state["conv"]:
                    if state:
                        yield finish()
                    state = {"conv": r["conv_id"], "head": (r["pid"] << 32) + r["nr"], "chunks": [], "paths": [_Path(0, Rope(""), None, 0, ""), None, None, None],
                             "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "low": None, "high": None, "end": ""}
                s = state
                for c, v in zip(("blank", "duplicate", "truncated"), _counts(r["seq"]), strict=True):
                    s[c] += v
                s["illegal"] += r["illegal"] + (bool(s["end"]) and s["end"] + r["ends"][0] not in ("su", "ua", "au"))
                s["turns"] += r["turns"] - (r["low"] is not None and r["low"] == s["high"])
                s["low"] = r["low"] if s["low"] is None else s["low"]
                s["high"] = s["high"] if r["high"] is None else r["high"]
                s["end"] = r["ends"][-1]
                s["chunks"].append((r["pid"], r["nr"]))
                square = lambda flat: [flat[k:k + STATES] for k in range(0, STATES * STATES, STATES)]
                s["paths"] = step(s["paths"], square(r["costs"]), square(r["audits"]))
        if state:
            yield finish()
    return fold


def _editor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [[{"role": a, "text": b} for a, b in edit(r["state"], r["piece"], [(x["role"], x["text"]) for x in r["rows"]])] for r in batch.select(["state", "piece", "rows"]).to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("head", "pid", "nr", "conv_id")), pa.array(made, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))],
                                         names=["head", "pid", "nr", "conv_id", "messages"])


class Repaired(NamedTuple):
    """whole: conversations in one chunk, figures and messages; cut: the figures of the others; pieces: their messages by chunk."""

    whole: DataFrame
    cut: DataFrame
    pieces: DataFrame


def repair(rows: DataFrame) -> Repaired:
    """Least-cost repairs of the conversations in rows (conv_id, turn, role, text); see the module."""
    chunks = _chunks(rows)
    kind = rows.schema["conv_id"].dataType.simpleString()
    arrow = to_arrow_type(rows.schema["conv_id"].dataType)
    whole = chunks.where("whole")
    cut, _ = settle_at(_marked(chunks.where("NOT whole").drop("rows")), "cut")
    sequences, _ = settle_at(whole.select("seq").unionByName(cut.select("seq")).groupBy("seq").agg(F.count("*").alias("n")), "sequences")
    grammar = Grammar(letters(), learn(sequences))

    done = whole.select("conv_id", "seq", "illegal", "turns", "low", "high", "rows").mapInArrow(_whole_repairer(grammar, arrow), f"conv_id {kind}, {FIGURES}, {MESSAGES}")
    slim = cut.select("pid", "nr", "conv_id", "seq", "ends", "illegal", "turns", "low", "high")
    moved = slim.mapInArrow(_transfers(grammar), f"pid int, nr int, conv_id {kind}, seq string, ends string, illegal long, turns long, low long, high long, costs array<long>, audits array<string>")
    folded, _ = settle_at(moved.repartition("conv_id").sortWithinPartitions("conv_id", "pid", "nr").mapInArrow(
        _folder(arrow), f"head long, pid int, nr int, state int, piece string, conv_id {kind}, {FIGURES}"), "folded")
    parts = folded.where("pid >= 0").select("head", "pid", "nr", "state", "piece")
    edited = chunks.where("NOT whole").select("pid", "nr", "conv_id", "rows").join(parts, ["pid", "nr"]).mapInArrow(_editor, f"head long, pid int, nr int, conv_id {kind}, {MESSAGES}")
    return Repaired(done, folded.where("pid < 0").drop("pid", "nr", "state", "piece"), edited)


def lines(messages: Column) -> Column:
    return F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["text"]))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, digest, some = None, None, False

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"d_head": pa.array([now], pa.int64()), "repaired_sha256": [digest.hexdigest()]})

    for batch in batches:
        for head, body in zip(batch.column("head").to_pylist(), batch.column("body"), strict=True):
            if head != now:
                if now is not None:
                    yield out()
                now, digest, some = head, hashlib.sha256(), False
            text = body.as_py()
            if text is not None:
                digest.update((b"\n" if some else b"") + text.encode("utf-8"))
                some = True
    if now is not None:
        yield out()


def digests(repaired: Repaired, originals: DataFrame) -> DataFrame:
    """A row for every conversation of the originals: figures, audit and the SHA-256 of its repaired lines."""
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    joined = F.array_join(lines(F.col("messages")), "\n")
    whole = repaired.whole.select("conv_id", *figures, F.sha2(joined, 256).alias("repaired_sha256"))
    body = F.when(F.size("messages") > 0, joined).alias("body")
    hashed = repaired.pieces.select("head", "pid", "nr", body).repartition("head").sortWithinPartitions("head", "pid", "nr").select("head", "body").mapInArrow(_digests, "d_head long, repaired_sha256 string")
    cut = repaired.cut.join(hashed, F.col("head") == F.col("d_head")).select("conv_id", *figures, "repaired_sha256")
    gone = originals.where("NOT kept").select("conv_id", *(F.lit(0).cast("long").alias(c) for c in figures[:-1]), F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256"))
    return whole.unionByName(cut).unionByName(gone)


def messages(repaired: Repaired) -> DataFrame:
    """All repaired messages: conv_id, part and nr give their order."""
    whole = repaired.whole.select("conv_id", F.lit(0).cast("long").alias("part"), F.posexplode("messages").alias("nr", "m"))
    cut = repaired.pieces.select("conv_id", (F.col("pid").cast("long") * (1 << 32) + F.col("nr")).alias("part"), F.posexplode("messages").alias("nr", "m"))
    return whole.unionByName(cut).select("conv_id", "part", "nr", "m.role", "m.text")
