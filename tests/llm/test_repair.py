import hashlib
import random
import zlib

from pyspark.sql import types as T

from stratamart.llm import grammar, repair

CONV = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
BLANKS = " \t\n\v\f\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        mode = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if mode == 0:
            continue
        text = "" if mode == 1 else "".join(c for c in text if c not in ".!?") if mode == 2 else text
        out += [(conv, turn, "user" if mode == 4 else role, text)] * (2 if mode == 3 else 1)
    return out


def plain(rows):
    """Figures, audit and lines of one conversation by a table over rows and states, strings compared whole."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        solid = text.strip(BLANKS)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    go = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}

    def with_inserts(best):
        best = dict(best)
        for _ in range(4):
            for (initial, state), to in go.items():
                if initial in "ua" and state in best:
                    cost, audit, lines = best[state]
                    new = (cost + 5, audit + "I", [*lines, {"u": "user:", "a": "assistant:"}[initial]])
                    if to not in best or new < best[to]:
                        best[to] = new
        return best

    best = {0: (0, "", [])}
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        after = {}

        def offer(to, entry, after=after):
            if to not in after or entry < after[to]:
                after[to] = entry

        for state, (cost, audit, lines) in with_inserts(best).items():
            offer(state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 * (fault == "truncated")
            if (role[:1], state) in go:
                offer(go[role[:1], state], (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
            for new in ("user", "assistant"):
                if (new[0], state) in go:
                    offer(go[new[0], state], (cost + 1 + more, audit + "R", [*lines, f"{new}:{text}"]))
        best = after
    cost, audit, lines = min(v for k, v in with_inserts(best).items() if k in (0, 3))
    turns = [r[1] for r in rows if r[1] is not None]
    marks = [r[2][:1] for r in rows]
    return {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(marks, marks[1:], strict=False)), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}, lines


def wanted(rows):
    by = {r[0]: [] for r in rows}
    for r in damaged(rows):
        by[r[0]].append(r)
    return {c: plain(v)[0] for c, v in by.items()}


def got(spark, rows, parts=3):
    df = spark.createDataFrame(rows, CONV).repartition(parts)
    out = repair.digests(repair.repair(repair.damage(df)), repair.survivors(df)).collect()
    assert len({r["conv_id"] for r in out}) == len(out)
    return {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in out}


def talk(rng, conv, n, turns=None):
    words = ["Yes.", "No!", "So what?", "half a", "", " \n", None, "Then it was.", "a b c", "why"]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    weights = [8, 8, 2, 1, 0.3, 0.3, 0.3]
    return [(conv, (turns or (lambda k: k))(k), rng.choices(roles, weights)[0], rng.choice(words) if rng.random() < 0.5 else f"row {k}.") for k in range(n)]


def test_repairs_equal_a_plain_table(spark):
    rng = random.Random(3)
    rows = [r for conv in range(300) for r in talk(rng, conv, rng.randrange(1, 12))]
    rows += talk(rng, None, 6) + talk(rng, (1 << 60) + 1, 5) + talk(rng, (1 << 60) + 3, 5) + talk(rng, 7001, 9, lambda k: None if k < 3 else 3 * k)
    rows += talk(rng, 7002, 8, lambda k: None) + [(7003, -(1 << 62), "user", "a."), (7003, 1 << 62, "assistant", "b.")] + rows[:40]
    assert got(spark, rows) == wanted(rows)


def test_a_conversation_of_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(repair, "ROWS", 7)
    rng = random.Random(5)
    rows = talk(rng, 1, 900) + [r for conv in range(2, 60) for r in talk(rng, conv, rng.randrange(1, 9))]
    rows += [(99, 5, "user", "same."), *[(99, k, "user", "same.") for k in range(200)]] + [(100, 3, "user", "é. " * 3000)] * 30
    assert got(spark, rows, 8) == wanted(rows)
    df = spark.createDataFrame(rows, CONV)
    told = sorted(repair.messages(repair.repair(repair.damage(df))).where("conv_id = 1").collect(), key=lambda r: (r["part"], r["nr"]))
    assert [f"{r['role']}:{r['text']}" for r in told] == plain([r for r in damaged(rows) if r[0] == 1])[1]


def test_empty_table_and_other_columns(spark):
    assert got(spark, []) == {}
    df = spark.createDataFrame([(1, 0, "user", "a.", 3, 4, "x")], T.StructType([*CONV.fields, T.StructField("pid", T.IntegerType()), T.StructField("nr", T.IntegerType()), T.StructField("seq", T.StringType())]))
    assert repair.digests(repair.repair(repair.damage(df)), repair.survivors(df)).count() == 1


def test_rules_and_ropes():
    rng = random.Random(1)
    letters = repair.letters()
    sequence = "".join(rng.choice("suaoSUAObd") for _ in range(80))
    rules = ["ua", "au", chr(grammar.FIRST) + "b", "dd"]
    plain_, packed = grammar.Grammar(letters, []), grammar.Grammar(letters, rules)
    assert len(packed.compress(sequence * 3)) < 240
    for start in range(4):
        a, b = plain_.run(sequence * 3, start), packed.run(sequence * 3, start)
        assert [x and (x[0], str(x[1])) for x in a] == [x and (x[0], str(x[1])) for x in b]
    for _ in range(200):
        x, y = ("".join(rng.choice("DI") for _ in range(rng.randrange(1, 9))) for _ in range(2))
        assert (grammar.rope_of(x) < grammar.rope_of(y)) == (x < y)
    assert list(grammar.pairs_of("aaaab")) == ["aa", "aa", "ab"]
