import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratamart.llm import lm
from stratamart.llm.common import fold_of, words_of


def texts(n):
    """Words of two languages that do not mix: context tells the next word."""
    rnd = random.Random(1)
    words = [[f"{p}{k}" for k in range(60)] for p in ("a", "b")]
    return [(k, " ".join(rnd.choices(words[k % 2], weights=[1 / (j + 1) for j in range(60)], k=80))) for k in range(n)]


def test_base_counts_and_held_out_gain(spark, frame, monkeypatch):
    monkeypatch.setattr(lm, "SHORTLIST", 40)
    monkeypatch.setattr(lm, "HEAD", 60)
    rows = [*texts(600), (1001, None), (1002, ""), (None, "A a B"), (1003, "never seen words"), (1003, "never seen words"), (1004, "Tab\tand\x0bmore " * 3000)]
    docs = frame(rows)
    counts, _ = lm.settle_at(lm.count_tokens(docs.filter(fold_of(F.col("doc_id"), 10) != 0)), "counts")
    totals = lm.read_counts(counts, 60)
    held = fold_of(F.col("doc_id"), 10) == 0
    got = lm.score(docs, counts, totals, lm.train(docs.filter(~held), totals), held).collect()
    fold = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    tokens = lambda t: [*(t or "").lower().split(), "\n"]
    c = Counter(w for i, t in rows if not fold(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), fold(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, round(sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in tokens(t)), 6)) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    ours = [r for r in got if r["held_out"] and r["n_tokens"] == 81]
    assert sum(r["score"] for r in ours) > 0.97 * sum(r["base_score"] for r in ours)  # log probabilities: closer to 0
    assert len({round(r["score"], 9) for r in got if r["doc_id"] == 1003}) == 1


def test_classes_are_normalised():
    totals = lm.Counts(1000, 30, {f"w{k}".encode(): 40 - k for k in range(20)})
    model = lm.start_model(totals)
    trainer = lm.Trainer(model)
    rng = np.random.default_rng(0)
    for _ in range(20):
        trainer.step(*rng.integers(0, model.classes, (3, 64)))
    text = model.ids([b"w1", b"w2", b"other"])
    start = model.classes
    a, b, z = model.tables()
    for far, near in ((start, start), (start, text[0]), (text[0], text[1])):
        assert np.exp(a[near] + b[far] - z[near, far]).sum() == pytest.approx(1, abs=1e-4)
    logits = model.context[text[1]] * model.near + model.context[text[0]] * model.far
    scores = logits @ model.target.T + model.bias
    assert model.log_probabilities(text)[2] == pytest.approx(scores[text[2]] - np.log(np.exp(scores).sum()), abs=1e-4)


def test_words_outside_the_shortlist_are_learnt(spark, frame, monkeypatch):
    """Every word has a distribution of its own given the class before it, whether its count is with the tasks or joined."""
    monkeypatch.setattr(lm, "SHORTLIST", 3)
    rnd = random.Random(2)
    rows = [(k, " ".join(f"{side} {side[0]}{rnd.randrange(60)}end" for side in rnd.choices(["left", "right"], k=40))) for k in range(200)]
    docs, none = frame([*rows, (1000, "left l7end"), (1001, "left r7end"), (1002, "left neverend")]), F.col("doc_id") >= 1000
    training = docs.filter(~none)
    counts, _ = lm.settle_at(lm.count_tokens(training), "counts")
    for head in (100_000, 30):
        totals = lm.read_counts(counts, head)
        model = lm.train(training, totals)
        words, learnt = lm.learn_words(training, totals, model)
        rows_of = learnt.toPandas()
        assert len(rows_of) == totals.distinct - len(totals.shortlist) >= 118
        s, b = words.vectors(rows_of["c"].to_numpy(), lm.unpack(rows_of["c"].to_numpy(), rows_of["packed"].tolist(), words.before), rows_of["g"].to_numpy())
        total = np.exp(s @ words.before.T + b[:, None] - words.log_z[rows_of["g"]]).sum(axis=0) + np.exp(math.log(lm.SMOOTH) - words.log_z).sum(axis=0)
        assert total == pytest.approx(np.full(len(words.before), model.groups), abs=1e-4)  # one for each class
        got = {r["doc_id"]: r["score"] for r in lm.score(docs, counts, totals, model, none).filter(none).collect()}
        assert got[1000] > got[1001] + 0.5 and got[1000] > got[1002]


def test_groups_follow_the_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHORTLIST", 5)
    sizes = []
    for n in (300, 30_000):
        counts = spark.createDataFrame([(f"é{k}", 1 + 900 // (k + 1)) for k in range(n)], "token string, c long")
        totals = lm.read_counts(counts)
        assert sum(totals.groups) == totals.class_size()[0]
        got = {r["token"]: r["g"] for r in counts.select("token", lm.group_column(F.col("token"), len(totals.groups)).alias("g")).collect()}
        assert got == {w: lm.group_of(w.encode(), len(totals.groups)) for w in got}
        sizes.append(len(totals.groups))
    assert sizes[1] > 5 * sizes[0]


def test_edges(spark, frame):
    assert lm.score_all(frame([]), fold_of(F.col("doc_id"), 10) == 0).count() == 0
    got = lm.score_all(frame([(1, "a b"), (2, None)]), F.lit(True)).collect()  # nothing to learn from
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] == pytest.approx(0, abs=1e-6) for r in got)


def test_a_step_is_that_of_the_whole_tables():
    """Rows that a batch does not meet stay as they are, and the others move as if all were summed up."""
    totals = lm.Counts(1000, 300, {f"w{k}".encode(): 40 - k for k in range(20)}, tuple([9] * 300))
    rows, sums = lm._row_sums(np.array([3, 1, 3, 0]), np.array([[1., 2], [3, 4], [5, 6], [7, 8]]))
    assert rows.tolist() == [0, 1, 3] and sums.tolist() == [[7, 8], [3, 4], [6, 8]]
    trainer, rng = lm.Trainer(lm.start_model(totals)), np.random.default_rng(3)
    for _ in range(5):
        far, near, target = rng.integers(0, trainer.m.classes, (3, 64))
        old, memory, noise_rng = [p.astype(np.float64) for p in trainer.params], [x.astype(np.float64) for x in trainer.memory], np.random.default_rng()
        noise_rng.bit_generator.state = trainer.rng.bit_generator.state
        noise = np.minimum(np.searchsorted(trainer.edges, noise_rng.random(lm.NOISE)), trainer.m.classes - 1)
        context, out, bias, a, b = old
        q = context[near] * a + context[far] * b
        up = -1 / (1 + np.exp((q * out[target]).sum(axis=1) + bias[target] - trainer.noise_log[target] - np.log(lm.NOISE)))
        down = 1 / (1 + np.exp(-(q @ out[noise].T + bias[noise] - trainer.noise_log[noise] - np.log(lm.NOISE))))
        dq = up[:, None] * out[target] + down @ out[noise]
        grads = [np.zeros_like(p) for p in old]
        for k, at, g in ((0, near, dq * a), (0, far, dq * b), (1, target, up[:, None] * q), (1, noise, down.T @ q), (2, target, up), (2, noise, down.sum(axis=0))):
            np.add.at(grads[k], at, g)
        grads[3], grads[4] = (dq * context[near]).sum(axis=0), (dq * context[far]).sum(axis=0)
        trainer.step(far, near, target)
        for p, was, g, x, now in zip(trainer.params, old, grads, memory, trainer.memory, strict=True):
            g = g / len(target)
            x = x + g * g
            assert now == pytest.approx(x, rel=1e-3, abs=1e-9) and p == pytest.approx(was - lm.RATE * g / np.sqrt(x), rel=1e-3, abs=1e-5)


def test_tokens_of_a_batch_are_those_of_its_texts():
    rnd = random.Random(4)
    signs = ["a", "B", "é", "İ", "word", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x00", "\x1c", "\x1f", "\x85", "\u2003", "\U0001f600"]
    for given in ([None, "", "  ", " a  b ", "A a"], ["one"], [None], [], ["".join(rnd.choices(signs, k=rnd.randrange(30))) for _ in range(3000)]):
        names, at, ends = lm.tokens_in(pa.array(given, pa.string()))
        want = [[*words_of(t), b"\n"] for t in given]
        got = [names[k].as_py().encode() for k in at.tolist()]
        assert got == [w for words in want for w in words] and ends.tolist() == np.cumsum([len(words) for words in want]).tolist()
        assert len(names) == len(set(got))


def test_endings_are_classed_once(monkeypatch):
    """The work on words follows the distinct endings of a batch, not its words."""
    model = lm.start_model(lm.Counts(1000, 300, {f"w{k}".encode(): 40 - k for k in range(20)}, tuple([9] * 30)))
    words, calls, group_of = [f"{k}end".encode() for k in range(500)] + [b"w3", "né".encode()], [], lm.group_of
    want = [*(20 + group_of(w, 30) for w in words[:500]), 3, 20 + group_of(words[-1], 30)]
    monkeypatch.setattr(lm, "group_of", lambda w, groups: calls.append(w) or group_of(w, groups))
    assert model.ids(words).tolist() == want and len(calls) == 2


def test_words_of_all_counts_are_learnt_over_tasks(spark, frame, monkeypatch):
    """Words met once to 300 times: their sums are those of the whole text, and each class is normalised over all of them."""
    monkeypatch.setattr(lm, "SHORTLIST", 2)
    rnd = random.Random(6)
    often = [f"x{k}" for k, n in enumerate((1, 2, lm.FEW, lm.FEW + 1, 100, 300)) for _ in range(n)] + [f"once{k}x" for k in range(900)]
    rnd.shuffle(often)
    pairs = [f"{rnd.choice(['left', 'right'])} {w}" for w in often]
    rows = [(k, " ".join(pairs[k::40])) for k in range(40)]
    docs = frame(rows, 4)
    counts, _ = lm.settle_at(lm.count_tokens(docs), "counts")
    totals = lm.read_counts(counts)
    model = lm.train(docs, totals)
    words, learnt = lm.learn_words(docs, totals, model)
    got = learnt.toPandas()
    sums = lm.unpack(got["c"].to_numpy(), got["packed"].tolist(), words.before)
    want = {}
    for _, text in rows:
        tokens = [*words_of(text), b"\n"]
        ids = model.ids(tokens)
        for before, at, token in zip([model.classes, *ids[:-1]], ids, tokens, strict=True):
            if at >= 2:
                c, total = want.get(token, (0, 0))
                want[token] = c + 1, total + words.before[before]
    assert {w.encode(): c for w, c in zip(got["token"], got["c"], strict=True)} == {w: c for w, (c, _) in want.items()} and got["c"].max() == 300
    assert sums == pytest.approx(np.array([want[w.encode()][1] for w in got["token"]]), abs=1e-2, rel=1e-4)
    s, b = words.vectors(got["c"].to_numpy(), sums, got["g"].to_numpy())
    total = np.exp(s @ words.before.T + b[:, None] - words.log_z[got["g"]]).sum(axis=0) + np.exp(math.log(lm.SMOOTH) - words.log_z).sum(axis=0)
    assert total == pytest.approx(np.full(len(words.before), model.groups), abs=1e-3)


def test_words_that_are_sure_to_follow_a_class_stay_finite(spark, frame, monkeypatch):
    """Logits beyond the range of exp() neither make a normaliser infinite nor take the words beside them along."""
    monkeypatch.setattr(lm, "SHORTLIST", 3)
    vectors = lm.before_vectors
    monkeypatch.setattr(lm, "before_vectors", lambda *given: 40 * vectors(*given))
    rnd = random.Random(7)
    docs = frame([(k, " ".join(f"{side} {side[0]}{rnd.randrange(40)}end {side}{rnd.randrange(2000)}" for side in rnd.choices(["left", "right"], k=30))) for k in range(100)])
    counts, _ = lm.settle_at(lm.count_tokens(docs), "counts")
    totals = lm.read_counts(counts)
    words, learnt = lm.learn_words(docs, totals, lm.train(docs, totals))
    got = learnt.toPandas()
    s, b = words.vectors(got["c"].to_numpy(), lm.unpack(got["c"].to_numpy(), got["packed"].tolist(), words.before), got["g"].to_numpy())
    logits = s.astype(np.float64) @ words.before.T.astype(np.float64) + b[:, None]
    assert logits.max() > 1000
    for g in range(len(words.log_z)):
        assert words.log_z[g] == pytest.approx(np.logaddexp(math.log(lm.SMOOTH), np.logaddexp.reduce(logits[got["g"] == g], axis=0)), rel=1e-4, abs=1e-3)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in lm.score_all(docs, fold_of(F.col("doc_id"), 10) == 0).collect())
