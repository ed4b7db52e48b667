import random

import pytest
from pyspark.sql import functions as F

from stratamart.llm import toxicity as X


def test_folding():
    assert X.fold("You 1D10T, Mor0n! réeux @nd") == " you idiot moron reeux @nd ".replace("@nd", "nd")
    assert X.fold("idіоt ​mo​ron l@me") == " idiot moron lame "
    assert X.fold(None) == X.fold("") == " "


def test_matching_prefers_exceptions_and_neighbours():
    lexicon = X.Lexicon({" trash ": 4.0, " moron ": 4.0, " lowei": 3.0}, ("trash can",), (-3.0, 2.0, 1.0))
    assert [e for _, e, _ in lexicon.matches(X.fold("trash moron lowe loweien"))] == [" trash ", " moron ", " lowei"]
    assert lexicon.evidence("the trash can is full") == (0.0, 0.0)
    assert lexicon.score("moron " * 3) > lexicon.score("moron" + " word" * 500) > lexicon.score("word " * 500)
    assert lexicon.score(None) == lexicon.score("") < 0.1


@pytest.fixture
def labelled(spark, frame):
    rnd = random.Random(2)
    bad, plain = ["idiot", "moron", "scum"], [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    rows, labels = [], []
    for k in range(900):
        words = rnd.choices(plain, k=rnd.choice([5, 30, 80]))
        toxic = k % 6 == 0
        if toxic:
            for _ in range(1 + len(words) // 20):
                words[rnd.randrange(len(words))] = rnd.choice(bad) if k % 12 else rnd.choice(["bestiola", "bestione"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return frame(rows), spark.createDataFrame([*labels, (5000, 1), (None, 1), (3, None)], "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy(spark, labelled):
    docs, labels, truth = labelled
    lexicon = X.fit(docs, labels, F.col("doc_id") % 3 != 1)
    assert " idiot " in lexicon.weights and len(lexicon.weights) < 30
    got = {r["doc_id"]: r["score"] for r in X.score(docs, lexicon).collect()}
    held = [k for k in truth if k % 3 == 1]
    assert sum((got[k] >= X.THRESHOLD) == bool(truth[k]) for k in held) >= 0.98 * len(held)
    clash = docs.withColumn("score", F.lit("theirs"))
    kept = X.reject_toxic(clash, lexicon)
    assert kept.columns == clash.columns and 700 < kept.count() < 800


def test_edges(spark, frame, labelled):
    docs, labels, _ = labelled
    none = X.fit(frame([]), labels, F.lit(True))
    assert [r["score"] for r in X.score(frame([(1, None), (2, ""), (None, "x " * 50_000)]), none).collect()] == [X.PRIOR] * 3
    assert X.fit(docs, labels.filter("toxic = 0"), F.lit(True)).weights == {}
    assert X.score(frame([]), none).count() == 0
