import random
import re
from collections import Counter

from stratamart.llm import quality as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def test_figures_equal_brute_force():
    rnd = random.Random(4)
    texts = [None, "", " \n\t ", "a b c", "a b c a b c", "é ü é ü x\x0by z", "l1\n\nl1\n \n \nl1"] + [
        "".join(rnd.choice(["ab", "c", " ", " ", "\n", "#", "é", "A!", "a b c "]) for _ in range(rnd.randrange(400))) for _ in range(200)]
    for t in texts:
        assert Q.figures(t)[:5] == brute(t), t


def test_ledger_policies_and_ablations(spark, frame):
    good = " ".join(f"word{k}" for k in range(80))
    rows = [(1, good), (2, "too short"), (3, None), (4, "same line here\n" * 40), (5, good.replace(" ", " ### ")), (6, good.upper()), (None, good), (1, good), (7, " ".join(f"w{k}!!" for k in range(60)))]
    book = Q.ledger(frame(rows)).cache()
    assert book.count() == len(rows)
    kept = sorted(str(r["doc_id"]) for r in book.filter(Q.passes("prose-1")).collect())
    assert kept == ["1", "1", "None"]
    bits = {r["doc_id"]: r["failed"] for r in book.collect()}
    assert bits[3] & Q.BIT["too_few_words"] and bits[6] == Q.BIT["capitals"] and bits[7] == Q.BIT["exclaims"]
    mask = Q.POLICIES["prose-1"]
    got = {r["rule"]: (r["failing"], r["only_this"], r["kept_without"]) for r in Q.ablations(book, "prose-1").collect()}
    rows = [r["failed"] & mask for r in book.collect()]
    for rule, (failing, only, without) in got.items():
        b = Q.BIT[rule]
        assert (failing, only, without) == (sum(bool(f & b) for f in rows), sum(f == b for f in rows), sum(f & ~b == 0 for f in rows))
    assert Q.ledger(frame([])).count() == 0
