import time
from stratamart.llm import quoting as Q

SCHEMA = "thread long, ordinal long, role string, text string"


def test_links_and_order(spark):
    rows = [
        (1, 0, "a", "How are you?\nTell me."), (1, 1, "b", "On Monday, a wrote:\n> How   are YOU?\n> Tell me.\n\nFine."), (1, 2, "a", "> > How are you?\n> > Tell me.\n>\n> Fine.\n\nGood."),
        (1, 3, "c", ">Tell me.\nWhat?"), (1, 4, "d", "> never said\nHuh"), (2, 0, "a", None), (2, 1, "b", "> How are you?\n> Tell me.\nother thread"), (None, None, "a", "> x"), (1, 3, "c", ">Tell me.\nWhat?"),
        (3, 0, "a", "> itself\nitself"), (3, 1, "b", "q" * 50_000), (3, 2, "b", ">" + "q" * 50_000)]
    got = {(r["thread"], r["ordinal"]): r for r in Q.conversations(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as parent", "2 as q_body")).collect()}
    tell = {k: (r["text"], r["parent"], r["root"], r["depth"], r["n_quotes"], r["n_linked"]) for k, r in got.items()}
    assert tell[1, 0] == ("How are you?\nTell me.", None, 0, 0, 0, 0)
    assert tell[1, 1] == ("Fine.", 0, 0, 1, 1, 1)
    assert tell[1, 2] == ("Good.", 1, 0, 2, 2, 2)
    assert tell[1, 3] == ("What?", 0, 0, 1, 1, 1)
    assert tell[1, 4] == ("Huh", None, 4, 0, 1, 0)
    assert tell[2, 0] == ("", None, 0, 0, 0, 0) and tell[2, 1][1] is None
    assert tell[None, None] == ("", None, None, 0, 1, 0)
    assert tell[3, 0][1] is None and tell[3, 2][1] == 1
    places = sorted((r["ordinal"], r["position"]) for r in Q.conversations(spark.createDataFrame(rows, SCHEMA)).collect() if r["thread"] == 1 and r["root"] == 0)
    assert places == [(0, 0), (1, 1), (2, 2), (3, 3), (3, 4)]
    assert Q.conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_long_chain_in_one_thread(spark):
    rows = [(1, k, "a", (f"> say {k - 1}\n" if k else "") + f"say {k}") for k in range(300)]
    got = Q.conversations(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r["ordinal"], r["depth"], r["root"], r["position"]) for r in got.collect()) == [(k, k, 0, k) for k in range(300)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_a_long_message_takes_time_in_proportion(spark):
    """Alternating levels make every line a run; four times the lines take at most some eight times as long, start-up aside."""
    def took(n):
        rows = [(1, 0, "user", "first words"), (1, 1, "user", "\n".join("> first words" if k % 2 else f"own {k}" for k in range(n)))]
        df = spark.createDataFrame(rows, "thread long, ordinal long, role string, text string")
        begin = time.perf_counter()
        assert Q.parse(df).selectExpr("max(size(q_runs)) AS n").head()["n"] == n
        return time.perf_counter() - begin
    took(100)
    assert took(32_000) < 8 * took(8_000) + 2
