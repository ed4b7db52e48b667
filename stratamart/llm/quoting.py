"""Conversations out of messages that quote each other, in DataFrame operations only.

A message (thread, ordinal, role, text) is cut into passages: runs of lines of one quote level, where the level is the
number of leading > signs. Quoted passages, white space and case apart, are hashed and joined to the message of the thread
that first wrote them as its own words; a quote of some lines of a message is found by its lines. The message that a
reply quotes at its lowest level is its parent, and following the parents gives each message its conversation, its depth
and its place. Quotes and the lines that introduce them are left out of the text.

One thread may hold any share of the messages: an original is one row per (thread, hash), so no join multiplies; parents
are followed by doubling; places come from range sorts.

Edge cases, all defined: NULL and blank texts quote nothing and have an empty text; a quote without an original leaves the
message without that link; a message never replies to itself or to a later one; rows of equal thread and ordinal share
parent and depth, and their places follow their text; a NULL thread or ordinal counts as a thread or as the first place of
its own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import free, settle_at
from stratamart.llm.ranges import prefix_sums

MARKS = r"^((?:[ \t]*>)+)[ \t]?"
INTRODUCTION = r"(?i)^[ \t]*(on\b.*|[^>]{1,80}) (wrote|writes|said):[ \t\r]*$"


def bound(df: DataFrame, name: str, value: Column) -> DataFrame:
    """df with a column that is evaluated once: behind a generator, expressions that use it do not repeat it."""
    return df.withColumn(name, F.explode(F.array(value)))


def lines_of(text: Column) -> Column:
    """Array of (level, line), without marks."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", "")).alias("level"), F.regexp_replace(line, MARKS, "").alias("line")))


def without_introductions(lines: Column) -> Column:
    """The lines but those that introduce a quote: an introduction stands right above a line of a deeper level."""
    return F.filter(F.transform(lines, lambda x, k: F.struct(x["level"].alias("level"), x["line"].alias("line"),
                                                            (x["line"].rlike(INTRODUCTION) & (F.get(lines, k + 1)["level"] > x["level"])).alias("intro"))),
                    lambda x: ~F.coalesce(x["intro"], F.lit(False)))


def starts_of(lines: Column) -> Column:
    """Where the runs of equal level begin in an array of lines."""
    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(lines) - 1, F.lit(0))), lambda k: (k == 0) | (F.get(lines, k - 1)["level"] != F.get(lines, k)["level"]))


def runs_of(lines: Column, starts: Column) -> Column:
    """The runs of equal level; each line is copied once."""
    return F.transform(starts, lambda s, j: F.struct(
        F.get(lines, s)["level"].alias("level"),
        F.transform(F.slice(lines, s + 1, F.coalesce(F.get(starts, j + 1), F.size(lines)) - s), lambda x: x["line"]).alias("lines")))


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def digest(text: Column) -> Column:
    """Hash of a normalised passage; NULL for a blank one."""
    plain = normal(text)
    return F.when(F.length(plain) > 0, F.md5(plain.cast("binary")))


def parse(messages: DataFrame) -> DataFrame:
    """Messages with q_runs (level, hash of the run, hashes of its lines) and q_body, the text without quotes."""
    rows = messages.select(F.col("thread"), F.col("ordinal"), F.col("role"), F.col("text").cast("string").alias("text"))
    rows = bound(rows, "q_all", lines_of(F.col("text")))
    rows = bound(rows, "q_lines", without_introductions(F.col("q_all")))
    rows = bound(rows, "q_starts", starts_of(F.col("q_lines")))
    rows = bound(rows, "q_cut", runs_of(F.col("q_lines"), F.col("q_starts")))
    body = F.trim(F.regexp_replace(F.array_join(F.transform(F.filter("q_lines", lambda x: x["level"] == 0), lambda x: x["line"]), "\n"), r"^\s+|\s+$", ""))
    runs = F.transform("q_cut", lambda r: F.struct(r["level"].alias("level"), digest(F.array_join(r["lines"], "\n")).alias("whole"),
                                                   F.array_distinct(F.filter(F.transform(r["lines"], lambda x: digest(x)), lambda h: h.isNotNull())).alias("each")))
    key = F.coalesce(F.concat(F.lit("t"), F.col("thread").cast("string")), F.lit("n"))
    return rows.select("thread", "ordinal", "role", key.alias("q_thread"), F.coalesce(F.col("ordinal").cast("long"), F.lit(-1)).alias("q_ordinal"), body.alias("q_body"),
                       F.filter(runs, lambda r: r["whole"].isNotNull()).alias("q_runs"))


def links(parsed: DataFrame) -> DataFrame:
    """(q_thread, q_ordinal, parent, n_linked): the message that each reply quotes, and how many quoted passages have an original."""
    own = parsed.select("q_thread", "q_ordinal", F.explode("q_runs").alias("r")).filter("r.level = 0").select(
        "q_thread", "q_ordinal", F.explode(F.array_distinct(F.concat(F.array("r.whole"), "r.each"))).alias("hash"))
    originals = own.groupBy("q_thread", "hash").agg(F.min("q_ordinal").alias("origin"))
    quoted = parsed.select("q_thread", "q_ordinal", F.posexplode("q_runs").alias("run", "r")).filter("r.level > 0").select("q_thread", "q_ordinal", "run", "r.*")
    asked = quoted.select("q_thread", "q_ordinal", "run", "level", F.explode(F.array_distinct(F.concat(F.array(F.struct(F.lit(1).alias("is_whole"), F.col("whole").alias("hash"))), F.transform(
        "each", lambda h: F.struct(F.when(h == F.col("whole"), 1).otherwise(0).alias("is_whole"), h.alias("hash")))))).alias("a")).select("q_thread", "q_ordinal", "run", "level", "a.*")
    found = asked.join(originals, ["q_thread", "hash"]).filter("origin < q_ordinal")
    # of a passage, its whole counts before its lines, and the origin of most lines before others
    voted = found.groupBy("q_thread", "q_ordinal", "run", "level", "origin").agg(F.max("is_whole").alias("is_whole"), F.count("*").alias("n"))
    of_run = voted.groupBy("q_thread", "q_ordinal", "run", "level").agg(F.max(F.struct("is_whole", "n", "origin"))["origin"].alias("origin"))
    return of_run.groupBy("q_thread", "q_ordinal").agg(F.min(F.struct("level", F.negative("origin").alias("back"), "origin"))["origin"].alias("parent"), F.count("*").alias("n_linked"))


def follow(parents: DataFrame) -> DataFrame:
    """(q_thread, q_ordinal, root, depth) by doubling: as many rounds as the depth has binary digits."""
    at, path = settle_at(parents.select("q_thread", "q_ordinal", F.coalesce("parent", "q_ordinal").alias("root"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth")), "follow")
    while True:
        up = at.select("q_thread", F.col("q_ordinal").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more")).filter("more > 0")
        moved, new = settle_at(at.join(up, ["q_thread", "root"], "left").select(
            "q_thread", "q_ordinal", F.coalesce("above", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("above").isNotNull().alias("moving")), "follow")
        free(at.sparkSession, path)
        at, path = moved.drop("moving"), new
        if moved.filter("moving").isEmpty():
            return at


def conversations(messages: DataFrame) -> DataFrame:
    """Per message: thread, ordinal, role, text without quotes, parent, root, depth, position in its conversation, n_quotes, n_linked."""
    parsed, _ = settle_at(parse(messages), "parsed")
    keys = parsed.select("q_thread", "q_ordinal").distinct()
    tree = keys.join(links(parsed), ["q_thread", "q_ordinal"], "left")
    tree, _ = settle_at(tree, "tree")
    placed = parsed.join(tree.join(follow(tree), ["q_thread", "q_ordinal"]), ["q_thread", "q_ordinal"])
    ranked = prefix_sums(placed, F.concat_ws("\u0001", "q_thread", F.col("root").cast("string")), [F.col("q_ordinal"), F.col("q_body")], F.lit(1))
    return ranked.select("thread", "ordinal", "role", F.col("q_body").alias("text"), "parent", F.when(F.col("root") >= 0, F.col("root")).alias("root"), "depth", F.col("before").alias("position"),
                         F.size(F.filter("q_runs", lambda r: r["level"] > 0)).cast("long").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"))


def quoting_messages(turns: DataFrame) -> DataFrame:
    """Turns of conversations as messages that quote: each the turn before it, which quotes in its turn; some the first turn."""
    one = turns.groupBy("conv_id", "turn").agg(F.min("text").alias("said"), F.min("role").alias("who"))
    first = one.filter("turn = 0").select("conv_id", F.col("said").alias("s0"), F.col("who").alias("w0"))
    last = one.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("said").alias("s1"), F.col("who").alias("w1"))
    older = one.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("said").alias("s2"), F.col("who").alias("w2"))
    rows = turns.select("conv_id", "turn", "role", "text").join(last, ["conv_id", "turn"], "left").join(older, ["conv_id", "turn"], "left").join(first, ["conv_id"], "left")
    mark = lambda text, marks: F.concat(F.lit(marks), F.regexp_replace(text, "\n", "\n" + marks))
    intro = lambda who: F.concat(F.lit("On some day, "), F.coalesce(who, F.lit("someone")), F.lit(" wrote:\n"))
    nested = F.concat(intro(F.col("w1")), F.when(F.col("s2").isNotNull(), F.concat(F.lit("> "), intro(F.col("w2")), mark(F.col("s2"), "> > "), F.lit("\n"))).otherwise(F.lit("")),
                      mark(F.col("s1"), "> "), F.lit("\n\n"))
    to_first = F.concat(intro(F.col("w0")), mark(F.col("s0"), "> "), F.lit("\n\n"))
    quote = F.when((F.col("turn") > 1) & (F.pmod(F.col("conv_id") + F.col("turn"), F.lit(5)) == 0) & F.col("s0").isNotNull(), to_first).when(F.col("s1").isNotNull(), nested).otherwise(F.lit(""))
    return rows.select(F.col("conv_id").alias("thread"), F.col("turn").alias("ordinal"), "role", F.concat(quote, F.coalesce("text", F.lit(""))).alias("text"))


OP10_SQL = r"""
WITH RECURSIVE said AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS n FROM conversations),
firsts AS (
  SELECT conv_id, n, min(turn) AS origin FROM said WHERE length(n) > 0 GROUP BY ALL),
asked AS (
  SELECT s.conv_id, s.turn, CASE WHEN s.turn > 1 AND (s.conv_id + s.turn) % 5 = 0 AND z.n IS NOT NULL THEN z.n ELSE p.n END AS q1,
    CASE WHEN s.turn > 1 AND (s.conv_id + s.turn) % 5 = 0 AND z.n IS NOT NULL THEN NULL WHEN p.n IS NOT NULL THEN o.n END AS q2
  FROM said s LEFT JOIN said p ON p.conv_id = s.conv_id AND p.turn = s.turn - 1
  LEFT JOIN said o ON o.conv_id = s.conv_id AND o.turn = s.turn - 2
  LEFT JOIN said z ON z.conv_id = s.conv_id AND z.turn = 0),
linked AS (
  SELECT a.conv_id, a.turn, f.origin AS o1, g.origin AS o2, a.q1 <> '' AS has1, a.q2 <> '' AS has2
  FROM asked a LEFT JOIN firsts f ON f.conv_id = a.conv_id AND f.n = a.q1 AND f.origin < a.turn
  LEFT JOIN firsts g ON g.conv_id = a.conv_id AND g.n = a.q2 AND g.origin < a.turn),
tree AS (
  SELECT conv_id, turn, coalesce(o1, o2) AS parent, CAST(coalesce(has1, FALSE) AS INT) + CAST(coalesce(has2, FALSE) AS INT) AS n_quotes,
    CAST(o1 IS NOT NULL AS INT) + CAST(o2 IS NOT NULL AS INT) AS n_linked FROM linked),
walk AS (
  SELECT conv_id, turn, turn AS root, 0 AS depth FROM tree WHERE parent IS NULL
  UNION ALL SELECT t.conv_id, t.turn, w.root, w.depth + 1 FROM tree t JOIN walk w ON t.conv_id = w.conv_id AND t.parent = w.turn)
SELECT s.conv_id, s.turn, s.role, regexp_replace(s.text, '^\s+|\s+$', '', 'g') AS text, t.parent, w.root, CAST(w.depth AS BIGINT) AS depth,
  row_number() OVER (PARTITION BY s.conv_id, w.root ORDER BY s.turn) - 1 AS position, CAST(t.n_quotes AS BIGINT) AS n_quotes, CAST(t.n_linked AS BIGINT) AS n_linked
FROM said s JOIN tree t USING (conv_id, turn) JOIN walk w USING (conv_id, turn)
"""
