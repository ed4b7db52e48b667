"""Mix sources to target weights, in DataFrame operations only.

A source's target is its share of all words by weight, at most ``max_epochs`` times its own size; what a full source
cannot take is shared out again by weight. With the sources ordered by cap / weight the fixed point of that resharing is
one prefix sum: a source is full when its cap is at most its weight times the level that the sources before it leave.

Documents get a hash-random key. Each source takes whole epochs of all its documents; the rest of its budget is cut out
of the key order, by distributed prefix sums: a range sort over (source, key), a total for each range, and a running sum
inside each range. No source, however large, meets in one task.

Edge cases, all defined: a NULL text has 0 words and takes 0; a NULL source is a source, last in order; rows of equal
doc_id, source and size are one unit and share evenly what the unit takes; ties in the key fall to doc_id and size; an
empty table gives no rows; other columns of the input are neither read nor clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import word_count
from stratamart.llm.ranges import prefix_sums

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"


def random_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def units_of(docs: DataFrame, size: Column) -> DataFrame:
    """(u_doc, u_source, u_size, u_rows): rows of equal id, source and size, counted."""
    return docs.select(F.col("doc_id").alias("u_doc"), F.col("source").alias("u_source"), size.alias("u_size")).groupBy(
        "u_doc", "u_source", "u_size").agg(F.count("*").alias("u_rows"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Sources (u_source, source_size) with their target; one row a source, so the windows run over few rows."""
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.select("*", F.row_number().over(Window.orderBy(F.col("u_source").asc_nulls_last())).alias("rank")).select(
        "*", weight.alias("weight"), (F.col("source_size") * max_epochs).cast("double").alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).cast("double")
             - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = ranked.select("*", level.alias("level")).select("*", (F.col("cap") <= F.col("weight") * F.col("level")).alias("full"))
    # the first source that is not full sets the level of all after it
    water = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), F.col("rank"), F.col("level")))).over(
        Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))["level"]
    return leveled.select("u_source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * water).alias("target"))


def mix_plan(docs: DataFrame, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
             seed: str = SEED) -> DataFrame:
    """One row per unit: u_doc, u_source, u_size, u_rows, source_size, target, epochs and taken, the last per row."""
    units = units_of(docs, word_count(F.col("text")) if size is None else size)
    sources = units.groupBy("u_source").agg(F.sum(F.col("u_size") * F.col("u_rows")).alias("source_size"))
    goal = targets(sources, weights, max_epochs).select(
        F.coalesce(F.concat(F.lit("s"), F.col("u_source")), F.lit("n")).alias("g_key"), "source_size", "target")
    key = random_key(F.col("u_doc"), seed)
    keyed = units.withColumn("u_key", key)
    source_key = F.coalesce(F.concat(F.lit("s"), F.col("u_source")), F.lit("n"))
    summed = prefix_sums(keyed, source_key, [F.col("u_key"), F.col("u_doc"), F.col("u_size")], F.col("u_size") * F.col("u_rows"))
    summed = summed.withColumn("g_key", source_key).join(goal, "g_key").drop("g_key", "u_key")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budget = F.floor(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("u_size") * F.col("u_rows"), budget - F.col("before")))
    return summed.withColumn("epochs", epochs).withColumn(
        "taken", (F.col("epochs") * F.col("u_size") + F.floor(part / F.col("u_rows"))).cast("long")).drop("before")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source, source_size, target, taken."""
    plan = mix_plan(docs, **options)
    copies = F.explode(F.sequence(F.lit(1), F.col("u_rows").cast("int"))).alias("u_copy")
    return plan.select("*", copies).select(F.col("u_doc").alias("doc_id"), F.col("u_size").alias("size"), F.col("u_source").alias("source"),
                                           "source_size", "target", "taken")


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: documents that the mix takes, each with its epochs and the words of the last, partial epoch.

    A document is repeated by its count, not by copying its text: ``epochs`` whole passes, then ``tail_words`` words.
    """
    plan = mix_plan(docs, **options).filter("taken > 0").select(
        "u_doc", "u_source", "u_size", "taken", "target", "epochs", (F.col("taken") - F.col("epochs") * F.col("u_size")).alias("tail_words"))
    kept = docs.select("doc_id", "text", "lang", "source", "n_chars").withColumn("d_size", word_count(F.col("text")))
    match = kept.doc_id.eqNullSafe(plan.u_doc) & kept.source.eqNullSafe(plan.u_source) & (kept.d_size == plan.u_size)
    return kept.join(plan, match).select("doc_id", "text", "lang", "source", "n_chars", F.col("d_size").alias("size"), "target", "taken", "epochs", "tail_words")


OP5_SQL = """
WITH units AS (
  SELECT doc_id, source, size, count(*) AS n FROM (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents)
  GROUP BY ALL),
sources AS (
  SELECT source, CAST(sum(size * n) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM units GROUP BY source),
weighed AS (
  SELECT *, CAST((rank - 1) % 3 + 1 AS DOUBLE) AS weight, CAST(source_size * 3 AS DOUBLE) AS cap FROM sources),
levels AS (
  SELECT *, (CAST((SELECT sum(source_size) FROM weighed) AS DOUBLE)
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
      / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
goals AS (
  SELECT source, source_size, CASE WHEN cap <= weight * level THEN cap
    ELSE weight * (SELECT level FROM levels WHERE cap > weight * level ORDER BY cap / weight, rank LIMIT 1) END AS target FROM levels),
summed AS (
  SELECT u.*, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN CAST(floor(g.target / g.source_size) AS BIGINT) ELSE 0 END AS epochs,
    coalesce(sum(size * n) OVER (PARTITION BY u.source ORDER BY md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM units u JOIN goals g ON u.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source, source_size, target,
  CAST(epochs * size + floor(greatest(0, least(size * n, CAST(floor(target) AS BIGINT) - epochs * source_size - before)) / n) AS BIGINT) AS taken
FROM (SELECT *, unnest(range(n)) AS copy FROM summed)
"""
