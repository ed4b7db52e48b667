"""Named queries of the text operators over the supplied tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm import decontaminate, lm, mixing, negatives, ngram_join, quality, quoting, repair, secrets, topk, toxicity, url_lists, warc
from stratamart.llm.common import fold_of, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item: a row per pair."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under a Jaccard similarity of 0.85 on 4-word shingles."""
    joined = ngram_join.join_documents(table(spark, sf_dir, "documents", "doc_id", "text"), width=4, percent=85)
    return joined.select("doc_id", "n_shingles", "component_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    read = warc.archive_and_read(spark, table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every document under a model of nine of ten documents."""
    return lm.score_all(table(spark, sf_dir, "documents", "doc_id", "text"), fold_of(F.col("doc_id"), 10) == 0)


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mixed_rows(table(spark, sf_dir, "documents", "doc_id", "text", "source")).select("doc_id", "size", "source", "source_size", "target", "taken")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document: counts and places of the base patterns, and all spans."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = secrets.scan(docs, secrets.train(docs))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(of(k).alias(f"n_{k}") for k in secrets.KINDS), F.sha2(secrets.joined(F.col("spans"), secrets.KINDS[:3]), 256).alias("base_sha256"),
                        secrets.joined(F.col("spans"), secrets.KINDS).alias("spans"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of every document and the verdict of the prose policy."""
    book = quality.ledger(table(spark, sf_dir, "documents", "doc_id", "text"))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~quality.passes("base-1")).alias("base_failed"),
                       quality.passes("prose-1").alias("kept"), "failed")


def op8_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page as of its fetch time, under list histories drawn from the pages' hosts."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    judged = url_lists.judge(url_lists.fetched(pages), url_lists.history(pages))
    stamp = lambda c: F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd HH:mm:ss").alias(c)
    return judged.select("page_id", "host", stamp("fetched_at"), "verdict", "list_name", "pattern", stamp("valid_from"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; two of three folds of the labels train."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), fold_of(F.col("doc_id"), 3) != 1)
    scored = toxicity.score(docs, lexicon)
    return scored.select("doc_id", (fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op10_quoting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns, turned into messages with nested quotes, linked and ordered again without them."""
    messages = quoting.quoting_messages(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return quoting.conversations(messages).withColumnsRenamed({"thread": "conv_id", "ordinal": "turn"})


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of each vector whose id is divisible by 20, among all others."""
    found = topk.vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), "vec_id", "embedding", scale=64)
    return topk.top_k(found, F.col("vec_id") % 20 == 0, 20)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, and its cheapest repair."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return repair.digests(repair.repair(repair.damage(rows)), repair.survivors(rows))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each vector whose id is divisible by 100, by positive."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.labelled(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), "vec_id", "embedding", label, scale=256)
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate, "op2_ngram_join": op2_ngram_join, "op3_warc": op3_warc, "op4_lm": op4_lm, "op5_mix": op5_mix, "op6_secrets": op6_secrets, "op7_quality": op7_quality, "op8_url_lists": op8_url_lists,
    "op9_toxicity": op9_toxicity, "op10_quoting": op10_quoting,
    "op11_topk": op11_topk, "op12_repair": op12_repair, "op13_negatives": op13_negatives,
}
SQL: dict[str, str] = {"op3_warc": warc.OP3_SQL, "op5_mix": mixing.OP5_SQL, "op8_url_lists": url_lists.OP8_SQL, "op10_quoting": quoting.OP10_SQL,
                       "op11_topk": topk.OP11_SQL, "op13_negatives": negatives.OP13_SQL}
