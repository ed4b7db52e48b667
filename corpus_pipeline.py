"""The corpus pipeline: stages over documents, each one of the text operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the docs of the
next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm import decontaminate, mixing, ngram_join, secrets, toxicity
from stratamart.llm.common import bound_batches, settle_at, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon, learnt from all labels of the documents at hand, does not reject."""
    return toxicity.reject_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), F.lit(True)))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 5-word shingles, a similarity of 0.8."""
    bound_batches(spark)
    return ngram_join.keep_one(docs, width=5, percent=80)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    bound_batches(spark)
    return secrets.mask_secrets(docs, secrets.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how often and how far: epochs, tail_words, taken."""
    return mixing.apply_mix(docs)


STAGES = [("toxicity", drop_toxic), ("ngram_join", keep_one_of_each), ("decontamination", drop_leaked), ("secrets", mask_secrets), ("mixing", mix_sources)]

#: Models are trained on the way, so SQL cannot express the rows; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = settle_at(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
