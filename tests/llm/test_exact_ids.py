"""Ids of 64 bits stay as they are, also beside a NULL id in the same batch."""
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.llm import lm, ngram_join, quality, warc

A, B = (1 << 60) + 1, (1 << 60) + 3
TEXT = " ".join(f"w{k}" for k in range(200))
NEAR = TEXT.replace("w150", "other")


@pytest.mark.parametrize("with_null", [False, True])
def test_documents(spark, frame, with_null):
    rows = [(A, TEXT), (B, NEAR), (2 * A, "something else entirely " * 20)] + ([(None, "no id")] if with_null else [])
    docs = frame(rows, 1)
    ids = {r[0] for r in rows}
    joined = {r["doc_id"]: r["component_id"] for r in ngram_join.join_documents(docs.select("doc_id", "text"), width=4, percent=85).collect()}
    assert set(joined) == ids and joined[A] == joined[B] == A and joined[2 * A] == 2 * A
    assert {r["doc_id"] for r in quality.ledger(docs).collect()} == ids
    assert {r["doc_id"] for r in lm.score_all(docs.select("doc_id", "text"), F.lit(False)).collect()} == ids


@pytest.mark.parametrize("with_null", [False, True])
def test_pages(spark, tmp_path, with_null):
    rows = [(A, "u", "x" * 200), (B, "u", "x" * 200), (5, "u", "short")] + ([(None, "u", "x" * 200)] if with_null else [])
    shape = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])
    got = {r["page_id"]: r for r in warc.archive_and_read(spark, spark.createDataFrame(rows, shape).coalesce(1), str(tmp_path)).collect()}
    assert set(got) == {r[0] for r in rows} and all(r["digest_ok"] for r in got.values())
    assert got[B]["refers_to"] == A and got[B]["payload_bytes"] == 200 and got[A]["refers_to"] is None
