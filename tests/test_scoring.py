import pytest
from pyspark.sql import functions as F

from stratamart.plans import scoring

CLAIM = (18500.0, 6.0, 3.0, 850.0, 21.76, 1.0)


def _claims(spark, *rows):
    return spark.createDataFrame(rows, ", ".join(f"{f} double" for f in scoring.CLAIM_FEATURES))


def test_missing_features_are_named(spark):
    got = scoring.with_rejection(_claims(spark, CLAIM, (None, *CLAIM[1:5], None)), scoring.CLAIM_FEATURES)
    assert [r.rejection for r in got.collect()] == [None, "Missing required feature(s): claim_amount, days_to_report"]


def test_claim_scores(spark):
    model = scoring.train_claim_model(scoring.synthetic_claims(spark.range(2000), "id"), trees=20)
    out = scoring.score_claims(model, _claims(spark, CLAIM, (None, *CLAIM[1:]))).collect()
    good = [r for r in out if r.rejection is None][0]
    assert good.risk_label in ("fraud", "legitimate") and 0 <= good.fraud_probability <= 1
    assert len(out) == 2 and [r.risk_label for r in out if r.rejection] == [None]


def test_classes(spark):
    data = spark.range(150).selectExpr("CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS y", *(f"double(id % 3 * {i + 1} + id % 7 / 10) AS {f}" for i, f in enumerate(scoring.FLOWER_FEATURES)))
    model = scoring.train_classifier(data, scoring.FLOWER_FEATURES, "y")
    row = scoring.classify(model, data.where("y = 'c'").limit(1), scoring.FLOWER_FEATURES).head()
    assert row.predicted_class == "c" and set(row.probabilities) == {"a", "b", "c"} and sum(row.probabilities.values()) == pytest.approx(1, abs=1e-5)


def test_sentiment(spark):
    df = spark.createDataFrame([("What a terrible, awful service!",), ("An amazing trip, wonderfully done",), ("It arrived on Monday",), ("   ",), (None,)], "text string")
    got = scoring.score_sentiment(df).select("sentiment", "polarity", F.col("rejection").isNotNull()).collect()
    assert [tuple(r) for r in got] == [("negative", -1.0, False), ("positive", 0.8, False), ("neutral", 0.0, False), (None, None, True), (None, None, True)]


def test_a_class_of_most_rows_is_many_tasks(spark, monkeypatch):
    class Seen:
        def __init__(self, stages):
            pass

        def fit(self, df):
            return df

    monkeypatch.setattr(scoring, "Pipeline", Seen)
    claims = spark.range(0, 4000, 1, 1).select(*(F.col("id").cast("double").alias(f) for f in scoring.CLAIM_FEATURES), F.when(F.col("id") < 40, None).when(F.col("id") % 20 == 0, 1).otherwise(0).alias("is_fraud"))
    got = scoring.train_claim_model(claims)
    assert max(r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()) < 400
    by_class = {r["is_fraud"]: (r["n"], r["w"]) for r in got.groupBy("is_fraud").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    assert {k: n for k, (n, _) in by_class.items()} == {0: 3762, 1: 198}
    assert by_class[0][1] == pytest.approx(4000 / 3) and by_class[1][1] == pytest.approx(4000 / 3)  # rows without a label count as a class, as before
