"""Batch scoring: request validation, claim fraud, multi-class classification, text sentiment.

Models are Spark ML pipelines and scoring is a transformation of the whole input.
No trained artefact is shipped; each model is trained from a labelled DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLAIM_FEATURES = ["claim_amount", "policy_tenure_months", "num_prior_claims", "premium_amount", "claim_to_premium_ratio", "days_to_report"]
FLOWER_FEATURES = ["sepal_length", "sepal_width", "petal_length", "petal_width"]
FRAUD_THRESHOLD = 0.5
FOREST_ROWS, FOREST_TASKS = 100_000, 4  # rows of a task at most; tasks for each core that the application has, at least


# --- validation ---------------------------------------------------------------------------

def with_rejection(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """``rejection`` names every missing feature, NULL for a complete request."""
    missing = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in required)))
    text = F.concat(F.lit("Missing required feature(s): "), F.concat_ws(", ", missing))
    return df.withColumn("rejection", F.when(F.size(missing) > 0, text))


def with_text_rejection(df: DataFrame, column: str = "text") -> DataFrame:
    blank = F.coalesce(F.length(F.trim(column)), F.lit(0)) == 0
    return df.withColumn("rejection", F.when(blank, f"Missing required field: {column} (must be a non-empty string)."))


# --- claims -------------------------------------------------------------------------------

def train_claim_model(labelled: DataFrame, label: str = "is_fraud", trees: int = 200, seed: int = 42) -> PipelineModel:
    """Random forest with classes weighted by the inverse of their frequency; rows without a label are left out.

    The classes are counted once and their weights, a handful, are literals: joined by label, all rows of a class would be
    one task. The rows are dealt out evenly, since the forest takes its tasks from the layout of its input.
    """
    counted = {r[label]: r["n"] for r in labelled.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total, classes = sum(counted.values()), len(counted)
    weight = F.lit(None).cast("double")
    for value, n in counted.items():
        if value is not None:
            weight = F.when(F.col(label) == F.lit(value), F.lit(total / (classes * n))).otherwise(weight)
    tasks = max(FOREST_TASKS * labelled.sparkSession.sparkContext.defaultParallelism, -(-total // FOREST_ROWS))
    weighted = labelled.where(F.col(label).isNotNull()).select(*CLAIM_FEATURES, label).repartition(tasks).withColumn("weight", weight)
    forest = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="weight", numTrees=trees, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=CLAIM_FEATURES, outputCol="features"), forest]).fit(weighted)


def score_claims(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """Complete requests get a probability to six digits and a label; the others keep their rejection."""
    checked = with_rejection(requests, CLAIM_FEATURES)
    scored = model.transform(checked.where("rejection IS NULL")).withColumn(
        "fraud_probability", F.round(vector_to_array("probability")[1], 6))
    out = scored.select(*checked.columns, "fraud_probability", F.when(F.col("fraud_probability") >= FRAUD_THRESHOLD, "fraud").otherwise("legitimate").alias("risk_label"))
    return out.unionByName(checked.where("rejection IS NOT NULL"), allowMissingColumns=True)


def synthetic_claims(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """A labelled claim per input row in realistic ranges, 5 % positive, decided by hashes of the key."""
    # feature: offset, scale, lowest, highest, digits (fixed values)
    ranges = {
        "claim_amount": (8000, 6000, 200, 75000, 2), "policy_tenure_months": (24, 15, 1, 240, 0), "num_prior_claims": (1.5, 1.2, 0, 12, 0),
        "premium_amount": (900, 400, 150, 6000, 2), "claim_to_premium_ratio": (3, 4, 0.05, 60, 2), "days_to_report": (10, 8, 0, 120, 0),
    }

    def uniform(n: int) -> Column:
        return (F.pmod(F.xxhash64(F.lit(seed + n), F.col(key)), F.lit(1_000_000)) + 0.5) / 1_000_000

    def normal(n: int) -> Column:  # Box-Muller
        return F.sqrt(-2 * F.ln(uniform(n))) * F.cos(2 * F.pi() * uniform(n + 50))

    fraud = (uniform(900) < 0.05).cast("int")
    features = []
    for i, (name, (offset, scale, low, high, digits)) in enumerate(ranges.items()):
        raw = offset + scale * (normal(i) + (1.5 if i < 4 else 0.0) * fraud)
        features.append(F.round(F.least(F.greatest(raw, F.lit(low)), F.lit(high)), digits).cast("double").alias(name))
    return df.select(F.col(key), *features, fraud.alias("is_fraud"))


# --- classes ------------------------------------------------------------------------------

def train_classifier(labelled: DataFrame, features: Sequence[str], label: str, iterations: int = 200) -> PipelineModel:
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="label_index", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=list(features), outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label_index", predictionCol="class_index", family="multinomial", maxIter=iterations),
    ]).fit(labelled)


def classify(model: PipelineModel, requests: DataFrame, features: Sequence[str]) -> DataFrame:
    """Predicted class and the probability of every class, to six digits."""
    names = F.array(*(F.lit(x) for x in model.stages[0].labels))
    checked = with_rejection(requests, features)
    stages = model.stages[1:]
    scored = checked.where("rejection IS NULL")
    for stage in stages:
        scored = stage.transform(scored)
    out = scored.select(
        *checked.columns, names[F.col("class_index").cast("int")].alias("predicted_class"),
        F.map_from_arrays(names, F.transform(vector_to_array("probability"), lambda p: F.round(p, 6))).alias("probabilities"))
    return out.unionByName(checked.where("rejection IS NOT NULL"), allowMissingColumns=True)


# --- sentiment ------------------------------------------------------------------------------

# word: (polarity, subjectivity); fixed values of our own small list
LEXICON = {
    "amazing": (0.6, 0.9), "awesome": (1.0, 1.0), "awful": (-1.0, 1.0), "bad": (-0.7, 0.667), "best": (1.0, 0.3), "boring": (-1.0, 1.0),
    "broken": (-0.4, 0.4), "disappointing": (-0.6, 0.7), "excellent": (1.0, 1.0), "fantastic": (0.4, 0.9), "good": (0.7, 0.6), "great": (0.8, 0.75),
    "happy": (0.8, 1.0), "hate": (-0.8, 0.9), "helpful": (0.5, 0.5), "horrible": (-1.0, 1.0), "love": (0.5, 0.6), "nice": (0.6, 1.0), "perfect": (1.0, 1.0),
    "poor": (-0.4, 0.6), "slow": (-0.3, 0.4), "terrible": (-1.0, 1.0), "useless": (-0.5, 0.2), "wonderful": (1.0, 1.0), "wonderfully": (1.0, 1.0), "worst": (-1.0, 1.0),
}
POSITIVE_ABOVE, NEGATIVE_BELOW = 0.1, -0.1


def score_sentiment(df: DataFrame, column: str = "text", lexicon: dict[str, tuple[float, float]] = LEXICON) -> DataFrame:
    """Mean polarity and subjectivity of the listed words in a text, repeats included.

    The list is a literal of a few dozen words, so a text is scored where it is
    read: nothing is exploded, joined or shuffled, whatever the length of a text.
    """
    table = F.create_map(*(x for w, (p, s) in lexicon.items() for x in (F.lit(w), F.struct(F.lit(p).alias("p"), F.lit(s).alias("s")))))
    words = F.split(F.lower(column), r"[^a-z]+")
    hits = F.filter(F.transform(words, lambda w: F.try_element_at(table, w)), lambda h: h.isNotNull())

    def mean(part: str) -> Column:
        # thousandths as whole numbers: the sum is exact whatever its order
        total = F.aggregate("__hits", F.lit(0).cast("bigint"), lambda acc, h: acc + F.round(h[part] * 1000).cast("bigint"))
        return F.coalesce(F.round(total / 1000.0 / F.nullif(F.size("__hits"), F.lit(0)), 6), F.lit(0.0))

    polarity = F.col("polarity")
    return (
        with_text_rejection(df, column).withColumn("__hits", hits)
        .withColumns({"polarity": F.when(F.col("rejection").isNull(), mean("p")), "subjectivity": F.when(F.col("rejection").isNull(), mean("s"))})
        .withColumn("sentiment", F.when(polarity > POSITIVE_ABOVE, "positive").when(polarity < NEGATIVE_BELOW, "negative").when(polarity.isNotNull(), "neutral"))
        .drop("__hits")
    )
