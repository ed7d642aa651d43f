"""Text classifier on Spark ML (ML1, ML2)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import attach


def class_weights(samples: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """ML1: (label, label_index, weight): labels in alphabetical order, weight total / (K * count).

    ``labels`` may name labels that the samples lack; their count is taken as one.
    """
    counts = samples.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    if labels is not None:
        counts = labels.select("label").distinct().join(counts, "label", "left")
    one = counts.withColumn("c", F.coalesce("n", F.lit(1)))
    sums = one.agg(F.count(F.lit(1)).alias("k"), F.sum(F.coalesce("n", F.lit(0))).alias("t"))
    k, t = sums.select("k").scalar(), sums.select("t").scalar()
    # Labels are few (the taxonomy), so numbering them in one task is bounded.
    from pyspark.sql import Window as W

    place = F.row_number().over(W.orderBy("label")) - 1
    return one.select("label", place.alias("label_index"), (t / (k * F.col("c"))).alias("weight"))


MAX_LABELS = 10_000


def fit(train: DataFrame, features: int = 1 << 12, iterations: int = 20) -> PipelineModel:
    """ML2: words of the description, weighted by class, into a multinomial regression."""
    # Labels are few, so the weights travel as a constant: no join on some seventy hot keys. More labels are joined.
    weights = class_weights(train).select("label", "weight")
    few = weights.limit(MAX_LABELS + 1).collect()
    if len(few) > MAX_LABELS:
        weighted = attach(train, weights, ["label"], ["description"])
    else:
        table = F.create_map(*[F.lit(x) for r in few if r["label"] is not None for x in (r["label"], float(r["weight"]))])
        weighted = train.withColumn("weight", F.try_element_at(table, F.col("label"))).filter("weight is not null")
    stages = [
        StringIndexer(inputCol="label", outputCol="label_idx", stringOrderType="alphabetAsc", handleInvalid="skip"),
        RegexTokenizer(inputCol="description", outputCol="tokens", pattern=r"[^\p{L}\p{N}]+", toLowercase=True),
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label_idx", weightCol="weight", maxIter=iterations,
                           regParam=1e-4)]
    return Pipeline(stages=stages).fit(weighted)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """ML2: adds model_code and model_confidence (the greatest probability)."""
    names = F.array(*[F.lit(x) for x in model.stages[0].labels])
    scored = rows
    for stage in model.stages[1:]:
        scored = stage.transform(scored)
    return scored.withColumns({
        "model_code": F.element_at(names, (F.col("prediction") + 1).cast("int")),
        "model_confidence": F.array_max(vector_to_array("probability"))}).drop(
        "tokens", "tf", "features", "rawPrediction", "probability", "prediction")
