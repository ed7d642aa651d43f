"""Evaluation of predictions (EVL1-EVL7, JN8, JN9, TOP5). scored(row_id, truth, predicted, confidence)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ratio(a, b):
    return F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))


def confusion(scored: DataFrame) -> DataFrame:
    """EVL2: rows per (truth, predicted); everything below derives from this small table."""
    return scored.groupBy("truth", "predicted").agg(F.count(F.lit(1)).alias("n"))


def accuracy(scored: DataFrame) -> DataFrame:
    """EVL1: samples, hits, errors and accuracy in percent."""
    hit = F.col("truth") == F.col("predicted")
    return scored.agg(F.count(F.lit(1)).alias("samples"), F.count_if(hit).alias("correct"),
                      F.count_if(~hit).alias("errors")).withColumn(
        "accuracy", F.coalesce(F.col("correct") * 100.0 / F.nullif("samples", F.lit(0)), F.lit(0.0)))


def label_scores(scored: DataFrame) -> DataFrame:
    """EVL1: precision, recall, F1 and support per label that occurs in the truth; 0 over 0 is 0."""
    c = confusion(scored)
    sides = c.select(F.explode(F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("given"),
                 F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("given"),
                 F.lit(0).cast("bigint").alias("hits")))).alias("s")).select("s.*")
    sums = sides.groupBy("label").agg(*[F.sum(x).alias(x) for x in ("support", "given", "hits")]).filter("support > 0")
    pr = sums.withColumns({"precision": _ratio("hits", "given"), "recall": _ratio("hits", "support")})
    both = F.col("precision") + F.col("recall")
    f1 = F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(both, F.lit(0.0)), F.lit(0.0))
    return pr.select("label", "precision", "recall", f1.alias("f1"), "support")


def extreme_labels(scores: DataFrame, n: int = 10, best: bool = True) -> DataFrame:
    """TOP5: labels with the greatest or least F1."""
    return scores.orderBy(F.desc("f1") if best else F.asc("f1"), F.asc("label")).limit(n)


def error_rows(scored: DataFrame, n: int = 50) -> DataFrame:
    """EVL3: the first wrong rows by id."""
    return scored.filter(F.col("truth") != F.col("predicted")).orderBy("row_id").limit(n)


def confusion_pairs(scored: DataFrame, n: int = 10) -> DataFrame:
    """EVL3/TOP5: most frequent confusions."""
    wrong = confusion(scored).filter(F.col("truth") != F.col("predicted"))
    return wrong.orderBy(F.desc("n"), "truth", "predicted").limit(n)


def confidence_bands(scored: DataFrame) -> DataFrame:
    """EVL4: rows per confidence band and the mean."""
    c = F.col("confidence")
    return scored.agg(
        F.count_if(c < 0.5).alias("very_low"), F.count_if((c >= 0.5) & (c < 0.7)).alias("low"),
        F.count_if((c >= 0.7) & (c < 0.9)).alias("medium"), F.count_if(c >= 0.9).alias("high"),
        F.round(F.avg(c.cast("decimal(10,6)")).cast("double"), 3).alias("mean_confidence"))


GOLDEN_KEY = ["customer_id", "tx_date", "description", "cents"]


def against_golden(predicted: DataFrame, golden: DataFrame) -> DataFrame:
    """JN8: predictions joined to expected codes on date, text and amount of a customer. A key
    with several expected codes has none that can be checked and is left out; see
    ``golden_conflicts``. Copies of one expectation count once."""
    g = (golden.groupBy(*GOLDEN_KEY).agg(F.min("code").alias("truth"), F.max("code").alias("_last"))
         .filter("truth = _last").drop("_last"))
    return predicted.join(g, GOLDEN_KEY).select(
        F.col("tx_id").alias("row_id"), "truth", F.col("code").alias("predicted"), "confidence")


def golden_conflicts(golden: DataFrame) -> DataFrame:
    """JN8: golden keys with more than one expected code, and how many."""
    return golden.groupBy(*GOLDEN_KEY).agg(F.countDistinct("code").alias("codes")).filter("codes > 1")


def errors_by_truth(scored: DataFrame) -> DataFrame:
    """EVL5: errors per expected code."""
    return scored.groupBy("truth").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("truth") != F.col("predicted")).alias("errors"))


def compare_predictors(a: DataFrame, b: DataFrame) -> DataFrame:
    """EVL6/JN9: agreement of two predictors on the same rows, in percent."""
    both = a.select("tx_id", F.col("code").alias("a")).join(b.select("tx_id", F.col("code").alias("b")), "tx_id")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("a") == F.col("b")).alias("agree")).withColumn(
        "agreement", F.round(F.col("agree") * 100.0 / F.nullif("rows", F.lit(0)), 1))


def branch_deltas(a: DataFrame, b: DataFrame) -> DataFrame:
    """EVL6: rows per branch in either predictor and the difference."""
    left = a.groupBy("branch").agg(F.count(F.lit(1)).alias("n_a"))
    right = b.groupBy("branch").agg(F.count(F.lit(1)).alias("n_b"))
    zero = F.lit(0)
    return left.join(right, "branch", "full").select(
        "branch", F.coalesce("n_a", zero).alias("n_a"), F.coalesce("n_b", zero).alias("n_b"),
        (F.coalesce("n_b", zero) - F.coalesce("n_a", zero)).alias("delta"))


def disagreements(a: DataFrame, b: DataFrame, n: int = 10) -> DataFrame:
    """EVL6: sample of rows on which two predictors differ, by id."""
    both = a.select("tx_id", F.col("code").alias("a")).join(b.select("tx_id", F.col("code").alias("b")), "tx_id")
    return both.filter(F.col("a") != F.col("b")).orderBy("tx_id").limit(n)


# fixed values: phrases and the code their rows must have
REGRESSION_CASES = [("MOMENTUM ENERGY", "EXP-040"), ("TAX OFFICE", "EXP-015"),
                    ("NAB CARDS", "EXP-061"), ("MCARE BENEFITS", "INC-015")]


def regression_cases(categorised: DataFrame, cases=None) -> DataFrame:
    """EVL7: per phrase the rows that contain it and how many have the expected code.

    The phrases become counters of one aggregation, so the rows are read once.
    """
    cases = cases or REGRESSION_CASES
    text, code = F.upper("description"), F.col("code")
    aggs = []
    for i, (phrase, expected) in enumerate(cases):
        aggs += [F.count_if(text.contains(phrase)).alias(f"m{i}"),
                 F.count_if(text.contains(phrase) & (code == expected)).alias(f"c{i}")]
    rows = F.array(*[F.struct(F.lit(p).alias("phrase"), F.lit(e).alias("expected"), F.col(f"m{i}").alias("matches"),
                              F.col(f"c{i}").alias("correct")) for i, (p, e) in enumerate(cases)])
    return categorised.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*")
