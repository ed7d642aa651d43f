"""Row shaping (PRJ1-PRJ13) and feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import money


def date_parts(date: Column) -> dict[str, Column]:
    """Month, weekday (Monday 0), day and year; zeros without a date."""
    zero = F.lit(0)
    return {"month": F.coalesce(F.month(date), zero), "day_of_week": F.coalesce(F.weekday(date), zero),
            "day_of_month": F.coalesce(F.dayofmonth(date), zero), "year": F.coalesce(F.year(date), zero)}


MODEL_INPUT = ["description", "merchant_name", "clean_description", "provider_category", "account_type",
               "transaction_type", "subclass_code", "subclass_title", "anzsic_group_code",
               "anzsic_group_title", "amount", "direction", "transaction_date", "month", "day_of_week",
               "day_of_month", "year", "account_holder", "account_name", "bsb", "account_number",
               "balance", "pending"]


def model_input(rows: DataFrame) -> DataFrame:
    """PRJ1: the 23 model-input columns of canonical statement rows; zero amounts are debits."""
    date = F.try_to_date(F.left(F.col("date"), F.lit(10)), "yyyy-MM-dd")
    empty = {c: F.lit("") for c in ("clean_description", "subclass_code", "subclass_title",
                                    "anzsic_group_code", "anzsic_group_title")}
    return rows.withColumns({
        **empty, **date_parts(date), "merchant_name": F.coalesce("third_party", F.lit("")),
        "provider_category": F.col("category"), "transaction_date": F.col("date"),
        "direction": F.when(F.col("amount") > 0, "credit").otherwise("debit")}).select(*MODEL_INPUT)


def amount_bucket(amount: Column) -> Column:
    """PRJ8: size class of the absolute amount."""
    a = F.abs(amount)
    return (F.when(a < 10, "micro").when(a < 50, "small").when(a < 200, "medium")
            .when(a < 1000, "large").otherwise("xlarge"))


def feature_rows(dataset: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """PRJ8: features of labelled rows; zero amounts are credits here.

    dataset(run_id, transaction_id, description, amount as text, transaction_date, post_date,
    provider_category, label_group_code, label_source).
    """
    amount = F.coalesce(F.trim("amount").try_cast("double"), F.lit(0.0))
    date = F.coalesce(F.nullif("transaction_date", F.lit("")), "post_date", F.lit(""))
    out = dataset.withColumns({"amount": amount, "transaction_date": date})
    out = out.withColumns({
        "amount_bucket": amount_bucket(F.col("amount")),
        "direction": F.when(F.col("amount") < 0, "debit").otherwise("credit"), **date_parts(
            F.try_to_date(F.left(F.col("transaction_date"), F.lit(10)), "yyyy-MM-dd"))})
    if mapping is None:
        return out.withColumns({"fallback_code": F.lit(""), "fallback_confidence": F.lit(0.0)})
    m = mapping.select("provider_category", F.col("code").alias("fallback_code"),
                       F.col("confidence").alias("fallback_confidence"))
    return out.join(m, "provider_category", "left").withColumns({
        "fallback_code": F.coalesce("fallback_code", F.lit("")),
        "fallback_confidence": F.coalesce("fallback_confidence", F.lit(0.0))})


def add_split(features: DataFrame, splits: DataFrame | None) -> DataFrame:
    """PRJ9: adds the split of the run, ``unknown`` without one; nothing if no splits are known."""
    if splits is None:
        return features
    return features.join(splits.select("run_id", "split"), "run_id", "left").withColumn(
        "split", F.coalesce("split", F.lit("unknown")))


def training_samples(features: DataFrame) -> DataFrame:
    """PRJ13: rows with a label; one bad number sets all four numbers to zero. Input is text."""
    label = F.trim("label_group_code")
    numbers = {"amount": "double", "month": "int", "day_of_week": "int", "day_of_month": "int"}
    parsed = {c: F.trim(c).try_cast(t) for c, t in numbers.items()}
    good = F.lit(True)
    for c in parsed.values():
        good = good & c.isNotNull()
    return (features.filter(F.coalesce(label, F.lit("")) != "")
            .withColumns({**{c: F.when(good, v).otherwise(F.lit(0).cast(numbers[c])) for c, v in parsed.items()},
                          "label": label, "amount_bucket": F.coalesce("amount_bucket", F.lit("medium")),
                          "split": F.coalesce("split", F.lit("train"))}))


def label_distribution(df: DataFrame, column: str) -> DataFrame:
    """AGG22: rows per value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def api_row(tx: DataFrame) -> DataFrame:
    """PRJ2: canonical record of an API transaction; amounts with two decimals or empty."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    return tx.select(
        text("id").alias("transaction_id"), F.coalesce(money(F.col("amount")).cast("string"), F.lit("")).alias("amount"),
        text("direction").alias("direction"), text("transactionDate").alias("transaction_date"),
        text("postDate").alias("post_date"), text("description").alias("description"))
