"""Filters and predicates (FLT1-FLT11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import tables
from ..config import INCOME_DEFAULT, EXPENSE_DEFAULT, REFUND, CascadeParams, MetricParams
from .skew import attach


def reporting_window(tx: DataFrame, days: int = MetricParams.period_days, end: str | None = None,
                     customer: str = "customer_id", date: str = "tx_date",
                     row_id: str = "tx_id") -> DataFrame:
    """FLT1: rows of the last ``days`` days of each customer, both ends included.

    With a fixed ``end`` (yyyy-MM-dd) this is a plain filter that reaches the scan.
    """
    if end is not None:
        stop = F.lit(end).cast("date")
        return tx.filter((F.col(date) >= F.date_sub(stop, days)) & (F.col(date) <= stop))
    dated = tx.filter(F.col(date).isNotNull())
    ends = dated.groupBy(customer).agg(F.max(date).alias("_end"), F.count(F.lit(1)).alias("_n"))
    return (attach(dated, ends.drop("_n"), [customer], [row_id], counts=ends)
            .filter(F.col(date) >= F.date_sub("_end", days)).drop("_end"))


def recent_window(tx: DataFrame, months: int = MetricParams.recent_months,
                  days_per_month: int = MetricParams.days_per_month,
                  customer: str = "customer_id", date: str = "tx_date",
                  row_id: str = "tx_id") -> DataFrame:
    """FLT2: rows since ``months`` * 30 days before the newest row of this same selection."""
    return reporting_window(tx, months * days_per_month, None, customer, date, row_id)


def split_by_sign(tx: DataFrame, cents: str = "cents") -> tuple[DataFrame, DataFrame]:
    """FLT3: (income rows, expense rows with positive amounts); zero is in neither."""
    return (tx.filter(F.col(cents) > 0),
            tx.filter(F.col(cents) < 0).withColumn(cents, F.abs(cents)))


def in_class(code: Column, name: str) -> Column:
    """FLT4: the code belongs to an expense class; null belongs to none."""
    return F.coalesce(code.isin(tables.CLASSES[name]), F.lit(False))


def direction_ok(code: Column, amount: Column) -> Column:
    """FLT5: the code fits the sign of the amount."""
    return (F.when(amount < 0, code.startswith("EXP-"))
            .when(amount > 0, code.startswith("INC-") | (code == REFUND))
            .otherwise(F.lit(True)))


def default_code(amount: Column) -> Column:
    """CLS12: uncategorised code by sign; zero counts as income."""
    return F.when(amount < 0, F.lit(EXPENSE_DEFAULT)).otherwise(F.lit(INCOME_DEFAULT))


def validate_api_rows(tx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FLT7: (good rows, rejected rows with a reason). Expects tx_id, amount, direction as text."""
    checked = tx.withColumn("reason", api_row_problem())
    return (checked.filter(F.col("reason").isNull()).drop("reason"),
            checked.filter(F.col("reason").isNotNull()))


def api_row_problem() -> Column:
    from ..functions.values import parse_amount

    return (F.when(F.coalesce(F.trim("tx_id"), F.lit("")) == "", F.lit("missing id"))
            .when(parse_amount(F.col("amount")).isNull(), F.lit("bad amount"))
            .when(~F.coalesce(F.lower("direction"), F.lit("")).isin("debit", "credit"),
                  F.lit("bad direction")))


def require_valid(tx: DataFrame) -> DataFrame:
    """FLT7 strict: the job fails on the first bad row."""
    problem = api_row_problem()
    return tx.filter(F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean"))
                     .otherwise(F.lit(True)))


GOLD_SOURCES = ("report_id", "report_key")


def gold_rows(labelled: DataFrame) -> DataFrame:
    """FLT8: rows labelled from a report, with subclass and label present."""
    return labelled.filter(
        F.col("label_source").isin(*GOLD_SOURCES)
        & (F.coalesce(F.trim("subclass_code"), F.lit("")) != "")
        & (F.coalesce(F.trim("label_group_code"), F.lit("")) != ""))


def split_by_confidence(df: DataFrame, threshold: float = 0.8,
                        column: str = "confidence") -> tuple[DataFrame, DataFrame]:
    """FLT9: (rows at or above the threshold, rows below it)."""
    return df.filter(F.col(column) >= threshold), df.filter(F.col(column) < threshold)


def is_generic_category(category: Column, params: CascadeParams = CascadeParams()) -> Column:
    """FLT10: provider category without information (any listed text inside it)."""
    found = F.lit(False)
    for text in params.generic:
        found = found | category.contains(text)
    return F.coalesce(found, F.lit(False))


def is_vague_category(category: Column, params: CascadeParams = CascadeParams()) -> Column:
    """FLT11: provider category too wide to map."""
    return F.coalesce(category.isin(*params.vague), F.lit(False))
