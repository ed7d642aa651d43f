"""Monthly series and sources (AGG1-AGG7, WIN1, WIN2).

Money is whole cents. Rows shrink to (customer, month) or (customer, source) before any
window, so a window group holds at most the months of one customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import MetricParams
from ..functions.text import merchant_key
from ..functions.values import cents_to_money, half_up_div

CUSTOMER = ["customer_id"]


def month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def monthly_totals(tx: DataFrame, by: list[str] = CUSTOMER, cents: str = "cents",
                   date: str = "tx_date") -> DataFrame:
    """AGG1: total per month that occurs."""
    return (tx.filter(F.col(date).isNotNull()).groupBy(*by, month(F.col(date)).alias("month"))
            .agg(F.sum(cents).alias("total")))


def calendar_months(tx: DataFrame, by: list[str] = CUSTOMER, date: str = "tx_date") -> DataFrame:
    """AGG2: sorted months that occur."""
    return (tx.filter(F.col(date).isNotNull()).groupBy(*by)
            .agg(F.array_sort(F.collect_set(month(F.col(date)))).alias("months")))


def mean_money(total: Column, n: Column) -> Column:
    """Mean of ``n`` months in money, halves away from zero; 0 without months."""
    mean = half_up_div(F.abs(total), n)
    return cents_to_money(F.when(total < 0, -mean).otherwise(mean))


def mean_monthly(monthly: DataFrame, by: list[str] = CUSTOMER) -> DataFrame:
    """AGG3: mean over the months present."""
    return (monthly.groupBy(*by).agg(F.sum("total").alias("t"), F.count(F.lit(1)).alias("n"))
            .select(*by, mean_money(F.col("t"), F.col("n")).alias("mean_monthly")))


def median_money(total: Column) -> Column:
    """Aggregate: median in money, halves up; 0 without months."""
    return F.coalesce(cents_to_money(F.floor(F.percentile(total, 0.5) + 0.5)), F.lit(0.0))


def median_monthly(monthly: DataFrame, by: list[str] = CUSTOMER) -> DataFrame:
    """AGG4: median over the months present."""
    return monthly.groupBy(*by).agg(median_money(F.col("total")).alias("median_monthly"))


def is_stable(now: Column, before: Column, percent: int) -> Column:
    """WIN1 step: within ``percent`` of the month before; zero stays stable only at zero."""
    return F.when(before == 0, now == 0).otherwise(
        F.abs(now - before) * 100 <= F.abs(before) * percent)


def is_secure(now: Column, before: Column, percent: int) -> Column:
    """WIN2 step: not more than ``percent`` below the month before."""
    return F.when(before == 0, now >= 0).otherwise(
        (now - before) * 100 >= -F.abs(before) * percent)


def run_columns(prefix: str, total: Column, present: Column, step, percent: int,
                by: list[str] = CUSTOMER) -> dict[str, Column]:
    """Window columns for ``run_length``: position of a month and whether it breaks the run."""
    w = W.partitionBy(*by).orderBy("month")
    seen = F.when(present, total)
    before = F.last(seen, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, -1))
    pos = F.count(seen).over(w.rowsBetween(W.unboundedPreceding, 0))
    breaks = present & before.isNotNull() & ~step(total, before, percent)
    return {f"{prefix}_pos": F.when(present, pos), f"{prefix}_break": F.when(breaks, pos)}


def run_length(prefix: str) -> Column:
    """Aggregate: months from the newest back to the last break, 0 without months."""
    last = F.coalesce(F.max(f"{prefix}_break"), F.lit(1))
    return F.coalesce(F.max(f"{prefix}_pos") - last + 1, F.lit(0))


def _run(monthly, step, percent, name, by):
    cols = run_columns("r", F.col("total"), F.lit(True), step, percent, by)
    return monthly.withColumns(cols).groupBy(*by).agg(run_length("r").alias(name))


def stability_months(monthly: DataFrame, percent: int = MetricParams.stable_percent,
                     by: list[str] = CUSTOMER) -> DataFrame:
    """WIN1: consecutive stable months, newest first."""
    return _run(monthly, is_stable, percent, "stable_months", by)


def security_months(monthly: DataFrame, percent: int = MetricParams.stable_percent,
                    by: list[str] = CUSTOMER) -> DataFrame:
    """WIN2: consecutive stable or rising months, newest first."""
    return _run(monthly, is_secure, percent, "secure_months", by)


def unique_merchants(tx: DataFrame, by: list[str] = CUSTOMER) -> DataFrame:
    """AGG5: distinct merchants; a missing description counts as one."""
    names = tx.select(*by, merchant_key(F.col("description")).alias("m")).distinct()
    return names.groupBy(*by).agg(F.count(F.lit(1)).alias("merchants"))


def sources(tx: DataFrame, by: list[str] = CUSTOMER, code: str = "code") -> DataFrame:
    """One row per (category, merchant) with row count and first and last date; nulls excluded."""
    named = tx.withColumn("merchant_key", merchant_key(F.col("description")))
    return (named.filter(F.col(code).isNotNull() & F.col("merchant_key").isNotNull())
            .groupBy(*by, code, "merchant_key")
            .agg(F.count("tx_date").alias("n"), F.min("tx_date").alias("first_date"),
                 F.max("tx_date").alias("last_date"), F.sum("cents").alias("total")))


def stopped_merchants(tx: DataFrame, since: DataFrame, by: list[str] = CUSTOMER) -> DataFrame:
    """SET3: merchants seen before a customer's own ``since`` date and not from then on.

    ``since``: the columns ``by`` and ``since`` (date), one row each. Customers without a date have
    no rows; undated rows and rows without a description count on neither side. One grouping by
    customer and merchant, then a join with the dates; amounts are the caller's to filter.
    """
    named = tx.withColumn("merchant_key", merchant_key(F.col("description")))
    last = (named.filter(F.col("merchant_key").isNotNull() & F.col("tx_date").isNotNull())
            .groupBy(*by, "merchant_key").agg(F.max("tx_date").alias("last_date")))
    dates = since.filter(F.col("since").isNotNull()).select(*by, "since")
    return last.join(dates, by).filter(F.col("last_date") < F.col("since")).select(*by, "merchant_key", "last_date")


def income_sources(tx: DataFrame, by: list[str] = CUSTOMER) -> DataFrame:
    """AGG6: number of distinct (category, merchant)."""
    return sources(tx, by).groupBy(*by).agg(F.count(F.lit(1)).alias("sources"))


def frequency(n: Column, first: Column, last: Column,
              params: MetricParams = MetricParams()) -> Column:
    """AGG7: name of the rhythm. The gaps add up to last - first, so the mean gap needs no window."""
    gap = F.date_diff(last, first)
    out = None
    for name, low, high in params.frequencies:
        fits = ((n >= params.min_dates) & (gap >= (n - 1) * low) & (gap <= (n - 1) * high))
        out = F.when(fits, F.lit(name)) if out is None else out.when(fits, F.lit(name))
    return out


def source_frequency(tx: DataFrame, by: list[str] = CUSTOMER,
                     params: MetricParams = MetricParams()) -> DataFrame:
    """AGG7 per source."""
    return sources(tx, by).withColumn("frequency", frequency(
        F.col("n"), F.col("first_date"), F.col("last_date"), params))
