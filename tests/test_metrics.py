import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import filters, metrics, series

D = dt.date


def tx(spark, rows):
    return spark.createDataFrame(
        [(f"t{i}", *r) for i, r in enumerate(rows)],
        "tx_id string, customer_id long, tx_date date, description string, cents long, code string")


def test_window_edges(spark):
    end = D(2024, 12, 31)
    rows = [(1, end, "a", 1, "x"), (1, end - dt.timedelta(180), "b", 1, "x"), (1, end - dt.timedelta(181), "c", 1, "x"), (1, None, "d", 1, "x")]
    assert {r.description for r in filters.reporting_window(tx(spark, rows)).collect()} == {"a", "b"}
    fixed = filters.reporting_window(tx(spark, rows), end="2024-07-05")
    assert {r.description for r in fixed.collect()} == {"b", "c"}


def monthly(spark, *totals):
    return spark.createDataFrame([(1, f"2024-{i + 1:02d}", t) for i, t in enumerate(totals)], "customer_id long, month string, total long")


def test_runs(spark):
    def stable(*t):
        return series.stability_months(monthly(spark, *t)).first().stable_months

    def secure(*t):
        return series.security_months(monthly(spark, *t)).first().secure_months

    assert stable(100) == 1 and stable(0, 0) == 2 and stable(0, 5) == 1
    assert stable(1000, 1100) == 2 and stable(10000, 11001) == 1
    assert stable(500, 100, 100, 105) == 3
    assert secure(100, 200, 400) == 3 and secure(1000, 899) == 1 and secure(1000, 900) == 2 and secure(0, 5) == 2
    assert series.stability_months(monthly(spark)).count() == 0


def test_frequency(spark):
    rows = [(2, 14), (3, 19), (3, 28), (3, 40), (3, 60), (3, 6)]
    df = spark.createDataFrame([(n, D(2024, 1, 1), D(2024, 1, 1) + dt.timedelta(g)) for n, g in rows], "n long, a date, b date")
    got = [r.f for r in df.select(series.frequency(F.col("n"), F.col("a"), F.col("b")).alias("f")).collect()]
    assert got == [None, None, "fortnightly", None, "monthly", "weekly"]


def test_mean_over_present_months(spark):
    rows = [(1, D(2024, 7, 1), "loan", -1000, "EXP-057"), (1, D(2024, 9, 1), "loan", -2001, "EXP-057"), (1, D(2024, 12, 1), "x", 5, "INC-007")]
    m = metrics.customer_metrics(tx(spark, rows)).first()
    assert m.ME008 == 15.01 and m.ME009 == 1 and m.ME010 is None and m.ME028 is True


def test_salary_change(spark):
    stopped = [(1, D(2024, 8, 1), "old job", 100, "INC-009"), (1, D(2024, 12, 1), "new job", 100, "INC-009")]
    new_only = [(2, D(2024, 11, 20), "one", 100, "INC-009"), (2, D(2024, 12, 1), "two", 100, "INC-009")]
    got = {r.customer_id: r.ME022 for r in metrics.customer_metrics(tx(spark, stopped + new_only)).collect()}
    assert got == {1: True, 2: False}


def test_customer_without_dates_stays(spark):
    m = metrics.customer_metrics(tx(spark, [(7, None, "x", -5, "EXP-016")])).first()
    assert m.customer_id == 7 and m.ME034 == 0.0 and m.ME028 is True and m.ME003 == 0


def test_nulls_and_accounts(spark):
    rows = [(1, D(2024, 12, 1), None, -500, "EXP-033"), (1, D(2024, 12, 2), "lender", -500, "EXP-033"), (1, D(2024, 12, 3), "m", -900, "EXP-056"),
            (1, D(2024, 12, 4), "pay", 1000, None)]
    acc = spark.createDataFrame([(1, ["100.50", "2"], None, True)], "customer_id long, l array<string>, b array<string>, has_mortgage_account boolean") \
        .select("customer_id", F.col("l").cast("array<decimal(18,2)>").alias("credit_card_limits"),
                F.col("b").cast("array<decimal(18,2)>").alias("credit_card_balances"), "has_mortgage_account")
    m = metrics.customer_metrics(tx(spark, rows), acc).first()
    assert (m.ME009, m.ME017, m.ME010, m.ME011, m.ME047, m.ME042) == (3, 2, 102.5, 0.0, False, 0)
    assert len([c for c in m.asDict() if c.startswith("ME")]) == 46


def test_required_columns(spark):
    import pytest

    with pytest.raises(ValueError, match="code"):
        metrics.prepare(tx(spark, [(1, None, "x", 1, "c")]).drop("code"))
