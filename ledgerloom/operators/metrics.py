"""The 46 customer metrics (MET0 and its parts) for all customers in one job.

The transactions are read once, into partial sums per customer, day, category and source
(``partials``), combined map-side before the shuffle. Partial sums add up (``merge``): they can be
kept, new files add theirs, and the metrics at any date follow from them alone. From there on:

1. (customer, day): one row per customer and day, whatever the number of transactions. The
   reporting window, months and run lengths work on this small table.
2. (customer, category, merchant, month) for credits, lenders and salary only: source counts
   and rhythms. The window end of a customer comes in by a salted join.
3. the results meet on customer_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import tables
from ..config import MetricParams
from ..functions.text import merchant_key
from ..functions.values import cents_to_money, half_up_div
from .series import (frequency, is_secure, is_stable, mean_money, median_money, month,
                     run_columns, run_length)
from .skew import attach
from .stage import written

REQUIRED = ["customer_id", "tx_id", "tx_date", "description", "cents", "code"]

FLAGS = {"ME023": "INC-021", "ME024": "INC-010", "ME025": "EXP-003", "ME026": "EXP-029",
         "ME028": "EXP-016", "ME029": "EXP-036", "ME030": "EXP-040", "ME031": "INC-016",
         "ME032": "INC-002", "ME047": "EXP-056"}
MISSING = ("ME028", "ME029", "ME030")

GROUPS = {
    "expense": ["ME012", "ME013", "ME014", "ME015", "ME016", "ME034", "ME039"],
    "income": ["ME001", "ME002", "ME003", "ME004", "ME033", "ME035", "ME036", "ME037",
               "ME040", "ME041", "ME042", "ME043", "ME045"],
    "commitments": ["ME008", "ME009", "ME010", "ME011", "ME046", "ME048"],
    "government": ["ME005", "ME006", "ME007"],
    "flags": ["ME022", "ME023", "ME024", "ME025", "ME026", "ME027", "ME028", "ME029",
              "ME030", "ME031", "ME032", "ME047"],
    "risk": ["ME017", "ME018", "ME019", "ME020", "ME021"],
}


def prepare(tx: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """PRJ11: rename known aliases, then check the required columns before anything runs."""
    for old, new in (aliases or {"category_code": "code"}).items():
        if old in tx.columns and new not in tx.columns:
            tx = tx.withColumnRenamed(old, new)
    missing = [c for c in REQUIRED if c not in tx.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return tx


def _in(codes) -> Column:
    return F.coalesce(F.col("code").isin(*codes), F.lit(False))


# -- partial sums --------------------------------------------------------------------

SOURCE = ["customer_id", "tx_date", "code", "merchant"]
SUMS = ["debit_c", "debit_n", "credit_c", "credit_n", "n"]
PARTIAL_SCHEMA = "customer_id bigint, tx_date date, code string, merchant string, " + ", ".join(f"{c} bigint" for c in SUMS)


def _lends(p: MetricParams) -> Column:
    return _in((*tables.CLASSES["lender_categories"], *p.small_loans))


def partials(tx: DataFrame, params: MetricParams = MetricParams()) -> DataFrame:
    """Cents and rows of debits and credits, and all rows, per customer, day, category and source.

    Only credits, salary, lenders and small loans keep their merchant; the other rows of a category
    and day are one. The result serves all parameters that name the same salary and small loan codes.
    """
    tx, cents = prepare(tx), F.col("cents")
    sourced = (cents > 0) | _in(params.salary) | ((cents < 0) & _lends(params))
    return tx.groupBy("customer_id", "tx_date", "code", F.when(sourced, merchant_key(F.col("description"))).alias("merchant")).agg(
        F.sum(F.when(cents < 0, -cents)).alias("debit_c"), F.count_if(cents < 0).alias("debit_n"),
        F.sum(F.when(cents > 0, cents)).alias("credit_c"), F.count_if(cents > 0).alias("credit_n"),
        F.count(F.lit(1)).alias("n"))


def merge(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Partial sums of several sets of transactions as those of their union."""
    for other in others:
        first = first.unionByName(other)
    return first.groupBy(*SOURCE).agg(*[F.sum(c).alias(c) for c in SUMS])


def _series(p: MetricParams) -> dict[str, tuple[str, Column]]:
    """The money series: debits or credits of which categories."""
    k, every = tables.CLASSES, F.lit(True)
    return {
        "nondisc": ("debit", _in(k["non_discretionary"])), "disc": ("debit", _in(k["discretionary"])),
        "other": ("debit", _in(k["other_expenses"])), "debit": ("debit", every),
        "free": ("debit", ~_in(k["liabilities"])), "credit": ("credit", every),
        "salary": ("credit", _in(p.salary)), "side": ("credit", _in(p.other_income)),
        "income": ("credit", _in(p.income)), "youth": ("credit", _in(p.youth)),
        "rental": ("credit", _in(p.rental)), "benefit": ("credit", _in(p.benefits)),
        "lender": ("debit", _in(k["lender_categories"])), "mortgage": ("debit", _in(p.mortgage)),
        "atm": ("debit", _in(p.atm)), "risky": ("debit", _in(p.high_risk)),
    }


def _count(n: str, cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, F.col(n))), F.lit(0).cast("bigint"))


def daily(parts: DataFrame, p: MetricParams = MetricParams()) -> DataFrame:
    """Pass 1: cents and row counts of every series per customer and day."""
    aggs = []
    for name, (side, cond) in _series(p).items():
        aggs += [F.sum(F.when(cond, F.col(f"{side}_c"))).alias(f"{name}_c"), _count(f"{side}_n", cond).alias(f"{name}_n")]
    for metric, code in FLAGS.items():
        aggs.append(_count("n", _in([code])).alias(metric))
    aggs += [_count("debit_n", _in(tables.CLASSES["high_cost_lenders"])).alias("ME027"),
             _count("n", _in(p.dishonours)).alias("ME019")]
    return parts.groupBy("customer_id", "tx_date").agg(*aggs)


def _windowed(days: DataFrame, p: MetricParams) -> DataFrame:
    """Days outside the reporting window keep their customer but lose their counts."""
    end = F.max("tx_date").over(W.partitionBy("customer_id"))
    return days.withColumn("_in", F.coalesce(
        F.col("tx_date") >= F.date_sub(end, p.period_days), F.lit(False)))


def _base(parts: DataFrame, p: MetricParams) -> DataFrame:
    """All metrics that need only days and months."""
    days = _windowed(daily(parts, p), p)
    names = list(_series(p))
    counts = [*FLAGS, "ME027", "ME019"]
    keep = F.col("_in")
    mort = keep & (F.col("mortgage_n") > 0)
    months = days.groupBy("customer_id", month(F.col("tx_date")).alias("month")).agg(
        *[F.sum(F.when(keep, F.col(f"{s}_c"))).alias(f"{s}_c") for s in names],
        *[F.coalesce(F.sum(F.when(keep, F.col(f"{s}_n"))), F.lit(0)).alias(f"{s}_n") for s in names],
        *[F.coalesce(F.sum(F.when(keep, F.col(c))), F.lit(0)).alias(c) for c in counts],
        F.min(F.when(mort, F.col("tx_date"))).alias("mort_first"),
        F.max(F.when(mort, F.col("tx_date"))).alias("mort_last"))
    runs = {**run_columns("stable", F.col("salary_c"), F.col("salary_n") > 0, is_stable, p.stable_percent),
            **run_columns("secure", F.col("income_c"), F.col("income_n") > 0, is_secure, p.stable_percent)}
    total = {s: F.coalesce(F.sum(f"{s}_c"), F.lit(0)) for s in names}
    present = {s: F.count_if(F.col(f"{s}_n") > 0) for s in names}
    one = months.withColumns(runs).groupBy("customer_id").agg(
        *[total[s].alias(f"{s}_c") for s in names], *[present[s].alias(f"{s}_m") for s in names],
        *[F.sum(c).alias(c) for c in counts],
        run_length("stable").alias("ME003"), run_length("secure").alias("ME045"),
        median_money(F.when(F.col("salary_n") > 0, F.col("salary_c"))).alias("ME036"),
        F.sum("mortgage_n").alias("mort_n"), F.min("mort_first").alias("mort_first"),
        F.max("mort_last").alias("mort_last"))

    def mean(s):
        return mean_money(F.col(f"{s}_c"), F.col(f"{s}_m"))

    def big(name):
        return F.col(name).cast("decimal(38,0)")

    def percent(num, den):
        return cents_to_money(half_up_div(num * 10000, den))

    nd = big("nondisc_c") * F.greatest("disc_m", F.lit(1))
    di = big("disc_c") * F.greatest("nondisc_m", F.lit(1))
    rhythm = frequency(F.col("mort_n"), F.col("mort_first"), F.col("mort_last"), p)
    return one.select(
        "customer_id",
        mean("salary").alias("ME002"), F.col("ME003").cast("int"), mean("side").alias("ME004"),
        mean("youth").alias("ME005"), mean("rental").alias("ME006"), mean("benefit").alias("ME007"),
        mean("lender").alias("ME008"), mean("nondisc").alias("ME012"),
        percent(nd, nd + di).alias("ME013"), mean("disc").alias("ME014"),
        percent(di, nd + di).alias("ME015"), mean("other").alias("ME016"),
        percent(big("atm_c"), big("credit_c")).alias("ME018"), F.col("ME019").cast("int"),
        percent(big("risky_c"), big("credit_c")).alias("ME020"),
        cents_to_money(F.col("risky_c")).alias("ME021"), "ME036",
        *[((F.col(m) == 0) if m in MISSING else (F.col(m) > 0)).alias(m)
          for m in [*FLAGS, "ME027"]],
        mean("debit").alias("ME034"), mean("free").alias("ME039"), mean("income").alias("ME040"),
        F.col("ME045").cast("int"),
        F.when(rhythm.isNotNull(), mean("mortgage")).otherwise(F.lit(0.0)).alias("ME048"))


def _source_rows(parts: DataFrame, p: MetricParams) -> DataFrame:
    wanted = (F.col("credit_n") > 0) | _in(p.salary) | ((F.col("debit_n") > 0) & _lends(p))
    return parts.filter(F.col("tx_date").isNotNull() & wanted)


def _ends(parts: DataFrame, p: MetricParams) -> DataFrame:
    """Window end, newest credit and newest salary in the window, per customer."""
    days = (parts.filter(F.col("tx_date").isNotNull()).groupBy("customer_id", "tx_date")
            .agg(F.max(F.col("credit_n") > 0).alias("credit"), F.max(_in(p.salary)).alias("salary"),
                 F.count(F.lit(1)).alias("_n")))
    w = _windowed(days, p)
    return w.groupBy("customer_id").agg(
        F.max("tx_date").alias("end"), F.sum("_n").alias("_n"),
        F.max(F.when(F.col("_in") & F.col("credit"), F.col("tx_date"))).alias("end_credit"),
        F.max(F.when(F.col("_in") & F.col("salary"), F.col("tx_date"))).alias("end_salary"))


def _sources(parts: DataFrame, p: MetricParams) -> DataFrame:
    """Pass 2: metrics over (category, merchant) sources."""
    ends = _ends(parts, p)
    rows = (attach(_source_rows(parts, p), ends.drop("_n"), ["customer_id"], ["tx_date", "code", "merchant"], counts=ends)
            .filter(F.col("tx_date") >= F.date_sub("end", p.period_days)))
    d = F.col("tx_date")
    lend, salary = _in(tables.CLASSES["lender_categories"]), _in(p.salary)
    ends_cols = [F.max(c).alias(c) for c in ("end", "end_credit", "end_salary")]

    def span(name, n, cond):
        met = cond & (F.col(n) > 0)
        return [_count(n, cond).alias(f"{name}_n"), F.min(F.when(met, d)).alias(f"{name}_first"),
                F.max(F.when(met, d)).alias(f"{name}_last")]

    by_month = rows.groupBy("customer_id", "code", "merchant", month(d).alias("month")).agg(
        *span("credit", "credit_n", F.lit(True)), *span("lend", "debit_n", lend), *span("salary", "n", salary),
        _count("debit_n", _in(p.small_loans)).alias("small_n"),
        F.sum(F.when(lend, F.col("debit_c"))).alias("lend_c"), *ends_cols)

    def merged(name):
        return [F.sum(f"{name}_n").alias(f"{name}_n"), F.min(f"{name}_first").alias(f"{name}_first"),
                F.max(f"{name}_last").alias(f"{name}_last")]

    # At most seven months fall into the window, so the list per source is short.
    source = by_month.groupBy("customer_id", "code", "merchant").agg(
        *merged("credit"), *merged("lend"), *merged("salary"), F.sum("small_n").alias("small_n"),
        F.collect_list(F.when(F.col("lend_n") > 0, F.struct("month", "lend_c"))).alias("lend_months"),
        *ends_cols)
    named = F.col("code").isNotNull() & F.col("merchant").isNotNull()

    def rhythm(name):
        return frequency(F.col(f"{name}_n"), F.col(f"{name}_first"), F.col(f"{name}_last"), p).isNotNull()

    facts = source.select(
        "customer_id", "merchant", "end", "end_salary", "salary_n", "salary_first", "salary_last",
        (named & _in(p.salary) & (F.col("credit_n") > 0)).cast("int").alias("ME001"),
        F.coalesce(named & (F.col("credit_last") >= F.date_sub("end_credit", p.recent_days)),
                   F.lit(False)).cast("int").alias("ME042"),
        (named & rhythm("credit")).cast("int").alias("ME043"),
        (F.col("lend_n") > 0).alias("lends"), (F.col("small_n") > 0).alias("small"))
    merchants = facts.groupBy("customer_id", "merchant").agg(
        F.sum("ME001").alias("ME001"), F.sum("ME042").alias("ME042"), F.sum("ME043").alias("ME043"),
        F.max("lends").cast("int").alias("ME009"), F.max("small").cast("int").alias("ME017"),
        (F.coalesce(F.min("salary_first") < F.date_sub(F.max("end"), p.recent_days), F.lit(False))
         & ~F.coalesce(F.max("salary_last") >= F.date_sub(F.max("end_salary"), p.recent_days),
                       F.lit(False))).alias("ME022"))
    counts = ["ME001", "ME009", "ME017", "ME042", "ME043"]
    numbers = merchants.groupBy("customer_id").agg(
        *[F.sum(c).cast("int").alias(c) for c in counts], F.max("ME022").alias("ME022"))
    lenders = (source.filter(named & rhythm("lend"))
               .select("customer_id", F.explode("lend_months").alias("m"))
               .groupBy("customer_id", F.col("m.month").alias("month"))
               .agg(F.sum("m.lend_c").alias("c"))
               .groupBy("customer_id").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n"))
               .select("customer_id", mean_money(F.col("c"), F.col("n")).alias("ME046")))
    return numbers.join(lenders, "customer_id", "left")


def customer_metrics(tx: DataFrame, accounts: DataFrame | None = None,
                     params: MetricParams = MetricParams(),
                     calculated_at: str | None = None) -> DataFrame:
    """MET0: one row per customer, metrics in id order.

    ``tx`` needs REQUIRED columns; ``cents`` is signed. ``accounts`` is the optional side table
    (customer_id, credit_card_limits, credit_card_balances, has_mortgage_account). ``tx`` is
    read once where the session names a shared folder for the partial sums between.
    """
    return metrics_at(written(partials(tx, params)), None, accounts, params, calculated_at)


def metrics_at(parts: DataFrame, as_of=None, accounts: DataFrame | None = None, params: MetricParams = MetricParams(),
               calculated_at: str | None = None) -> DataFrame:
    """MET0 from partial sums, without the transactions. With ``as_of`` (a date or its text) what is
    dated later is left out, as if it had not come yet; customers known only from then on have no row,
    undated rows stay."""
    if as_of is not None:
        parts = parts.filter(F.coalesce(F.col("tx_date") <= F.lit(as_of).cast("date"), F.lit(True)))
    out = _base(parts, params).join(_sources(parts, params), "customer_id", "left")
    if accounts is None:
        out = out.withColumns({"ME010": F.lit(None).cast("double"),
                               "ME011": F.lit(None).cast("double")})
    else:
        def total(c):
            return F.aggregate(F.coalesce(c, F.array().cast("array<decimal(18,2)>")),
                               F.lit(0).cast("decimal(28,2)"),
                               lambda a, x: (a + x).cast("decimal(28,2)")).cast("double")

        side = accounts.select(
            "customer_id",
            F.when(F.col("credit_card_limits").isNotNull() | F.col("credit_card_balances").isNotNull()
                   | F.col("has_mortgage_account").isNotNull(), F.lit(True)).alias("_given"),
            total(F.col("credit_card_limits")).alias("_limits"),
            total(F.col("credit_card_balances")).alias("_balances"),
            F.coalesce("has_mortgage_account", F.lit(False)).alias("_shared"))
        out = out.join(side, "customer_id", "left").withColumns({
            "ME010": F.when(F.col("_given"), F.col("_limits")),
            "ME011": F.when(F.col("_given"), F.col("_balances")),
            "ME047": F.col("ME047") & ~F.coalesce("_shared", F.lit(False))})
    zero = F.lit(0)
    filled = {c: F.coalesce(c, zero) for c in ("ME001", "ME009", "ME017", "ME042", "ME043")}
    same = {"ME033": "ME002", "ME035": "ME003", "ME037": "ME036", "ME041": "ME034"}
    out = out.withColumns({**filled, "ME022": F.coalesce("ME022", F.lit(False)),
                           "ME046": F.coalesce("ME046", F.lit(0.0)),
                           **{a: F.col(b) for a, b in same.items()}})
    at = F.lit(calculated_at) if calculated_at else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    ids = [m[0] for m in tables.METRIC_DEFS]
    fields = [F.col(m).alias(m, metadata={"name": n, "type": t}) for m, n, t in tables.METRIC_DEFS]
    assert len(ids) == 46
    return out.select("customer_id", F.lit(params.period_days).alias("reporting_period_days"),
                      at.alias("calculation_date"), *fields)


def metric_group(metrics: DataFrame, group: str) -> DataFrame:
    """The metrics of one section; unused branches of the plan fall away."""
    return metrics.select("customer_id", *GROUPS[group])


def portfolio_summary(metrics: DataFrame) -> DataFrame:
    """AGG21: one row over all customers."""
    return metrics.agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(_cents("ME033")).alias("salary_cents"), F.sum(_cents("ME034")).alias("outgoing_cents"),
        F.count_if(F.col("ME017") > 0).alias("with_small_loans"),
        F.count_if(F.col("ME019") > 0).alias("with_dishonours"),
        F.count_if("ME031").alias("with_unemployment")).withColumns({
            "mean_salary": mean_money(F.col("salary_cents"), F.col("customers")),
            "mean_outgoings": mean_money(F.col("outgoing_cents"), F.col("customers"))})


def _cents(metric: str) -> Column:
    return F.round(F.col(metric) * 100).cast("bigint")
