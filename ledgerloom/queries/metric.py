"""Windows, monthly series, run lengths and the customer metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import tables
from ..config import MetricParams
from ..operators import filters, metrics, series
from ..operators.stage import written
from .base import literal, sql, transactions
from .registry import query

P = MetricParams()

LAST = "last AS (SELECT customer_id, max(tx_date) AS stop FROM tx GROUP BY 1)"
WIN = """win AS (SELECT tx.* FROM tx JOIN last USING (customer_id)
  WHERE tx_date BETWEEN stop - 180 AND stop)"""
MONTHLY = """monthly AS (SELECT customer_id, strftime(tx_date, '%Y-%m') AS month,
  CAST(sum(cents) AS BIGINT) AS total FROM tx WHERE cents > 0 GROUP BY 1, 2)"""


def day(c="tx_date"):
    return F.date_format(c, "yyyy-MM-dd").alias(c)


@query("flt1_reporting_window", sql("""SELECT tx_id, customer_id, strftime(tx_date, '%Y-%m-%d') AS tx_date,
  cents FROM win""", LAST, WIN))
def flt1(spark, sf):
    return filters.reporting_window(transactions(spark, sf)).select("tx_id", "customer_id", day(), "cents")


@query("flt2_recent_window", sql("""SELECT tx_id, customer_id, strftime(tx_date, '%Y-%m-%d') AS tx_date
  FROM tx JOIN (SELECT customer_id, max(tx_date) AS stop FROM tx WHERE cents > 0 GROUP BY 1)
  USING (customer_id) WHERE cents > 0 AND tx_date >= stop - 60"""))
def flt2(spark, sf):
    income, _ = filters.split_by_sign(transactions(spark, sf))
    return filters.recent_window(income).select("tx_id", "customer_id", day())


@query("flt3_income_expense", sql("""SELECT customer_id, CAST(coalesce(sum(cents) FILTER (cents > 0), 0) AS BIGINT)
  AS income_cents, CAST(coalesce(sum(-cents) FILTER (cents < 0), 0) AS BIGINT) AS expense_cents FROM tx GROUP BY 1"""))
def flt3(spark, sf):
    income, expense = filters.split_by_sign(transactions(spark, sf))
    both = income.select("customer_id", "cents", F.lit(0).alias("out")).unionByName(
        expense.select("customer_id", F.lit(0).alias("cents"), F.col("cents").alias("out")))
    return both.groupBy("customer_id").agg(F.sum("cents").alias("income_cents"),
                                           F.sum("out").alias("expense_cents"))


def codes(name):
    return "(" + ", ".join(literal(c) for c in tables.CLASSES[name]) + ")"


@query("flt4_class_membership", sql("SELECT code, count(*) AS n, " + ", ".join(
    f"count(*) FILTER (code IN {codes(k)}) AS {k}" for k in tables.CLASSES) + " FROM tx GROUP BY 1"))
def flt4(spark, sf):
    return transactions(spark, sf).groupBy("code").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(filters.in_class(F.col("code"), k)).alias(k) for k in tables.CLASSES])


def credits(spark, sf):
    return filters.split_by_sign(transactions(spark, sf))[0]


@query("agg1_monthly_totals", sql("SELECT * FROM monthly", MONTHLY))
def agg1(spark, sf):
    return series.monthly_totals(credits(spark, sf))


@query("agg2_calendar_months", sql("""SELECT customer_id, string_agg(month, ',' ORDER BY month) AS months FROM
  (SELECT DISTINCT customer_id, strftime(tx_date, '%Y-%m') AS month FROM tx) GROUP BY 1"""))
def agg2(spark, sf):
    return series.calendar_months(transactions(spark, sf)).withColumn("months", F.array_join("months", ","))


@query("agg3_mean_monthly", sql("""SELECT customer_id, ((2 * sum(total) + count(*)) // (2 * count(*))) / 100.0
  AS mean_monthly FROM monthly GROUP BY 1""", MONTHLY))
def agg3(spark, sf):
    return series.mean_monthly(series.monthly_totals(credits(spark, sf)))


@query("agg4_median_monthly", sql("""SELECT customer_id,
  CAST(CASE WHEN n % 2 = 1 THEN l[n // 2 + 1] ELSE (l[n // 2] + l[n // 2 + 1] + 1) // 2 END AS BIGINT) / 100.0
  AS median_monthly FROM (SELECT customer_id, list(total ORDER BY total) AS l, count(*) AS n
  FROM monthly GROUP BY 1)""", MONTHLY))
def agg4(spark, sf):
    return series.median_monthly(series.monthly_totals(credits(spark, sf)))


@query("agg5_unique_merchants", sql("""SELECT customer_id, count(DISTINCT trim(lower(description))) AS merchants
  FROM tx GROUP BY 1"""))
def agg5(spark, sf):
    return series.unique_merchants(transactions(spark, sf))


@query("agg6_income_sources", sql("""SELECT customer_id, count(DISTINCT code || '|' || trim(lower(description)))
  AS sources FROM tx WHERE cents > 0 GROUP BY 1"""))
def agg6(spark, sf):
    return series.income_sources(credits(spark, sf))


FREQ = """freq AS (SELECT customer_id, code, trim(lower(description)) AS merchant_key, count(*) AS n,
  date_diff('day', min(tx_date), max(tx_date)) AS gap FROM {src} GROUP BY 1, 2, 3)"""
NAME = """CASE WHEN n < 3 THEN NULL WHEN gap * 1.0 / (n - 1) BETWEEN 3 AND 9 THEN 'weekly'
  WHEN gap * 1.0 / (n - 1) BETWEEN 10 AND 17 THEN 'fortnightly'
  WHEN gap * 1.0 / (n - 1) BETWEEN 25 AND 35 THEN 'monthly' END"""


@query("agg7_frequency", sql(f"SELECT customer_id, code, merchant_key, n, {NAME} AS frequency FROM freq",
                             FREQ.format(src="tx")))
def agg7(spark, sf):
    return series.source_frequency(transactions(spark, sf)).select(
        "customer_id", "code", "merchant_key", "n", "frequency")


# Recursive walk from the newest month, unlike the window form under test.
WALK = """ranked AS (SELECT customer_id, total, lead(total) OVER w AS prev, row_number() OVER w AS pos
    FROM {src} WINDOW w AS (PARTITION BY customer_id ORDER BY month DESC)),
  walk AS (SELECT customer_id, pos, total, prev FROM ranked WHERE pos = 1
    UNION ALL SELECT r.customer_id, r.pos, r.total, r.prev FROM walk w JOIN ranked r
    ON r.customer_id = w.customer_id AND r.pos = w.pos + 1 WHERE {ok}),
  {name} AS (SELECT customer_id, max(pos) AS months FROM walk GROUP BY 1)"""
STABLE = "CASE WHEN w.prev = 0 THEN w.total = 0 ELSE abs(w.total - w.prev) * 10 <= abs(w.prev) END"
SECURE = "CASE WHEN w.prev = 0 THEN w.total >= 0 ELSE (w.total - w.prev) * 10 >= -abs(w.prev) END"


def recursive(statement):
    return statement.replace("WITH ", "WITH RECURSIVE ", 1)


SALARY_MONTHS = """salary_m AS (SELECT customer_id, strftime(tx_date, '%Y-%m') AS month,
  CAST(sum(cents) AS BIGINT) AS total FROM tx WHERE cents > 0 AND code = 'INC-009' GROUP BY 1, 2)"""


@query("win1_stability_run", recursive(sql(
    "SELECT customer_id, CAST(months AS BIGINT) AS stable_months FROM st", SALARY_MONTHS,
    WALK.format(src="salary_m", ok=STABLE, name="st"))))
def win1(spark, sf):
    salary = credits(spark, sf).filter(F.col("code") == "INC-009")
    return series.stability_months(series.monthly_totals(salary))


@query("win2_security_run", recursive(sql(
    "SELECT customer_id, CAST(months AS BIGINT) AS secure_months FROM se", MONTHLY,
    WALK.format(src="monthly", ok=SECURE, name="se"))))
def win2(spark, sf):
    return series.security_months(series.monthly_totals(credits(spark, sf)))


# -- customer metrics ----------------------------------------------------------------

def group_means(**conds):
    """One grouped subquery per metric instead of correlated ones."""
    parts = []
    for name, cond in conds.items():
        parts.append(f"""{name}_m AS (SELECT customer_id, CAST(sum(t) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n,
          ((2 * sum(t) + count(*)) // (2 * count(*))) / 100.0 AS v FROM
          (SELECT customer_id, strftime(tx_date, '%Y-%m') AS mm, CAST(sum(abs(cents)) AS HUGEINT) AS t
           FROM win WHERE {cond} GROUP BY 1, 2) GROUP BY 1)""")
    return parts


CUST = "c AS (SELECT DISTINCT customer_id FROM tx)"


def joins(*names):
    return " ".join(f"LEFT JOIN {n} USING (customer_id)" for n in names)


EXPENSE = group_means(
    nd=f"cents < 0 AND code IN {codes('non_discretionary')}", di=f"cents < 0 AND code IN {codes('discretionary')}",
    ot=f"cents < 0 AND code IN {codes('other_expenses')}", al="cents < 0",
    fr=f"cents < 0 AND code NOT IN {codes('liabilities')}")


def pct(num, den):
    return f"coalesce(((2 * 10000 * ({num}) + ({den})) // nullif(2 * ({den}), 0)) / 100.0, 0.0)"


ND = "coalesce(nd_m.s, 0) * coalesce(di_m.n, 1)"
DI = "coalesce(di_m.s, 0) * coalesce(nd_m.n, 1)"
EXPENSE_COLS = f"""coalesce(nd_m.v, 0.0) AS ME012, {pct(ND, ND + ' + ' + DI)} AS ME013, coalesce(di_m.v, 0.0) AS ME014,
  {pct(DI, ND + ' + ' + DI)} AS ME015, coalesce(ot_m.v, 0.0) AS ME016, coalesce(al_m.v, 0.0) AS ME034,
  coalesce(fr_m.v, 0.0) AS ME039"""
EXPENSE_JOINS = joins("nd_m", "di_m", "ot_m", "al_m", "fr_m")


def all_metrics(spark, sf, accounts=None):
    return metrics.customer_metrics(transactions(spark, sf), accounts, P, "fixed")


@query("met_expense", sql(f"SELECT customer_id, {EXPENSE_COLS} FROM c {EXPENSE_JOINS}", LAST, WIN, CUST, *EXPENSE))
def met_expense(spark, sf):
    return metrics.metric_group(all_metrics(spark, sf), "expense")


INCOME_CODES = "(" + ", ".join(literal(c) for c in P.income) + ")"
SIDE_CODES = "(" + ", ".join(literal(c) for c in P.other_income) + ")"
INCOME = [
    *group_means(sa="cents > 0 AND code = 'INC-009'", si=f"cents > 0 AND code IN {SIDE_CODES}",
                 inc=f"cents > 0 AND code IN {INCOME_CODES}", deb="cents < 0"),
    """sal_mo AS (SELECT customer_id, strftime(tx_date, '%Y-%m') AS month, CAST(sum(cents) AS BIGINT) AS total
      FROM win WHERE cents > 0 AND code = 'INC-009' GROUP BY 1, 2)""",
    f"""inc_mo AS (SELECT customer_id, strftime(tx_date, '%Y-%m') AS month, CAST(sum(cents) AS BIGINT) AS total
      FROM win WHERE cents > 0 AND code IN {INCOME_CODES} GROUP BY 1, 2)""",
    """med AS (SELECT customer_id, CAST(CASE WHEN n % 2 = 1 THEN l[n // 2 + 1]
      ELSE (l[n // 2] + l[n // 2 + 1] + 1) // 2 END AS BIGINT) / 100.0 AS v FROM
      (SELECT customer_id, list(total ORDER BY total) AS l, count(*) AS n FROM sal_mo GROUP BY 1))""",
    WALK.format(src="sal_mo", ok=STABLE, name="stab"),
    WALK.format(src="inc_mo", ok=SECURE, name="sec").replace("ranked", "ranked2").replace("walk", "walk2"),
    """src1 AS (SELECT customer_id, count(DISTINCT code || '|' || trim(lower(description))) AS n FROM win
      WHERE cents > 0 AND code = 'INC-009' GROUP BY 1)""",
    """src42 AS (SELECT customer_id, count(DISTINCT code || '|' || trim(lower(description))) AS n FROM win
      JOIN (SELECT customer_id, max(tx_date) AS lc FROM win WHERE cents > 0 GROUP BY 1) USING (customer_id)
      WHERE cents > 0 AND tx_date >= lc - 60 GROUP BY 1)""",
    "winc AS (SELECT * FROM win WHERE cents > 0)", FREQ.format(src="winc"),
    f"src43 AS (SELECT customer_id, count(*) AS n FROM freq WHERE {NAME} IS NOT NULL GROUP BY 1)",
]
INCOME_COLS = """coalesce(src1.n, 0) AS ME001, coalesce(sa_m.v, 0.0) AS ME002, coalesce(stab.months, 0) AS ME003,
  coalesce(si_m.v, 0.0) AS ME004, coalesce(sa_m.v, 0.0) AS ME033, coalesce(stab.months, 0) AS ME035,
  coalesce(med.v, 0.0) AS ME036, coalesce(med.v, 0.0) AS ME037, coalesce(inc_m.v, 0.0) AS ME040,
  coalesce(deb_m.v, 0.0) AS ME041, coalesce(src42.n, 0) AS ME042, coalesce(src43.n, 0) AS ME043,
  coalesce(sec.months, 0) AS ME045"""
INCOME_JOINS = joins("src1", "sa_m", "stab", "si_m", "med", "inc_m", "deb_m", "src42", "src43", "sec")


@query("met_income", recursive(sql(f"SELECT customer_id, {INCOME_COLS} FROM c {INCOME_JOINS}",
                                   LAST, WIN, CUST, *INCOME)))
def met_income(spark, sf):
    return metrics.metric_group(all_metrics(spark, sf), "income")


def accounts(spark, sf):
    """Side table from the customers' ids: limits for some, balances for fewer."""
    from .base import users

    d = "decimal(18,2)"
    return users(spark, sf).select(
        F.when(F.col("user_id") % 3 == 0, F.col("user_id")).otherwise(-1 - F.col("user_id")).alias("customer_id"),
        F.array((F.col("user_id") * 10 + 500).cast(d), F.lit("1000.50").cast(d)).alias("credit_card_limits"),
        F.when(F.col("user_id") % 2 == 0, F.array((F.col("user_id") + 0).cast(d))).alias("credit_card_balances"),
        (F.col("user_id") % 6 == 0).alias("has_mortgage_account"))


LENDERS = codes("lender_categories")
COMMIT = [
    *group_means(le=f"cents < 0 AND code IN {LENDERS}", mo="cents < 0 AND code = 'EXP-056'"),
    f"""lm AS (SELECT customer_id, count(DISTINCT trim(lower(description))) AS n FROM win
      WHERE cents < 0 AND code IN {LENDERS} GROUP BY 1)""",
    f"winl AS (SELECT * FROM win WHERE cents < 0 AND code IN {LENDERS})",
    FREQ.format(src="winl").replace("freq AS", "freql AS"),
    f"""on_m AS (SELECT customer_id, ((2 * sum(t) + count(*)) // (2 * count(*))) / 100.0 AS v FROM
      (SELECT w.customer_id, strftime(tx_date, '%Y-%m') AS mm, CAST(sum(-cents) AS HUGEINT) AS t FROM winl w
       JOIN freql f ON f.customer_id = w.customer_id AND f.code = w.code
        AND f.merchant_key = trim(lower(w.description)) AND {NAME} IS NOT NULL GROUP BY 1, 2) GROUP BY 1)""",
    """mf AS (SELECT customer_id, count(*) AS n, date_diff('day', min(tx_date), max(tx_date)) AS gap
      FROM win WHERE cents < 0 AND code = 'EXP-056' GROUP BY 1)""",
]
COMMIT_COLS = f"""coalesce(le_m.v, 0.0) AS ME008, coalesce(lm.n, 0) AS ME009,
  CASE WHEN customer_id % 3 = 0 THEN customer_id * 10 + 1500.5 END AS ME010,
  CASE WHEN customer_id % 3 = 0 THEN CASE WHEN customer_id % 2 = 0 THEN customer_id * 1.0 ELSE 0.0 END END AS ME011,
  coalesce(on_m.v, 0.0) AS ME046,
  CASE WHEN (SELECT {NAME}) IS NOT NULL THEN coalesce(mo_m.v, 0.0) ELSE 0.0 END AS ME048""".replace(
    f"(SELECT {NAME})", NAME.replace("n <", "mf.n <").replace("(n - 1)", "(mf.n - 1)").replace("gap", "mf.gap"))
COMMIT_JOINS = joins("le_m", "lm", "on_m", "mo_m", "mf")


@query("met_commitments", sql(f"""SELECT customer_id, ME008, ME009, CAST(ME010 AS DOUBLE) AS ME010,
  CAST(ME011 AS DOUBLE) AS ME011, ME046, ME048 FROM (SELECT customer_id, {COMMIT_COLS} FROM c {COMMIT_JOINS})""",
                              LAST, WIN, CUST, *COMMIT))
def met_commitments(spark, sf):
    return metrics.metric_group(all_metrics(spark, sf, accounts(spark, sf)), "commitments")


BENEFITS = "(" + ", ".join(literal(c) for c in P.benefits) + ")"
GOV = group_means(yo="cents > 0 AND code = 'INC-012'", ra="cents > 0 AND code = 'INC-013'",
                  be=f"cents > 0 AND code IN {BENEFITS}")
GOV_COLS = "coalesce(yo_m.v, 0.0) AS ME005, coalesce(ra_m.v, 0.0) AS ME006, coalesce(be_m.v, 0.0) AS ME007"


@query("met_government", sql(f"SELECT customer_id, {GOV_COLS} FROM c {joins('yo_m', 'ra_m', 'be_m')}",
                             LAST, WIN, CUST, *GOV))
def met_government(spark, sf):
    return metrics.metric_group(all_metrics(spark, sf), "government")


FLAG_CTES = [
    "has AS (SELECT customer_id, " + ", ".join(
        f"count(*) FILTER (code = '{code}') AS n_{m}" for m, code in metrics.FLAGS.items())
    + f", count(*) FILTER (cents < 0 AND code IN {codes('high_cost_lenders')}) AS n_ME027 FROM win GROUP BY 1)",
    """sw AS (SELECT customer_id, trim(lower(description)) AS m, tx_date FROM win WHERE code = 'INC-009')""",
    """chg AS (SELECT DISTINCT a.customer_id FROM sw a JOIN last USING (customer_id) WHERE a.tx_date < stop - 60
      AND NOT EXISTS (SELECT 1 FROM sw b WHERE b.customer_id = a.customer_id AND b.m = a.m AND b.tx_date >=
        (SELECT max(tx_date) - 60 FROM sw d WHERE d.customer_id = a.customer_id)))""",
]
FLAG_COLS = ("CAST(chg.customer_id IS NOT NULL AS BOOLEAN) AS ME022, " + ", ".join(
    f"n_{m} {'=' if m in metrics.MISSING else '>'} 0 AS {m}" for m in ["ME023", "ME024", "ME025", "ME026", "ME027", "ME028",
                                                                        "ME029", "ME030", "ME031", "ME032"])
    + ", n_ME047 > 0 AND NOT (c.customer_id % 6 = 0) AS ME047")
FLAG_FROM = "FROM c LEFT JOIN has USING (customer_id) LEFT JOIN chg USING (customer_id)"


@query("met_flags", sql(f"SELECT c.customer_id, {FLAG_COLS} {FLAG_FROM}", LAST, WIN, CUST, *FLAG_CTES))
def met_flags(spark, sf):
    return metrics.metric_group(all_metrics(spark, sf, accounts(spark, sf)), "flags")


RISKY = "(" + ", ".join(literal(c) for c in P.high_risk) + ")"
RISK = [f"""rk AS (SELECT customer_id,
  count(DISTINCT trim(lower(description))) FILTER (cents < 0 AND code = 'EXP-033') AS small,
  CAST(coalesce(sum(cents) FILTER (cents > 0), 0) AS HUGEINT) AS inc,
  CAST(coalesce(sum(-cents) FILTER (cents < 0 AND code = 'EXP-001'), 0) AS HUGEINT) AS atm,
  CAST(coalesce(sum(-cents) FILTER (cents < 0 AND code IN {RISKY}), 0) AS HUGEINT) AS risky,
  count(*) FILTER (code = 'EXP-009') AS dis FROM win GROUP BY 1)"""]
RISK_COLS = f"""coalesce(small, 0) AS ME017, {pct('atm', 'inc')} AS ME018, coalesce(dis, 0) AS ME019,
  {pct('risky', 'inc')} AS ME020, coalesce(CAST(risky AS BIGINT) / 100.0, 0.0) AS ME021"""


@query("met_risk", sql(f"SELECT customer_id, {RISK_COLS} FROM c LEFT JOIN rk USING (customer_id)",
                       LAST, WIN, CUST, *RISK))
def met_risk(spark, sf):
    return metrics.metric_group(all_metrics(spark, sf), "risk")


MET0 = recursive(sql(
    f"""SELECT c.customer_id, 180 AS reporting_period_days, 'fixed' AS calculation_date,
    {EXPENSE_COLS}, {INCOME_COLS}, {COMMIT_COLS.replace('customer_id', 'c.customer_id')}, {GOV_COLS}, {FLAG_COLS}, {RISK_COLS}
    FROM c {EXPENSE_JOINS} {INCOME_JOINS} {COMMIT_JOINS} {joins('yo_m', 'ra_m', 'be_m', 'has', 'chg', 'rk')}""",
    LAST, WIN, CUST, *EXPENSE, *INCOME, *COMMIT, *GOV, *FLAG_CTES, *RISK))


@query("met0_all", "SELECT * REPLACE (CAST(ME010 AS DOUBLE) AS ME010, CAST(ME011 AS DOUBLE) AS ME011) FROM (" + MET0 + ")")
def met0(spark, sf):
    return all_metrics(spark, sf, accounts(spark, sf))


AS_OF = "2024-10-20"


@query("met0_as_of", "SELECT * REPLACE (CAST(ME010 AS DOUBLE) AS ME010, CAST(ME011 AS DOUBLE) AS ME011) FROM ("
       + MET0.replace("UNION ALL SELECT * FROM acc)", f"UNION ALL SELECT * FROM acc), tx AS (SELECT * FROM every_tx WHERE tx_date <= DATE '{AS_OF}')")
       .replace("tx AS (SELECT * FROM ev ", "every_tx AS (SELECT * FROM ev ") + ")")
def met0_as_of(spark, sf):
    """The metrics as they stood at an earlier day, from partial sums of two sets of transactions added up."""
    tx = transactions(spark, sf)
    half = F.pmod(F.xxhash64("tx_id"), F.lit(2)) == 0
    parts = metrics.merge(metrics.partials(tx.filter(half), P), metrics.partials(tx.filter(~half), P))
    return metrics.metrics_at(written(parts), AS_OF, accounts(spark, sf), P, "fixed")


@query("agg21_portfolio", f"""SELECT count(*) AS customers, CAST(sum(CAST(round(ME033 * 100) AS BIGINT)) AS BIGINT) AS salary_cents,
  CAST(sum(CAST(round(ME034 * 100) AS BIGINT)) AS BIGINT) AS outgoing_cents,
  count(*) FILTER (ME017 > 0) AS with_small_loans, count(*) FILTER (ME019 > 0) AS with_dishonours,
  count(*) FILTER (ME031) AS with_unemployment FROM ({MET0})""")
def agg21(spark, sf):
    return metrics.portfolio_summary(all_metrics(spark, sf)).drop("mean_salary", "mean_outgoings")


def _metric_def_sql():
    rows = ", ".join("(" + ", ".join(literal(v) for v in r) + ")" for r in tables.METRIC_DEFS)
    return f"""SELECT metric_id, name, type, (SELECT count(DISTINCT user_id) FROM events) AS customers
      FROM (VALUES {rows}) AS t(metric_id, name, type)"""


@query("snk4_metric_definitions", _metric_def_sql())
def snk4(spark, sf):
    """Metric definitions from the output schema, with the number of customers they cover."""
    out = all_metrics(spark, sf)
    n = out.agg(F.count(F.lit(1)).alias("customers"))
    kinds = [(f.name, f.metadata["name"], f.metadata["type"]) for f in out.schema if "type" in f.metadata]
    import pyarrow as pa

    defs = tables.frame(spark, [("metric_id", pa.string()), ("name", pa.string()), ("type", pa.string())], kinds)
    return defs.withColumn("customers", n.scalar())
