"""The transaction view that the queries start from, in Spark and as SQL.

No driver table is a bank statement, so ``events`` becomes one: each event is a transaction of
its user, described by a small catalogue, plus regular income and transfers per user.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import tables

# (text, code, sign, provider category, third party, subclass); '#' becomes a number of the event
CATALOGUE = [
    ("WOOLWORTHS # ASHWOOD AU Card Used 3960", "EXP-016", -1, "Groceries", None, "411"),
    ("PENDING - POS AUTHORISATION CORNER CAFÉ MELBOURNE AU", "EXP-008", -1, "Dining Out", None, "451"),
    ("RAY WHITE REAL ESTATE RENT REF #", "EXP-030", -1, "Rent", None, "671"),
    ("VISA DEBIT PURCHASE CARD 3960 NETFLIX.COM", "EXP-035", -1, "Subscription", None, "591"),
    ("DIRECT DEBIT TELSTRA MOBILE {#77}", "EXP-036", -1, "Phone", None, "580"),
    ("ANZ INTERNET BANKING BPAY ORIGIN ENERGY 235#", "EXP-040", -1, "Utilities", None, "263"),
    ("ATM WITHDRAWAL CITY BRANCH", "EXP-001", -1, "Cash", None, "622"),
    ("DISHONOUR FEE", "EXP-009", -1, "Bank Fees", None, "622"),
    ("SPORTSBET DEPOSIT", "EXP-014", -1, "Gambling", None, "920"),
    ("WALLET WIZARD LOAN REPAY", "EXP-033", -1, "Loan Repayments", None, "623"),
    ("HOME LOAN MORTGAGE PAYMENT", "EXP-056", -1, "Mortgage Repayments", None, "623"),
    ("CAR FINANCE CO # INSTALMENT", "EXP-023", -1, "Automotive", None, "623"),
    ("CENTRELINK FAMILY TAX BENEFIT", "INC-014", 1, "Centrelink", None, "751"),
    ("ZARA REFUND MELBOURNE", "EXP-032", 1, "Fashion", None, "425"),
    ("EFTPOS 507PIN* KMART BURWOOD", "EXP-031", -1, "Department Stores", None, "426"),
    ("ZQX HOLDINGS PTY LTD", "EXP-039", -1, "Third Party Payment Providers", None, ""),
    ("SERVICES AUSTRALIA JOBSEEKER", "INC-016", 1, "Benefits", None, "751"),
    ("TRANSFER FROM MCARE BENEFITS 198#", "INC-015", 1, "Medicare", None, "751"),
    ("CREDIT INTEREST PAID", "INC-004", 1, "Earned Interest", None, "622"),
    ("QWERTY WIDGETS SYDNEY", "EXP-039", -1, "Shopping", None, "427"),
    ("WOOLWORTHS LIMITED", "INC-007", 1, "All Other Credits", "Internal Transfer Credit", "411"),
    ("CREDIT CARD CASH ADVANCE", "EXP-003", -1, "Cash", None, "622"),
    ("LOAN REDRAW OFFSET STORE.COM", "EXP-029", -1, None, None, ""),
    ("YOUTH ALLOWANCE PAYMENT", "INC-012", 1, "Benefits", None, "751"),
]

CATALOGUE_FIELDS = [("idx", pa.int64()), ("text", pa.string()), ("code", pa.string()),
                    ("sign", pa.int64()), ("provider_category", pa.string()),
                    ("third_party", pa.string()), ("subclass_code", pa.string())]

MAPPING = [("Groceries", "EXP-016", 0.92), ("Shopping", "EXP-031", 0.5), ("Phone", "EXP-036", 0.5),
           ("Cash", "EXP-007", 0.5), ("Benefits", "INC-001", 0.5), ("Earned Interest", "INC-004", 0.5),
           ("Bank Fees", "EXP-015", 0.5), ("Fashion", "EXP-055", 0.5),
           ("Third Party Payment Providers", "EXP-039", 0.3), ("All Other Credits", "INC-007", 0.3),
           ("External Transfers", "EXP-013", 0.5), ("Wages", "INC-009", 0.81)]

TX_COLUMNS = ["tx_id", "customer_id", "seq", "tx_date", "description", "cents",
              "provider_category", "third_party", "account_number", "bsb", "code", "subclass_code"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def catalogue(spark: SparkSession) -> DataFrame:
    return tables.frame(spark, CATALOGUE_FIELDS, [(i, *r) for i, r in enumerate(CATALOGUE)])


def mapping(spark: SparkSession) -> DataFrame:
    return tables.frame(spark, [("provider_category", pa.string()), ("code", pa.string()),
                                ("confidence", pa.float64())], MAPPING)


def spread(df: DataFrame, key: str) -> DataFrame:
    """A small table is one scan task; give every core a part of it. Large scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = df._jdf.queryExecution().toRdd().getNumPartitions() < cores
    return df.repartition(cores, key) if few else df


def event_rows(spark: SparkSession, sf: str) -> DataFrame:
    ev = spread(table(spark, sf, "events").select("event_id", "user_id", "value"), "event_id").withColumn(
        "idx", F.col("event_id") % len(CATALOGUE))
    number = (F.lit(1000) + F.col("event_id") % 9000).cast("string")
    return ev.join(catalogue(spark), "idx").select(
        F.concat(F.lit("e"), F.col("event_id")).alias("tx_id"), F.col("user_id").alias("customer_id"),
        F.col("event_id").alias("seq"),
        F.date_add(F.lit("2024-07-01").cast("date"),
                   ((F.col("event_id") * 37 + F.col("user_id")) % 184).cast("int")).alias("tx_date"),
        F.replace("text", F.lit("#"), number).alias("description"),
        (F.col("sign") * F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
        "provider_category", "third_party", F.lit(None).cast("string").alias("account_number"),
        F.lit(None).cast("string").alias("bsb"), "code", "subclass_code")


def users(spark: SparkSession, sf: str) -> DataFrame:
    """The distinct ids are few bytes, which would be put together in one task; what is made of them
    is work for every core."""
    return table(spark, sf, "events").select("user_id").distinct().repartition(spark.sparkContext.defaultParallelism, "user_id")


def income_rows(spark: SparkSession, sf: str) -> DataFrame:
    u = users(spark, sf).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(11))))
    kind = F.when((F.col("user_id") % 11 == 0) & (F.col("i") >= 6), (F.col("user_id") + 1) % 3) \
        .otherwise(F.col("user_id") % 3)
    text = (F.when(kind == 0, "ACME CORP WAGES").when(kind == 1, "PAY/SALARY FROM NORTHSIDE PAYROLL 2465")
            .otherwise("TECH STARTUP PTY LTD SALARY"))
    base = F.lit(1500) + (F.col("user_id") % 7) * 350 + F.when(
        (F.col("user_id") % 5 == 0) & (F.col("i") >= 8), 400).otherwise(0)
    return u.select(
        F.concat(F.lit("s"), F.col("user_id"), F.lit("-"), F.col("i")).alias("tx_id"),
        F.col("user_id").alias("customer_id"),
        (F.lit(10_000_000_000) + F.col("user_id") * 100 + F.col("i")).alias("seq"),
        F.date_add(F.lit("2024-07-03").cast("date"), F.col("i") * 14).alias("tx_date"),
        text.alias("description"), (base * 100).cast("bigint").alias("cents"),
        F.lit("Wages").alias("provider_category"), F.lit(None).cast("string").alias("third_party"),
        F.lit(None).cast("string").alias("account_number"), F.lit(None).cast("string").alias("bsb"),
        F.lit("INC-009").alias("code"), F.lit("").alias("subclass_code"))


def account_rows(spark: SparkSession, sf: str) -> DataFrame:
    u = users(spark, sf).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    uid, k = F.col("user_id"), F.col("k")
    text = (F.when(k == 0, F.concat(F.lit("ANZ M-BANKING FUNDS TFER TRANSFER 168136 TO "), uid + 600000000))
            .when(k == 1, F.concat(F.lit("TRANSFER FROM "), uid + 600000000))
            .when(k == 2, F.concat(F.lit("TRANSFER TO "), uid + 700000000))
            .otherwise(F.concat(F.lit("FUNDS TFER TO "), uid + 800000000)))
    declared = (k == 3) & (uid % 10 == 0)
    return u.select(
        F.concat(F.lit("o"), uid, F.lit("-"), k).alias("tx_id"), uid.alias("customer_id"),
        (F.lit(20_000_000_000) + uid * 10 + k).alias("seq"),
        F.date_add(F.lit("2024-08-01").cast("date"), (uid % 28).cast("int")).alias("tx_date"),
        text.alias("description"),
        F.when(k == 1, 25000).when(k == 0, -25000).when(k == 2, -7500).otherwise(-4000)
        .cast("bigint").alias("cents"),
        F.when((k == 0) & (uid % 4 == 0), "Internal Transfer").otherwise("External Transfers")
        .alias("provider_category"), F.lit(None).cast("string").alias("third_party"),
        F.when(declared, (uid + 800000000).cast("string")).alias("account_number"),
        F.when(declared, "012345").alias("bsb"), F.lit("EXP-013").alias("code"),
        F.lit("").alias("subclass_code"))


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    return (event_rows(spark, sf).unionByName(income_rows(spark, sf))
            .unionByName(account_rows(spark, sf)))


# -- the same in SQL -----------------------------------------------------------------

def literal(v) -> str:
    if v is None:
        return "NULL"
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(literal(v) for v in r) + ")" for r in rows)
    return f"{name}({columns}) AS (VALUES {body})"


TX_CTES = [
    values("cat", "idx, text, code, sign, provider_category, third_party, subclass_code",
           [(i, *r) for i, r in enumerate(CATALOGUE)]),
    f"""ev AS (SELECT 'e' || event_id AS tx_id, user_id AS customer_id, event_id AS seq,
      DATE '2024-07-01' + CAST((event_id * 37 + user_id) % 184 AS INTEGER) AS tx_date,
      replace(text, '#', CAST(1000 + event_id % 9000 AS VARCHAR)) AS description,
      CAST(sign * CAST(round(value * 100) AS BIGINT) AS BIGINT) AS cents,
      provider_category, CAST(third_party AS VARCHAR) AS third_party,
      CAST(NULL AS VARCHAR) AS account_number, CAST(NULL AS VARCHAR) AS bsb, code, subclass_code
      FROM events JOIN cat ON idx = event_id % {len(CATALOGUE)})""",
    "usr AS (SELECT DISTINCT user_id FROM events)",
    """pay0 AS (SELECT user_id, i, CASE WHEN user_id % 11 = 0 AND i >= 6 THEN (user_id + 1) % 3
      ELSE user_id % 3 END AS kind FROM usr, range(12) AS r(i))""",
    """pay AS (SELECT 's' || user_id || '-' || i AS tx_id, user_id AS customer_id,
      10000000000 + user_id * 100 + i AS seq, DATE '2024-07-03' + CAST(14 * i AS INTEGER) AS tx_date,
      CASE kind WHEN 0 THEN 'ACME CORP WAGES' WHEN 1 THEN 'PAY/SALARY FROM NORTHSIDE PAYROLL 2465'
        ELSE 'TECH STARTUP PTY LTD SALARY' END AS description,
      CAST((1500 + (user_id % 7) * 350 + CASE WHEN user_id % 5 = 0 AND i >= 8 THEN 400 ELSE 0 END)
        * 100 AS BIGINT) AS cents, 'Wages' AS provider_category, CAST(NULL AS VARCHAR) AS third_party,
      CAST(NULL AS VARCHAR) AS account_number, CAST(NULL AS VARCHAR) AS bsb, 'INC-009' AS code,
      '' AS subclass_code FROM pay0)""",
    """acc AS (SELECT 'o' || user_id || '-' || k AS tx_id, user_id AS customer_id,
      20000000000 + user_id * 10 + k AS seq,
      DATE '2024-08-01' + CAST(user_id % 28 AS INTEGER) AS tx_date,
      CASE k WHEN 0 THEN 'ANZ M-BANKING FUNDS TFER TRANSFER 168136 TO ' || (user_id + 600000000)
        WHEN 1 THEN 'TRANSFER FROM ' || (user_id + 600000000)
        WHEN 2 THEN 'TRANSFER TO ' || (user_id + 700000000)
        ELSE 'FUNDS TFER TO ' || (user_id + 800000000) END AS description,
      CAST(CASE k WHEN 1 THEN 25000 WHEN 0 THEN -25000 WHEN 2 THEN -7500 ELSE -4000 END AS BIGINT) AS cents,
      CASE WHEN k = 0 AND user_id % 4 = 0 THEN 'Internal Transfer' ELSE 'External Transfers' END AS provider_category,
      CAST(NULL AS VARCHAR) AS third_party,
      CASE WHEN k = 3 AND user_id % 10 = 0 THEN CAST(user_id + 800000000 AS VARCHAR) END AS account_number,
      CASE WHEN k = 3 AND user_id % 10 = 0 THEN '012345' END AS bsb, 'EXP-013' AS code,
      '' AS subclass_code FROM usr, range(4) AS r(k))""",
    "tx AS (SELECT * FROM ev UNION ALL SELECT * FROM pay UNION ALL SELECT * FROM acc)",
]

MAPPING_CTE = values("mapping", "provider_category, code, confidence", MAPPING)


def sql(select: str, *ctes: str) -> str:
    """A statement over ``tx`` and further named parts."""
    return "WITH " + ",\n".join([*TX_CTES, *ctes]) + "\n" + select
