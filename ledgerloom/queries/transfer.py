"""Own-account transfers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import transfers
from .base import sql, transactions
from .registry import query
from .textual import ACCOUNTS_SQL

NAMED = ("named AS (SELECT tx.*, unnest(" + ACCOUNTS_SQL.format(d="description") + ") AS account FROM tx)")
HINT = """(coalesce(contains(provider_category, 'Internal Transfer'), false)
  OR coalesce(contains(third_party, 'Internal Transfer'), false))"""
WORDED = """(contains(upper({a}description), 'TFER') OR contains(upper({a}description), 'TRANSFER')
  OR contains(upper({a}description), 'INTERNET BANKING PAYMENT') OR contains(upper({a}description), 'MOBILE BANKING PAYMENT')
  OR contains(upper({a}description), 'M-BANKING FUNDS'))"""
TWO_WAY = """two_way AS (SELECT customer_id, account FROM named WHERE cents > 0
  INTERSECT SELECT customer_id, account FROM named WHERE cents <= 0)"""
# The oracle forms the pairs that the operator avoids.
PAIRS = f"""pairs AS (SELECT DISTINCT a.customer_id, a.account FROM named a JOIN tx b
  ON a.customer_id = b.customer_id AND a.tx_date = b.tx_date AND a.cents = -b.cents AND a.cents <> 0
  WHERE {WORDED.format(a='a.')} AND {WORDED.format(a='b.')})"""
OWN = f"""own AS (SELECT * FROM two_way UNION SELECT * FROM pairs
  UNION SELECT customer_id, account FROM named WHERE {HINT}
  UNION SELECT customer_id, coalesce(bsb, '') || account_number FROM tx WHERE account_number <> '')"""


@query("set2_two_way_accounts", sql("SELECT * FROM two_way", NAMED, TWO_WAY))
def set2(spark, sf):
    return transfers.two_way_accounts(transactions(spark, sf))


@query("jn4_transfer_pairs", sql("SELECT * FROM pairs", NAMED, PAIRS))
def jn4(spark, sf):
    return transfers.paired_accounts(transactions(spark, sf))


@query("trf2_hinted_accounts", sql(f"SELECT DISTINCT customer_id, account FROM named WHERE {HINT}", NAMED))
def trf2(spark, sf):
    return transfers.hinted_accounts(transactions(spark, sf))


@query("set1_account_evidence", sql(f"""SELECT 'two_way' AS evidence, count(*) AS n FROM two_way
  UNION ALL SELECT 'pair', count(*) FROM pairs
  UNION ALL SELECT 'hint', count(*) FROM (SELECT DISTINCT customer_id, account FROM named WHERE {HINT})
  UNION ALL SELECT 'declared', count(*) FROM (SELECT DISTINCT customer_id, bsb, account_number FROM tx WHERE account_number <> '')""",
                                    NAMED, TWO_WAY, PAIRS))
def set1(spark, sf):
    tx = transactions(spark, sf)
    parts = {"two_way": transfers.two_way_accounts(tx), "pair": transfers.paired_accounts(tx),
             "hint": transfers.hinted_accounts(tx), "declared": transfers.declared_accounts(tx)}
    out = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias("evidence"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("evidence").agg(F.count(F.lit(1)).alias("n"))


@query("trf1_own_accounts", sql("SELECT customer_id, account FROM own", NAMED, TWO_WAY, PAIRS, OWN))
def trf1(spark, sf):
    return transfers.own_accounts(transactions(spark, sf))


@query("trf4_account_list", sql("""SELECT customer_id, count(DISTINCT account) AS accounts, min(account) AS first_account
  FROM own GROUP BY 1""", NAMED, TWO_WAY, PAIRS, OWN))
def trf4(spark, sf):
    return transfers.own_accounts(transactions(spark, sf)).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("accounts"), F.min("account").alias("first_account"))


MATCHED = """matched AS (SELECT DISTINCT n.customer_id, n.account FROM named n JOIN own o ON n.customer_id = o.customer_id
  AND (n.account = o.account OR contains(n.account, o.account) OR contains(o.account, n.account))
  WHERE length(n.account) >= 6 OR n.account = o.account)"""


@query("jn5_own_account_match", sql("SELECT * FROM matched", NAMED, TWO_WAY, PAIRS, OWN, MATCHED))
def jn5(spark, sf):
    tx = transactions(spark, sf)
    return transfers.matching_accounts(transfers._exploded(tx), transfers.own_accounts(tx))


@query("trf3_flag_transfers", sql(f"""SELECT tx_id, customer_id, {HINT} OR ({WORDED.format(a='')} AND EXISTS (SELECT 1
  FROM named n JOIN matched m ON m.customer_id = n.customer_id AND m.account = n.account
  WHERE n.tx_id = tx.tx_id)) AS is_own_transfer FROM tx""", NAMED, TWO_WAY, PAIRS, OWN, MATCHED))
def trf3(spark, sf):
    return transfers.flag_own_transfers(transactions(spark, sf)).select(
        "tx_id", "customer_id", "is_own_transfer")


@query("trf3_hints_only", sql(f"SELECT {HINT} AS is_own_transfer, count(*) AS n FROM tx GROUP BY 1"))
def trf3_hints(spark, sf):
    return (transfers.flag_own_transfers(transactions(spark, sf), learn=False)
            .groupBy("is_own_transfer").agg(F.count(F.lit(1)).alias("n")))
