"""Projections, parsing and feature rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import MetricParams
from ..functions import values as V
from ..operators import features, metrics
from ..sources import api_json, statements
from .base import MAPPING_CTE, literal, mapping, sql, transactions
from .dataset import API, RUNS, SPLIT, run_personas
from .registry import query

def seq():
    return F.col("seq")


def hundred():
    return F.lit(100).cast("decimal(3,0)")


def money_text():
    return (F.col("cents") / hundred()).cast("decimal(18,2)").cast("string")


def day_text():
    return F.date_format("tx_date", "yyyy-MM-dd")


@query("prj1_model_input", sql("""SELECT tx_id AS account_number, description, CAST(cents AS BIGINT) / 100.0 AS amount,
  CASE WHEN cents > 0 THEN 'credit' ELSE 'debit' END AS direction, coalesce(provider_category, '') AS provider_category,
  coalesce(month(d), 0) AS month, coalesce(isodow(d) - 1, 0) AS day_of_week, coalesce(day(d), 0) AS day_of_month,
  coalesce(year(d), 0) AS year FROM (SELECT *, CASE WHEN seq % 9 <> 0 THEN tx_date END AS d FROM tx)"""))
def prj1(spark, sf):
    rows = transactions(spark, sf).select(
        F.lit("savings").alias("account_type"), F.lit("").alias("account_holder"), F.lit("").alias("account_name"),
        F.lit("").alias("bsb"), F.col("tx_id").alias("account_number"),
        F.when(seq() % 9 == 0, "not a day").otherwise(day_text()).alias("date"), "description",
        (F.col("cents") / hundred()).cast("decimal(18,2)").alias("amount"), F.lit(0).alias("balance"),
        F.coalesce("provider_category", F.lit("")).alias("category"), "third_party",
        F.lit("").alias("transaction_type"), F.lit(False).alias("pending"))
    return features.model_input(rows).select(
        "account_number", "description", F.col("amount").cast("double").alias("amount"), "direction", "provider_category",
        "month", "day_of_week", "day_of_month", "year")


def raw_amount():
    """Amount text with more digits, blanks and rubbish."""
    return (F.when(seq() % 10 == 0, "abc").when(seq() % 10 == 1, F.concat(F.lit(" "), money_text(), F.lit("50 ")))
            .otherwise(money_text()))


AMOUNT = """am AS (SELECT *, CASE WHEN seq % 10 = 0 THEN NULL WHEN seq % 10 = 1 THEN (cents + CASE WHEN cents < 0 THEN -1 ELSE 1 END)
  ELSE cents END AS c2 FROM tx)"""


@query("prj5_money", sql("SELECT tx_id, printf('%.2f', c2 / 100.0) AS amount FROM am", AMOUNT))
def prj5(spark, sf):
    return transactions(spark, sf).select("tx_id", V.money_text(raw_amount()).alias("amount"))


@query("prj2_api_row", sql("""SELECT tx_id AS transaction_id, coalesce(printf('%.2f', c2 / 100.0), '') AS amount,
  CASE WHEN cents > 0 THEN 'credit' ELSE 'debit' END AS direction, strftime(tx_date, '%Y-%m-%d') AS transaction_date,
  '' AS post_date, description FROM am""", AMOUNT))
def prj2(spark, sf):
    raw = transactions(spark, sf).select(
        F.col("tx_id").alias("id"), raw_amount().alias("amount"), F.when(F.col("cents") > 0, "credit").otherwise("debit").alias("direction"),
        day_text().alias("transactionDate"), F.lit(None).cast("string").alias("postDate"), "description")
    return features.api_row(raw)


def enriched(spark, sf):
    """Enrichment JSON with each of the alternate spellings."""
    e, d = seq() % 4, F.col("description")
    group = F.struct(F.col("subclass_code").alias("code"), F.concat(F.lit("G"), "subclass_code").alias("title"))
    merchant = F.struct(d.alias("name"))
    js = (F.when(e == 0, F.to_json(F.struct(d.alias("cleanDescription"), merchant.alias("merchant"),
                                            F.struct(group.alias("group")).alias("anzsic"))))
          .when(e == 1, F.to_json(F.struct(d.alias("clean_description"), F.struct(
              F.lit("flat").alias("group"), F.col("subclass_code").alias("groupCode"), F.lit("T").alias("groupTitle")).alias("anzsic"))))
          .when(e == 2, F.to_json(F.struct(F.lit("").alias("cleanDescription"), d.alias("clean")))))
    sub = F.when(F.col("subclass_code") != "", F.to_json(F.struct(F.col("subclass_code").alias("code"), F.lit("sub").alias("title"))))
    return transactions(spark, sf).withColumns({"enrich": js, "sub": sub})


@query("prj3_enrichment", sql("""SELECT tx_id, CASE WHEN seq % 4 < 3 THEN description ELSE '' END AS clean_description,
  CASE WHEN seq % 4 = 0 THEN description ELSE '' END AS merchant_name,
  CASE WHEN seq % 4 < 2 THEN subclass_code ELSE '' END AS anzsic_group_code,
  CASE seq % 4 WHEN 0 THEN 'G' || subclass_code WHEN 1 THEN 'T' ELSE '' END AS anzsic_group_title FROM tx"""))
def prj3(spark, sf):
    cols = api_json.enrichment(F.col("enrich"), F.col("sub"))
    return enriched(spark, sf).select("tx_id", *[cols[c].alias(c) for c in (
        "clean_description", "merchant_name", "anzsic_group_code", "anzsic_group_title")])


@query("prj4_subclass", sql("""SELECT tx_id, subclass_code, CASE WHEN subclass_code = '' THEN '' ELSE 'sub' END AS subclass_title FROM tx"""))
def prj4(spark, sf):
    cols = api_json.enrichment(F.col("enrich"), F.col("sub"))
    return enriched(spark, sf).select("tx_id", cols["subclass_code"].alias("subclass_code"), cols["subclass_title"].alias("subclass_title"))


@query("prj6_match_key", sql("""SELECT tx_id, CASE WHEN c2 IS NULL OR seq % 7 = 0 THEN NULL ELSE lower(description) || '|' ||
  printf('%.2f', c2 / 100.0) || '|' || strftime(tx_date, '%Y-%m-%d') END AS match_key FROM am""", AMOUNT))
def prj6(spark, sf):
    key = V.match_key(F.concat(F.lit("  "), F.regexp_replace("description", " ", "  ")), raw_amount(),
                      F.when(seq() % 7 == 0, "").otherwise(F.concat(day_text(), F.lit("T08:00:00Z"))))
    k = transactions(spark, sf).select("tx_id", key.alias("k"))
    return k.select("tx_id", F.when(F.col("k").isNotNull(), F.concat_ws("|", "k.description", "k.amount", "k.day")).alias("match_key"))


FEAT = """ft AS (SELECT *, CASE WHEN seq % 8 = 0 THEN NULL ELSE tx_date END AS td, CASE WHEN seq % 16 = 0 THEN NULL ELSE tx_date + 1 END AS pd FROM tx)"""


def feature_input(spark, sf):
    return transactions(spark, sf).select(
        F.concat(F.lit("run"), F.col("customer_id") % 60).alias("run_id"), F.col("tx_id").alias("transaction_id"), "description",
        F.when(seq() % 10 == 0, "n/a").otherwise(money_text()).alias("amount"),
        F.when(seq() % 8 == 0, "").otherwise(F.concat(day_text(), F.lit("T23:10:00Z"))).alias("transaction_date"),
        F.when(seq() % 16 == 0, "").otherwise(F.date_format(F.date_add("tx_date", 1), "yyyy-MM-dd")).alias("post_date"),
        "provider_category", F.col("code").alias("label_group_code"), F.lit("report_id").alias("label_source"))


BUCKET = """CASE WHEN abs(c) < 1000 THEN 'micro' WHEN abs(c) < 5000 THEN 'small' WHEN abs(c) < 20000 THEN 'medium'
  WHEN abs(c) < 100000 THEN 'large' ELSE 'xlarge' END"""


@query("prj8_features", sql(f"""SELECT tx_id AS transaction_id, {BUCKET} AS amount_bucket, CASE WHEN c < 0 THEN 'debit' ELSE 'credit' END AS direction,
  coalesce(month(d), 0) AS month, coalesce(isodow(d) - 1, 0) AS day_of_week, coalesce(day(d), 0) AS day_of_month, coalesce(year(d), 0) AS year,
  coalesce(m.code, '') AS fallback_code, CAST(coalesce(m.confidence, 0) AS DOUBLE) AS fallback_confidence
  FROM (SELECT *, CASE WHEN seq % 10 = 0 THEN 0 ELSE cents END AS c, coalesce(td, pd) AS d FROM ft) LEFT JOIN mapping m USING (provider_category)""",
                            FEAT, MAPPING_CTE))
def prj8(spark, sf):
    return features.feature_rows(feature_input(spark, sf), mapping(spark)).select(
        "transaction_id", "amount_bucket", "direction", "month", "day_of_week", "day_of_month", "year", "fallback_code", "fallback_confidence")


@query("prj9_add_split", sql("""SELECT tx_id AS transaction_id, coalesce(split, 'unknown') AS split FROM (SELECT tx_id, 'demo' || (customer_id % 60 % 7)
  || '/run' || (customer_id % 60) AS run_id FROM tx) LEFT JOIN (SELECT * REPLACE (CASE WHEN run_id LIKE '%1' THEN run_id || 'x' ELSE run_id END AS run_id) FROM sp) USING (run_id)""",
                             API, RUNS, SPLIT))
def prj9(spark, sf):
    from ..operators.labels import persona_splits

    run = F.concat(F.lit("demo"), F.col("customer_id") % 60 % 7, F.lit("/run"), F.col("customer_id") % 60)
    rows = transactions(spark, sf).select(F.col("tx_id").alias("transaction_id"), run.alias("run_id"))
    known = persona_splits(run_personas(spark, sf)).withColumn("run_id", F.when(F.col("run_id").endswith("1"), F.concat("run_id", F.lit("x"))).otherwise(F.col("run_id")))
    return features.add_split(rows, known).select("transaction_id", "split")


@query("agg22_distributions", sql(f"""SELECT {BUCKET} AS amount_bucket, count(*) AS n FROM
  (SELECT CASE WHEN seq % 10 = 0 THEN 0 ELSE cents END AS c FROM tx) GROUP BY 1"""))
def agg22(spark, sf):
    return features.label_distribution(features.feature_rows(feature_input(spark, sf)), "amount_bucket")


@query("prj12_day_first_date", sql("SELECT tx_id, CASE WHEN seq % 6 <> 0 THEN strftime(tx_date, '%Y-%m-%d') END AS day FROM tx"))
def prj12(spark, sf):
    text = F.when(seq() % 6 == 0, "31/02/2024").otherwise(F.date_format("tx_date", "dd/MM/yyyy"))
    return transactions(spark, sf).select("tx_id", F.date_format(V.day_first_date(text), "yyyy-MM-dd").alias("day"))


@query("prj13_training_samples", sql("""SELECT tx_id AS transaction_id, code AS label, CASE WHEN seq % 9 = 0 THEN 0.0 ELSE cents / 100.0 END AS amount,
  CASE WHEN seq % 9 = 0 THEN 0 ELSE month(tx_date) END AS month FROM tx WHERE seq % 7 <> 0"""))
def prj13(spark, sf):
    raw = transactions(spark, sf).select(
        F.col("tx_id").alias("transaction_id"), F.when(seq() % 7 == 0, " ").otherwise(F.col("code")).alias("label_group_code"),
        money_text().alias("amount"), F.month("tx_date").cast("string").alias("month"),
        F.when(seq() % 9 == 0, "x").otherwise("2").alias("day_of_week"), F.lit("5").alias("day_of_month"),
        F.lit("small").alias("amount_bucket"), F.lit("train").alias("split"))
    return features.training_samples(raw).select("transaction_id", "label", "amount", "month")


@query("prj11_alias_and_check", sql("SELECT code, count(*) AS n FROM tx GROUP BY 1"))
def prj11(spark, sf):
    renamed = transactions(spark, sf).withColumnRenamed("code", "category_code")
    return metrics.prepare(renamed).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("set4_other_income_codes", sql("SELECT code, count(*) AS n FROM tx WHERE code IN (" + ", ".join(
    literal(c) for c in MetricParams.income) + ") AND code <> 'INC-009' GROUP BY 1"))
def set4(spark, sf):
    return (transactions(spark, sf).filter(F.col("code").isin(*MetricParams().other_income))
            .groupBy("code").agg(F.count(F.lit(1)).alias("n")))


# -- statement texts ---------------------------------------------------------------------

@query("src4_card_rows", sql("""SELECT tx_id, CASE WHEN seq % 4 = 0 THEN 'shop' ELSE description END AS description,
  CASE WHEN seq % 3 = 0 THEN -abs(cents) ELSE cents END / 100.0 AS amount, strftime(tx_date, '%Y-%m-%d') AS date FROM tx WHERE seq % 5 <> 0"""))
def src4(spark, sf):
    size = (F.abs("cents") / hundred()).cast("decimal(18,2)")
    text = (F.when(seq() % 5 == 0, "pending").when(seq() % 3 == 0, F.concat(F.lit("($"), F.format_number(size, 2), F.lit(")")))
            .otherwise(F.concat(F.when(F.col("cents") < 0, "-").otherwise(""), F.lit("$"), F.format_number(size, 2))))
    raw = transactions(spark, sf).select(
        "tx_id", F.when(seq() % 4 == 0, "").otherwise(F.col("description")).alias("Description"),
        F.lit("shop").alias("Merchant"), F.lit("").alias("Amount"), text.alias("Debit"), day_text().alias("Transaction Date"))
    return statements.card_rows(raw).withColumn("amount", F.col("amount").cast("double"))


@query("src5_provider_rows", sql("""SELECT tx_id, cents / 100.0 AS amount, strftime(tx_date, '%Y-%m-%d') AS date,
  coalesce(provider_category, '') AS provider_category FROM tx WHERE seq % 10 <> 0 AND seq % 9 <> 0"""))
def src5(spark, sf):
    size = (F.col("cents") / hundred()).cast("decimal(18,2)")
    raw = transactions(spark, sf).select(
        "tx_id", "description", F.when(seq() % 10 == 0, "n/a").otherwise(F.format_number(size, 2)).alias("amount"),
        F.when(seq() % 9 == 0, F.date_format("tx_date", "dd/MM/yyyy")).otherwise(day_text()).alias("date"),
        F.col("provider_category").alias("Category"), F.col("third_party").alias("thirdParty"), F.lit("").alias("accountType"))
    return statements.provider_match_rows(raw).select("tx_id", F.col("amount").cast("double").alias("amount"),
                                                      F.date_format("date", "yyyy-MM-dd").alias("date"), "provider_category")


@query("src6_labelled_rows", sql("""SELECT tx_id AS transaction_id, strftime(tx_date, '%Y-%m-%d') || ' 01:16:55' AS ts, code FROM tx
  WHERE seq % 10 <> 0 AND seq % 9 <> 0"""))
def src6(spark, sf):
    raw = transactions(spark, sf).select(
        F.col("tx_id").alias("transaction_id"), "description", F.when(seq() % 10 == 0, "n/a").otherwise(money_text()).alias("amount"),
        F.when(seq() % 9 == 0, "").otherwise(F.concat(day_text(), F.lit("T01:16:55Z"))).alias("transaction_date"),
        F.col("code").alias("label_group_code"), F.lit("report_id").alias("label_source"))
    return statements.labelled_match_rows(raw).select(
        "transaction_id", F.date_format(F.to_utc_timestamp("ts", F.current_timezone()), "yyyy-MM-dd HH:mm:ss").alias("ts"), "code")


@query("cls14_card_statement", sql("""SELECT tx_id, lower(description) AS text, cents / 100.0 AS amount FROM tx"""))
def cls14(spark, sf):
    from ..plans.jobs import categorise_card

    raw = transactions(spark, sf).select("tx_id", F.col("description").alias("Transaction Details"),
                                         money_text().alias("Amount"), day_text().alias("Date"))
    out = categorise_card(statements.card_rows(raw), mapping=None)
    return out.select("tx_id", F.lower("description").alias("text"), F.col("amount").cast("double").alias("amount"))


