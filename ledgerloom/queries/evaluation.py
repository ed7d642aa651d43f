"""Evaluation, checks and the classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import tables
from ..operators import cascade, classifier, evaluate, quality, series
from ..operators.rules import RuleBook
from .base import MAPPING_CTE, mapping, sql, transactions, values
from .classify import CASCADE, ON_RAW, RULE_M, TAXONOMY, categorised
from .registry import query
from .textual import MERCHANT

SCORED = "sc AS (SELECT tx.tx_id AS row_id, tx.code AS truth, cls.code AS predicted, cls.confidence FROM tx JOIN cls USING (tx_id))"
PARTS = [*CASCADE, SCORED]


def scored(spark, sf):
    """Cascade output of each transaction next to its catalogue code."""
    return (cascade.categorize(transactions(spark, sf).withColumn("truth", F.col("code")).drop("code"), mapping=mapping(spark))
            .select(F.col("tx_id").alias("row_id"), "truth", F.col("code").alias("predicted"), "confidence"))


@query("evl1_accuracy", sql("""SELECT count(*) AS samples, count(*) FILTER (truth = predicted) AS correct, count(*) FILTER (truth <> predicted) AS errors,
  count(*) FILTER (truth = predicted) * CAST(100.0 AS DOUBLE) / count(*) AS accuracy FROM sc""", *PARTS))
def evl1_accuracy(spark, sf):
    return evaluate.accuracy(scored(spark, sf))


SCORES = """pl AS (SELECT label, CAST(support AS BIGINT) AS support, coalesce(hits / nullif(given, 0), 0.0) AS precision, hits / support AS recall FROM
  (SELECT DISTINCT truth AS label, (SELECT count(*) FROM sc b WHERE b.truth = a.truth) AS support, (SELECT count(*) FROM sc b WHERE b.predicted = a.truth) AS given,
   (SELECT count(*) FROM sc b WHERE b.predicted = a.truth AND b.truth = a.truth) AS hits FROM sc a)),
  f1 AS (SELECT label, precision, recall, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) AS f1, support FROM pl)"""


@query("evl1_label_scores", sql("SELECT * FROM f1", *PARTS, SCORES))
def evl1(spark, sf):
    return evaluate.label_scores(scored(spark, sf))


@query("top5_best_labels", sql("SELECT label, f1 FROM f1 ORDER BY f1 DESC, label LIMIT 10", *PARTS, SCORES))
def top5(spark, sf):
    return evaluate.extreme_labels(evaluate.label_scores(scored(spark, sf))).select("label", "f1")


@query("top5_worst_labels", sql("SELECT label, f1 FROM f1 ORDER BY f1, label LIMIT 10", *PARTS, SCORES))
def top5_worst(spark, sf):
    return evaluate.extreme_labels(evaluate.label_scores(scored(spark, sf)), best=False).select("label", "f1")


@query("evl2_confusion", sql("SELECT truth, predicted, count(*) AS n FROM sc GROUP BY 1, 2", *PARTS))
def evl2(spark, sf):
    return evaluate.confusion(scored(spark, sf))


@query("evl3_error_rows", sql("SELECT * FROM sc WHERE truth <> predicted ORDER BY row_id LIMIT 50", *PARTS))
def evl3(spark, sf):
    return evaluate.error_rows(scored(spark, sf))


@query("evl3_confusion_pairs", sql("""SELECT truth, predicted, count(*) AS n FROM sc WHERE truth <> predicted GROUP BY 1, 2
  ORDER BY 3 DESC, 1, 2 LIMIT 10""", *PARTS))
def evl3_pairs(spark, sf):
    return evaluate.confusion_pairs(scored(spark, sf))


@query("evl4_confidence_bands", sql("""SELECT count(*) FILTER (confidence < 0.5) AS very_low, count(*) FILTER (confidence >= 0.5 AND confidence < 0.7) AS low,
  count(*) FILTER (confidence >= 0.7 AND confidence < 0.9) AS medium, count(*) FILTER (confidence >= 0.9) AS high,
  round(avg(confidence), 3) AS mean_confidence FROM sc""", *PARTS))
def evl4(spark, sf):
    return evaluate.confidence_bands(scored(spark, sf))


GOLDEN = """gold AS (SELECT customer_id, tx_date, CASE WHEN seq % 2 = 0 THEN description ELSE description || ' *' END AS description, cents,
  min(code) AS truth FROM tx GROUP BY 1, 2, 3, 4),
  gj AS (SELECT cls.tx_id AS row_id, truth, cls.code AS predicted FROM cls JOIN gold USING (customer_id, tx_date, description, cents))"""


def golden(spark, sf):
    # Every second expectation carries another text and finds no row.
    text = F.when(F.col("seq") % 2 == 0, F.col("description")).otherwise(F.concat("description", F.lit(" *")))
    tx = transactions(spark, sf).withColumn("description", text).groupBy("customer_id", "tx_date", "description", "cents").agg(F.min("code").alias("code"))
    return evaluate.against_golden(categorised(spark, sf), tx)


@query("jn8_golden_join", sql("SELECT row_id, truth, predicted FROM gj", *CASCADE, GOLDEN))
def jn8(spark, sf):
    return golden(spark, sf).drop("confidence")


@query("evl5_errors_by_code", sql("""SELECT truth, count(*) AS n, count(*) FILTER (truth <> predicted) AS errors FROM gj GROUP BY 1""", *CASCADE, GOLDEN))
def evl5(spark, sf):
    return evaluate.errors_by_truth(golden(spark, sf))


# The second predictor is the same cascade without a mapping.
OTHER = """other AS (SELECT tx_id, CASE WHEN branch = 'mapping' THEN CASE WHEN cents < 0 THEN 'EXP-039' ELSE 'INC-007' END ELSE code END AS code,
  CASE WHEN branch = 'mapping' THEN 'uncategorised' ELSE branch END AS branch FROM cls)"""


def other(spark, sf):
    return cascade.categorize(transactions(spark, sf).drop("code"))


@query("evl6_agreement", sql("""SELECT count(*) AS rows, count(*) FILTER (a.code = b.code) AS agree,
  round(count(*) FILTER (a.code = b.code) * CAST(100.0 AS DOUBLE) / count(*), 1) AS agreement FROM cls a JOIN other b USING (tx_id)""", *CASCADE, OTHER))
def evl6(spark, sf):
    return evaluate.compare_predictors(categorised(spark, sf), other(spark, sf))


@query("evl6_branch_deltas", sql("""SELECT branch, coalesce(x, 0) AS n_a, coalesce(y, 0) AS n_b, coalesce(y, 0) - coalesce(x, 0) AS delta FROM
  (SELECT branch, count(*) AS x FROM cls GROUP BY 1) FULL JOIN (SELECT branch, count(*) AS y FROM other GROUP BY 1) USING (branch)""", *CASCADE, OTHER))
def evl6_deltas(spark, sf):
    return evaluate.branch_deltas(categorised(spark, sf), other(spark, sf))


@query("jn9_disagreements", sql("""SELECT tx_id, a.code AS a, b.code AS b FROM cls a JOIN other b USING (tx_id) WHERE a.code <> b.code
  ORDER BY tx_id LIMIT 10""", *CASCADE, OTHER))
def jn9(spark, sf):
    return evaluate.disagreements(categorised(spark, sf), other(spark, sf))


CASES = values("cases", "phrase, expected", [*evaluate.REGRESSION_CASES, ("WOOLWORTHS", "EXP-016")])


@query("evl7_regression_cases", sql("""SELECT phrase, expected, count(cls.tx_id) AS matches, count(*) FILTER (cls.code = expected) AS correct
  FROM cases LEFT JOIN cls ON contains(upper(description), phrase) GROUP BY 1, 2""", *CASCADE, CASES))
def evl7(spark, sf):
    return evaluate.regression_cases(categorised(spark, sf), [*evaluate.REGRESSION_CASES, ("WOOLWORTHS", "EXP-016")])


# -- checks ------------------------------------------------------------------------------------

@query("dq1_unknown_codes", sql("SELECT code, count(*) AS n FROM cls WHERE code NOT IN (SELECT code FROM tax) GROUP BY 1", *CASCADE, TAXONOMY))
def dq1(spark, sf):
    return quality.unknown_codes(categorised(spark, sf), tables.taxonomy(spark))


@query("dq1_required_codes", sql("SELECT code FROM required WHERE code NOT IN (SELECT code FROM tx)", values("required", "code", [(c,) for c in tables.REQUIRED_CODES])))
def dq1_required(spark, sf):
    """The codes of the transactions as a taxonomy: which required ones it lacks."""
    return quality.missing_required(transactions(spark, sf).select("code").distinct())


# Every seventh transaction carries a code that no taxonomy has.
def astray(code):
    return F.when(F.col("seq") % 7 == 0, F.concat(code, F.lit("-X"))).otherwise(F.col(code))


@query("jn11_codes_outside", sql("""SELECT DISTINCT CASE WHEN seq % 7 = 0 THEN code || '-X' ELSE code END AS code FROM tx
  WHERE CASE WHEN seq % 7 = 0 THEN code || '-X' ELSE code END NOT IN (SELECT code FROM tax)""", TAXONOMY))
def jn11(spark, sf):
    return quality.unknown_codes(transactions(spark, sf).withColumn("code", astray("code")), tables.taxonomy(spark)).select("code")


@query("set6_codes_difference", sql("""SELECT CASE WHEN tx.seq % 7 = 0 THEN cls.code || '-X' ELSE cls.code END AS code FROM cls JOIN tx USING (tx_id)
  EXCEPT SELECT code FROM tax""", *CASCADE, TAXONOMY))
def set6(spark, sf):
    return quality.unknown_codes(categorised(spark, sf).withColumn("code", astray("code")), tables.taxonomy(spark)).select("code")


@query("set3_own_windows", sql("""SELECT customer_id, m AS merchant_key, strftime(last_date, '%Y-%m-%d') AS last_date FROM
  (SELECT customer_id, trim(lower(description)) AS m, max(tx_date) AS last_date FROM tx GROUP BY 1, 2)
  JOIN (SELECT customer_id, max(tx_date) - 90 AS since FROM tx GROUP BY 1) USING (customer_id) WHERE last_date < since"""))
def set3_own(spark, sf):
    """Merchants that fell silent in the last 90 days of each customer's own history."""
    tx = transactions(spark, sf)
    since = tx.groupBy("customer_id").agg(F.date_sub(F.max("tx_date"), 90).alias("since"))
    return series.stopped_merchants(tx, since).withColumn("last_date", F.date_format("last_date", "yyyy-MM-dd"))


@query("dq2_must_not_probes", sql("""SELECT code, count(*) AS n, count(*) FILTER (hit) AS ok FROM (SELECT tx.code,
  CASE WHEN seq % 3 = 0 THEN rm.code IS DISTINCT FROM tx.code WHEN seq % 3 = 1 THEN coalesce(rm.code = tx.code, false)
  ELSE coalesce(rm.code = tx.code AND rm.code <> 'EXP-016', false) END AS hit FROM tx LEFT JOIN rm ON rm.text = description) GROUP BY 1""", ON_RAW))
def dq2_not(spark, sf):
    """A third of the cases must not give their code, a third must, a third must and not be EXP-016."""
    turn = F.col("seq") % 3
    cases = transactions(spark, sf).select(
        "code", F.col("description").alias("text"), F.when(turn > 0, F.col("code")).alias("must_be"),
        F.when(turn == 0, F.col("code")).when(turn == 2, F.lit("EXP-016")).alias("must_not_be"))
    return quality.rule_probes(cases, RuleBook.seed()).groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("ok"))


@query("dq5_normaliser_codes", sql("SELECT tx_id, rm.code AS code FROM m3 LEFT JOIN rm ON rm.text = merchant", *MERCHANT, RULE_M))
def dq5_codes(spark, sf):
    cases = transactions(spark, sf).select("tx_id", F.col("description").alias("text"), F.lit("").alias("gone"), F.lit("").alias("kept"))
    return quality.normaliser_probes(cases, RuleBook.seed()).select("tx_id", "code")


@query("set3_stopped_merchants", sql("""SELECT customer_id, m FROM (SELECT customer_id, trim(lower(description)) AS m FROM tx
  WHERE tx_date < DATE '2024-10-01' AND cents > 0 EXCEPT SELECT customer_id, trim(lower(description)) FROM tx WHERE tx_date >= DATE '2024-10-01' AND cents > 0)"""))
def set3(spark, sf):
    old = series.sources(transactions(spark, sf).filter("cents > 0")).groupBy("customer_id", F.col("merchant_key").alias("m")).agg(
        F.max("last_date").alias("last"))
    return old.filter(F.col("last") < F.lit("2024-10-01").cast("date")).select("customer_id", "m")


@query("dq2_rule_probes", sql("""SELECT code, count(*) AS n, count(*) FILTER (hit) AS ok FROM (SELECT tx.code, tx.code = rm.code AS hit
  FROM tx LEFT JOIN rm ON rm.text = description) GROUP BY 1""", ON_RAW))
def dq2(spark, sf):
    cases = transactions(spark, sf).select(F.col("description").alias("text"), F.col("code").alias("must_be"),
                                           F.lit(None).cast("string").alias("must_not_be"))
    return quality.rule_probes(cases, RuleBook.seed()).groupBy(F.col("must_be").alias("code")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("ok"))


RULE_ROWS = values("rs", "seq, rule_seq, keyword, code, confidence, reason", tables.rules_rows())


@query("dq3_generic_keyword", sql("""SELECT count(*) AS keywords, count(*) > 0 AS ok, (SELECT count(*) FROM tx WHERE code = 'EXP-034') AS transactions
  FROM rs WHERE code = 'EXP-034' AND NOT contains(keyword, ' ') AND contains(keyword, 'superannuation')""", RULE_ROWS))
def dq3(spark, sf):
    n = transactions(spark, sf).agg(F.count_if(F.col("code") == "EXP-034").alias("n"))
    return quality.has_generic_keyword(tables.seed_rules(spark), "EXP-034", "superannuation").withColumn("transactions", n.scalar())


@query("dq4_generic_to_default", sql("""SELECT provider_category, m.code AS code, count(tx_id) AS n FROM mapping m JOIN tx USING (provider_category)
  WHERE provider_category IN ('Third Party Payment Providers', 'Uncategorised') AND m.code IN ('EXP-039', 'INC-007') GROUP BY 1, 2""", MAPPING_CTE))
def dq4(spark, sf):
    bad = quality.generic_to_default(mapping(spark)).select("provider_category", "code")
    n = transactions(spark, sf).groupBy("provider_category").agg(F.count(F.lit(1)).alias("n"))
    return bad.join(n, "provider_category")


@query("dq5_normaliser_probes", sql("""SELECT tx_id, NOT contains(lower(merchant), 'visa debit purchase card') AS prefix_gone,
  contains(lower(merchant), lower(split_part(description, ' ', -1))) AS merchant_kept FROM m3""",
                                    *MERCHANT))
def dq5(spark, sf):
    cases = transactions(spark, sf).select("tx_id", F.col("description").alias("text"), F.lit("visa debit purchase card").alias("gone"),
                                           F.lower(F.element_at(F.split("description", " "), -1)).alias("kept"))
    return quality.normaliser_probes(cases, RuleBook.seed()).select("tx_id", "prefix_gone", "merchant_kept")


@query("dq6_shadowed_keywords", sql("""SELECT b.keyword, CAST(b.seq AS INTEGER) AS seq, b.code AS never_used, a.code AS used, (SELECT count(*) FROM tx
  WHERE tx.code = b.code) AS transactions FROM rs b JOIN rs a ON a.keyword = b.keyword AND a.seq = (SELECT min(seq) FROM rs c WHERE c.keyword = b.keyword)
  WHERE b.seq > a.seq AND b.code <> a.code""", RULE_ROWS))
def dq6(spark, sf):
    used = transactions(spark, sf).groupBy(F.col("code").alias("never_used")).agg(F.count(F.lit(1)).alias("transactions"))
    return (quality.shadowed_keywords(tables.seed_rules(spark)).join(used, "never_used", "left")
            .withColumn("transactions", F.coalesce("transactions", F.lit(0))))


# -- classifier ----------------------------------------------------------------------------------

def samples(spark, sf):
    return transactions(spark, sf).select("tx_id", "description", F.col("code").alias("label"), "seq")


@query("ml1_class_weights", sql("""SELECT code AS label, CAST(row_number() OVER (ORDER BY code) - 1 AS INTEGER) AS label_index, t / (k * n) AS weight FROM
  (SELECT code, count(*) AS n, (SELECT count(DISTINCT code) FROM tx) AS k, (SELECT count(*) FROM tx) AS t FROM tx GROUP BY 1)"""))
def ml1(spark, sf):
    return classifier.class_weights(samples(spark, sf))


@query("ml2_text_classifier")
def ml2(spark, sf):
    """Fitted on four of five rows, scored on the others: accuracy per label."""
    rows = samples(spark, sf)
    model = classifier.fit(rows.filter("seq % 5 <> 0"))
    out = classifier.predict(model, rows.filter("seq % 5 = 0"))
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == F.col("model_code")).alias("hits"),
                                    F.round(F.avg("model_confidence"), 2).alias("mean_confidence"))

