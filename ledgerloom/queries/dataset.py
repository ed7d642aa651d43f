"""Labelled dataset, coverage, reconciliation and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import filters, labels
from .. import tables
from .base import event_rows, sql, values
from .registry import query

# One API row per event, every 20th twice; report records with ids or keys, some in conflict.
API = """runs AS (SELECT ev.*, seq AS e, customer_id % 60 AS rn, 'demo' || (customer_id % 60 % 7) || '/run' || (customer_id % 60) AS run_id FROM ev),
  api0 AS (SELECT run_id, run_id || '/StatementCapture/retrieve-transactions_' || (e % 3) || '.json' AS path, e AS pos, 't' || e AS tx_id,
    CASE WHEN e % 16 = 1 THEN '1.00' ELSE printf('%.2f', cents / 100.0) END AS amount, CASE WHEN cents > 0 THEN 'CREDIT' ELSE 'debit' END AS direction,
    CASE WHEN e % 16 = 1 THEN 'Card  fee' ELSE description END AS description,
    CASE WHEN e % 4 = 0 THEN '' ELSE CASE WHEN e % 16 = 1 THEN '2024-08-01' ELSE strftime(tx_date, '%Y-%m-%d') END || 'T10:00:00Z' END AS transaction_date,
    strftime(tx_date, '%Y-%m-%d') AS post_date, code, e FROM runs),
  api AS (SELECT * FROM api0 UNION ALL SELECT * REPLACE (path || '_z' AS path, 'copy' AS description) FROM api0 WHERE e % 20 = 0),
  rec0 AS (SELECT CASE WHEN e % 3 = 0 OR CAST(split_part(run_id, 'run', 2) AS INTEGER) % 10 = 3 THEN 'gone' ELSE '' END || run_id AS run_id, e % 4 AS report_seq, e AS pos, CASE WHEN e % 2 = 0 THEN tx_id END AS tx_id, description, amount,
    CASE WHEN transaction_date = '' THEN post_date ELSE transaction_date END AS date, code, e
    FROM api0),
  rec1 AS (SELECT * FROM rec0 UNION ALL SELECT * REPLACE (report_seq + 4 AS report_seq, 'EXP-054' AS code) FROM rec0 WHERE e % 5 = 0
    UNION ALL SELECT * REPLACE (report_seq + 2050 AS report_seq) FROM rec0 WHERE e % 25 = 0),
  rec AS (SELECT *, run_id || '/AffordabilityReports/report_' || report_seq || '.json' AS report_path FROM rec1)"""


def api_full(spark, sf):
    e = F.col("seq")
    run = F.concat(F.lit("demo"), F.col("customer_id") % 60 % 7, F.lit("/run"), F.col("customer_id") % 60)
    day = F.date_format("tx_date", "yyyy-MM-dd")
    fee = e % 16 == 1
    base = event_rows(spark, sf).select(
        run.alias("run_id"), F.concat(run, F.lit("/StatementCapture/retrieve-transactions_"), e % 3, F.lit(".json")).alias("path"),
        e.alias("pos"), F.concat(F.lit("t"), e).alias("tx_id"),
        F.when(fee, "1.00").otherwise((F.col("cents") / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)").cast("string")).alias("amount"),
        F.when(F.col("cents") > 0, "CREDIT").otherwise("debit").alias("direction"),
        F.when(fee, "Card  fee").otherwise(F.col("description")).alias("description"),
        F.when(e % 4 == 0, "").otherwise(F.concat(F.when(fee, "2024-08-01").otherwise(day), F.lit("T10:00:00Z"))).alias("transaction_date"),
        day.alias("post_date"), "code")
    return base


def api(spark, sf):
    base = api_full(spark, sf)
    copies = base.filter(F.col("pos") % 20 == 0).withColumns({
        "path": F.concat("path", F.lit("_z")), "description": F.lit("copy")})
    return base.unionByName(copies).drop("code")


def records(spark, sf):
    e = F.col("pos")
    # A third of the rows, and all of some runs, are reported for runs without transactions.
    gone = (e % 3 == 0) | (F.split_part("run_id", F.lit("run"), F.lit(2)).cast("int") % 10 == 3)
    base = api_full(spark, sf).select(
        F.concat(F.when(gone, "gone").otherwise(""), "run_id").alias("run_id"), (e % 4).alias("report_seq"), "pos", F.when(e % 2 == 0, F.col("tx_id")).alias("tx_id"), "description", "amount",
        F.when(F.col("transaction_date") == "", F.col("post_date")).otherwise(F.col("transaction_date")).alias("date"), "code")
    more = base.filter(e % 5 == 0).withColumns({"report_seq": F.col("report_seq") + 4, "code": F.lit("EXP-054")})
    again = base.filter(e % 25 == 0).withColumn("report_seq", F.col("report_seq") + 2050)
    return base.unionByName(more).unionByName(again).withColumn("report_path", F.concat(
        "run_id", F.lit("/AffordabilityReports/report_"), "report_seq", F.lit(".json")))


DEDUP = """tx1 AS (SELECT *, lower(trim(regexp_replace(description, '\\s+', ' ', 'g'))) || '|' || amount || '|' ||
  left(CASE WHEN transaction_date = '' THEN post_date ELSE transaction_date END, 10) AS k FROM
  (SELECT *, row_number() OVER (PARTITION BY run_id, tx_id ORDER BY path, pos) AS rn FROM api) WHERE rn = 1)"""
# The records of a key are read one by one.
FOLD = """kr AS (SELECT *, row_number() OVER (PARTITION BY run_id, k ORDER BY report_seq, pos) AS rn FROM (SELECT *, CASE WHEN tx_id IS NOT NULL
  THEN 'id:' || tx_id ELSE 'key:' || lower(trim(regexp_replace(description, '\\s+', ' ', 'g'))) || '|' || amount || '|' || left(date, 10) END AS k FROM rec)),
  step AS (SELECT run_id, k, rn, code AS state FROM kr WHERE rn = 1 UNION ALL SELECT kr.run_id, kr.k, kr.rn,
    CASE WHEN step.state IS NULL OR step.state = kr.code THEN kr.code END FROM step JOIN kr ON kr.run_id = step.run_id AND kr.k = step.k AND kr.rn = step.rn + 1),
  lastrec AS (SELECT run_id, k, max(rn) AS rn, count(DISTINCT code) > 1 AS conflict FROM kr GROUP BY 1, 2),
  fin AS (SELECT l.run_id, l.k, state AS code, CASE WHEN state IS NOT NULL THEN report_path END AS report_path, conflict
    FROM lastrec l JOIN step USING (run_id, k, rn) JOIN kr USING (run_id, k, rn))"""
LABEL = """n AS (SELECT run_id, k, count(*) AS n FROM tx1 GROUP BY 1, 2),
  lab AS (SELECT t.*, CASE WHEN i.code IS NOT NULL THEN 'report_id' WHEN f.code IS NOT NULL AND n = 1 THEN 'report_key'
    WHEN (coalesce(i.conflict, false) OR coalesce(f.conflict, false)) AND contains(lower(description), '.com') THEN 'rule_online_retail'
    WHEN contains(lower(description), 'transfer') THEN 'rule_transfer'
    WHEN contains(lower(description), 'interest') AND starts_with(amount, '-') THEN 'rule_interest_debit'
    WHEN contains(lower(description), 'interest') THEN 'rule_interest_credit' ELSE 'fallback_uncategorised' END AS label_source,
    i.code AS ic, f.code AS fc, i.report_path AS ip, f.report_path AS fp FROM tx1 t JOIN n USING (run_id, k)
    LEFT JOIN fin i ON i.run_id = t.run_id AND i.k = 'id:' || t.tx_id LEFT JOIN fin f ON f.run_id = t.run_id AND f.k = 'key:' || t.k),
  done AS (SELECT run_id, tx_id, lower(direction) AS direction, CAST(amount AS DOUBLE) AS amount, description, label_source,
    CASE label_source WHEN 'report_id' THEN ic WHEN 'report_key' THEN fc WHEN 'rule_online_retail' THEN 'EXP-024' WHEN 'rule_transfer' THEN 'EXP-013'
      WHEN 'rule_interest_debit' THEN 'EXP-006' WHEN 'rule_interest_credit' THEN 'INC-004'
      ELSE CASE WHEN lower(direction) = 'credit' THEN 'INC-007' ELSE 'EXP-039' END END AS label_group_code,
    CASE label_source WHEN 'report_id' THEN ip WHEN 'report_key' THEN fp ELSE '' END AS report_path FROM lab)"""


def rsql(select, *ctes):
    return sql(select, *ctes).replace("WITH ", "WITH RECURSIVE ", 1)


@query("win3_first_row", sql("SELECT run_id, tx_id, path, description FROM tx1", API, DEDUP))
def win3(spark, sf):
    return labels.first_rows(api(spark, sf)).select("run_id", "tx_id", "path", "description")


@query("win5_key_counts", sql("""SELECT n AS rows_per_key, count(*) AS keys FROM (SELECT run_id, k, count(*) AS n FROM tx1 GROUP BY 1, 2)
  GROUP BY 1""", API, DEDUP))
def win5(spark, sf):
    tx = labels.first_rows(api(spark, sf))
    counts = labels.key_counts(labels.with_key(tx, labels.tx_day(tx)))
    return counts.groupBy(F.col("_n").alias("rows_per_key")).agg(F.count(F.lit(1)).alias("keys"))


@query("win4_conflicts", rsql("SELECT run_id, substr(k, 4) AS tx_id, code, report_path, conflict FROM fin WHERE starts_with(k, 'id:')", API, FOLD))
def win4(spark, sf):
    return labels.labels_by_id(records(spark, sf))


@query("dst1_report_labels", rsql("""SELECT CASE WHEN starts_with(k, 'id:') THEN 'id' ELSE 'key' END AS kind, count(*) AS n,
  count(code) AS usable, count(*) FILTER (conflict) AS conflicts FROM fin GROUP BY 1""", API, FOLD))
def dst1(spark, sf):
    rec = records(spark, sf)
    both = labels.labels_by_id(rec).select(F.lit("id").alias("kind"), "code", "conflict").unionByName(
        labels.labels_by_key(rec).select(F.lit("key").alias("kind"), "code", "conflict"))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count("code").alias("usable"),
                                    F.count_if("conflict").alias("conflicts"))


def labelled(spark, sf):
    return labels.label_transactions(api(spark, sf), records(spark, sf))


@query("dst2_label_cascade", rsql("SELECT * FROM done", API, DEDUP, FOLD, LABEL))
def dst2(spark, sf):
    return labelled(spark, sf).select("run_id", "tx_id", "direction", F.col("amount").cast("double").alias("amount"), "description",
                                      "label_source", "label_group_code", "report_path")


@query("jn1_label_by_id", rsql("SELECT run_id, tx_id, label_group_code FROM done WHERE label_source = 'report_id'", API, DEDUP, FOLD, LABEL))
def jn1(spark, sf):
    return labelled(spark, sf).filter("label_source = 'report_id'").select("run_id", "tx_id", "label_group_code")


@query("jn2_label_by_key", rsql("SELECT run_id, tx_id, label_group_code FROM done WHERE label_source = 'report_key'", API, DEDUP, FOLD, LABEL))
def jn2(spark, sf):
    return labelled(spark, sf).filter("label_source = 'report_key'").select("run_id", "tx_id", "label_group_code")


@query("dst4_check_codes", rsql("""SELECT * FROM (SELECT CASE WHEN ends_with(tx_id, '7') THEN label_group_code || '-X' ELSE label_group_code END AS code,
  count(*) AS n, 'dataset' AS place FROM done GROUP BY 1 UNION ALL SELECT CASE WHEN e % 50 = 9 THEN code || '-X' ELSE code END, count(*), 'report' FROM rec GROUP BY 1)
  WHERE code NOT IN (SELECT code FROM tax)""", API, DEDUP, FOLD, LABEL, values("tax", "code, name", tables.TAXONOMY)))
def dst4_check(spark, sf):
    """Some labels and some records carry a code that the taxonomy lacks."""
    rec = records(spark, sf)
    done = labels.label_transactions(api(spark, sf), rec)
    code = F.col("label_group_code")
    done = done.withColumn("label_group_code", F.when(F.col("tx_id").endswith("7"), F.concat(code, F.lit("-X"))).otherwise(code))
    rec = rec.withColumn("code", F.when(F.col("pos") % 50 == 9, F.concat("code", F.lit("-X"))).otherwise(F.col("code")))
    return labels.check_labels(done, rec, tables.taxonomy(spark))


@query("agg14_coverage", rsql("""SELECT coalesce(run_id, 'ALL') AS run_id, CAST(sum(total) AS BIGINT) AS total_transactions, CAST(sum(i) AS BIGINT) AS labeled_by_id,
  CAST(sum(k) AS BIGINT) AS labeled_by_key, CAST(sum(u) AS BIGINT) AS uncategorised, CAST(sum(t) AS BIGINT) AS rule_transfer, CAST(sum(n) AS BIGINT) AS rule_interest,
  CAST(sum(o) AS BIGINT) AS rule_online_retail, CAST(sum(CASE WHEN run_id IN (SELECT run_id FROM rec) THEN 0 ELSE u END) AS BIGINT) AS missing_report,
  CAST(sum(coalesce(ci, 0)) AS BIGINT) AS conflicts_id, CAST(sum(coalesce(ck, 0)) AS BIGINT) AS conflicts_key FROM
  (SELECT run_id, count(*) AS total, count(*) FILTER (label_source = 'report_id') AS i, count(*) FILTER (label_source = 'report_key') AS k,
   count(*) FILTER (label_source = 'fallback_uncategorised') AS u, count(*) FILTER (label_source = 'rule_transfer') AS t,
   count(*) FILTER (label_source LIKE 'rule_interest%') AS n, count(*) FILTER (label_source = 'rule_online_retail') AS o FROM done GROUP BY 1)
  LEFT JOIN (SELECT run_id, count(*) FILTER (starts_with(k, 'id:')) AS ci, count(*) FILTER (starts_with(k, 'key:')) AS ck FROM fin WHERE conflict GROUP BY 1)
  USING (run_id) GROUP BY GROUPING SETS ((run_id), ())""", API, DEDUP, FOLD, LABEL))
def agg14(spark, sf):
    rec = records(spark, sf)
    return labels.coverage(labels.label_transactions(api(spark, sf), rec), rec)


@query("agg15_dataset_totals", rsql("""SELECT run_id, label_group_code, CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) / 100.0 AS total
  FROM done GROUP BY 1, 2""", API, DEDUP, FOLD, LABEL))
def agg15(spark, sf):
    return labels.dataset_totals(labelled(spark, sf)).withColumn("total", F.col("total").cast("double"))


GROUPS = """grp AS (SELECT run_id, report_path, code, CASE WHEN e % 50 = 7 THEN 'n/a' ELSE amount END AS total FROM rec)"""


def groups(spark, sf):
    return records(spark, sf).select("run_id", "report_path", "code", F.when(F.col("pos") % 50 == 7, "n/a")
                                     .otherwise(F.col("amount")).alias("total"))


REC = """SELECT g.run_id, report_path, g.code, report_total / 100.0 AS report_total, coalesce(t, 0) / 100.0 AS total, (coalesce(t, 0) - report_total) / 100.0 AS delta
  FROM (SELECT run_id, report_path, code, CAST(sum(CAST(round(CAST(total AS DOUBLE) * 100) AS BIGINT)) AS BIGINT) AS report_total FROM grp
    WHERE total <> 'n/a' GROUP BY 1, 2, 3) g LEFT JOIN (SELECT run_id, label_group_code AS code, CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS t
    FROM done GROUP BY 1, 2) d ON d.run_id = g.run_id AND d.code = g.code"""


@query("agg16_reconciliation", rsql(REC, API, DEDUP, FOLD, LABEL, GROUPS))
def agg16(spark, sf):
    out = labels.reconcile(labelled(spark, sf), groups(spark, sf))
    return out.withColumns({c: F.col(c).cast("double") for c in ("report_total", "total", "delta")})


@query("jn10_missing_totals", rsql(f"SELECT run_id, report_path, code FROM ({REC}) WHERE total = 0", API, DEDUP, FOLD, LABEL, GROUPS))
def jn10(spark, sf):
    return labels.reconcile(labelled(spark, sf), groups(spark, sf)).filter("total = 0").select("run_id", "report_path", "code")


# -- splits -----------------------------------------------------------------------------------

RUNS = """rr AS (SELECT DISTINCT run_id, CASE WHEN rn % 7 <> 6 THEN 'Persona ' || (rn % 7) END AS persona FROM runs)"""


def run_personas(spark, sf):
    no = F.split_part("run_id", F.lit("run"), F.lit(2)).cast("int") % 7
    return api_full(spark, sf).select("run_id").distinct().withColumn(
        "persona", F.when(no != 6, F.concat(F.lit("Persona "), no)))


@query("spl1_hash_split", sql("""SELECT run_id, CASE WHEN h < 0.7 THEN 'train' WHEN h < 0.85 THEN 'val' ELSE 'test' END AS split FROM
  (SELECT run_id, CAST(CAST('0x' || substr(sha256(run_id), 1, 16) AS UBIGINT) AS DOUBLE) / 18446744073709551616.0 AS h FROM rr)""", API, RUNS))
def spl1(spark, sf):
    return run_personas(spark, sf).select("run_id", labels.hash_split(F.col("run_id")).alias("split"))


SPLIT = """small AS (SELECT persona FROM rr WHERE persona IS NOT NULL GROUP BY 1 ORDER BY count(*), persona LIMIT 2),
  sp AS (SELECT *, CASE WHEN persona IS NULL THEN 'val' WHEN persona IN (SELECT persona FROM small) THEN 'test' ELSE 'train' END AS split FROM rr)"""


@query("spl2_persona_split", sql("SELECT run_id, persona, split FROM sp", API, RUNS, SPLIT))
def spl2(spark, sf):
    return labels.persona_splits(run_personas(spark, sf)).select("run_id", "persona", "split")


@query("spl3_split_manifest", sql("SELECT split, count(*) AS runs, count(DISTINCT persona) AS personas FROM sp GROUP BY 1", API, RUNS, SPLIT))
def spl3(spark, sf):
    return labels.split_manifest(labels.persona_splits(run_personas(spark, sf)))


@query("spl3_split_personas", sql("SELECT split, persona, count(*) AS runs FROM sp WHERE persona IS NOT NULL GROUP BY 1, 2", API, RUNS, SPLIT))
def spl3_personas(spark, sf):
    return labels.split_personas(labels.persona_splits(run_personas(spark, sf)))


@query("flt7_validation", sql("""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN seq % 11 = 0 THEN 'missing id' WHEN seq % 13 = 0 THEN 'bad amount'
  WHEN seq % 17 = 0 THEN 'bad direction' END AS reason FROM tx) GROUP BY 1"""))
def flt7(spark, sf):
    from .base import transactions

    s = F.col("seq")
    dirty = transactions(spark, sf).select(
        F.when(s % 11 == 0, " ").otherwise(F.col("tx_id")).alias("tx_id"),
        F.when(s % 13 == 0, "12,5x").otherwise("12.50").alias("amount"),
        F.when(s % 17 == 0, "sideways").otherwise("Debit").alias("direction"))
    good, bad = filters.validate_api_rows(dirty)
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"))


@query("top4_ordered_output", rsql("SELECT run_id, tx_id, row_number() OVER (ORDER BY run_id, tx_id) AS place FROM done",
                                   API, DEDUP, FOLD, LABEL))
def top4(spark, sf):
    # Place in the order within the run, after the rows of earlier runs: no task ranks all rows.
    from pyspark.sql import Window as W

    rows = labelled(spark, sf).select("run_id", "tx_id")
    runs = rows.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    before = W.orderBy("run_id").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select("run_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(W.partitionBy("run_id").orderBy("tx_id")) + F.col("before")
    return rows.join(runs, "run_id").select("run_id", "tx_id", place.alias("place")).orderBy("run_id", "tx_id")


