"""Fuzzy matching and learned mappings."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import tables
from ..operators import filters, learning, matching
from .base import CATALOGUE, catalogue, spread, sql, table, transactions
from .classify import NAME_SQL, NAMES
from .registry import query

LAB = f"""lab AS (SELECT user_id AS customer_id, event_id AS seq,
  CASE WHEN event_id % 4 = 1 THEN 'AUS CARD SETTLED BY NETWORK ' ELSE '' END ||
    replace(text, '#', CAST(1000 + event_id % 9000 AS VARCHAR)) AS description,
  CAST(sign * CAST(round(value * 100) AS BIGINT) + event_id % 3 - 1 + CASE WHEN event_id % 3 = 0 THEN 1000000000 ELSE 0 END AS BIGINT) AS cents,
  CAST(DATE '2024-07-01' + CAST((event_id * 37 + user_id) % 184 + event_id % 7 - 3 AS INTEGER) AS TIMESTAMP)
    + to_hours(CAST(event_id % 24 AS INTEGER)) AS ts, code
  FROM events JOIN cat ON idx = event_id % {len(CATALOGUE)})"""


def labelled(spark, sf):
    e = F.col("event_id")
    ev = spread(table(spark, sf, "events"), "event_id").withColumn("idx", e % len(CATALOGUE))
    day = F.date_add(F.lit("2024-07-01").cast("date"),
                     ((e * 37 + F.col("user_id")) % 184 + e % 7 - 3).cast("int"))
    return ev.join(catalogue(spark), "idx").select(
        F.col("user_id").alias("customer_id"), e.alias("seq"),
        F.concat(F.when(e % 4 == 1, "AUS CARD SETTLED BY NETWORK ").otherwise(""),
                 F.replace("text", F.lit("#"), (F.lit(1000) + e % 9000).cast("string"))).alias("description"),
        (F.col("sign") * F.round(F.col("value") * 100).cast("bigint") + e % 3 - 1 + F.when(e % 3 == 0, 1_000_000_000).otherwise(0)).alias("cents"),
        (day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (e % 24).cast("int"))).alias("ts"), "code")


WORDS = """list_distinct(string_split(trim(regexp_replace(regexp_replace(lower({d}), '[^a-z0-9 ]', '', 'g'), ' +', ' ', 'g')), ' '))"""
# All pairs of one customer, then the first by order.
MATCH = [LAB, f"lt AS (SELECT tx.*, {WORDS.format(d='description')} AS w FROM tx)",
         f"rt AS (SELECT lab.*, {WORDS.format(d='description')} AS w FROM lab)",
         """best AS (SELECT l.tx_id, arg_min(r.seq, r.seq) AS match_seq, arg_min(r.code, r.seq) AS match_code
  FROM lt l JOIN rt r ON l.customer_id = r.customer_id AND r.cents BETWEEN l.cents - 1 AND l.cents + 1
  AND abs(floor((epoch(CAST(l.tx_date AS TIMESTAMP)) - epoch(r.ts)) / 86400.0)) <= 2
  WHERE len(list_intersect(l.w, r.w)) * 5 >= 2 * least(len(l.w), len(r.w)) GROUP BY 1)""",
         "fz AS (SELECT tx.*, match_seq, match_code FROM tx LEFT JOIN best USING (tx_id))"]


@query("jn3_fuzzy_range", sql("SELECT tx_id, customer_id, match_seq, match_code FROM fz", *MATCH))
def jn3(spark, sf):
    return matching.fuzzy_match(transactions(spark, sf), labelled(spark, sf)).select(
        "tx_id", "customer_id", "match_seq", "match_code")


@query("set5_word_overlap", sql("""SELECT tx_id, CAST(len(list_intersect(l.w, r.w)) AS INTEGER) AS common,
  CAST(least(len(l.w), len(r.w)) AS INTEGER) AS smaller FROM lt l JOIN rt r ON l.tx_id = 'e' || r.seq""", *MATCH))
def set5(spark, sf):
    left = transactions(spark, sf).select("tx_id", matching.word_set(F.col("description")).alias("a"))
    right = labelled(spark, sf).select(F.concat(F.lit("e"), "seq").alias("tx_id"),
                                       matching.word_set(F.col("description")).alias("b"))
    return left.join(right, "tx_id").select(
        "tx_id", F.size(F.array_intersect("a", "b")).alias("common"), F.least(F.size("a"), F.size("b")).alias("smaller"))


MODE = """cnt AS (SELECT provider_category, match_code, count(*) AS n, min(seq) AS first FROM fz
    WHERE match_seq IS NOT NULL AND provider_category <> '' GROUP BY 1, 2),
  rk AS (SELECT *, row_number() OVER (PARTITION BY provider_category ORDER BY n DESC, first) AS rn,
    CAST(sum(n) OVER (PARTITION BY provider_category) AS BIGINT) AS total FROM cnt)"""


@query("agg8_mode", sql("SELECT provider_category, match_code, n, total FROM rk WHERE rn = 1", *MATCH, MODE))
def agg8(spark, sf):
    m = matching.fuzzy_match(transactions(spark, sf), labelled(spark, sf))
    hits = m.filter((F.col("provider_category") != "") & F.col("match_seq").isNotNull())
    return matching.mode_by(hits, "provider_category", "match_code", "seq")


@query("agg9_first_samples", sql("""SELECT code, string_agg(tx_id, ',' ORDER BY seq) AS samples FROM (SELECT *, row_number()
  OVER (PARTITION BY code ORDER BY seq) AS rn FROM tx) WHERE rn <= 5 GROUP BY 1"""))
def agg9(spark, sf):
    head = learning.first_k(transactions(spark, sf), ["code"], [F.asc("seq")], 5)
    return head.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("seq", "tx_id"))).alias("s")).select(
        "code", F.array_join("s.tx_id", ",").alias("samples"))


LEARNED = f"""lm AS (SELECT provider_category, coalesce(rk.match_code, nm_code, CASE WHEN s > 0 THEN 'INC-007' ELSE 'EXP-039' END) AS code,
  CASE WHEN rk.n IS NOT NULL THEN rk.n / total_count WHEN nm_code IS NOT NULL THEN 0.5 ELSE 0.3 END AS confidence,
  coalesce(rk.n, 0) AS matched_count, total_count, CASE WHEN rk.n IS NOT NULL THEN 'transaction_match'
  WHEN nm_code IS NOT NULL THEN 'semantic' ELSE 'fallback' END AS provenance FROM (SELECT provider_category,
  {NAME_SQL.format(c='provider_category')} AS nm_code, total_count, s FROM (SELECT provider_category, count(*) AS total_count,
  sum(cents) AS s FROM fz WHERE provider_category <> '' GROUP BY 1)) t LEFT JOIN (SELECT * FROM rk WHERE rn = 1) rk
  USING (provider_category))"""


@query("agg10_category_mapping", sql("SELECT * REPLACE (CAST(confidence AS DOUBLE) AS confidence) FROM lm",
                                     *MATCH, MODE, NAMES, LEARNED))
def agg10(spark, sf):
    m = matching.fuzzy_match(transactions(spark, sf), labelled(spark, sf))
    return matching.learn_category_mapping(m).drop("sample_matches")


@query("agg11_mapping_report", sql("""SELECT count(*) AS total_categories,
  count(*) FILTER (provenance = 'transaction_match') AS transaction_match, count(*) FILTER (provenance = 'semantic') AS semantic,
  count(*) FILTER (provenance = 'fallback') AS fallback, count(*) FILTER (confidence >= 0.8) AS high_confidence,
  count(*) FILTER (confidence >= 0.5 AND confidence < 0.8) AS medium_confidence,
  count(*) FILTER (confidence < 0.5) AS low_confidence FROM lm""", *MATCH, MODE, NAMES, LEARNED))
def agg11(spark, sf):
    m = matching.fuzzy_match(transactions(spark, sf), labelled(spark, sf))
    return matching.mapping_report(matching.learn_category_mapping(m))


GOLD = """gd AS (SELECT seq, subclass_code, CASE WHEN subclass_code = '' THEN '' ELSE 'Class ' || subclass_code ||
  CASE WHEN seq % 5 = 0 THEN ' old' ELSE '' END END AS subclass_title, code AS label_group_code, description,
  CASE WHEN seq % 4 = 0 THEN 'report_key' WHEN seq % 4 = 3 THEN 'default' ELSE 'report_id' END AS label_source FROM tx)"""


def gold_input(spark, sf):
    s = F.col("seq")
    return transactions(spark, sf).select(
        "seq", "subclass_code", F.when(F.col("subclass_code") == "", "").otherwise(F.concat(
            F.lit("Class "), "subclass_code", F.when(s % 5 == 0, " old").otherwise(""))).alias("subclass_title"),
        F.col("code").alias("label_group_code"), "description",
        F.when(s % 4 == 0, "report_key").when(s % 4 == 3, "default").otherwise("report_id").alias("label_source"))


@query("flt8_gold_rows", sql("""SELECT seq, subclass_code, label_group_code FROM gd WHERE label_source <> 'default'
  AND subclass_code <> ''""", GOLD))
def flt8(spark, sf):
    return filters.gold_rows(gold_input(spark, sf)).select("seq", "subclass_code", "label_group_code")


SUB = """sub AS (SELECT subclass_code, subclass_title, label_group_code, n / total AS confidence, CAST(total AS BIGINT) AS transaction_count,
    (SELECT string_agg(description, '|' ORDER BY seq) FROM (SELECT description, seq FROM gd g WHERE label_source <> 'default'
      AND g.subclass_code = b.subclass_code AND g.label_group_code = b.label_group_code ORDER BY seq LIMIT 5)) AS samples
  FROM (SELECT *, row_number() OVER (PARTITION BY subclass_code ORDER BY n DESC, first) AS rn,
    sum(n) OVER (PARTITION BY subclass_code) AS total FROM (SELECT subclass_code, label_group_code, count(*) AS n, min(seq) AS first
    FROM gd WHERE label_source <> 'default' AND subclass_code <> '' GROUP BY 1, 2)) b
  JOIN (SELECT subclass_code, subclass_title FROM (SELECT subclass_code, subclass_title, row_number() OVER (PARTITION BY subclass_code
    ORDER BY count(*) DESC, min(seq)) AS rn FROM gd WHERE label_source <> 'default' AND subclass_code <> '' GROUP BY 1, 2) WHERE rn = 1)
  USING (subclass_code) WHERE rn = 1)"""


@query("lrm1_subclass_mapping", sql("SELECT * FROM sub", GOLD, SUB))
def lrm1(spark, sf):
    return matching.learn_subclass_mapping(gold_input(spark, sf)).withColumn(
        "samples", F.array_join("sample_descriptions", "|")).drop("sample_descriptions")


@query("flt9_confidence_split", sql("""SELECT subclass_code, confidence >= 0.8 AS high FROM sub""", GOLD, SUB))
def flt9(spark, sf):
    high, low = matching.subclass_outputs(matching.learn_subclass_mapping(gold_input(spark, sf)))
    return high.select("subclass_code", F.lit(True).alias("high")).unionByName(
        low.select("subclass_code", F.lit(False).alias("high")))


