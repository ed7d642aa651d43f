"""Rule matching and category cascades."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from .. import tables
from ..config import CascadeParams
from ..operators import cascade, filters, rules, transfers
from .base import MAPPING_CTE, literal, mapping, sql, transactions, values
from .registry import query
from .textual import ACCOUNTS_SQL, MERCHANT
from .transfer import HINT, MATCHED, NAMED, OWN, PAIRS, TWO_WAY

P = CascadeParams()
WORD = r"[\p{L}\p{N}_]"


def bounded(keyword: str) -> str:
    """Whole-word pattern without word-boundary escapes, which are ASCII-only in RE2."""
    word = re.compile(r"\w")
    start = r"(^|[^\p{L}\p{N}_])" if word.match(keyword[0]) else WORD
    end = r"($|[^\p{L}\p{N}_])" if word.match(keyword[-1]) else WORD
    return start + re.escape(keyword).replace("\\ ", " ") + end


def first_hit(name, rows, text, where="TRUE", source="m3"):
    """The first matching rule per distinct text: an ordered CASE, then the rule's columns."""
    cases = " ".join(f"WHEN regexp_matches(low, {literal(bounded(r[2]))}) THEN {r[0]}" for r in rows)
    table = values("r", "seq, keyword, code, confidence, reason", [(r[0], r[2], r[3], r[4], r[5]) for r in rows])
    return f"""{name} AS (WITH {table} SELECT text, code, CAST(confidence AS DOUBLE) AS confidence, reason, keyword FROM
      (SELECT text, CASE {cases} END AS seq FROM (SELECT DISTINCT {text} AS text, lower({text}) AS low
       FROM {source} WHERE {where})) JOIN r USING (seq))"""


RULE_M = first_hit("rm", tables.rules_rows(), "merchant")
INCOME_M = first_hit("im", tables.income_rows(), "merchant", "cents > 0")
ON_RAW = first_hit("rm", tables.rules_rows(), "description", source="tx")
KEYWORDS = values("rl", "seq, keyword, code", [(r[0], r[2], r[3]) for r in tables.rules_rows()])


@query("cls1_rule_match", sql("""SELECT tx_id, rm.code AS rule_code, rm.confidence AS rule_confidence,
  rm.reason AS rule_reason, rm.keyword AS rule_keyword FROM tx LEFT JOIN rm ON rm.text = description""",
                              ON_RAW))
def cls1(spark, sf):
    return rules.match_rules(transactions(spark, sf), rules.RuleBook.seed(), "description").select(
        "tx_id", "rule_code", "rule_confidence", "rule_reason", "rule_keyword")


@query("cls1_rule_match_join", sql("""SELECT tx_id, rm.code AS rule_code, rm.confidence AS rule_confidence,
  rm.reason AS rule_reason, rm.keyword AS rule_keyword FROM tx LEFT JOIN rm ON rm.text = description""",
                                   ON_RAW))
def cls1_join(spark, sf):
    return rules.match_rules_join(transactions(spark, sf), tables.seed_rules(spark), "description",
                                  "tx_id").select(
        "tx_id", "rule_code", "rule_confidence", "rule_reason", "rule_keyword")


@query("cls2_substring_match", sql("""SELECT tx_id, (SELECT arg_min(code, seq) FROM rl
  WHERE contains(lower(description), keyword)) AS rule_code FROM tx""", KEYWORDS))
def cls2(spark, sf):
    return rules.match_substrings(transactions(spark, sf), rules.RuleBook.seed(), "description").select(
        "tx_id", "rule_code")


RULE_SEQ = values("rs", "seq, rule_seq, keyword, code, confidence, reason", tables.rules_rows())


@query("cls3_rule_table", sql("""SELECT rs.code, count(DISTINCT rule_seq) AS rules, count(DISTINCT seq) AS keywords,
  coalesce(any_value(n), 0) AS transactions FROM rs LEFT JOIN (SELECT code, count(*) AS n FROM tx GROUP BY 1) t
  ON t.code = rs.code GROUP BY 1""", RULE_SEQ))
def cls3(spark, sf):
    used = transactions(spark, sf).groupBy("code").agg(F.count(F.lit(1)).alias("transactions"))
    return (rules.rule_counts(tables.seed_rules(spark)).join(used, "code", "left")
            .withColumn("transactions", F.coalesce("transactions", F.lit(0))))


@query("cls4_income_priority", sql("""SELECT tx_id, im.code AS income_code, im.confidence AS income_confidence,
  im.reason AS income_reason FROM m3 LEFT JOIN im ON im.text = merchant AND cents > 0""", *MERCHANT, INCOME_M))
def cls4(spark, sf):
    from ..functions.text import merchant_text

    tx = transactions(spark, sf).withColumn("merchant", merchant_text(F.col("description")))
    return rules.match_income(tx, "merchant", "cents").select(
        "tx_id", "income_code", "income_confidence", "income_reason")


def any_of(phrases):
    return "(" + " OR ".join(f"starts_with(d, {literal(p[1:])})" if p.startswith("^")
                             else f"contains(d, {literal(p)})" for p in phrases) + ")"


def context_cases(pick):
    out = []
    for start, any1, also, never, *result in tables.CONTEXT_RULES:
        conds = [any_of(x) for x in (start, any1, also) if x] + ([f"NOT {any_of(never)}"] if never else [])
        out.append(f"WHEN {' AND '.join(conds)} THEN {literal(result[pick])}")
    for phrases, code, conf, what in tables.CONTEXT_WORDS:
        out.append(f"WHEN {any_of(phrases)} THEN {literal((code, conf, f'Matched {what} from description')[pick])}")
    utility = " OR ".join(f"regexp_matches(d, {literal(bounded(w))})" for w in tables.UTILITY_WORDS)
    out.append(f"WHEN {utility} THEN {literal(tables.UTILITY_RESULT[pick])}")
    for name, code, conf, label in tables.TRUSTED_HINTS:
        out.append(f"WHEN provider_category = {literal(name)} THEN {literal((code, conf, f'Provider category: {label}')[pick])}")
    last = ("UNKNOWN", 0.5, "No confident pattern match")[pick]
    return "CASE " + " ".join(out) + f" ELSE {literal(last)} END"


CONTEXT = f"""cx AS (SELECT *, {context_cases(0)} AS c_code, CAST({context_cases(1)} AS DOUBLE) AS c_conf,
  {context_cases(2)} AS c_reason FROM (SELECT *, lower(description) AS d FROM tx))"""


@query("cls5_context_rules", sql("""SELECT tx_id, c_code AS context_code, c_conf AS context_confidence,
  c_reason AS context_reason FROM cx""", CONTEXT))
def cls5(spark, sf):
    return rules.with_context(transactions(spark, sf)).select(
        "tx_id", "context_code", "context_confidence", "context_reason")


HINTS = values("hint", "name, code, confidence, label", tables.TRUSTED_HINTS)


@query("cls6_trusted_hint", sql("""SELECT provider_category, any_value(hint.code) AS hint_code,
  any_value(hint.confidence) AS hint_confidence, count(*) AS n FROM tx LEFT JOIN hint ON name = provider_category
  GROUP BY 1""", HINTS).replace("hint.confidence)", "CAST(hint.confidence AS DOUBLE))"))
def cls6(spark, sf):
    hint = rules.trusted_hint(F.col("provider_category"))
    return transactions(spark, sf).groupBy("provider_category").agg(
        F.count(F.lit(1)).alias("n")).select(
        "provider_category", hint["code"].alias("hint_code"), hint["confidence"].alias("hint_confidence"), "n")


NAMES = values("nm", "seq, name, code", [(i, n, c) for i, (n, c) in enumerate(tables.CATEGORY_NAMES)])
NAME_SQL = """coalesce((SELECT arg_min(code, seq) FROM nm WHERE name = {c}), (SELECT arg_min(code, seq) FROM nm
  WHERE contains(lower({c}), lower(name)) OR contains(lower(name), lower({c}))))"""


@query("cls7_category_names", sql(f"""SELECT category, {NAME_SQL.format(c='category')} AS code, n FROM
  (SELECT coalesce(provider_category, 'none') || CASE WHEN seq % 3 = 0 THEN ' Online' ELSE '' END AS category,
   count(*) AS n FROM tx GROUP BY 1)""", NAMES))
def cls7(spark, sf):
    tx = transactions(spark, sf).select(F.concat(
        F.coalesce("provider_category", F.lit("none")),
        F.when(F.col("seq") % 3 == 0, " Online").otherwise("")).alias("category"))
    return tx.groupBy("category").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "code", rules.category_by_name(F.col("category")))


def fits(code):
    return (f"coalesce(CASE WHEN cents < 0 THEN starts_with({code}, 'EXP-') WHEN cents > 0 THEN "
            f"starts_with({code}, 'INC-') OR {code} = 'EXP-032' ELSE TRUE END, FALSE)")


DEFAULT = "CASE WHEN cents < 0 THEN 'EXP-039' ELSE 'INC-007' END"


@query("flt5_direction", sql(f"SELECT tx_id, {fits('code')} AS fits, {DEFAULT} AS default_code FROM tx"))
def flt5(spark, sf):
    return transactions(spark, sf).select(
        "tx_id", filters.direction_ok(F.col("code"), F.col("cents")).alias("fits"),
        filters.default_code(F.col("cents")).alias("default_code"))


@query("cls12_default_code", sql(f"SELECT {DEFAULT} AS code, count(*) AS n FROM tx GROUP BY 1"))
def cls12(spark, sf):
    return (transactions(spark, sf).groupBy(filters.default_code(F.col("cents")).alias("code"))
            .agg(F.count(F.lit(1)).alias("n")))


GENERIC = " OR ".join(f"contains(provider_category, {literal(g)})" for g in P.generic)
VAGUE = "provider_category IN (" + ", ".join(literal(v) for v in P.vague) + ")"


@query("flt10_generic_category", sql(f"""SELECT provider_category, coalesce({GENERIC}, FALSE) AS generic, count(*) AS n
  FROM tx GROUP BY 1, 2"""))
def flt10(spark, sf):
    return (transactions(spark, sf).groupBy("provider_category", filters.is_generic_category(
        F.col("provider_category")).alias("generic")).agg(F.count(F.lit(1)).alias("n")))


@query("flt11_vague_category", sql(f"""SELECT coalesce({VAGUE}, FALSE) AS vague, count(*) AS n FROM tx GROUP BY 1"""))
def flt11(spark, sf):
    return (transactions(spark, sf).groupBy(filters.is_vague_category(F.col("provider_category")).alias("vague"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("jn6_provider_mapping", sql("""SELECT tx_id, m.code AS mapped_code, CAST(m.confidence AS DOUBLE) AS mapped_confidence
  FROM tx LEFT JOIN mapping m USING (provider_category)""", MAPPING_CTE))
def jn6(spark, sf):
    return cascade.with_mapping(transactions(spark, sf), mapping(spark)).select(
        "tx_id", "mapped_code", "mapped_confidence")


# One row per transaction with every candidate, then the ordered choice.
CASCADE = [*MERCHANT, MAPPING_CTE, RULE_M, INCOME_M, f"""cand AS (SELECT m3.*,
    {HINT} AS own, im.code AS i_code, im.confidence AS i_conf, im.reason AS i_reason, rm.code AS r_code,
    rm.confidence AS r_conf, rm.reason AS r_reason, m.code AS p_code, m.confidence AS p_conf
    FROM m3 LEFT JOIN im ON im.text = merchant AND cents > 0 LEFT JOIN rm ON rm.text = merchant
    LEFT JOIN mapping m USING (provider_category))""", f"""step AS (SELECT *, CASE
    WHEN own THEN 'own_transfer' WHEN i_code IS NOT NULL THEN 'income'
    WHEN {fits('r_code')} AND r_conf >= 0.9 THEN 'rule_high'
    WHEN {fits('r_code')} AND r_conf >= 0.8 THEN 'rule_medium'
    WHEN {VAGUE} THEN 'uncategorised'
    WHEN p_code IS NOT NULL AND {fits('p_code')} THEN 'mapping' ELSE 'uncategorised' END AS branch FROM cand)""",
           f"""cls AS (SELECT * EXCLUDE (code), CASE branch WHEN 'own_transfer' THEN 'INTERNAL_TRANSFER'
    WHEN 'income' THEN i_code WHEN 'rule_high' THEN r_code WHEN 'rule_medium' THEN r_code
    WHEN 'mapping' THEN p_code ELSE {DEFAULT} END AS code,
    CAST(CASE branch WHEN 'own_transfer' THEN 1.0 WHEN 'income' THEN i_conf WHEN 'rule_high' THEN r_conf
      WHEN 'rule_medium' THEN r_conf WHEN 'mapping' THEN p_conf ELSE 0.3 END AS DOUBLE) AS confidence,
    CASE branch WHEN 'own_transfer' THEN 'own_transfer' WHEN 'income' THEN 'income:' || i_reason
      WHEN 'mapping' THEN 'mapping' WHEN 'uncategorised' THEN 'default' ELSE 'rules:' || r_reason END AS source,
    NOT own AND i_code IS NULL AND r_code IS NOT NULL AND NOT {fits('r_code')} AS direction_filtered,
    NOT own AND i_code IS NULL AND {fits('r_code')} AND r_conf < 0.8 AS rule_low FROM step)"""]


def categorised(spark, sf):
    return cascade.categorize(transactions(spark, sf).drop("code"), mapping=mapping(spark))


@query("cls8_cascade", sql("SELECT tx_id, merchant, tx_type, code, confidence, source, branch FROM cls", *CASCADE))
def cls8(spark, sf):
    return categorised(spark, sf).select("tx_id", "merchant", "tx_type", "code", "confidence", "source", "branch")


TIER = [CONTEXT, MAPPING_CTE, NAMED, TWO_WAY, PAIRS, OWN, MATCHED, f"""sc AS (SELECT cx.*, m.code AS p_code,
    m.confidence AS p_conf, CASE WHEN seq % 3 = 0 THEN cx.code END AS m_code, (seq % 100) / 100.0 AS m_conf,
    {HINT} OR EXISTS (SELECT 1 FROM named n JOIN matched k ON k.customer_id = n.customer_id AND k.account = n.account
      WHERE n.tx_id = cx.tx_id AND (contains(upper(n.description), 'TFER') OR contains(upper(n.description), 'TRANSFER')))
    AS own FROM cx LEFT JOIN mapping m USING (provider_category))"""]
USABLE = f"(p_code IS NOT NULL AND p_code NOT IN ('EXP-039', 'INC-007') AND NOT coalesce({GENERIC}, FALSE))"


def tiers_sql(rule, model, extra=""):
    return f"""SELECT tx_id, branch, CASE branch WHEN 'own_transfer' THEN 'EXP-013' WHEN 'rules' THEN c_code
      WHEN 'learned' THEN l_code WHEN 'review' THEN a_code WHEN 'model' THEN m_code
      WHEN 'mapping' THEN p_code WHEN 'mapping_override' THEN p_code ELSE {DEFAULT} END AS code,
      CAST(CASE branch WHEN 'own_transfer' THEN 0.95 WHEN 'rules' THEN c_conf WHEN 'learned' THEN l_conf
      WHEN 'review' THEN a_conf WHEN 'model' THEN m_conf WHEN 'mapping' THEN p_conf
      WHEN 'mapping_override' THEN p_conf ELSE 0.3 END AS DOUBLE) AS confidence FROM (SELECT *, CASE
      WHEN own THEN 'own_transfer' WHEN c_code <> 'UNKNOWN' AND c_conf >= {rule} THEN 'rules' {extra}
      WHEN m_conf >= {model} AND m_code IN ('EXP-039', 'INC-007') AND {USABLE} THEN 'mapping_override'
      WHEN m_conf >= {model} THEN 'model' WHEN p_code IS NOT NULL THEN 'mapping' ELSE 'uncategorised' END AS branch
      FROM scored)"""


NO_DICTIONARY = """scored AS (SELECT *, CAST(NULL AS VARCHAR) AS l_code, 0.0 AS l_conf, CAST(NULL AS VARCHAR) AS a_code,
  0.0 AS a_conf FROM sc)"""


def scored(spark, sf):
    tx = transfers.flag_own_transfers(transactions(spark, sf))
    return tx.withColumns({"model_code": F.when(F.col("seq") % 3 == 0, F.col("code")),
                           "model_confidence": (F.col("seq") % 100) / 100.0}).drop("code")


def nulls_for(sql_text):
    """A missing model label never counts, whatever its score."""
    return sql_text.replace("WHEN m_conf >=", "WHEN m_code IS NOT NULL AND m_conf >=")


@query("cls9_four_tiers", sql(nulls_for(tiers_sql(0.9, 0.8)), *TIER, NO_DICTIONARY))
def cls9(spark, sf):
    return cascade.categorize_tiers(scored(spark, sf), mapping(spark), "is_own_transfer").select(
        "tx_id", "branch", "code", "confidence")


@query("cls11_override", sql(f"""SELECT tx_id, CASE WHEN code IN ('EXP-039', 'INC-007') AND {USABLE} THEN p_code ELSE code END AS code
  FROM (SELECT tx.*, m.code AS p_code FROM tx LEFT JOIN mapping m USING (provider_category))""", MAPPING_CTE))
def cls11(spark, sf):
    tx = cascade.with_mapping(transactions(spark, sf), mapping(spark))
    pick = F.struct("code", F.lit(0.5).alias("confidence"), F.lit("").alias("source"), F.lit("").alias("branch"))
    return tx.select("tx_id", cascade.override(
        pick, F.col("mapped_code"), F.col("mapped_confidence"), F.col("provider_category"), P)["code"].alias("code"))


TAXONOMY = values("tax", "code, name", tables.TAXONOMY)


@query("cls13_statement_output", sql("""SELECT tx_id, customer_id, strftime(tx_date, '%Y-%m-%d') AS tx_date, description, cents,
  provider_category, cls.code, coalesce(name, 'Unknown') AS category_name, round(confidence, 3) AS confidence, source
  FROM cls LEFT JOIN tax ON tax.code = cls.code""", *CASCADE, TAXONOMY))
def cls13(spark, sf):
    return cascade.statement_output(categorised(spark, sf)).withColumn(
        "tx_date", F.date_format("tx_date", "yyyy-MM-dd"))


@query("prj10_code_names", sql("""SELECT tx_id, coalesce(name, 'Unknown') AS category_name FROM
  (SELECT tx_id, CASE WHEN seq % 50 = 0 THEN 'EXP-999' ELSE code END AS code FROM tx) t LEFT JOIN tax USING (code)""", TAXONOMY))
def prj10(spark, sf):
    tx = transactions(spark, sf).withColumn("code", F.when(F.col("seq") % 50 == 0, "EXP-999").otherwise(F.col("code")))
    return cascade.describe_codes(tx).select("tx_id", "category_name")


@query("agg12_share_by_branch", sql("""SELECT branch, n, round(n * 1000 / t) / 10 AS pct FROM
  (SELECT branch, count(*) AS n, CAST((SELECT count(*) FROM cls) AS DOUBLE) AS t FROM cls GROUP BY 1)""", *CASCADE))
def agg12(spark, sf):
    return cascade.share_by(categorised(spark, sf), "branch")


@query("agg13_cascade_statistics", sql("SELECT count(*) AS total, " + ", ".join(
    f"count(*) FILTER (branch = '{b}') AS {b}" for b in
    ["own_transfer", "income", "rule_high", "rule_medium", "mapping", "uncategorised"])
    + """, count(*) FILTER (rule_low) AS rule_low, count(*) FILTER (direction_filtered) AS direction_filtered,
  count(*) FILTER (branch <> 'review') AS free, count(*) FILTER (branch = 'review') AS reviewed FROM cls""", *CASCADE))
def agg13(spark, sf):
    return cascade.cascade_statistics(categorised(spark, sf))


@query("top1_categories", sql("SELECT code, count(*) AS n FROM cls GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10", *CASCADE))
def top1(spark, sf):
    return cascade.top_n(categorised(spark, sf).groupBy("code").agg(F.count(F.lit(1)).alias("n")), 10)
