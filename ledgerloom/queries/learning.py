"""Merchant dictionary, review queue and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import cascade, learning
from ..operators.stage import computed, written
from .base import mapping, sql, table, transactions
from .classify import CASCADE, DEFAULT, GENERIC, TIER, categorised, nulls_for, scored, tiers_sql
from .registry import query
from .textual import CLEAN

AT = "2025-01-01T00:00:00"

# Two batches: the dictionary comes from every third row, the second batch from every fifth.
BATCH = """conf AS (SELECT *, 0.85 + (seq % 4) * 0.04 AS conf FROM pat)"""


def old_new(name, step, source):
    return f"""{name} AS (SELECT pattern, arg_min(code, seq) AS category, max(conf) AS confidence,
      '{source}' AS source, min(seq) AS first FROM conf WHERE CASE WHEN seq % {step} = 0 THEN conf ELSE 0.5 END >= 0.9 AND pattern <> '' GROUP BY 1)"""


def examples(name, step):
    return f"""{name} AS (SELECT pattern, list(description ORDER BY seq) AS ex FROM (SELECT pattern, description, min(seq) AS seq,
      row_number() OVER (PARTITION BY pattern ORDER BY min(seq)) AS rn FROM conf
      WHERE CASE WHEN seq % {step} = 0 THEN conf ELSE 0.5 END >= 0.9 AND pattern <> '' GROUP BY 1, 2) WHERE rn <= 5 GROUP BY 1)"""


DICT = [*CLEAN, BATCH, old_new("d1", 3, "first"), examples("x1", 3), old_new("d2", 5, "second"), examples("x2", 5)]
HIT = """hit AS (SELECT pat.*, coalesce(a.pattern, b.pattern) AS learned_pattern, coalesce(a.category, b.category) AS learned_code,
  coalesce(a.confidence, b.confidence) AS learned_confidence FROM pat LEFT JOIN d1 a ON a.pattern = pat.pattern
  LEFT JOIN d1 b ON b.pattern = split_part(pat.pattern, ' ', 1) AND length(b.pattern) >= 3)"""


def batch(spark, sf, step, source):
    """All rows; only every ``step``-th is confident enough for the dictionary."""
    sure = (F.lit("0.85").cast("decimal(4,2)") + (F.col("seq") % 4) * F.lit("0.04").cast("decimal(4,2)")).cast("double")
    return transactions(spark, sf).select(
        "seq", "description", F.col("code").alias("category"),
        F.when(F.col("seq") % step == 0, sure).otherwise(0.5).alias("confidence"), F.lit(source).alias("source"))


def dictionary(spark, sf):
    return learning.batch_patterns(batch(spark, sf, 3, "first"), learned_at=AT)


def looked_up(spark, sf, known=None):
    return learning.lookup_patterns(transactions(spark, sf), dictionary(spark, sf) if known is None else known)


@query("lrn1_lookup", sql("SELECT tx_id, learned_pattern, learned_code, CAST(learned_confidence AS DOUBLE) AS learned_confidence FROM hit",
                          *DICT, HIT))
def lrn1(spark, sf):
    return looked_up(spark, sf).select("tx_id", "learned_pattern", "learned_code", "learned_confidence")


UPSERT = """up AS (SELECT coalesce(d1.pattern, d2.pattern) AS pattern, coalesce(d1.category, d2.category) AS category,
  CAST(greatest(coalesce(d1.confidence, 0), coalesce(d2.confidence, 0)) AS DOUBLE) AS confidence,
  coalesce(d1.source, d2.source) AS source FROM d1 FULL JOIN d2 ON d1.pattern = d2.pattern)"""


@query("lrn2_upsert", sql("""SELECT up.*, array_to_string(list_slice(list_concat(coalesce(ex1, []), [e FOR e IN coalesce(ex2, [])
  IF NOT list_contains(coalesce(ex1, []), e)]), 1, 5), '|') AS examples FROM up
  LEFT JOIN (SELECT pattern, ex AS ex1 FROM x1) USING (pattern) LEFT JOIN (SELECT pattern, ex AS ex2 FROM x2) USING (pattern)""",
                          *DICT, UPSERT))
def lrn2(spark, sf):
    out = learning.upsert_patterns(dictionary(spark, sf), batch(spark, sf, 5, "second"), learned_at=AT)
    return out.select("pattern", "category", "confidence", "source", F.array_join("examples", "|").alias("examples"))


USED = """used AS (SELECT d1.pattern, d1.category, d1.confidence, coalesce(n, 0) AS usage_count FROM d1 LEFT JOIN
  (SELECT learned_pattern, count(*) AS n FROM hit WHERE learned_pattern IS NOT NULL GROUP BY 1) ON learned_pattern = d1.pattern)"""


def used_and_hits(spark, sf):
    """The dictionary with its usage, and the lookups it comes from; each is made once."""
    known = written(dictionary(spark, sf))
    hits = written(looked_up(spark, sf, known).select("tx_id", "learned_pattern"))
    return learning.record_usage(known, hits, AT), hits


def used(spark, sf):
    return used_and_hits(spark, sf)[0]


@query("lrn3_usage", sql("""SELECT pattern, usage_count, CASE WHEN usage_count > 0 THEN '2025-01-01T00:00:00' END AS last_used
  FROM used""", *DICT, HIT, USED))
def lrn3(spark, sf):
    return used(spark, sf).select("pattern", "usage_count", "last_used")


def weaker(spark, sf):
    """Dictionary with some weak, unused entries."""
    d = dictionary(spark, sf)
    weak = F.length("pattern") % 3 == 0
    return d.withColumns({"confidence": F.when(weak, 0.5).otherwise(F.col("confidence")),
                          "usage_count": (F.length("pattern") % 2).cast("bigint")})


@query("lrn4_prune", sql("""SELECT pattern FROM d1 WHERE NOT (length(pattern) % 3 = 0 AND length(pattern) % 2 = 0)""", *DICT))
def lrn4(spark, sf):
    return learning.prune_patterns(weaker(spark, sf)).select("pattern")


@query("lrn5_statistics", sql("""SELECT (SELECT count(*) FROM d1) AS total_patterns, count(*) AS total_lookups,
  count(learned_pattern) AS total_hits, (SELECT CAST(sum(usage_count) AS BIGINT) FROM used) AS total_usage,
  round(count(learned_pattern) * 100.0 / count(*), 2) AS hit_rate FROM hit""", *DICT, HIT, USED)
       .replace("count(*), 2)", "CAST(count(*) AS DOUBLE), 2)"))
def lrn5(spark, sf):
    return learning.dictionary_statistics(*used_and_hits(spark, sf))


@query("lrn5_distribution", sql("SELECT category, count(*) AS n FROM d1 GROUP BY 1", *DICT))
def lrn5_distribution(spark, sf):
    return learning.distribution(dictionary(spark, sf), "category")


@query("top2_used_patterns", sql("""SELECT pattern, category, usage_count, CAST(confidence AS DOUBLE) AS confidence FROM used
  ORDER BY usage_count DESC, pattern LIMIT 10""", *DICT, HIT, USED))
def top2(spark, sf):
    return learning.top_patterns(used(spark, sf))


@query("lrn10_review_export", sql("""SELECT d1.pattern, category, printf('%.2f', confidence) AS confidence, 0 AS usage_count, source,
  '2025-01-01T00:00:00' AS learned_at, ex[1] AS example FROM d1 JOIN x1 USING (pattern)""", *DICT))
def lrn10(spark, sf):
    return learning.review_export(dictionary(spark, sf))


SIMILAR = """sim AS (SELECT form, pattern, category, CAST(s AS DOUBLE) AS similarity, rank FROM (SELECT f.form, d1.pattern, d1.category,
  len(list_intersect(string_split(f.form, ' '), string_split(d1.pattern, ' '))) / greatest(len(list_distinct(string_split(f.form, ' '))),
    len(list_distinct(string_split(d1.pattern, ' ')))) AS s, row_number() OVER (PARTITION BY f.form ORDER BY
  len(list_intersect(string_split(f.form, ' '), string_split(d1.pattern, ' '))) / greatest(len(list_distinct(string_split(f.form, ' '))),
    len(list_distinct(string_split(d1.pattern, ' ')))) DESC, d1.pattern) AS rank
  FROM (SELECT DISTINCT pattern AS form FROM pat WHERE pattern <> '') f JOIN d1
  ON len(list_intersect(string_split(f.form, ' '), string_split(d1.pattern, ' '))) > 0) WHERE rank <= {k})"""


@query("jn7_similarity", sql("SELECT form, pattern, category, similarity, rank FROM sim", *DICT, SIMILAR.format(k=5)))
def jn7(spark, sf):
    asked = transactions(spark, sf).select(T.merchant_pattern(F.col("description")).alias("form"))
    return learning.similar_patterns(asked, dictionary(spark, sf)).drop("examples")


@query("top6_most_similar", sql("SELECT form, pattern AS best, similarity FROM sim WHERE rank = 1", *DICT, SIMILAR.format(k=1)))
def top6(spark, sf):
    asked = transactions(spark, sf).select(T.merchant_pattern(F.col("description")).alias("form"))
    return learning.similar_patterns(asked, dictionary(spark, sf), 1).select(
        "form", F.col("pattern").alias("best"), "similarity")


@query("lrn6_review_queue", sql("""SELECT pattern AS form, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents,
  min(provider_category) AS hint, min(description) AS example, any_value(similar_patterns) AS similar_patterns
  FROM pat JOIN (SELECT tx_id FROM cls WHERE branch = 'uncategorised') USING (tx_id)
  LEFT JOIN (SELECT form, string_agg(sim.pattern || '=' || ex[1], ';' ORDER BY rank) AS similar_patterns FROM sim
    JOIN x1 ON x1.pattern = sim.pattern GROUP BY 1) s ON s.form = pattern WHERE pattern <> '' GROUP BY 1""",
                                *DICT, *CASCADE, SIMILAR.format(k=3)))
def lrn6(spark, sf):
    queue = learning.review_queue(categorised(spark, sf), dictionary(spark, sf))
    shown = F.transform("similar", lambda s: F.concat(s["pattern"], F.lit("="), s["example"]))
    return queue.select("form", "n", "cents", "hint", "example", F.array_join(shown, ";").alias("similar_patterns"))


ANSWERS = """ans AS (SELECT form, CASE WHEN length(form) % 4 = 0 THEN NULL ELSE 'EXP-054' END AS a_code,
  CASE WHEN length(form) % 4 = 0 THEN NULL ELSE 0.9 + (length(form) % 3) * 0.03 END AS a_conf
  FROM (SELECT DISTINCT pattern AS form FROM pat WHERE pattern <> ''))"""


def answers(spark, sf):
    """Reviewed answers as text: plain JSON, fenced JSON and unusable ones."""
    forms = (computed(transactions(spark, sf), {"form": T.merchant_pattern(F.col("description"))})
             .groupBy("form")
             .agg(F.min("seq").alias("seq"), F.min_by("description", "seq").alias("description"))
             .filter("form <> ''"))
    n = F.length("form")
    conf = (F.lit("0.90").cast("decimal(4,2)") + (n % 3) * F.lit("0.03").cast("decimal(4,2)")).cast("string")
    body = F.concat(F.lit('{"category": "EXP-054", "confidence": '), conf, F.lit(', "reasoning": "seen"}'))
    return forms.withColumn("answer", F.when(n % 4 == 0, "no idea").when(
        n % 4 == 1, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body))


@query("str19_answer_parse", sql("""SELECT form, a_code AS category, CAST(a_conf AS DOUBLE) AS confidence,
  CASE WHEN a_code IS NOT NULL THEN 'seen' END AS reasoning FROM ans""", *CLEAN, ANSWERS))
def str19(spark, sf):
    return answers(spark, sf).select("form", T.parse_answer(F.col("answer")).alias("a")).select("form", "a.*")


@query("lrn7_answers", sql(f"""SELECT tx_id, CASE WHEN form IS NOT NULL THEN coalesce(a_code, {DEFAULT}) END AS answer_code,
  CAST(CASE WHEN form IS NOT NULL THEN coalesce(a_conf, 0.3) END AS DOUBLE) AS answer_confidence
  FROM pat LEFT JOIN ans ON form = pattern""", *CLEAN, ANSWERS))
def lrn7(spark, sf):
    return learning.attach_answers(transactions(spark, sf), answers(spark, sf)).select(
        "tx_id", "answer_code", "answer_confidence")


@query("lrn7_learn_answers", sql("""SELECT coalesce(d1.pattern, form) AS pattern, coalesce(category, a_code) AS category,
  CAST(greatest(coalesce(confidence, 0), coalesce(a_conf, 0)) AS DOUBLE) AS confidence, coalesce(source, 'review') AS source
  FROM d1 FULL JOIN (SELECT * FROM ans WHERE a_code IS NOT NULL) ON form = pattern""", *DICT, ANSWERS))
def lrn7_learn(spark, sf):
    return learning.learn_from_answers(dictionary(spark, sf), answers(spark, sf), learned_at=AT).select(
        "pattern", "category", "confidence", "source")


@query("lrn8_cost", sql("""SELECT count(*) AS requests, CAST(sum(length(description)) AS BIGINT) AS chars_in,
  CAST(sum(length(pattern)) AS BIGINT) AS chars_out, CAST(sum(length(description)) / 4 * 0.25 + sum(length(pattern)) / 4 * 1.25 AS DOUBLE)
  AS cost_millionths FROM pat""", *CLEAN))
def lrn8(spark, sf):
    return learning.review_cost(transactions(spark, sf).select(
        F.col("description").alias("prompt"), T.merchant_pattern(F.col("description")).alias("answer")))


@query("lrn12_medium_review", sql(f"""SELECT tx_id, CASE WHEN use THEN a_code ELSE c.code END AS code,
  CAST(CASE WHEN use THEN a_conf ELSE c.confidence END AS DOUBLE) AS confidence, CASE WHEN use THEN 'review' ELSE branch END AS branch
  FROM (SELECT cls.*, a_code, a_conf, branch = 'rule_medium' AND coalesce(cls.provider_category, '') <> '' AND a_code IS NOT NULL AS use
  FROM cls JOIN pat USING (tx_id) LEFT JOIN ans ON form = pat.pattern) c""", *CLEAN, ANSWERS, *CASCADE))
def lrn12(spark, sf):
    return learning.resolve_medium(categorised(spark, sf), answers(spark, sf)).select(
        "tx_id", "code", "confidence", "branch")


@query("lrn12_to_review", sql("""SELECT tx_id, code FROM cls WHERE branch = 'rule_medium' AND coalesce(provider_category, '') <> ''""",
                              *CASCADE))
def lrn12_to_review(spark, sf):
    return learning.medium_review(categorised(spark, sf)).select("tx_id", "code")


HYBRID = nulls_for(tiers_sql(0.95, 0.95, """WHEN l_code IS NOT NULL THEN 'learned'
  WHEN asked AND a_code IN ('EXP-039', 'INC-007') AND (p_code IS NOT NULL AND p_code NOT IN ('EXP-039', 'INC-007')
    AND NOT coalesce(GENERIC, FALSE)) THEN 'mapping_override' WHEN asked THEN 'review'""".replace("GENERIC", GENERIC)))
HYBRID_CTES = [*TIER, *DICT, HIT, ANSWERS, f"""scored AS (SELECT sc.*, learned_code AS l_code, learned_confidence AS l_conf,
  form IS NOT NULL AS asked, coalesce(ans.a_code, {DEFAULT}) AS a_code, coalesce(ans.a_conf, 0.3) AS a_conf
  FROM sc JOIN (SELECT tx_id, pattern, learned_code, learned_confidence FROM hit) h USING (tx_id) LEFT JOIN ans ON form = pattern)"""]


def hybrid(spark, sf):
    # Entries and answers under another name are there and do not match.
    named = lambda c, n: F.when(F.length(c) % n == 0, F.col(c)).otherwise(F.concat(c, F.lit(" *")))
    known = dictionary(spark, sf).withColumn("pattern", named("pattern", 2))
    tx = learning.lookup_patterns(scored(spark, sf), known)
    tx = learning.attach_answers(tx, answers(spark, sf).withColumn("form", named("form", 3)))
    return cascade.categorize_hybrid(tx, mapping(spark), "is_own_transfer")


HYBRID_SQL = sql(HYBRID, *HYBRID_CTES).replace(
    "LEFT JOIN d1 a ON a.pattern = pat.pattern", "LEFT JOIN d1 a ON a.pattern = pat.pattern AND length(a.pattern) % 2 = 0").replace(
    "AND length(b.pattern) >= 3)", "AND length(b.pattern) >= 3 AND length(b.pattern) % 2 = 0)").replace(
    "LEFT JOIN ans ON form = pattern", "LEFT JOIN ans ON form = pattern AND length(form) % 3 = 0")


@query("cls10_hybrid", HYBRID_SQL)
def cls10(spark, sf):
    return hybrid(spark, sf).select("tx_id", "branch", "code", "confidence")


# -- sessions ---------------------------------------------------------------------------

LOG = """log AS (SELECT 'x' || (event_id // 60) AS session_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS started,
  CASE event_id % 5 WHEN 0 THEN 'review' WHEN 1 THEN 'learned' WHEN 2 THEN 'mapping' ELSE 'rules' END AS source,
  CASE WHEN event_id % 5 = 0 THEN event_id % 7 ELSE 0 END AS cost_units, event_id % 15 = 0 AS learned FROM events),
  ses AS (SELECT session_id, min(started) AS started, count(*) AS transactions, count(*) FILTER (source = 'review') AS reviews,
    count(*) FILTER (source = 'learned') AS dictionary_hits, count(*) FILTER (learned) AS patterns_learned,
    CAST(sum(cost_units) AS BIGINT) AS cost_units,
    round(count(*) FILTER (source = 'review') * CAST(100.0 AS DOUBLE) / count(*), 2) AS review_pct FROM log GROUP BY 1)"""


def log(spark, sf):
    e = F.col("event_id")
    return table(spark, sf, "events").select(
        F.concat(F.lit("x"), F.floor(e / 60)).alias("session_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("started"),
        F.when(e % 5 == 0, "review").when(e % 5 == 1, "learned").when(e % 5 == 2, "mapping").otherwise("rules").alias("source"),
        F.when(e % 5 == 0, e % 7).otherwise(0).alias("cost_units"), (e % 15 == 0).alias("learned"))


@query("lrn9_sessions", sql("SELECT * FROM ses", LOG))
def lrn9(spark, sf):
    return learning.session_summary(log(spark, sf))


@query("lrn9_by_source", sql("SELECT session_id, source, count(*) AS n FROM log GROUP BY 1, 2", LOG))
def lrn9_by_source(spark, sf):
    return learning.sessions_by_source(log(spark, sf))


@query("lrn9_history", sql("""SELECT count(*) AS sessions, CAST(sum(transactions) AS BIGINT) AS transactions, CAST(sum(reviews) AS BIGINT) AS reviews,
  CAST(sum(patterns_learned) AS BIGINT) AS patterns_learned, CAST(sum(cost_units) AS BIGINT) AS cost_units,
  round(sum(reviews) * CAST(100.0 AS DOUBLE) / sum(transactions), 2) AS review_pct FROM ses""", LOG))
def lrn9_history(spark, sf):
    return learning.history_summary(learning.session_summary(log(spark, sf)))


CURVE = "SELECT *, left(started, 10) AS date, row_number() OVER (ORDER BY started, session_id) AS session FROM ses"


@query("win6_learning_curve", sql(CURVE, LOG))
def win6(spark, sf):
    return learning.learning_curve(learning.session_summary(log(spark, sf)))


@query("top7_recent_sessions", sql(CURVE + " ORDER BY session DESC LIMIT 10", LOG))
def top7(spark, sf):
    return learning.recent_sessions(learning.learning_curve(learning.session_summary(log(spark, sf))))
