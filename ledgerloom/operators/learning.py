"""Merchant dictionary, review queue and session statistics (LRN1-LRN12, JN7).

patterns(pattern, category, confidence, source, learned_at, usage_count, last_used, examples):
one row per pattern, a pattern is the output of ``merchant_pattern`` (one or two words).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import LearningParams
from ..functions.text import merchant_pattern, parse_answer, pattern_variants
from .filters import default_code
from .skew import attach
from .stage import computed, written

PATTERN_SCHEMA = ("pattern string, category string, confidence double, source string, "
                  "learned_at string, usage_count bigint, last_used string, examples array<string>")


def lookup_patterns(tx: DataFrame, patterns: DataFrame, row_id: str = "tx_id") -> DataFrame:
    """LRN1: adds learned_pattern, learned_code, learned_confidence: full form, then first word.

    The dictionary is asked once per distinct form; rows get the answer by a salted join. The forms
    are worked out once and written with the rows, which are read for the forms and for the join.
    """
    rows = written(computed(tx, {"_form": merchant_pattern(F.col("description"))}))
    forms = rows.groupBy("_form").agg(F.count(F.lit(1)).alias("_n"))
    asks = forms.select("_form", F.posexplode(pattern_variants(F.col("_form"))).alias("_rank", "pattern"))
    known = patterns.select("pattern", "category", "confidence")
    best = (asks.join(known, "pattern").groupBy("_form")
            .agg(F.min(F.struct("_rank", "pattern", "category", "confidence")).alias("_hit")))
    out = attach(rows, best, ["_form"], [row_id], "left", counts=forms)
    return out.withColumns({"learned_pattern": F.col("_hit.pattern"),
                            "learned_code": F.col("_hit.category"),
                            "learned_confidence": F.col("_hit.confidence")}).drop("_form", "_hit")


def first_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """AGG9: the first ``k`` rows per group; the limit applies before the shuffle as well."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)


def batch_patterns(batch: DataFrame, params: LearningParams = LearningParams(),
                   learned_at: str | None = None) -> DataFrame:
    """Patterns of one batch(seq, description, category, confidence, source)."""
    good = (computed(batch.filter(F.col("confidence") >= params.min_confidence),
                     {"pattern": merchant_pattern(F.col("description"))}).filter(F.col("pattern") != ""))
    # One pass over the batch: the head of a pattern and its examples both follow from its texts.
    texts = written(good.groupBy("pattern", "description").agg(
        F.min("seq").alias("seq"), F.min(F.struct("seq", "category", "source")).alias("_first"),
        F.max("confidence").alias("confidence")))
    head = texts.groupBy("pattern").agg(F.min("_first").alias("_first"), F.max("confidence").alias("confidence"))
    examples = (first_k(texts.select("pattern", "description", "seq"), ["pattern"], [F.asc("seq")], params.max_examples)
                .groupBy("pattern").agg(F.array_sort(F.collect_list(F.struct("seq", "description")))
                                        .alias("_ex")))
    at = F.lit(learned_at) if learned_at else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return head.join(examples, "pattern").select(
        "pattern", F.col("_first.category").alias("category"), "confidence",
        F.col("_first.source").alias("source"), at.alias("learned_at"),
        F.lit(0).cast("bigint").alias("usage_count"), F.lit(None).cast("string").alias("last_used"),
        F.col("_ex.description").alias("examples"))


def upsert_patterns(patterns: DataFrame, batch: DataFrame, params: LearningParams = LearningParams(),
                    learned_at: str | None = None) -> DataFrame:
    """LRN2: known patterns keep their category; confidence grows; examples are added."""
    new = batch_patterns(batch, params, learned_at)
    o, n = patterns.alias("o"), new.alias("n")
    known = F.col("o.pattern").isNotNull()
    examples = F.slice(F.array_distinct(F.concat(
        F.coalesce("o.examples", F.array().cast("array<string>")),
        F.coalesce("n.examples", F.array().cast("array<string>")))), 1, params.max_examples)

    def keep(c):
        return F.when(known, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c)

    return o.join(n, F.col("o.pattern") == F.col("n.pattern"), "full").select(
        F.coalesce("o.pattern", "n.pattern").alias("pattern"), keep("category"),
        F.greatest("o.confidence", "n.confidence").alias("confidence"), keep("source"),
        keep("learned_at"), keep("usage_count"), keep("last_used"), examples.alias("examples"))


def record_usage(patterns: DataFrame, looked_up: DataFrame, at: str | None = None) -> DataFrame:
    """LRN3: adds the hits of a lookup to usage_count and sets last_used."""
    hits = (looked_up.filter(F.col("learned_pattern").isNotNull())
            .groupBy(F.col("learned_pattern").alias("pattern")).agg(F.count(F.lit(1)).alias("_hits")))
    at = F.lit(at) if at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return patterns.join(hits, "pattern", "left").withColumns({
        "usage_count": F.col("usage_count") + F.coalesce("_hits", F.lit(0)),
        "last_used": F.when(F.col("_hits").isNotNull(), at).otherwise(F.col("last_used")),
    }).drop("_hits")


def prune_patterns(patterns: DataFrame, params: LearningParams = LearningParams()) -> DataFrame:
    """LRN4: drop weak patterns that were never used."""
    return patterns.filter(~((F.col("confidence") < params.prune_below) & (F.col("usage_count") == 0)))


def dictionary_statistics(patterns: DataFrame, lookups: DataFrame) -> DataFrame:
    """LRN5: one row: patterns, lookups, hits, hit rate in percent, total usage."""
    p = patterns.agg(F.count(F.lit(1)).alias("p"), F.sum("usage_count").alias("u"))
    return lookups.agg(
        F.count(F.lit(1)).alias("total_lookups"), F.count("learned_pattern").alias("total_hits"),
    ).withColumns({
        "total_patterns": p.select("p").scalar(),
        "total_usage": F.coalesce(p.select("u").scalar(), F.lit(0)),
        "hit_rate": F.coalesce(F.round(F.col("total_hits") * 100.0 / F.nullif(
            F.col("total_lookups"), F.lit(0)), 2), F.lit(0.0))})


def distribution(patterns: DataFrame, column: str) -> DataFrame:
    """LRN5: patterns per category or source."""
    return patterns.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def top_patterns(patterns: DataFrame, n: int = 10) -> DataFrame:
    """TOP2: most used patterns."""
    return (patterns.orderBy(F.desc("usage_count"), F.asc("pattern")).limit(n)
            .select("pattern", "category", "usage_count", "confidence"))


def review_export(patterns: DataFrame) -> DataFrame:
    """LRN10: readable rows sorted by pattern, for the CSV sink."""
    return patterns.select(
        "pattern", "category", F.format_number("confidence", 2).alias("confidence"), "usage_count",
        "source", "learned_at", F.coalesce(F.try_element_at("examples", F.lit(1)), F.lit(""))
        .alias("example")).orderBy("pattern")


# -- similar patterns ------------------------------------------------------------------

def similar_patterns(asked: DataFrame, patterns: DataFrame,
                     k: int = LearningParams.similar) -> DataFrame:
    """JN7/TOP6: up to ``k`` dictionary patterns per asked form, by common words.

    Similarity is |common| / max(|a|, |b|), ties in pattern order. Between a form and an entry of
    at most two words a partial overlap is always one half, so per word only the first few
    entries in tie order can be among the best ``k`` and a frequent word costs no more than a rare
    one. Longer forms and longer entries are joined in full on their words.
    """
    words = F.array_sort(F.array_distinct(F.split("pattern", " ")))
    left = (asked.select("form").filter(F.col("form") != "").distinct()
            .withColumn("_lw", F.array_sort(F.array_distinct(F.split("form", " ")))))
    right = (patterns.select("pattern", "category", "examples").filter(F.col("pattern") != "")
             .withColumn("_rw", words))
    # Both are read several times below.
    left, right = written(left), written(right)
    token_left = left.withColumn("_w", F.explode("_lw"))
    token_right = right.withColumn("_w", F.explode("_rw"))
    short = first_k(token_right.filter(F.size("_rw") <= 2), ["_w"], [F.asc("pattern")], k + 2).drop("_rn")
    few = F.size("_lw") <= 2
    same = left.join(right.withColumnRenamed("_rw", "_lw"), "_lw").withColumn("_rw", F.col("_lw"))
    cols = ["form", "_lw", "pattern", "category", "examples", "_rw"]
    near = (token_left.filter(few).join(short.unionByName(token_right.filter(F.size("_rw") > 2)), "_w")
            .unionByName(token_left.filter(~few).join(token_right, "_w"))).select(*cols)
    pairs = same.select(*cols).unionByName(near).dropDuplicates(["form", "pattern"])
    scored = pairs.withColumn("similarity", F.size(F.array_intersect("_lw", "_rw"))
                              / F.greatest(F.size("_lw"), F.size("_rw")))
    return (first_k(scored, ["form"], [F.desc("similarity"), F.asc("pattern")], k)
            .select("form", "pattern", "category", "similarity", "examples", F.col("_rn").alias("rank")))


# -- review of open merchants ---------------------------------------------------------

def review_queue(categorised: DataFrame, patterns: DataFrame, branches=("uncategorised",),
                 similar: int = 3) -> DataFrame:
    """LRN6: one row per open merchant form, with its size, a hint and similar patterns."""
    open_rows = computed(categorised.filter(F.col("branch").isin(*branches)),
                         {"form": merchant_pattern(F.col("description"))}).filter(F.col("form") != "")
    # Read for the similar patterns and again for the queue itself.
    queue = written(open_rows.groupBy("form").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"),
        F.min("provider_category").alias("hint"), F.min("description").alias("example")))
    near = (similar_patterns(queue.select("form"), patterns, similar)
            .groupBy("form").agg(F.array_sort(F.collect_list(F.struct(
                "rank", "pattern", "category", F.try_element_at("examples", F.lit(1)).alias("example"))))
                .alias("similar")))
    return queue.join(near, "form", "left")


def medium_review(categorised: DataFrame) -> DataFrame:
    """LRN12: rows with a medium rule match and a provider category go to review."""
    return categorised.filter((F.col("branch") == "rule_medium")
                              & (F.coalesce("provider_category", F.lit("")) != ""))


def read_answers(answers: DataFrame) -> DataFrame:
    """LRN7: answers(form, answer[, seq]) parsed, one row per form: the first usable answer by
    ``seq``, or without it the most confident; a form without a usable one has a null code."""
    parsed = computed(answers, {"_a": parse_answer(F.col("answer"))})
    order = [F.col("seq")] if "seq" in answers.columns else [-F.col("_a.confidence")]
    best = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)],
                    F.col("_a.category").alias("answer_code"), F.col("_a.confidence").alias("answer_confidence"),
                    F.col("_a.reasoning").alias("answer_reason"))
    return (parsed.groupBy("form").agg(F.min(F.when(F.col("_a.category").isNotNull(), best)).alias("_b"))
        .select("form", "_b.answer_code", "_b.answer_confidence", "_b.answer_reason"))


def attach_answers(tx: DataFrame, answers: DataFrame, row_id: str = "tx_id") -> DataFrame:
    """LRN7: adds answer_code and answer_confidence; a failed answer gives the default by sign."""
    read = read_answers(answers).withColumn("_asked", F.lit(True))
    # Read to count the forms and for the join.
    rows = written(computed(tx.drop("form"), {"form": merchant_pattern(F.col("description"))}))
    out = attach(rows, read, ["form"], [row_id], "left")
    return out.withColumns({
        "answer_code": F.when(F.col("_asked"), F.coalesce("answer_code", default_code(F.col("cents")))),
        "answer_confidence": F.when(F.col("_asked"), F.coalesce("answer_confidence", F.lit(0.3))),
    }).drop("_asked", "form")


def resolve_medium(categorised: DataFrame, answers: DataFrame, row_id: str = "tx_id") -> DataFrame:
    """LRN12: the answer decides; without a usable one the rule stays."""
    reviewed = attach_answers(categorised, answers, row_id)
    use = ((F.col("branch") == "rule_medium") & (F.coalesce("provider_category", F.lit("")) != "")
           & F.col("answer_reason").isNotNull())
    return reviewed.withColumns({
        "code": F.when(use, F.col("answer_code")).otherwise(F.col("code")),
        "confidence": F.when(use, F.col("answer_confidence")).otherwise(F.col("confidence")),
        "branch": F.when(use, F.lit("review")).otherwise(F.col("branch")),
        "source": F.when(use, F.concat(F.lit("review:"), "answer_reason")).otherwise(F.col("source")),
    }).drop("answer_code", "answer_confidence", "answer_reason")


def learn_from_answers(patterns: DataFrame, answers: DataFrame,
                       params: LearningParams = LearningParams(), learned_at: str | None = None) -> DataFrame:
    """LRN7: usable answers(seq, description, answer) enter the dictionary."""
    parsed = computed(answers, {"_a": parse_answer(F.col("answer"))}).filter("_a IS NOT NULL")
    batch = parsed.select("seq", "description", F.col("_a.category").alias("category"),
                          F.col("_a.confidence").alias("confidence"), F.lit("review").alias("source"))
    return upsert_patterns(patterns, batch, params, learned_at)


def review_cost(requests: DataFrame, params: LearningParams = LearningParams()) -> DataFrame:
    """LRN8: requests(prompt, answer): characters, and the price in millionths of a unit."""
    def price(chars, rate):
        return F.col(chars) / params.chars_per_token * rate

    return requests.agg(
        F.count(F.lit(1)).alias("requests"),
        F.coalesce(F.sum(F.length("prompt")), F.lit(0)).alias("chars_in"),
        F.coalesce(F.sum(F.length("answer")), F.lit(0)).alias("chars_out"),
    ).withColumn("cost_millionths",
                 price("chars_in", params.price_in) + price("chars_out", params.price_out))


# -- sessions (LRN9, WIN6, TOP7) ----------------------------------------------------------

def session_summary(log: DataFrame) -> DataFrame:
    """LRN9: log(session_id, started, source, cost_units, learned) to one row per session."""
    s = log.groupBy("session_id").agg(
        F.min("started").alias("started"), F.count(F.lit(1)).alias("transactions"),
        F.count_if(F.col("source") == "review").alias("reviews"),
        F.count_if(F.col("source") == "learned").alias("dictionary_hits"),
        F.count_if("learned").alias("patterns_learned"), F.sum("cost_units").alias("cost_units"))
    return s.withColumn("review_pct", F.round(F.col("reviews") * 100.0 / F.col("transactions"), 2))


def sessions_by_source(log: DataFrame) -> DataFrame:
    """LRN9: predictions per session and source."""
    return log.groupBy("session_id", "source").agg(F.count(F.lit(1)).alias("n"))


def history_summary(sessions: DataFrame) -> DataFrame:
    """LRN9: totals over all sessions."""
    return sessions.agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("transactions").alias("transactions"),
        F.sum("reviews").alias("reviews"), F.sum("patterns_learned").alias("patterns_learned"),
        F.sum("cost_units").alias("cost_units")).withColumn(
            "review_pct", F.round(F.col("reviews") * 100.0 / F.nullif("transactions", F.lit(0)), 2))


def learning_curve(sessions: DataFrame) -> DataFrame:
    """WIN6: sessions numbered by start.

    The number is the sessions of earlier days plus the place within the day, so no window
    spans the whole table; the running total is over one row per day.
    """
    day = F.left(F.col("started"), F.lit(10))
    dated = sessions.withColumn("date", day)
    per_day = dated.groupBy("date").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("date").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(W.partitionBy("date").orderBy("started", "session_id"))
    return (dated.join(per_day.withColumn("_before", before).drop("_n"), "date")
            .withColumn("session", F.col("_before") + place).drop("_before"))


def recent_sessions(curve: DataFrame, n: int = 10) -> DataFrame:
    """TOP7: the newest sessions."""
    return curve.orderBy(F.desc("session")).limit(n)
