"""Category cascades (CLS8-CLS14) and their statistics (AGG12, AGG13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import tables
from ..config import DEFAULT_CODES, EXTERNAL_TRANSFER, OWN_TRANSFER, CascadeParams
from ..functions.text import has_internal_hint, merchant_text, payment_type
from .filters import default_code, direction_ok, is_generic_category, is_vague_category
from .rules import ContextBook, RuleBook, context_rule, match_rules_join
from .stage import computed


def _pick(code, confidence, source, branch) -> Column:
    as_col = [x if isinstance(x, Column) else F.lit(x) for x in (code, confidence, source, branch)]
    return F.struct(as_col[0].alias("code"), as_col[1].cast("double").alias("confidence"),
                    as_col[2].alias("source"), as_col[3].alias("branch"))


def with_mapping(tx: DataFrame, mapping: DataFrame | None) -> DataFrame:
    """JN6: adds mapped_code and mapped_confidence of the provider category.

    The table has one row per category name. Catalyst picks the join from its size.
    """
    if mapping is None:
        return tx.withColumns({"mapped_code": F.lit(None).cast("string"),
                               "mapped_confidence": F.lit(None).cast("double")})
    m = mapping.select("provider_category", F.col("code").alias("mapped_code"),
                       F.col("confidence").cast("double").alias("mapped_confidence"))
    return tx.join(m, "provider_category", "left")


def _rule_column(step: DataFrame, rules: RuleBook | DataFrame, row_id: str) -> DataFrame:
    """The first rule of each row as struct ``_rule``."""
    if isinstance(rules, RuleBook):
        return step.withColumn("_rule", rules.whole_word_match(F.col("merchant")))
    found = match_rules_join(step, rules, "merchant", row_id, "_r")
    rule = F.struct(F.col("_r_code").alias("code"), F.col("_r_confidence").alias("confidence"), F.col("_r_reason").alias("reason"))
    return (found.withColumn("_rule", F.when(F.col("_r_code").isNotNull(), rule))
            .drop("_r_code", "_r_confidence", "_r_reason", "_r_keyword"))


def categorize(tx: DataFrame, rules: RuleBook | DataFrame | None = None, income: RuleBook | None = None,
               mapping: DataFrame | None = None, params: CascadeParams = CascadeParams(),
               own_flag: str | None = None, row_id: str = "tx_id") -> DataFrame:
    """CLS8: five steps, direction aware. Adds merchant, tx_type, code, confidence, source,
    branch, direction_filtered, rule_low.

    ``own_flag`` names a flag column from ``flag_own_transfers``; without it only the
    provider's hints mark own-account transfers. Stateless per row, so it also runs on streams.
    ``rules`` may be a table of any size: then keywords meet the texts in a join, with ``row_id``
    to spread hot texts.
    """
    rules, income = RuleBook.seed() if rules is None else rules, income or RuleBook.income()
    amount, category = F.col("cents"), F.nullif(F.col("provider_category"), F.lit(""))
    own = (F.col(own_flag) if own_flag
           else has_internal_hint(F.col("provider_category"), F.col("third_party")))
    step = (with_mapping(tx, mapping)
            .withColumns({"merchant": merchant_text(F.col("description")),
                          "tx_type": payment_type(F.col("description")), "_own": own})
            .withColumn("_income", F.when(~F.col("_own") & (amount > 0),
                                          income.whole_word_match(F.col("merchant"))))
            .transform(_rule_column, rules, row_id)
            .withColumn("_rule", F.when(~F.col("_own") & F.col("_income").isNull(), F.col("_rule")))
            .withColumn("_fits", F.coalesce(direction_ok(F.col("_rule.code"), amount), F.lit(False))
                        & F.col("_rule").isNotNull()))
    rule, inc, fits = F.col("_rule"), F.col("_income"), F.col("_fits")
    rule_source = F.concat(F.lit("rules:"), rule["reason"])
    default = _pick(default_code(amount), 0.3, "default", "uncategorised")
    mapped_ok = F.coalesce(direction_ok(F.col("mapped_code"), amount), F.lit(False)) \
        & F.col("mapped_code").isNotNull() & category.isNotNull()
    result = (
        F.when(F.col("_own"), _pick(OWN_TRANSFER, 1.0, "own_transfer", "own_transfer"))
        .when(inc.isNotNull(), _pick(inc["code"], inc["confidence"],
                                     F.concat(F.lit("income:"), inc["reason"]), "income"))
        .when(fits & (rule["confidence"] >= params.high),
              _pick(rule["code"], rule["confidence"], rule_source, "rule_high"))
        .when(fits & (rule["confidence"] >= params.medium),
              _pick(rule["code"], rule["confidence"], rule_source, "rule_medium"))
        .when(is_vague_category(category, params), default)
        .when(mapped_ok, _pick(F.col("mapped_code"), F.col("mapped_confidence"),
                               "mapping", "mapping"))
        .otherwise(default))
    # Filters on the result, as error reports and review queues have, must not repeat the matching.
    return (computed(step, {"_r": result})
            .withColumns({
                "direction_filtered": F.col("_rule").isNotNull() & ~F.col("_fits"),
                "rule_low": F.col("_fits") & (F.col("_rule.confidence") < params.medium),
                "code": F.col("_r.code"), "confidence": F.col("_r.confidence"),
                "source": F.col("_r.source"), "branch": F.col("_r.branch")})
            .drop("_own", "_income", "_rule", "_fits", "_r", "mapped_code", "mapped_confidence"))


def override(pick: Column, mapped: Column, confidence: Column, category: Column,
             params: CascadeParams) -> Column:
    """CLS11: a default code gives way to a specific mapping."""
    usable = (category.isNotNull() & ~is_generic_category(category, params)
              & mapped.isNotNull() & ~mapped.isin(*DEFAULT_CODES))
    return F.when(pick["code"].isin(*DEFAULT_CODES) & usable,
                  _pick(mapped, confidence, "mapping_override", "mapping_override")).otherwise(pick)


def _tiers(tx, mapping, own_flag, params, rule_threshold, model_threshold, between, context=None):
    category = F.nullif(F.col("provider_category"), F.lit(""))
    mapped, mapped_conf = F.col("mapped_code"), F.col("mapped_confidence")
    own = (F.col(own_flag) if own_flag
           else has_internal_hint(F.col("provider_category"), F.col("third_party")))
    step = (with_mapping(tx, mapping)
            .withColumn("_t", F.lower(F.coalesce("description", F.lit(""))))
            .withColumn("_c", context_rule(F.col("_t"), category, context)))
    ctx = F.col("_c")

    def final(p):
        return override(p, mapped, mapped_conf, category, params)

    out = F.when(own, _pick(EXTERNAL_TRANSFER, 0.95, "own_transfer", "own_transfer")).when(
        (ctx["code"] != "UNKNOWN") & (ctx["confidence"] >= rule_threshold),
        final(_pick(ctx["code"], ctx["confidence"], "rules", "rules")))
    for ok, pick, may_override in between:
        out = out.when(ok, final(pick) if may_override else pick)
    if "model_code" in tx.columns:
        scored = F.col("model_code").isNotNull() & (F.col("model_confidence") >= model_threshold)
        out = out.when(scored, final(
            _pick(F.col("model_code"), F.col("model_confidence"), "model", "model")))
    out = out.when(mapped.isNotNull() & category.isNotNull(),
                   _pick(mapped, mapped_conf, "mapping", "mapping"))
    out = out.otherwise(_pick(default_code(F.col("cents")), 0.3, "uncategorised", "uncategorised"))
    return (computed(step, {"_r": out})
            .withColumns({"code": F.col("_r.code"), "confidence": F.col("_r.confidence"),
                          "source": F.col("_r.source"), "branch": F.col("_r.branch")})
            .drop("_t", "_c", "_r", "mapped_code", "mapped_confidence"))


def categorize_tiers(tx: DataFrame, mapping: DataFrame | None = None, own_flag: str | None = None,
                     params: CascadeParams = CascadeParams(), context: ContextBook | None = None) -> DataFrame:
    """CLS9: own transfer, contextual rules (``context``, or the seed), model score if present,
    mapping, default.

    A model score comes as columns model_code and model_confidence.
    """
    return _tiers(tx, mapping, own_flag, params, params.rule_threshold, params.model_threshold, [], context)


def categorize_hybrid(tx: DataFrame, mapping: DataFrame | None = None,
                      own_flag: str | None = None,
                      params: CascadeParams = CascadeParams(), context: ContextBook | None = None) -> DataFrame:
    """CLS10: as CLS9 with the dictionary and reviewed answers between rules and model.

    Uses columns learned_code, learned_confidence (from ``learning.lookup_patterns``) and
    answer_code, answer_confidence (from ``learning.attach_answers``) where present.
    """
    between = []
    if "learned_code" in tx.columns:
        between.append((F.col("learned_code").isNotNull(), _pick(
            F.col("learned_code"), F.col("learned_confidence"), "learned", "learned"), False))
    if "answer_code" in tx.columns:
        between.append((F.col("answer_code").isNotNull(), _pick(
            F.col("answer_code"), F.col("answer_confidence"), "review", "review"), True))
    return _tiers(tx, mapping, own_flag, params, params.hybrid_rule_threshold,
                  params.hybrid_model_threshold, between, context)


def describe_codes(df: DataFrame, code: str = "code", text: str = "Unknown",
                   taxonomy: DataFrame | None = None) -> DataFrame:
    """PRJ10: adds the category name."""
    taxonomy = tables.taxonomy(df.sparkSession) if taxonomy is None else taxonomy
    names = taxonomy.select(F.col("code").alias(code), F.col("name").alias("category_name"))
    return (df.join(names, code, "left")
            .withColumn("category_name", F.coalesce("category_name", F.lit(text))))


def statement_output(categorised: DataFrame) -> DataFrame:
    """CLS13: columns of a scored statement, confidence with three decimals."""
    return describe_codes(categorised).select(
        "tx_id", "customer_id", "tx_date", "description", "cents", "provider_category",
        "code", "category_name", F.round("confidence", 3).alias("confidence"), "source")


# -- statistics ---------------------------------------------------------------------

def share_by(df: DataFrame, key: str) -> DataFrame:
    """AGG12: count and percentage (one decimal) per value."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("pct", F.round(F.col("n") * 1000 / total) / 10)


def cascade_statistics(categorised: DataFrame) -> DataFrame:
    """AGG13: one row of counters over the emitted branches."""
    def n(cond):
        return F.count_if(cond)

    b = F.col("branch")
    return categorised.agg(
        F.count(F.lit(1)).alias("total"),
        n(b == "own_transfer").alias("own_transfer"), n(b == "income").alias("income"),
        n(b == "rule_high").alias("rule_high"), n(b == "rule_medium").alias("rule_medium"),
        n(F.col("rule_low")).alias("rule_low"), n(b == "mapping").alias("mapping"),
        n(b == "uncategorised").alias("uncategorised"),
        n(F.col("direction_filtered")).alias("direction_filtered"),
        n(b != "review").alias("free"), n(b == "review").alias("reviewed"))


def top_n(counts: DataFrame, n: int, by: str = "n", tie: str | None = None) -> DataFrame:
    """TOP1: the ``n`` greatest groups; ties by name."""
    tie = tie or [c for c in counts.columns if c != by][0]
    return counts.orderBy(F.desc(by), F.asc(tie)).limit(n)
