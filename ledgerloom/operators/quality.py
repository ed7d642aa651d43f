"""Checks of rules, mapping and normaliser (DQ1-DQ6, JN11, SET6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import tables
from ..config import DEFAULT_CODES
from ..functions.text import merchant_text
from .rules import RuleBook


def unknown_codes(used: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """DQ1/JN11/SET6: codes in use that the taxonomy lacks, with their rows."""
    return (used.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
            .join(taxonomy.select("code"), "code", "left_anti"))


def missing_required(taxonomy: DataFrame) -> DataFrame:
    """DQ1: required codes that the taxonomy lacks."""
    import pyarrow as pa

    need = tables.frame(taxonomy.sparkSession, [("code", pa.string())], [(c,) for c in tables.REQUIRED_CODES])
    return need.join(taxonomy.select("code"), "code", "left_anti")


def rule_probes(cases: DataFrame, book: RuleBook, text: str = "text") -> DataFrame:
    """DQ2: cases(text, must_be, must_not_be): the code found and whether the case holds."""
    found = cases.withColumn("found", book.whole_word_match(F.col(text))["code"])
    ok = (F.coalesce(F.col("found") == F.col("must_be"), F.col("must_be").isNull())
          & ~F.coalesce(F.col("found") == F.col("must_not_be"), F.lit(False)))
    return found.withColumn("ok", ok)


def has_generic_keyword(rules: DataFrame, code: str, domain: str) -> DataFrame:
    """DQ3: one row: does the code have a single-word keyword that contains the domain word."""
    hit = (F.col("code") == code) & ~F.col("keyword").contains(" ") & F.col("keyword").contains(domain)
    return rules.agg(F.count_if(hit).alias("keywords")).withColumn("ok", F.col("keywords") > 0)


def generic_to_default(mapping: DataFrame, generic=("Third Party Payment Providers", "Uncategorised")) -> DataFrame:
    """DQ4: wide provider categories that map to a default code."""
    return mapping.filter(F.col("provider_category").isin(*generic) & F.col("code").isin(*DEFAULT_CODES))


def normaliser_probes(cases: DataFrame, book: RuleBook) -> DataFrame:
    """DQ5: cases(text, gone, kept): prefix removed, merchant kept, rule found."""
    m = cases.withColumn("merchant", F.lower(merchant_text(F.col("text"))))
    return m.withColumns({"prefix_gone": ~F.contains("merchant", "gone"), "merchant_kept": F.contains("merchant", "kept"),
                          "code": book.whole_word_match(F.col("merchant"))["code"]})


def shadowed_keywords(rules: DataFrame) -> DataFrame:
    """DQ6: keywords that return later with another code and so never decide."""
    first = rules.groupBy("keyword").agg(F.min(F.struct("seq", "code")).alias("f"))
    later = rules.join(first, "keyword").filter((F.col("seq") > F.col("f.seq")) & (F.col("code") != F.col("f.code")))
    return later.select("keyword", "seq", F.col("code").alias("never_used"), F.col("f.code").alias("used"))
