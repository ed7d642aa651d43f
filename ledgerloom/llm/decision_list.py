"""Quality rules learned from labels: ordered conjunctions of thresholds on text statistics."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, text_of, words

SYMBOLS = "#*$%&|<>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["n_words", "chars_per_word", "symbols_per_word", "marks_per_word", "upper_share", "digit_share",
            "dup_line_share", "repeat_share", "distinct_share"]


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return (c > self.threshold) if self.above else (c <= self.threshold)


@dataclass(frozen=True)
class LearnParams:
    bins: int = 32          # thresholds per feature, at quantiles of the labelled rows
    max_rules: int = 12
    max_conditions: int = 3
    min_precision: float = 0.95  # of a rule on rows held back from growing it
    min_rows: int = 3       # bad rows that a rule must find


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the five base counts (long) and the features, each of the whole text.

    Null text counts as empty: no words, zero counts. A repeated word lies in a window of three
    words that occurs twice or more in its text. The windows are sorted by hash within their
    row, in n log n steps for n words, and nothing is shuffled. Other columns are ignored and
    repeated rows are counted each."""
    t = docs.select("doc_id", text_of("text").alias("t")).withColumn("w", words("t"))
    t = t.withColumn("n", F.size("w"))
    at = F.when(F.col("n") >= 3, F.sequence(F.lit(0), F.col("n") - 3)).otherwise(F.array().cast("array<int>"))
    t = t.withColumn("s", F.sort_array(F.transform(at, lambda i: F.struct(
        F.xxhash64(F.col("w")[i], F.col("w")[i + 1], F.col("w")[i + 2]).alias("h"), i.alias("i")))))
    last = F.size("s") - 1
    again = F.filter("s", lambda x, j: ((j > 0) & (F.col("s")[F.greatest(j - 1, F.lit(0))]["h"] == x["h"]))
                     | ((j < last) & (F.col("s")[F.least(j + 1, last)]["h"] == x["h"])))
    t = t.withColumn("p", F.array_sort(F.transform(again, lambda x: x["i"])))
    zero = F.struct(F.lit(-3).alias("before"), F.lit(0).cast("bigint").alias("n"))
    repeated = F.aggregate("p", zero, lambda a, p: F.struct(p.alias("before"), (a["n"] + F.least(F.lit(3), p - a["before"])).alias("n")), lambda a: a["n"])
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    count = lambda chars: (F.length("t") - F.length(F.translate(F.col("t"), chars, ""))).cast("bigint")
    matching = lambda pattern: (F.length("t") - F.length(F.regexp_replace("t", pattern, ""))).cast("bigint")
    t = t.withColumn("lines", lines).select(
        "doc_id", F.col("n").cast("bigint").alias("n_words"), (F.length("t") - count(" \t\n\x0b\x0c\r")).cast("bigint").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"), F.size("lines").alias("n_lines"), count("!?").alias("marks"),
        matching(r"\p{Lu}+").alias("upper"), matching(r"[0-9]+").alias("digits"), F.size(F.array_distinct("w")).alias("distinct"))
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return t.select("doc_id", *BASE, share("word_chars", "n_words").alias("chars_per_word"), share("n_symbols", "n_words").alias("symbols_per_word"),
                    share("marks", "n_words").alias("marks_per_word"), share("upper", "word_chars").alias("upper_share"),
                    share("digits", "word_chars").alias("digit_share"), share("n_dup_lines", "n_lines").alias("dup_line_share"),
                    share("n_repeat_words", "n_words").alias("repeat_share"), share("distinct", "n_words").alias("distinct_share"))


def base_failed() -> Column:
    """Too short, or more than half of its words are repeated."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def _thresholds(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    marks = rows.agg(*[F.percentile_approx(F.col(f).cast("double"), [i / bins for i in range(1, bins)], 10_000).alias(f) for f in FEATURES]).first()
    return {f: sorted(set(marks[f] or [])) for f in FEATURES}


def _histogram(rows: DataFrame, cuts: dict[str, list[float]]) -> dict:
    """(feature, bin) -> (bad, good) rows; a bin counts the thresholds below the value. At most
    features * bins rows reach the driver."""
    def cell(f, marks):
        return F.struct(F.lit(f).alias("f"), F.size(F.filter(F.array(*map(F.lit, marks)), lambda x: x < F.col(f))).alias("b"))

    cells = [cell(f, c) for f, c in cuts.items() if c]
    if not cells:
        return {}
    cell = rows.select("bad", F.explode(F.array(*cells)).alias("c"))
    return {(r.f, r.b): (r.p, r.n) for r in cell.groupBy("c.f", "c.b").agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect()}


def _best(hist: dict, cuts: dict, p0: int, n0: int) -> Condition | None:
    """The condition with the greatest information gain over p0 bad and n0 good rows."""
    best, found = 1e-9, None
    info = math.log2(p0 / (p0 + n0))
    for f, marks in cuts.items():
        below_p = below_n = 0
        for b, mark in enumerate(marks):
            p, n = hist.get((f, b), (0, 0))
            below_p, below_n = below_p + p, below_n + n
            for above, (p, n) in ((True, (p0 - below_p, n0 - below_n)), (False, (below_p, below_n))):
                gain = p * (math.log2(p / (p + n)) - info) if p else 0
                if gain > best:
                    best, found = gain, Condition(f, above, mark)
    return found


def _all(conditions) -> Column:
    c = F.lit(True)
    for x in conditions:
        c = c & x.column()
    return c


def learn(stats: DataFrame, labels: DataFrame, scratch: Scratch, params: LearnParams = LearnParams()) -> list[tuple[Condition, ...]]:
    """Ordered conjunctions that find bad rows (``labels.quality`` = 0) among labelled ones.

    Sequential covering: a rule grows on two thirds of the labelled rows, by the condition of
    greatest gain until it holds no good row, loses its last conditions as long as the other
    third scores the shorter rule no worse, and is kept if it is precise there; then the rows
    it finds are set aside. Every choice rests on counts that Spark takes over all labelled
    rows; the driver sees at most one number pair per feature and bin. Rows that a rule finds
    are bad, the rest good. Ids with several labels take the least; null labels are left out;
    no labels give no rules.
    """
    known = labels.filter("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = stats.filter(~base_failed()).join(known, "doc_id").select(
        *FEATURES, (F.col("quality") == 0).cast("int").alias("bad"), (F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(3)) == 0).alias("held"))
    rows = scratch.write(rows, "labelled")
    cuts = _thresholds(rows, params.bins)
    rules: list[tuple[Condition, ...]] = []
    for _ in range(params.max_rules):
        left = rows.filter(~_found(rules)) if rules else rows
        grow: list[Condition] = []
        while len(grow) < params.max_conditions:
            hist = _histogram(left.filter("not held").filter(_all(grow)), cuts)
            first = next((f for f in cuts if cuts[f]), None)
            p0, n0 = (sum(v[i] for k, v in hist.items() if k[0] == first) for i in (0, 1)) if hist else (0, 0)
            best = _best(hist, cuts, p0, n0) if p0 and n0 else None
            if best is None:
                break
            grow.append(best)
        if not grow:
            break
        cols = [F.sum(F.when(_all(grow[:k]), v).otherwise(0)).alias(f"{s}{k}") for k in range(1, len(grow) + 1)
                for s, v in (("p", F.col("bad")), ("n", 1 - F.col("bad")))]
        got = left.filter("held").agg(*cols).first()
        worth = {k: ((got[f"p{k}"] or 0) - (got[f"n{k}"] or 0)) / max(1, (got[f"p{k}"] or 0) + (got[f"n{k}"] or 0)) for k in range(1, len(grow) + 1)}
        k = min(worth, key=lambda k: (-worth[k], k))
        p, n = got[f"p{k}"] or 0, got[f"n{k}"] or 0
        if p < params.min_rows or p < params.min_precision * (p + n):
            break
        rules.append(tuple(grow[:k]))
    return rules


def _found(rules) -> Column:
    c = F.lit(False)
    for r in rules:
        c = c | _all(r)
    return c


def rule_number(rules) -> Column:
    """The first rule that holds, from 1, as one conditional expression; 0 if none does."""
    c = F.lit(0)
    for i, r in reversed(list(enumerate(rules, 1))):
        c = F.when(_all(r), F.lit(i)).otherwise(c)
    return c


def judge(docs: DataFrame, labels: DataFrame, params: LearnParams = LearnParams()) -> DataFrame:
    """``statistics`` of every document with ``base_failed``, ``rule`` (number of the rule that
    found it, 0 for none) and ``kept``. Empty tables give no rows, and no rules."""
    scratch = Scratch(docs.sparkSession)
    stats = scratch.write(statistics(docs), "statistics")
    rules = learn(stats, labels, scratch, params)
    return (stats.withColumn("base_failed", base_failed()).withColumn("rule", rule_number(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))
