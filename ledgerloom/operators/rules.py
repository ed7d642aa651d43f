"""Ordered rule matching (CLS1-CLS7) without a shuffle.

A rule table is small (some thousand keywords). It travels as one constant inside the plan:
keywords are grouped by a checksum of their first word, so a row only looks at keywords that
begin with one of its own words. Matching is a plain projection, hence works on streams and
cannot skew. A table beyond ``MAX_KEYWORDS`` uses ``match_rules_join`` instead.
"""

from __future__ import annotations

import json
import re
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import tables
from ..functions.text import UNICODE, let
from .phrases import PhraseIndex

MAX_KEYWORDS = 50_000
FIELDS = ("seq", "keyword", "code", "confidence", "reason")
RESULT = "struct<seq:int,keyword:string,code:string,confidence:double,reason:string,pattern:string>"
WORD = UNICODE + r"\w+"


def first_word(keyword: str) -> str | None:
    hit = re.search(r"\w+", keyword)
    return hit.group(0) if hit else None


def whole_word(keyword: str) -> str:
    return UNICODE + r"\b\Q" + keyword + r"\E\b"


class RuleBook:
    """Rules as constants: rows of (seq, keyword, code, confidence, reason) in match order."""

    def __init__(self, rows):
        self.rows = [dict(zip(FIELDS, r)) for r in rows]
        bad = [r["keyword"] for r in self.rows if first_word(r["keyword"]) is None]
        if bad:
            raise ValueError(f"keywords without a word character: {bad[:5]}")
        if len(self.rows) > MAX_KEYWORDS:
            raise ValueError("rule table too large for a plan constant; use match_rules_join")
        size = 1
        while size < 2 * len(self.rows):
            size *= 2
        self.size = size

    @classmethod
    def from_dataframe(cls, rules: DataFrame) -> "RuleBook":
        """Read a rule table; only as many rows are fetched as a book may hold."""
        got = rules.select(*FIELDS).limit(MAX_KEYWORDS + 1).collect()
        return cls(sorted(tuple(r) for r in got))

    @classmethod
    def seed(cls) -> "RuleBook":
        return cls([(r[0], *r[2:]) for r in tables.rules_rows()])

    @classmethod
    def income(cls) -> "RuleBook":
        return cls([(r[0], *r[2:]) for r in tables.income_rows()])

    def _entry(self, r):
        return {**r, "pattern": whole_word(r["keyword"])}

    def whole_word_match(self, text: Column) -> Column:
        """CLS1: struct of the first rule whose keyword is in the text as whole words."""
        buckets = [[] for _ in range(self.size)]
        for r in self.rows:
            word = first_word(r["keyword"])
            buckets[zlib.crc32(word.encode()) % self.size].append(self._entry(r))
        table = F.from_json(F.lit(json.dumps(buckets)), f"array<array<{RESULT}>>")

        def look(t):
            found = F.array_distinct(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)))
            near = F.flatten(F.transform(found, lambda w: F.element_at(
                table, (F.crc32(w) % self.size + 1).cast("int"))))
            hits = F.filter(near, lambda r: F.contains(t, r["keyword"])
                            & F.regexp_like(t, r["pattern"]))
            return F.array_min(hits)

        return let(F.lower(text), look)

    def substring_match(self, text: Column) -> Column:
        """CLS2: struct of the first rule whose keyword occurs anywhere in the text."""
        index = PhraseIndex([{**self._entry(r), "phrase": r["keyword"]} for r in self.rows], RESULT[:-1] + ",phrase:string>")
        return F.array_min(index.found(F.lower(text)))


def match_rules(df: DataFrame, book: RuleBook, text: str, prefix: str = "rule") -> DataFrame:
    """CLS1 as an operator: adds <prefix>_code, _confidence, _reason, _keyword."""
    m = df.withColumn("_m", book.whole_word_match(F.col(text)))
    return _spread(m, prefix)


def match_substrings(df: DataFrame, book: RuleBook, text: str, prefix: str = "rule") -> DataFrame:
    """CLS2 as an operator."""
    return _spread(df.withColumn("_m", book.substring_match(F.col(text))), prefix)


def match_income(df: DataFrame, text: str, amount: str, book: RuleBook | None = None,
                 prefix: str = "income") -> DataFrame:
    """CLS4: income words, for credits only."""
    book = book or RuleBook.income()
    m = F.when(F.col(amount) > 0, book.whole_word_match(F.col(text)))
    return _spread(df.withColumn("_m", m), prefix)


def _spread(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumns({
        f"{prefix}_code": F.col("_m.code"), f"{prefix}_confidence": F.col("_m.confidence"),
        f"{prefix}_reason": F.col("_m.reason"), f"{prefix}_keyword": F.col("_m.keyword"),
    }).drop("_m")


def match_rules_join(df: DataFrame, rules: DataFrame, text: str, row_id: str,
                     prefix: str = "rule") -> DataFrame:
    """CLS1 for rule tables of any size: join on the keyword's first word, keep the first rule.

    Works on distinct texts; the result returns to the rows by a salted join.
    """
    from .skew import attach

    texts = df.select(text).filter(F.col(text).isNotNull()).distinct()
    found = texts.select(text, F.explode(F.array_distinct(F.regexp_extract_all(
        F.lower(text), F.lit(WORD), F.lit(0)))).alias("_word"))
    keyed = rules.select(*FIELDS, F.regexp_extract("keyword", WORD, 0).alias("_word"))
    hit = F.regexp_like(F.lower(F.col(text)), F.concat(
        F.lit(UNICODE + r"\b\Q"), F.col("keyword"), F.lit(r"\E\b")))
    best = (found.join(keyed, "_word").filter(hit).groupBy(text)
            .agg(F.min(F.struct(*FIELDS)).alias("_m")))
    return _spread(attach(df, best, [text], [row_id], "left"), prefix)


# -- rule table access ----------------------------------------------------------

def rules_by_code(rules: DataFrame, code: str) -> DataFrame:
    """CLS3: keywords of one code."""
    return rules.filter(F.col("code") == code)


def rule_counts(rules: DataFrame) -> DataFrame:
    """CLS3: rules and keywords per code."""
    return rules.groupBy("code").agg(
        F.countDistinct("rule_seq").alias("rules"), F.count(F.lit(1)).alias("keywords"))


# -- contextual rules -------------------------------------------------------------

def _result(code, confidence, reason) -> Column:
    return F.struct(F.lit(code).alias("code"), F.lit(confidence).alias("confidence"),
                    F.lit(reason).alias("reason"))


def trusted_hint(category: Column) -> Column:
    """CLS6: struct for the provider categories that are trusted as they are."""
    out = None
    for name, code, confidence, label in tables.TRUSTED_HINTS:
        value = _result(code, confidence, f"Provider category: {label}")
        out = F.when(category == name, value) if out is None else out.when(category == name, value)
    return out


# What a phrase of a contextual rule must be in the text: part of it, its beginning, or whole words.
KINDS = ("in", "start", "word")
CONTEXT_SCHEMA = ("seq int, needs array<array<struct<kind:string,phrase:string>>>, never array<struct<kind:string,phrase:string>>, "
                  "code string, confidence double, reason string")


class ContextBook:
    """CLS5 rules as a constant: dicts with the columns of ``CONTEXT_SCHEMA``. A rule holds if each of
    its ``needs`` lists has a phrase in the text and ``never`` has none; the least ``seq`` wins.
    Rules need at least one ``needs`` list that is not empty, and phrases in lower case.

    One pass over the text finds all phrases of all rules (``PhraseIndex``). A rule is looked at
    only where a phrase of its shortest list was found, so most rows look at no rule at all.
    """

    def __init__(self, rows):
        self.rows = sorted(({**r, "needs": [n for n in r["needs"] if n]} for r in rows), key=lambda r: r["seq"])
        bad = [r["seq"] for r in self.rows if not r["needs"] or any(k not in KINDS or not p for n in (*r["needs"], r["never"]) for k, p in n)]
        if bad or len({r["seq"] for r in self.rows}) < len(self.rows):
            raise ValueError(f"rules without a phrase, with an unknown kind or with equal numbers: {bad[:5]}")
        if len(self.rows) > MAX_KEYWORDS:
            raise ValueError(f"more than {MAX_KEYWORDS} contextual rules do not fit a plan constant")

    @classmethod
    def seed(cls) -> "ContextBook":
        kinds = lambda phrases: [("start", p[1:]) if p.startswith("^") else ("in", p) for p in phrases]
        rules = [([kinds(x) for x in (start, any_of, also)], kinds(never), *result)
                 for start, any_of, also, never, *result in tables.CONTEXT_RULES]
        rules += [([kinds(phrases)], [], code, confidence, f"Matched {what} from description") for phrases, code, confidence, what in tables.CONTEXT_WORDS]
        rules.append(([[("word", w) for w in tables.UTILITY_WORDS]], [], *tables.UTILITY_RESULT))
        return cls([dict(zip(("seq", "needs", "never", "code", "confidence", "reason"), (i, *r))) for i, r in enumerate(rules)])

    @classmethod
    def from_dataframe(cls, rules: DataFrame) -> "ContextBook":
        """Read a rule table (``CONTEXT_SCHEMA``); only as many rows are fetched as a book may hold."""
        pairs = lambda phrases: [(p["kind"], p["phrase"]) for p in phrases or []]
        got = rules.select("seq", "needs", "never", "code", "confidence", "reason").limit(MAX_KEYWORDS + 1).collect()
        return cls([{**r.asDict(), "needs": [pairs(n) for n in r["needs"]], "never": pairs(r["never"])} for r in got])

    def to_dataframe(self, spark) -> DataFrame:
        return spark.createDataFrame([tuple(r[c] for c in ("seq", "needs", "never", "code", "confidence", "reason")) for r in self.rows], CONTEXT_SCHEMA)

    def match(self, text: Column) -> Column:
        """struct(seq, code, confidence, reason) of the first rule that holds; ``text`` in lower case."""
        ids: dict[tuple, int] = {}
        number = lambda phrases: [ids.setdefault(tuple(p), len(ids)) for p in phrases]
        rules, leads = [], {}
        for at, r in enumerate(self.rows):
            needs = sorted((number(n) for n in r["needs"]), key=len)
            for i in needs[0]:
                leads.setdefault(i, []).append(at + 1)
            rules.append({"seq": r["seq"], "needs": needs[1:], "never": number(r["never"]), "code": r["code"], "confidence": r["confidence"], "reason": r["reason"]})
        index = PhraseIndex([{"phrase": p, "id": i, "kind": k, "pattern": whole_word(p) if k == "word" else "", "leads": leads.get(i, [])}
                             for (k, p), i in ids.items()], "struct<phrase:string,id:int,kind:string,pattern:string,leads:array<int>>")
        table = F.from_json(F.lit(json.dumps(rules)), "array<struct<seq:int,needs:array<array<int>>,never:array<int>,code:string,confidence:double,reason:string>>")

        def as_asked(t):
            return F.filter(index.found(t), lambda e: F.when(e["kind"] == "start", F.startswith(t, e["phrase"]))
                            .when(e["kind"] == "word", F.regexp_like(t, e["pattern"])).otherwise(True))

        def look(found):
            seen = F.transform(found, lambda e: e["id"])
            near = F.array_distinct(F.flatten(F.transform(found, lambda e: e["leads"])))
            hits = F.filter(F.transform(near, lambda i: F.element_at(table, i)),
                            lambda r: F.forall(r["needs"], lambda n: F.arrays_overlap(n, seen)) & ~F.arrays_overlap(r["never"], seen))
            return F.array_min(F.transform(hits, lambda r: F.struct(r["seq"].alias("seq"), r["code"].alias("code"),
                                                                    r["confidence"].alias("confidence"), r["reason"].alias("reason"))))

        return let(let(text, as_asked), look)


def context_rule(text: Column, category: Column, book: ContextBook | None = None) -> Column:
    """CLS5: struct(code, confidence, reason) from the contextual rules (``book``, or the seed), else
    from trusted provider categories; code UNKNOWN if none. ``text`` must be lower case."""
    hit = (book or ContextBook.seed()).match(text)
    other = F.coalesce(trusted_hint(category), _result("UNKNOWN", 0.5, "No confident pattern match"))
    return let(hit, lambda m: F.when(m.isNotNull(), F.struct(*[m[f].alias(f) for f in ("code", "confidence", "reason")])).otherwise(other))


def with_context(df: DataFrame, text: str = "description", category: str = "provider_category",
                 prefix: str = "context", book: ContextBook | None = None) -> DataFrame:
    """CLS5 as an operator."""
    m = (df.withColumn("_t", F.lower(F.coalesce(F.col(text), F.lit(""))))
         .withColumn("_m", context_rule(F.col("_t"), F.col(category), book)))
    return m.withColumns({
        f"{prefix}_code": F.col("_m.code"), f"{prefix}_confidence": F.col("_m.confidence"),
        f"{prefix}_reason": F.col("_m.reason")}).drop("_m", "_t")


# -- provider category names --------------------------------------------------------

def category_by_name(category: Column) -> Column:
    """CLS7: code for a provider category name: exact, else first name inside it or around it."""
    names = [{"name": n, "lower": n.lower(), "code": c} for n, c in tables.CATEGORY_NAMES]
    table = F.from_json(F.lit(json.dumps(names)),
                        "array<struct<name:string,lower:string,code:string>>")

    def look(c):
        exact = F.try_element_at(F.filter(table, lambda n: n["name"] == c), F.lit(1))
        near = F.try_element_at(F.filter(table, lambda n: F.contains(F.lower(c), n["lower"])
                                         | F.contains(n["lower"], F.lower(c))), F.lit(1))
        return F.coalesce(exact["code"], near["code"])

    return let(F.nullif(category, F.lit("")), look)
