"""Text functions on descriptions: every one maps Column to Column inside the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

# Java's \w, \s and \b follow Unicode only under (?U).
UNICODE = "(?U)"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, UNICODE + r"^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    return strip(F.regexp_replace(c, UNICODE + r"\s+", " "))


def words(c: Column) -> Column:
    """Whitespace-separated words; no empty entries."""
    return F.filter(F.split(strip(c), UNICODE + r"\s+"), lambda w: w != "")


def _any_of(phrases) -> str:
    return "|".join(re.escape(p) for p in phrases)


def let(c: Column, body) -> Column:
    """``body(c)`` with ``c`` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(c), body), 1)


# -- learning normaliser ------------------------------------------------------

def strip_leading_phrases(c: Column) -> Column:
    """STR2: remove listed phrases from the front until none is left."""
    return strip(F.regexp_replace(c, UNICODE + r"^(?:(?:%s)\s*)+" % _any_of(K.LEADING_PHRASES), ""))


def strip_references(c: Column) -> Column:
    """STR3: long digit runs and reference numbers."""
    for pattern in (r"\b\d{5,}\b", r"\{\d+\}", r"(?i)ref\s*\d+", r"(?i)reference\s*\d+"):
        c = F.regexp_replace(c, UNICODE + pattern, "")
    return c


def strip_places(c: Column) -> Column:
    """STR4: drop place words."""
    places = F.array(*[F.lit(w) for w in K.PLACE_WORDS])
    return F.array_join(F.filter(words(c), lambda w: ~F.array_contains(places, w)), " ")


def strip_trailing_phrases(c: Column) -> Column:
    """STR5: remove listed endings until none is left; blocked by trailing blanks."""
    return F.regexp_replace(c, UNICODE + r"(?:\s*(?:%s))+\z" % _any_of(K.TRAILING_PHRASES), "")


def short_name(c: Column) -> Column:
    """STR6: the merchant part of cleaned, single-spaced text.

    Up to two words stay; of three or more, a known name at the start or the first two words.
    """
    known = r"(?=\S+ \S+ \S)(?:%s)" % _any_of(K.KNOWN_NAMES)
    return F.regexp_extract(c, r"^(?:%s|\S+(?: \S+)?)" % known, 0)


def merchant_pattern(c: Column) -> Column:
    """STR1: canonical form used as the dictionary key."""
    t = strip(F.lower(F.coalesce(c, F.lit(""))))
    t = strip_places(strip_references(strip_leading_phrases(t)))
    t = F.regexp_replace(t, UNICODE + r"[^a-z0-9\s]", " ")
    return short_name(collapse(strip_trailing_phrases(t)))


def remove_places(c: Column) -> Column:
    """STR20: place removal on raw text."""
    return strip_places(F.lower(c))


def lookup_form(c: Column) -> Column:
    """STR20: the dictionary lookup form."""
    return merchant_pattern(c)


def pattern_variants(pattern: Column) -> Column:
    """STR7: forms to look up, best first; takes the output of merchant_pattern."""
    w = F.split(pattern, " ")
    first = F.element_at(w, 1)
    two = F.array_join(F.slice(w, 1, 2), " ")
    return F.array_distinct(F.filter(
        F.array(pattern, F.when(F.length(first) >= 3, first), F.when(F.size(w) >= 2, two)),
        lambda v: v.isNotNull()))


# -- payment-prefix stripper --------------------------------------------------

PREFIX_REGEX = UNICODE + "(?i)^(?:%s)" % "|".join(K.PAYMENT_PREFIXES)


def removed_prefix(c: Column) -> Column:
    return strip(F.regexp_extract(strip(F.coalesce(c, F.lit(""))), PREFIX_REGEX, 0))


def merchant_text(c: Column) -> Column:
    """STR8/STR10: description without payment prefix and card noise."""
    raw = F.coalesce(c, F.lit(""))
    t = strip(F.regexp_replace(strip(raw), PREFIX_REGEX, ""))
    for pattern in K.NOISE:
        t = strip(F.regexp_replace(t, UNICODE + "(?i)" + pattern, ""))
    enough = F.regexp_extract(t, r"(?s)^.{3,}$", 0)
    return F.coalesce(F.nullif(enough, F.lit("")), raw)


def payment_type(c: Column) -> Column:
    """STR9: payment type from the removed prefix."""
    def pick(p):
        out = F.when(p == "", F.lit("UNKNOWN"))
        for name, fragments in K.PREFIX_TYPES:
            hit = F.lit(False)
            for f in fragments:
                hit = hit | (p.startswith(f[1:]) if f.startswith("^") else p.contains(f))
            out = out.when(hit, F.lit(name))
        return out.otherwise(F.lit("OTHER"))

    return let(F.lower(removed_prefix(c)), pick)


# -- other forms --------------------------------------------------------------

def match_form(c: Column) -> Column:
    """STR11: lower case, only ASCII letters, digits and single blanks."""
    return collapse(F.regexp_replace(F.lower(c), UNICODE + r"[^a-z0-9\s]", ""))


def merchant_key(c: Column) -> Column:
    """STR12: key that counts merchants."""
    return strip(F.lower(c))


def account_numbers(c: Column) -> Column:
    """STR13: account numbers mentioned in a description."""
    i = UNICODE + "(?i)"
    text = F.coalesce(c, F.lit(""))

    def groups(pattern, n):
        return F.regexp_extract_all(text, F.lit(i + pattern), F.lit(n))

    return F.array_distinct(F.concat(
        F.zip_with(groups(K.SPLIT_ACCOUNT, 1), groups(K.SPLIT_ACCOUNT, 2),
                   lambda a, b: F.concat(a, b)),
        groups(K.DIRECTED_ACCOUNT, 1),
        groups(K.NUMBERED_TRANSFER_ACCOUNT, 1)))


def is_transfer_worded(c: Column) -> Column:
    """STR14: the description speaks of a transfer."""
    return F.coalesce(F.upper(c).rlike(_any_of(K.TRANSFER_PHRASES)), F.lit(False))


def has_internal_hint(*cols: Column) -> Column:
    """STR14: any of the given fields marks an own-account transfer."""
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.coalesce(c.rlike(_any_of(K.INTERNAL_HINTS)), F.lit(False))
    return hit


def redact(c: Column) -> Column:
    """PRJ7: first and last three characters, or a fixed mask for short text."""
    t = collapse(F.coalesce(c, F.lit("")))
    return (F.when(F.coalesce(c, F.lit("")) == "", F.lit(""))
            .when(F.length(t) <= 6, F.lit("[REDACTED]"))
            .otherwise(F.concat(F.left(t, F.lit(3)), F.lit("..."), F.right(t, F.lit(3)))))


def request_key(description: Column, amount: Column, category: Column) -> Column:
    """STR17: md5 key of one review request; the amount is written with two decimals."""
    return F.md5(F.concat_ws("|", description, amount.cast("decimal(18,2)").cast("string"),
                             F.coalesce(category, F.lit(""))))


ANSWER_SCHEMA = "category string, confidence string, reasoning string"


def parse_answer(c: Column) -> Column:
    """STR19: struct(category, confidence, reasoning) of a JSON answer; null if unusable.

    Code fences are dropped: inside a fenced text, the parts between fence lines count.
    """
    def body(t):
        parts = F.split(t, r"(?m)^\s*```[^\n]*$")
        inside = F.array_join(F.filter(parts, lambda _, i: i % 2 == 1), "\n")
        return F.when(t.startswith("```"), inside).otherwise(t)

    def read(j):
        confidence = j["confidence"].try_cast("double")
        ok = j["category"].isNotNull() & confidence.isNotNull()
        return F.when(ok, F.struct(
            j["category"].alias("category"), confidence.alias("confidence"),
            F.coalesce(j["reasoning"], F.lit("No reasoning provided")).alias("reasoning")))

    text = let(strip(F.coalesce(c, F.lit(""))), body)
    return let(F.from_json(text, ANSWER_SCHEMA), read)
