"""Number, date and path functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, let


def parse_amount(c: Column) -> Column:
    """PRJ5: exact decimal or null."""
    return F.trim(c).try_cast("decimal(38,10)")


def money(c: Column) -> Column:
    """PRJ5: two decimals, half away from zero; null when it is not a number."""
    return F.round(parse_amount(c), 2).try_cast("decimal(18,2)")


def money_text(c: Column) -> Column:
    return money(c).cast("string")


def day_key(c: Column) -> Column:
    """First ten characters of a date text."""
    return F.left(c, F.lit(10))


def match_key(description: Column, amount: Column, date: Column) -> Column:
    """PRJ6: (description, amount, day) or null when a part is missing."""
    parts = F.struct(collapse(F.lower(F.coalesce(description, F.lit("")))).alias("description"),
                     money_text(amount).alias("amount"), day_key(date).alias("day"))
    return let(parts, lambda k: F.when(
        (k["description"] != "") & k["amount"].isNotNull()
        & (F.coalesce(k["day"], F.lit("")) != ""), k))


def day_first_date(c: Column) -> Column:
    """PRJ12: dd/MM/yyyy, bad text is null."""
    return F.to_date(F.try_to_timestamp(c, F.lit("dd/MM/yyyy")))


def iso_date(c: Column) -> Column:
    """Strict yyyy-MM-dd, bad text is null."""
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), c.try_cast("date"))


def iso_timestamp(c: Column) -> Column:
    """ISO text as it reads on the clock: a zone is dropped, the session's is not used; bad text is null."""
    return c.try_cast("timestamp_ntz")


def cents(c: Column) -> Column:
    """Whole cents of a two-decimal amount as BIGINT."""
    return (c.try_cast("decimal(18,2)") * 100).cast("bigint")


def half_up_div(num: Column, den: Column) -> Column:
    """Rounded quotient of non-negative integers, halves up; zero if the divisor is zero."""
    n, d = num.cast("decimal(38,0)"), den.cast("decimal(38,0)")
    q = F.call_function("div", n * 2 + d, F.nullif(d * 2, F.lit(0).cast("decimal(38,0)")))
    return F.coalesce(q.cast("bigint"), F.lit(0).cast("bigint"))


def cents_to_money(c: Column) -> Column:
    return c.cast("double") / F.lit(100.0)


# -- paths (STR15, STR16) -----------------------------------------------------

def name_timestamp(name: Column) -> Column:
    """STR15: earliest valid yyyyMMdd[HHmmss] in a file name."""
    hits = F.regexp_extract_all(name, F.lit(r"(20\d{6})(?:[_-]?(\d{6}))?"), F.lit(0))
    digits = F.transform(hits, lambda h: F.rpad(F.regexp_replace(h, r"[_-]", ""), 14, "0"))
    return F.array_min(F.transform(
        digits, lambda d: F.try_to_timestamp(d, F.lit("yyyyMMddHHmmss"))))


# fixed values: artefact types by folder and file-name start
CAPTURE_FOLDER = "StatementCapture"
CAPTURE_FILES = ["retrieve-transactions", "retrieve-accounts", "verify-credentials"]


def artefact_type(path: Column) -> Column:
    """STR16: type of a file from its path relative to the root."""
    parts = F.split(path, "/")
    folder = F.try_element_at(parts, F.lit(3))
    name = F.element_at(parts, -1)
    capture = F.lit(CAPTURE_FOLDER + "/other")
    for start in reversed(CAPTURE_FILES):
        capture = F.when(name.startswith(start + "_"),
                         F.lit(f"{CAPTURE_FOLDER}/{start}")).otherwise(capture)
    return (F.when(F.size(parts) < 3, F.lit("other"))
            .when(folder == CAPTURE_FOLDER, capture).otherwise(folder))


def run_of_path(path: Column) -> Column:
    """STR16: first two path parts; null for paths less than three deep."""
    parts = F.split(path, "/")
    return F.when(F.size(parts) >= 3, F.concat_ws("/", F.slice(parts, 1, 2)))


def glob_regex(pattern: str) -> str:
    """FLT6: a shell pattern as a regular expression for the whole text."""
    out, i = "", 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "*":
            out += ".*"
        elif ch == "?":
            out += "."
        elif ch == "[" and "]" in pattern[i + 2:]:
            end = pattern.index("]", i + 2)
            body = pattern[i + 1:end].replace("\\", "\\\\")
            out += "[" + ("^" + body[1:] if body.startswith("!") else body) + "]"
            i = end
        else:
            out += "\\" + ch if not ch.isalnum() else ch
        i += 1
    return "(?s)^" + out + "$"


def path_included(path: Column, globs: list[str]) -> Column:
    """FLT6: any pattern matches; patterns without a slash look at the file name only."""
    name = F.element_at(F.split(path, "/"), -1)
    hit = F.lit(False)
    for g in globs:
        hit = hit | (path if "/" in g else name).rlike(glob_regex(g))
    return hit
