import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import constants as K
from ledgerloom.functions import text as T
from ledgerloom.functions import values as V


def run(spark, fn, items):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, c string")
    return [r.v for r in df.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize("text,want", [
    ("WOOLWORTHS 1234 MELBOURNE VIC", "woolworths 1234"),
    ("KFC PARRAMATTA NSW", "kfc"),
    ("PAYMENT TO MOMENTUM ENERGY 23522784", "momentum energy"),
    ("TRANSFER FROM MCARE BENEFITS 198145800 CYWQ", "mcare benefits"),
    ("ORIGIN ENERGY HOLDINGS SYDNEY", "origin energy"),
    ("", ""), (None, ""),
])
def test_merchant_pattern(spark, text, want):
    assert run(spark, T.merchant_pattern, [text]) == [want]


def test_prefixes(spark):
    rows = ["PENDING - POS AUTHORISATION BELAIR FINE WINES BELAIR AU Card Used 3960", "EFTPOS 507PIN* SHOP",
            "CREDIT INTEREST PAID", "PAY/SALARY FROM VIC BUILDING AUT 2465", "ANZ MOBILE BANKING PAYMENT 168136 TO Anita"]
    assert run(spark, T.merchant_text, rows) == [
        "BELAIR FINE WINES BELAIR", "SHOP", "CREDIT INTEREST PAID", "VIC BUILDING AUT 2465", "Anita"]
    assert run(spark, T.payment_type, rows) == ["PENDING", "POS", "INTEREST", "SALARY", "OTHER"]


def test_suffix_blocked_by_trailing_blank(spark):
    assert run(spark, T.strip_trailing_phrases, ["foo ltd", "foo ltd ", "foo pty ltd au"]) == ["foo", "foo ltd ", "foo"]


def test_accounts(spark):
    got = run(spark, lambda c: T.account_numbers(c), [
        "TRANSFER 12 TO 123456789", "FROM 012-3456789", "TO 12345", "TRANSFER 168136 TO 1234567890123"])
    assert sorted(got[0]) == ["123456789"]
    assert sorted(got[1]) == ["0123456789"]
    assert got[2] == []
    assert got[3] == ["123456789"]


def peel_front(text):
    for p in K.LEADING_PHRASES:
        if text.startswith(p):
            return peel_front(text[len(p):].strip())
    return text


def peel_back(text):
    for s in K.TRAILING_PHRASES:
        if text.endswith(s):
            return peel_back(text[:-len(s)].strip())
    return text


PIECES = st.lists(st.sampled_from(K.LEADING_PHRASES + K.TRAILING_PHRASES + ["shop", "au", " ", "p", "l", "x1"]), max_size=6)


@settings(max_examples=8, deadline=None)
@given(batch=st.lists(st.tuples(PIECES, st.sampled_from(["", " "])), min_size=30, max_size=30))
def test_phrase_stripping_equals_recursion(spark, batch):
    items = [sep.join(parts).strip() for parts, sep in batch]
    assert run(spark, T.strip_leading_phrases, items) == [peel_front(t) for t in items]
    assert [v.strip() for v in run(spark, T.strip_trailing_phrases, items)] == [peel_back(t) for t in items]


def test_values(spark):
    assert run(spark, V.money_text, ["2.675", "-1.005", "x", None, " 3 ", "1e2"]) == ["2.68", "-1.01", None, None, "3.00", "100.00"]
    assert [str(d) if d else None for d in run(spark, V.day_first_date, ["05/07/2024", "31/02/2024", ""])] == ["2024-07-05", None, None]
    assert [str(d) if d else None for d in run(spark, V.name_timestamp, ["a_20240105_101112-20231231.json", "x_20249999.json"])] == [
        "2023-12-31 00:00:00", None]
    assert run(spark, V.artefact_type, ["a/b/StatementCapture/retrieve-accounts_1.json", "a/b", "a/b/Misc/x"]) == [
        "StatementCapture/retrieve-accounts", "other", "Misc"]
    assert run(spark, lambda c: V.path_included(c, ["*.json"]), ["a/b.json", "b.jsonx"]) == [True, False]


def test_answers(spark):
    got = run(spark, T.parse_answer, ['{"category": "EXP-001", "confidence": "0.9"}',
                                      '```json\n{"category": "EXP-001", "confidence": 0.5, "reasoning": "r"}\n```', '{"category": "X"}', "no"])
    assert got[0].confidence == 0.9 and got[0].reasoning == "No reasoning provided"
    assert got[1].reasoning == "r" and got[2] is None and got[3] is None


def test_redaction_and_key(spark):
    assert run(spark, T.redact, ["abc", "  hello   world ", ""]) == ["[REDACTED]", "hel...rld", ""]
