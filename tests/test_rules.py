import random
import re

from pyspark.sql import functions as F

from ledgerloom import tables
from ledgerloom.operators import cascade, quality, rules
from ledgerloom.operators.rules import RuleBook


def naive(rows, text):
    """Ordered scan over every keyword."""
    for seq, keyword, code, *_ in rows:
        if re.search(r"\b" + re.escape(keyword) + r"\b", text.lower()):
            return seq
    return None


def test_match_equals_ordered_scan(spark):
    book = RuleBook.seed()
    rows = [(r[0], r[2], r[3]) for r in tables.rules_rows()]
    rnd = random.Random(3)
    words = [r[1] for r in rows] + ["x", "CAFÉX", "pre", "bp", "disney+x", "disney+ x", "netflix-com"]
    texts = [rnd.choice(["", "a"]) .join([" ".join(rnd.sample(words, rnd.randint(1, 3)))]) for _ in range(200)]
    texts += ["CORNER CAFÉ", "CAFÉS", "DISNEY+X", "DISNEY+ X", "IGAX", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", book.whole_word_match(F.col("t"))["seq"].alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [naive(rows, t) for t in texts]
    joined = rules.match_rules_join(df.withColumn("id", F.col("i").cast("string")), tables.seed_rules(spark), "t", "id")
    by_join = {r.i: r.rule_keyword for r in joined.collect()}
    keyword = {r[0]: r[1] for r in rows}
    assert by_join == {i: keyword.get(naive(rows, t)) for i, t in enumerate(texts)}


def tx(spark, rows):
    return spark.createDataFrame(rows, "tx_id string, description string, cents long, provider_category string, third_party string")


def code_of(spark, description, cents, category=None, third=None, mapping=None):
    r = cascade.categorize(tx(spark, [("1", description, cents, category, third)]), mapping=mapping).first()
    return r.code, r.branch


def test_cascade_cases(spark):
    assert code_of(spark, "WOOLWORTHS LIMITED WAGES", 420000) == ("INC-009", "income")
    assert code_of(spark, "WOOLWORTHS LIMITED WAGES", -420) == ("EXP-016", "rule_high")
    assert code_of(spark, "ZARA REFUND", 100) == ("EXP-032", "income")
    # The first match has the wrong direction and no later rule is tried.
    assert code_of(spark, "WOOLWORTHS", 100) == ("INC-007", "uncategorised")
    assert code_of(spark, "SOMETHING ELSE", 0) == ("INC-007", "uncategorised")
    assert code_of(spark, "X", -1, "Uncategorised") == ("EXP-039", "uncategorised")
    assert code_of(spark, "X", -1, None, "Internal Transfer Debit") == ("INTERNAL_TRANSFER", "own_transfer")
    assert code_of(spark, None, -1) == ("EXP-039", "uncategorised")


def test_income_order(spark):
    book = RuleBook.income()
    df = spark.createDataFrame([("centrelink jobseeker",), ("age pension",), ("salary refund",), ("wagesx",)], "t string")
    got = [r.c for r in df.select(book.whole_word_match(F.col("t"))["code"].alias("c")).collect()]
    assert got == ["INC-014", "INC-017", "INC-009", None]


def test_category_names(spark):
    df = spark.createDataFrame([("Wages",), ("Bank fees and charges",), ("zzz",), ("",), (None,), ("ATM",)], "c string")
    got = [r.v for r in df.select(rules.category_by_name(F.col("c")).alias("v")).collect()]
    assert got == ["INC-009", "EXP-015", None, None, None, "EXP-001"]


def test_context_rules(spark):
    rows = [("SQ * BEAN COFFEE", "EXP-008"), ("BOTTLE-O HOTEL", "UNKNOWN"), ("PET WAREHOUSE", "EXP-028"), ("GRAND HOTEL", "EXP-038"),
            ("MONASH UNIVERSITY FEE", "EXP-011"), ("WARRIGAS", "UNKNOWN"), ("GAS BILL", "EXP-040")]
    out = rules.with_context(tx(spark, [(str(i), t, -1, None, None) for i, (t, _) in enumerate(rows)]))
    assert [r.context_code for r in out.orderBy("tx_id").collect()] == [c for _, c in rows]


def test_quality(spark):
    shadow = quality.shadowed_keywords(tables.seed_rules(spark)).collect()
    assert {r.keyword for r in shadow} == {"redraw", "iga"}
    assert quality.missing_required(tables.taxonomy(spark)).count() == 0
    used = spark.createDataFrame([("INC-017",), ("EXP-042",), ("EXP-001",)], "code string")
    assert {r.code for r in quality.unknown_codes(used, tables.taxonomy(spark)).collect()} == {"INC-017", "EXP-042"}


def test_large_table_is_refused():
    import pytest

    with pytest.raises(ValueError):
        RuleBook([(i, f"w{i}", "EXP-001", 0.9, "r") for i in range(rules.MAX_KEYWORDS + 1)])
    with pytest.raises(ValueError):
        RuleBook([(0, "++", "EXP-001", 0.9, "r")])
