"""Substring and contextual rules against plain scans of all rules."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom import tables
from ledgerloom.operators import cascade, phrases as index_of, rules
from ledgerloom.operators.phrases import PhraseIndex
from ledgerloom.operators.rules import ContextBook, RuleBook

@pytest.fixture(params=["scan", "look up"])
def way(request, monkeypatch):
    monkeypatch.setattr(index_of, "SCAN", 10_000 if request.param == "scan" else 0)


ALPHABET = "ab cé😀.*^"


def texts_of(rnd, n, longest=25):
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


def test_index_finds_what_a_scan_finds(spark, way):
    rnd = random.Random(5)
    phrases = ["", "a", "é", "😀", "ab", "aaa", "a.*", "^ab", *{t for t in texts_of(rnd, 300, 6)}]
    index = PhraseIndex([{"phrase": p, "id": i} for i, p in enumerate(phrases)], "struct<phrase:string,id:int>")
    texts = ["", "\n", "a\nb", "x" * 100_000 + "aaa", None, *texts_of(rnd, 300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for r in df.select("i", index.found(F.col("t"))["id"].alias("ids")).collect():
        want = None if texts[r.i] is None else sorted(i for i, p in enumerate(phrases) if p in texts[r.i])
        assert (r.ids and sorted(r.ids)) == want or r.ids == want == []


def test_substring_rules_equal_a_scan(spark, way):
    rnd = random.Random(6)
    words = [w for w in texts_of(rnd, 200, 5) if re.search(r"\w", w)]
    rows = [(i, w, f"C{i}", 0.5, "r") for i, w in enumerate(words)]
    texts = [*texts_of(rnd, 300), None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = rules.match_substrings(df, RuleBook(rows), "t")
    for r in got.collect():
        assert r.rule_code == next((f"C{i}" for i, w in enumerate(words) if r.t is not None and w in r.t.lower()), None)
    assert rules.match_substrings(df, RuleBook([]), "t").filter("rule_code is not null").count() == 0


def holds(kind, phrase, text):
    return {"in": phrase in text, "start": text.startswith(phrase), "word": bool(re.search(r"\b" + re.escape(phrase) + r"\b", text))}[kind]


def scan(rows, text):
    for r in rows:
        if all(any(holds(k, p, text) for k, p in n) for n in r["needs"]) and not any(holds(k, p, text) for k, p in r["never"]):
            return r["code"], r["confidence"], r["reason"]
    return "UNKNOWN", 0.5, "No confident pattern match"


def test_contextual_rules_equal_a_scan(spark, way):
    book = ContextBook.seed()
    phrases = sorted({p for r in book.rows for n in (*r["needs"], r["never"]) for _, p in n})
    rnd = random.Random(7)
    texts = ["", *phrases, *["".join(rnd.choice(["", " ", "x"]) + p for p in rnd.sample(phrases, rnd.randint(1, 4))) for _ in range(600)]]
    df = spark.createDataFrame([(i, t.upper(), None) for i, t in enumerate(texts)], "i int, description string, provider_category string")
    for b in (book, ContextBook.from_dataframe(book.to_dataframe(spark))):
        got = {r.i: (r.context_code, r.context_confidence, r.context_reason) for r in rules.with_context(df, book=b).collect()}
        assert [got[i] for i in range(len(texts))] == [scan(book.rows, t) for t in texts]


def test_rules_of_the_caller_decide(spark, way):
    book = ContextBook([{"seq": 4, "needs": [[("in", "tea")], []], "never": [("word", "steam")], "code": "EXP-001", "confidence": 0.99, "reason": "tea"},
                        {"seq": 2, "needs": [[("in", "tea"), ("in", "pot")], [("start", "shop")]], "never": [], "code": "EXP-002", "confidence": 0.99, "reason": "pot"}])
    rows = [("1", "SHOP TEA", -1, None, None), ("2", "TEA", -1, None, None), ("3", "STEAM", -1, None, None), ("4", "WOOLWORTHS", -1, None, None), ("5", None, -1, None, None)]
    df = spark.createDataFrame(rows, "tx_id string, description string, cents long, provider_category string, third_party string")
    for run in (cascade.categorize_tiers, cascade.categorize_hybrid):
        got = {r.tx_id: r.code for r in run(df, context=book).collect()}
        assert got == {"1": "EXP-002", "2": "EXP-001", "3": "EXP-039", "4": "EXP-039", "5": "EXP-039"}
    for bad in ({"needs": [[]]}, {"needs": [[("near", "x")]]}, {"needs": [[("in", "")]]}):
        with pytest.raises(ValueError):
            ContextBook([{"seq": 1, "never": [], "code": "c", "confidence": 1.0, "reason": "r", **bad}])
    with pytest.raises(ValueError):
        ContextBook([book.rows[0], book.rows[0]])


def test_many_keywords_cost_little_more(spark):
    rnd = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda: "".join(rnd.choice(letters) for _ in range(8))
    many = [(i, word(), "C", 0.5, "r") for i in range(20_000)]
    df = spark.range(20_000).select(F.concat_ws(" ", *[F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(str(k)))), 1, 8) for k in range(4)]).alias("t")).cache()
    df.count()

    def seconds(rows):
        out = rules.match_substrings(df, RuleBook(rows), "t")
        out.agg(F.count("rule_code")).collect()
        start = time.time()
        out.agg(F.count("rule_code")).collect()
        return time.time() - start

    assert seconds(many) < 10 * seconds(many[:500]) + 2
    df.unpersist()
