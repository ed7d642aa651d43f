"""Joins, transfers, matching and conflict folding against brute force on small data."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerloom.operators import labels, learning, matching, skew, stage, transfers

D = dt.date


def test_attach_with_hot_key(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id")).alias("k"),
                                    F.col("id").cast("string").alias("row"))
    dim = rows.select("k").distinct().filter("k < 1500").withColumn("v", F.col("k") * 2)
    for how in ("inner", "left"):
        plain = rows.join(dim, "k", how).select("k", "row", "v")
        salted = skew.attach(rows, dim, ["k"], ["row"], how, min_rows=10).select("k", "row", "v")
        assert sorted(plain.collect(), key=repr) == sorted(salted.collect(), key=repr)
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("_n"))
    hot = skew.hot_keys(counts, ["k"], "_n", min_rows=10).collect()
    assert [(r.k, r._salts > 1) for r in hot] == [(-1, True)]
    assert skew.hot_keys(counts, ["k"], "_n") is None


def test_transfers_against_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        c, acc = rnd.randint(1, 3), rnd.choice(["123456", "9123456", "600000001", "600000002", "12345"])
        word = rnd.choice(["TRANSFER TO ", "TRANSFER FROM ", "SHOP "])
        rows.append((c, f"t{i}", D(2024, 7, rnd.randint(1, 5)), f"{word}{acc}", rnd.choice([-500, 500, -700, 700, 0]),
                     rnd.choice([None, "Internal Transfer"]) if i % 40 == 0 else None, None,
                     "1234567" if i % 90 == 0 else None, "01" if i % 90 == 0 else None))
    tx = spark.createDataFrame(rows, "customer_id long, tx_id string, tx_date date, description string, cents long, provider_category string, "
                                     "third_party string, account_number string, bsb string")
    import re

    def found(d):
        return set(re.findall(r"(?:TO|FROM)\s+(\d{6,9})\b", d)) | {a + b for a, b in re.findall(r"\b(\d{3})[- ]?(\d{6,9})\b", d)}

    own = {}
    for c, _, day, d, cents, cat, _, num, bsb in rows:
        s = own.setdefault(c, set())
        if num:
            s.add((bsb or "") + num)
        if cat:
            s |= found(d)
        if "TRANSFER" in d:
            for c2, _, day2, d2, cents2, *_ in rows:
                if c2 == c and day2 == day and "TRANSFER" in d2 and cents * cents2 < 0 and abs(cents) == abs(cents2):
                    s |= found(d)
        for a in found(d):
            signs = {x[4] > 0 for x in rows if x[0] == c and a in found(x[3])}
            if len(signs) == 2:
                s.add(a)
    got = {}
    for r in transfers.own_accounts(tx).collect():
        got.setdefault(r.customer_id, set()).add(r.account)
    assert got == {c: s for c, s in own.items() if s}
    want = {}
    for c, i, _, d, _, cat, *_ in rows:
        hit = any(a in o or o in a for a in found(d) for o in own[c])
        want[i] = bool(cat) or ("TRANSFER" in d and hit)
    assert {r.tx_id: r.is_own_transfer for r in transfers.flag_own_transfers(tx).collect()} == want


def test_fuzzy_match_against_brute_force(spark, tmp_path, monkeypatch):
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(9)]
    left, right = [], []
    for i in range(150):
        text = " ".join(rnd.choices(vocab, k=rnd.choice([0, 1, 2, 3, 5, 7, 9, 12])))
        left.append((1, f"t{i}", D(2024, 7, rnd.randint(1, 9)), rnd.randint(100, 103), text))
        text = " ".join(rnd.choices(vocab, k=rnd.choice([1, 2, 4, 6, 8, 12])))
        right.append((1, i, dt.datetime(2024, 7, rnd.randint(1, 9), rnd.choice([0, 0, 13])), rnd.randint(100, 103), text, "c"))
    ldf = spark.createDataFrame(left, "customer_id long, tx_id string, tx_date date, cents long, description string")
    rdf = spark.createDataFrame(right, "customer_id long, seq long, ts timestamp_ntz, cents long, description string, code string")
    want = {}
    for _, i, day, cents, text in left:
        a, best = set(text.split()), None
        for _, seq, ts, c2, t2, _ in right:
            b = set(t2.split())
            days = abs((dt.datetime(day.year, day.month, day.day) - ts).days)
            if a and b and abs(cents - c2) <= 1 and days <= 2 and len(a & b) / min(len(a), len(b)) >= 0.4:
                best = seq
                break
        want[i] = best
    got = {r.tx_id: r.match_seq for r in matching.fuzzy_match(ldf, rdf).collect()}
    assert got == want and any(want.values())
    monkeypatch.setattr(stage, "shared_folder", lambda _: str(tmp_path))
    assert {r.tx_id: r.match_seq for r in matching.fuzzy_match(ldf, rdf).collect()} == want
    assert len(list((tmp_path / "ledgerloom").iterdir())) == 2


def test_fuzzy_match_broadcasts_nothing(spark, tmp_path, monkeypatch):
    """Its tables grow with the input and must not pass the driver, however small their files are."""
    monkeypatch.setattr(stage, "shared_folder", lambda _: str(tmp_path))
    rows = [(1, f"t{i}", D(2024, 7, 1 + i % 3), 100 + i, " ".join(f"w{j}" for j in range(i % 9)), i, dt.datetime(2024, 7, 1), "c") for i in range(40)]
    both = spark.createDataFrame(rows, "customer_id long, tx_id string, tx_date date, cents long, description string, seq long, ts timestamp_ntz, code string")
    plans, read = [], stage.written
    monkeypatch.setattr(matching, "written", lambda df: plans.append(df) or read(df))
    plans.append(matching.fuzzy_match(both.drop("seq", "ts", "code"), both.drop("tx_id", "tx_date")))
    for df in plans:
        assert df.collect()
        assert "BroadcastExchange" not in df._jdf.queryExecution().executedPlan().toString()


def fold(codes):
    state, torn = None, False
    for c in codes:
        if state is not None and state != c:
            state, torn = None, True
        else:
            state = c
    return state, torn


def test_conflicts_against_fold(spark):
    rnd = random.Random(7)
    rows, seen = [], {}
    for k in range(60):
        n = rnd.randint(1, 7)
        spots = sorted(rnd.sample([(r, p) for r in (0, 1, 5, 1023, 1024, 3000) for p in (0, 1)], n))
        codes = [rnd.choice("ABC") for _ in spots]
        seen[f"t{k}"] = (codes, spots)
        rows += [("run", r, f"rep{r:05d}", p, f"t{k}", "d", "1", "2024-01-01", c) for (r, p), c in zip(spots, codes)]
    rnd.shuffle(rows)
    rec = spark.createDataFrame(rows, "run_id string, report_seq long, report_path string, pos long, tx_id string, description string, "
                                      "amount string, date string, code string")
    for r in labels.labels_by_id(rec).collect():
        codes, spots = seen[r.tx_id]
        state, torn = fold(codes)
        assert (r.code, r.conflict) == (state, torn)
        assert r.report_path == (f"rep{spots[-1][0]:05d}" if state else None)
    strict = {r.tx_id: r.code for r in labels.labels_by_id(rec, strict=True).collect()}
    assert all((c is None) == (len(set(seen[t][0])) > 1) for t, c in strict.items())


def test_default_codes(spark):
    import pytest

    def of(rows, asked=None):
        asked = spark.createDataFrame(asked, "kind string, code string") if asked else None
        return labels.default_codes(spark.createDataFrame(rows, "code string, name string"), asked)

    both = of([("EXP-039", "Uncategorised Debits"), ("EXP-040", "uncategorized"), ("INC-007", "Other"), ("X-1", "Uncategorised income")], [("expense", "EXP-040")])
    assert {(r.kind, r.code, r.fallback) for r in both.collect()} == {("expense", "EXP-040", False), ("income", "X-1", False)}
    last = of([("UNKNOWN", "x")])
    assert labels.as_defaults(last) == {"expense": "UNKNOWN", "income": "UNKNOWN"} and all(r.fallback for r in last.collect())
    for rows, asked in (([("EXP-001", "x")], None), ([("EXP-039", "Uncategorised"), ("UNKNOWN", "x")], [("income", "INC-999")])):
        with pytest.raises(ValueError):
            labels.as_defaults(of(rows, asked))


def test_similar_patterns_against_brute_force(spark):
    rnd = random.Random(2)
    words = [f"v{i}" for i in range(7)]
    names = sorted({" ".join(rnd.sample(words, rnd.choice([1, 2, 2, 4]))) for _ in range(60)})
    pats = spark.createDataFrame([(n, "c", [n]) for n in names], "pattern string, category string, examples array<string>")
    forms = sorted({" ".join(rnd.sample(words, rnd.choice([1, 2, 3, 5]))) for _ in range(30)})
    got = {}
    for r in learning.similar_patterns(spark.createDataFrame([(f,) for f in forms], "form string"), pats, 4).collect():
        got.setdefault(r.form, []).append((r["rank"], r.pattern))
    for f in forms:
        a = set(f.split())
        sims = sorted((-len(a & set(n.split())) / max(len(a), len(n.split())), n) for n in names if a & set(n.split()))
        assert [p for _, p in sorted(got.get(f, []))] == [n for _, n in sims[:4]]


def test_upsert_keeps_category(spark):
    empty = spark.createDataFrame([], learning.PATTERN_SCHEMA)
    schema = "seq long, description string, category string, confidence double, source string"
    one = spark.createDataFrame([(1, "KFC SYDNEY", "A", 0.92, "s"), (2, "KFC PERTH", "B", 0.97, "s"), (3, "WEAK", "A", 0.89, "s")], schema)
    first = learning.upsert_patterns(empty, one, learned_at="t")
    r = first.collect()
    assert len(r) == 1 and (r[0].category, r[0].confidence, r[0].examples) == ("A", 0.97, ["KFC SYDNEY", "KFC PERTH"])
    again = learning.upsert_patterns(first, spark.createDataFrame([(1, "KFC CAIRNS", "Z", 0.91, "s")], schema), learned_at="u").first()
    assert (again.category, again.confidence, len(again.examples)) == ("A", 0.97, 3)
