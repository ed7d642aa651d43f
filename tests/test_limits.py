"""Inputs of any size or quality: no cap loses rows, no bad row or file ends a job."""

import json

from pyspark.sql import functions as F

from ledgerloom.functions import values as V
from ledgerloom.operators import cascade, evaluate, labels, learning, rules, transfers
from ledgerloom.plans import jobs
from ledgerloom.sources import api_json, files, sinks, statements

HUGE = "99999999999999999999.00"


def test_better_match_of_a_longer_form_is_kept(spark):
    names = ["zz yy"] + [f"aa{i:02d} zz" if i % 2 else f"ab{i:02d} xx" for i in range(20)]
    pats = spark.createDataFrame([(n, "c", [n]) for n in names], "pattern string, category string, examples array<string>")
    got = learning.similar_patterns(spark.createDataFrame([("zz yy xx",)], "form string"), pats, 3).collect()
    assert [r.pattern for r in sorted(got, key=lambda r: r["rank"])][0] == "zz yy" and len(got) == 3


def test_accounts_of_any_length(spark):
    own = spark.createDataFrame([(1, "1234567890123"), (1, "99" * 10)], "customer_id long, account string")
    seen = spark.createDataFrame([(1, "1234567890123"), (1, "99" * 8), (1, "00" + "1234567890123"), (2, "1234567890123"), (1, "55555")], "customer_id long, account string")
    assert {(r.customer_id, r.account) for r in transfers.matching_accounts(seen, own).collect()} == {
        (1, "1234567890123"), (1, "99" * 8), (1, "001234567890123")}


def test_rules_as_a_table(spark):
    tx = spark.createDataFrame([(f"t{i}", d, c, None, None) for i, (d, c) in enumerate([("kw17 shop", -5), ("kw3 kw2", -5), ("nothing", 7), ("kw9", -1)])],
                               "tx_id string, description string, cents long, provider_category string, third_party string")
    table = spark.createDataFrame([(i, f"kw{i}", "EXP-001", 0.95, "r") for i in range(40)], "seq int, keyword string, code string, confidence double, reason string")
    cols = ["tx_id", "code", "confidence", "source", "branch", "direction_filtered"]
    plain = cascade.categorize(tx, rules.RuleBook.from_dataframe(table)).select(cols)
    assert sorted(plain.collect()) == sorted(cascade.categorize(tx, table).select(cols).collect())


def test_overflow_is_null_or_a_rejected_row(spark):
    one = spark.createDataFrame([(HUGE,)], "a string")
    assert one.select(V.money(F.col("a")), V.cents(V.parse_amount(F.col("a")))).first() == (None, None)
    raw = spark.createDataFrame([("x", HUGE, "2024-01-02", "1"), ("y", "2.00", "2024-01-02", "2")], "description string, amount string, date string, transaction_id string")
    full = raw.withColumns({c: F.lit("") for c in ("Category", "thirdParty", "accountType", "label_group_code", "label_source")}).withColumn("transaction_date", F.col("date"))
    assert [r.description for r in statements.provider_match_rows(full).collect()] == ["y"]
    assert [r.description for r in statements.labelled_match_rows(full).collect()] == ["y"]
    assert [r.description for r in statements.card_rows(raw.select("description", F.col("amount").alias("Amount"), "date")).collect()] == ["y"]


def test_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a_categorized.csv").write_text("date,description,amount,code\n05/07/2024,x,-1.00,EXP-001\n05/07/2024,x,-1.00,EXP-001\n")
    (tmp_path / "b_categorized.csv").write_text(f"date,description,amount,balance,category_code\n05/07/2024,y,2.00,9,INC-007\n05/07/2024,z,{HUGE},9,INC-007\n")
    (tmp_path / "c_categorized.csv").write_text("")
    good, bad = statements.read_categorised(spark, str(tmp_path))
    rows = good.collect()
    assert sorted((r.customer_id, r.cents, r.code) for r in rows) == [("a_categorized", -100, "EXP-001")] * 2 + [("b_categorized", 200, "INC-007")]
    assert len({r.tx_id for r in rows}) == 3 and [r.description for r in bad.collect()] == ["z"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16b")
    try:
        assert {r.tx_id for r in statements.read_categorised(spark, str(tmp_path))[0].collect()} == {r.tx_id for r in rows}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "cards").mkdir()
    (tmp_path / "cards" / "1.csv").write_text("Date,Description,Amount\n1/1,p,3\n")
    (tmp_path / "cards" / "2.csv").write_text("Transaction Date,Merchant,Debit\n1/2,q,$4\n")
    assert sorted((r.description, float(r.amount), r.date) for r in statements.read_card_csv(spark, str(tmp_path / "cards")).collect()) == [("p", 3.0, "1/1"), ("q", 4.0, "1/2")]


def test_auto_takes_any_mix_of_files(spark, tmp_path):
    for name in ("json", "text", "none"):
        (tmp_path / name).mkdir()
    (tmp_path / "json" / "a.json").write_text(json.dumps([{"description": "J", "amount": 1}]))
    (tmp_path / "text" / "b.txt").write_text("description,amount\nT,2\n")
    read = lambda p: [(r.description, float(r.amount)) for r in statements.read_statements(spark, str(tmp_path / p)).collect()]
    assert read("json") == [("J", 1.0)] and read("text") == [("T", 2.0)] and read("none") == []


def test_broken_documents_are_told(spark):
    docs = spark.createDataFrame([("a", '{"data": []}'), ("b", '{"data": ['), ("c", ""), ("d", None), ("e", "[1]")], "path string, value string")
    assert sorted(r.path for r in api_json.rejected_documents(docs).collect()) == ["b", "c", "d"]


def test_the_usable_answer_wins(spark):
    good = '{"category": "EXP-054", "confidence": 0.9, "reasoning": "r"}'
    other = good.replace("EXP-054", "EXP-001").replace("0.9", "0.5")
    got = {r.form: r.answer_code for r in learning.read_answers(spark.createDataFrame(
        [("kfc", "no idea"), ("kfc", other), ("kfc", good), ("none", "?")], "form string, answer string")).collect()}
    assert got == {"kfc": "EXP-054", "none": None}
    ordered = spark.createDataFrame([("kfc", 2, good), ("kfc", 1, other), ("kfc", 0, "no idea")], "form string, seq int, answer string")
    assert learning.read_answers(ordered).first().answer_code == "EXP-001"


def test_labelled_times_do_not_follow_the_session_zone(spark):
    raw = spark.createDataFrame([("t", "d", "1.00", "2024-07-01T23:30:00Z", "c", "s")],
                                "transaction_id string, description string, amount string, transaction_date string, label_group_code string, label_source string")
    seen = set()
    for zone in ("UTC", "Australia/Sydney"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        seen.add(str(statements.labelled_match_rows(raw).first().ts))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert seen == {"2024-07-01 23:30:00"}


def test_golden_copies_do_not_multiply(spark):
    pred = spark.createDataFrame([("t1", 1, "d", "x", 5, "A", 0.9), ("t2", 1, "d", "x", 5, "B", 0.9), ("t3", 1, "d", "y", 5, "A", 0.9)],
                                 "tx_id string, customer_id int, tx_date string, description string, cents int, code string, confidence double")
    gold = spark.createDataFrame([(1, "d", "x", 5, "A"), (1, "d", "x", 5, "A"), (1, "d", "y", 5, "A"), (1, "d", "y", 5, "B")],
                                 "customer_id int, tx_date string, description string, cents int, code string")
    assert evaluate.against_golden(pred, gold).count() == 2
    assert [r.description for r in evaluate.golden_conflicts(gold).collect()] == ["y"]


def test_index_parts_are_put_together(spark, tmp_path):
    names = [f"r1/AffordabilityReports/x/{i:03d}.json" for i in range(25)] + ["r2/StatementCapture/retrieve-transactions/y/1.json"]
    rows = spark.createDataFrame([(n, 1, None) for n in names], "relative_path string, size_bytes long, modified_at timestamp")
    rows.createOrReplaceTempView("_files")
    index = files.run_index(rows, spark.createDataFrame([], "run_id string, persona string"), per_record=10)
    index.withColumn("run_created_at", F.col("run_created_at").cast("string")).write.json(str(tmp_path / "index"))
    back = {r.run_id: r for r in api_json.read_run_index(spark, str(tmp_path / "index")).collect()}
    assert sorted(sum((r.other_files + r.affordability_files + r.tx_files for r in back.values()), [])) == sorted(names)
    assert all(r.parts == 1 for r in back.values()) and sum(len(p) for r in back.values() for p in r.paths.values()) == 26


def test_dataset_job_rejects_and_checks(spark):
    api = spark.createDataFrame([("r", "p", 0, "1", "-2.00", "debit", "KFC"), ("r", "p", 1, "2", "xx", "sideways", "KFC")],
                                "run_id string, path string, pos long, tx_id string, amount string, direction string, description string").withColumns(
        {c: F.lit("2024-01-01") for c in ("transaction_date", "post_date")})
    records = spark.createDataFrame([("r", 0, "rp", 0, "1", "KFC", "-2.00", "2024-01-01", "ZZZ-999")],
                                    "run_id string, report_seq int, report_path string, pos long, tx_id string, description string, amount string, date string, code string")
    groups = spark.createDataFrame([("r", "rp", "ZZZ-999", "-2.00")], "run_id string, report_path string, code string, total string")
    runs = spark.createDataFrame([("r", "anna", True), ("s", None, False)], "run_id string, persona string, has_affordability_report boolean")
    taxonomy = spark.createDataFrame([("EXP-039", "Uncategorised debits"), ("UNKNOWN", "?")], "code string, name string")
    out = jobs.labelled_dataset(api, records, groups, runs, taxonomy)
    assert [r.reason for r in out["rejected"].collect()] == ["bad amount"]
    assert {r.code for r in out["unknown_codes"].collect()} == {"ZZZ-999"} and out["dataset"].count() == 1
    assert {(r.kind, r.fallback) for r in out["default_codes"].collect()} == {("expense", False), ("income", True)}


def test_a_report_without_rows_is_not_missing(spark):
    done = spark.createDataFrame([("r", "fallback_uncategorised"), ("q", "fallback_uncategorised")], "run_id string, label_source string")
    records = spark.createDataFrame([], "run_id string, report_seq int, report_path string, pos long, tx_id string, description string, amount string, date string, code string")
    got = labels.coverage(done, records, spark.createDataFrame([("r",)], "run_id string"))
    assert {r.run_id: r.missing_report for r in got.collect()} == {"r": 0, "q": 1, "ALL": 1}
