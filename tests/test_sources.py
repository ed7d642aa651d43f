import hashlib
import json

from pyspark.sql import functions as F

from ledgerloom.operators import cascade
from ledgerloom.plans import jobs
from ledgerloom.sources import api_json, files, sinks, statements, tables
from ledgerloom.streaming import statements as streams


def test_statement_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('date,description,amount,Balance,Category,pending\n2024-07-01,"SHOP, A",-1.5,,Groceries,Pending\n2024-07-02,B,x,2,,\n')
    (tmp_path / "b.json").write_text(json.dumps({"transactions": [{"date": "2024-07-03", "description": "C", "amount": 3, "balance": "1", "Category": "Rent", "pending": True}]}))
    (tmp_path / "c.json").write_text(json.dumps(indent=1, obj=[{"date": "2024-07-04", "description": "D", "amount": None, "category": "", "Category": "Tax", "pending": "Pending"}]))
    rows = statements.read_statements(spark, str(tmp_path)).orderBy("description").collect()
    got = [(r.description, float(r.amount), float(r.balance), r.category, r.pending, r.account_type) for r in rows]
    assert got == [("B", 0.0, 2.0, "", False, ""), ("C", 3.0, 1.0, "Rent", True, ""), ("D", 0.0, 0.0, "Tax", True, ""),
                   ("SHOP, A", -1.5, 0.0, "Groceries", True, "")]


def test_categorised_folder(spark, tmp_path):
    (tmp_path / "anna_categorized.csv").write_text("date,description,amount,code\n05/07/2024,x,-1.00,EXP-001\nbad,y,2,INC-007\n")
    (tmp_path / "ben_categorized.csv").write_text("date,description,amount,code\n05/07/2024,z,oops,EXP-001\n")
    (tmp_path / "other.csv").write_text("a\n1\n")
    good, bad = statements.read_categorised(spark, str(tmp_path))
    assert sorted((r.customer_id, str(r.tx_date), r.cents) for r in good.collect()) == [
        ("anna_categorized", "2024-07-05", -100), ("anna_categorized", "None", 200)]
    assert [r.customer_id for r in bad.collect()] == ["ben_categorized"]


def test_taxonomy_rules_and_snapshots(spark, tmp_path):
    (tmp_path / "t.yaml").write_text('groups:\n  - code: "EXP-001"\n    name: "Cash"\n  - code: "INC-001"\n    title: "Pay"\nuncategorised:\n  expense: "EXP-001"\n')
    codes, over = tables.read_taxonomy(spark, str(tmp_path / "t.yaml"))
    assert sorted((r.code, r.name) for r in codes.collect()) == [("EXP-001", "Cash"), ("INC-001", "Pay")] and over == {"expense": "EXP-001"}
    (tmp_path / "r.csv").write_text("seq,rule_seq,keyword,code,confidence,reason\n0,0,foo,EXP-001,0.9,r\n")
    from ledgerloom.operators.rules import RuleBook

    book = RuleBook.from_dataframe(tables.read_rules(spark, str(tmp_path / "r.csv")))
    assert book.rows[0]["keyword"] == "foo"
    root = str(tmp_path / "dict")
    empty = tables.read_patterns(spark, root)
    assert empty.count() == 0
    assert tables.write_patterns(empty, root) == 1 and tables.write_patterns(empty, root) == 2
    assert tables.snapshot_metadata(spark, root).first().total_patterns == 0


def test_manifest(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.bin").write_bytes(b"abc" * 10)
    r = files.manifest(spark, str(tmp_path), True).first()
    assert (r.relative_path, r.size_bytes, r.sha256) == ("d/x.bin", 30, hashlib.sha256(b"abc" * 10).hexdigest())


def test_report_document(spark):
    doc = {"data": {"groups": [{"id": "EXP-001", "analysis": {"amount": {"total": "-3.00"}}, "transactions": [{"id": "a"}],
                               "subgroup": [{"transactions": [{"description": "x", "amount": -2, "date": "2024-01-01"}]}, {}]},
                              {"id": None}, {"id": "EXP-002"}]}}
    docs = spark.createDataFrame([("r", "p", 0, json.dumps(doc)), ("r", "q", 1, "broken")], "run_id string, report_path string, report_seq int, value string")
    got = [(r.code, r.tx_id, r.amount) for r in api_json.report_records(docs).orderBy("pos").collect()]
    assert got == [("EXP-001", "a", None), ("EXP-001", None, "-2")]
    assert [r.total for r in api_json.report_totals_raw(docs).collect()] == ["-3.00", None]


def test_run_index_in_parts(spark, tmp_path):
    paths = [(f"o/r{i % 2}/StatementCapture/retrieve-transactions_{i}.json", i) for i in range(50)] + [("o/r0", 1), ("o/r0/Misc/a", 1)]
    df = spark.createDataFrame(paths, "relative_path string, size_bytes long").withColumn("modified_at", F.lit("2024-01-01").cast("timestamp"))
    index = files.run_index(df, per_record=10).collect()
    assert len(index) > 4 and max(len(r.tx_files) for r in index) < 25
    assert sum(len(r.tx_files) for r in index) == 50 and sum(len(r.other_files) for r in index) == 1


def test_written_and_stream(spark, tmp_path):
    rows = spark.createDataFrame([("1", 1, None, "WOOLWORTHS", -5, "Groceries", None), ("2", 1, None, "ACME WAGES", 5, None, None)],
                                 streams.TX_SCHEMA)
    sinks.write_parquet(rows, str(tmp_path / "in"))
    stream = streams.categorise_stream(streams.statement_stream(spark, str(tmp_path / "in")))
    q = stream.select("tx_id", "code").writeStream.format("memory").queryName("scored").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    batch = {r.tx_id: r.code for r in cascade.categorize(rows).collect()}
    assert {r.tx_id: r.code for r in spark.sql("select * from scored").collect()} == batch == {"1": "EXP-016", "2": "INC-009"}
    out = jobs.written(rows, str(tmp_path / "shared"))
    assert out.count() == 2 and "Scan parquet" in out._jdf.queryExecution().toString()
    reviewed = spark.createDataFrame([(1, "KFC SYDNEY", "EXP-008", 0.95, "review")], "seq long, description string, category string, confidence double, source string")
    sinks.write_parquet(reviewed, str(tmp_path / "rev"))
    s = streams.statement_stream(spark, str(tmp_path / "rev"), reviewed.schema.simpleString()[7:-1].replace(":", " "))
    w = streams.learn_stream(s, str(tmp_path / "dict"), str(tmp_path / "cp")).start()
    w.processAllAvailable()
    w.stop()
    assert [r.pattern for r in tables.read_patterns(spark, str(tmp_path / "dict")).collect()] == ["kfc"]


def test_monthly_totals_of_a_stream_with_late_rows(spark, tmp_path):
    import datetime as dt

    def rows(*items):
        return spark.createDataFrame([(str(i), 1, dt.date.fromisoformat(d), "x", c, None, None) for i, (d, c) in enumerate(items)], streams.TX_SCHEMA)

    root = str(tmp_path / "in")
    rows(("2024-01-05", 1), ("2024-01-05", 2), ("2024-02-01", 4)).coalesce(1).write.parquet(root)
    daily = streams.daily_totals_stream(streams.statement_stream(spark, root, max_files=1), "10 days")
    q = daily.writeStream.format("memory").queryName("days").outputMode("append").start()
    q.processAllAvailable()
    # In time: after the last row less ten days. Too late: January. A row of May closes all before.
    rows(("2024-01-25", 8), ("2024-01-05", 16), ("2024-05-01", 32)).coalesce(1).write.mode("append").parquet(root)
    q.processAllAvailable()
    rows(("2024-02-02", 64)).write.mode("append").parquet(root)
    q.processAllAvailable()
    q.stop()
    got = {r.month: r.total for r in streams.monthly_totals(spark.sql("select * from days")).collect()}
    assert got == {"2024-01": 11, "2024-02": 4}
