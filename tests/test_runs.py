"""From a folder of raw files to the labelled dataset."""

import json

from ledgerloom import tables
from ledgerloom.plans import jobs
from ledgerloom.sources import api_json, runs


def put(root, path, doc):
    at = root / path
    at.parent.mkdir(parents=True, exist_ok=True)
    at.write_text(doc if isinstance(doc, str) else json.dumps(doc))


def tx(i, amount="-5.00", text="SHOP", day="2024-07-01", direction="debit"):
    return {"id": i, "amount": amount, "direction": direction, "description": text, "transactionDate": day}


def report(*groups):
    return {"data": {"groups": [{"id": code, "analysis": {"amount": {"total": total}}, "transactions": [dict(i) for i in items]} for code, total, items in groups]}}


def test_folder_to_dataset(spark, tmp_path):
    root = tmp_path / "raw"
    cap = "StatementCapture/retrieve-transactions"
    put(root, f"a/run1/{cap}_20240701_000000.json", {"data": [tx("1"), tx("2", "-7.10", "BOOKS"), tx("3", "x"), tx("", "1.00")]})
    put(root, f"a/run1/{cap}_20240702_000000.json", [tx("1", "-9.99", "copy"), tx("4", "12.00", "REFUND", direction="credit")])
    put(root, f"a/run1/{cap}_20240703_000000.json", '{"data": [')
    # The later report in path order speaks last: it clears, and the third sets again.
    put(root, "a/run1/AffordabilityReports/r1.json", report(("EXP-001", "-5.00", [{"id": "1"}])))
    put(root, "a/run1/AffordabilityReports/r2.json", report(("EXP-016", "-5.00", [{"id": "1"}]), ("EXP-020", "n/a", [{"description": "books", "amount": "-7.1", "date": "2024-07-01T09"}])))
    put(root, "a/run1/AffordabilityReports/r3.json", report(("EXP-021", "-5.00", [{"id": "1"}])))
    put(root, "a/run1/StatementCapture/verify-credentials_1.json", {"profile": {"fullName": "Ann"}})
    put(root, f"b/run2/{cap}_20240701_000000.json", {"transactions": [tx("1", text="TRANSFER TO X")]})
    put(root, "b/run2/Misc/other.json", {"data": [tx("99")]})
    asked = spark.createDataFrame([("income", "INC-007")], "kind string, code string")
    out = jobs.dataset_from_folder(spark, str(root), str(tmp_path / "index"), tables.taxonomy(spark), asked)
    got = {(r.run_id, r.tx_id): (r.label_group_code, r.label_source, r.report_path.split("/")[-1]) for r in out["dataset"].collect()}
    assert got == {("a/run1", "1"): ("EXP-021", "report_id", "r3.json"), ("a/run1", "2"): ("EXP-020", "report_key", "r2.json"),
                   ("a/run1", "4"): ("INC-007", "fallback_uncategorised", ""), ("b/run2", "1"): ("EXP-013", "rule_transfer", "")}
    assert sorted(r.tx_id for r in out["rejected"].collect()) == ["", "3"]
    assert [r.relative_path for r in out["rejected_documents"].collect()] == [f"a/run1/{cap}_20240703_000000.json"] and out["missing_documents"].count() == 0
    assert {r.run_id: r.total_transactions for r in out["coverage"].collect()} == {"a/run1": 3, "b/run2": 1, "ALL": 4}
    assert {(r.code, float(r.delta)) for r in out["reconciliation"].collect()} == {("EXP-001", 5.0), ("EXP-016", 5.0), ("EXP-021", 0.0)}
    assert {r.run_id: (r.persona, r.split) for r in out["splits"].collect()} == {"a/run1": ("Ann", "train"), "b/run2": (None, "val")}


def test_listed_files_that_are_not_there(spark, tmp_path):
    put(tmp_path / "raw", "x/1.json", [tx("1")])
    put(tmp_path / "raw", "x/2.json", [tx("2")])
    (tmp_path / "index.json").write_text(json.dumps({"run_id": "r", "tx_files": ["x/1.json", "x/0.json", "x/1.json"], "affordability_files": ["x/9.json"]})
                                         + "\n" + json.dumps({"run_id": "", "tx_files": ["x/2.json"]}) + "\n")
    index = api_json.read_run_index(spark, str(tmp_path / "index.json"))
    out = jobs.dataset_from_files(spark, str(tmp_path / "raw"), index)
    assert [(r.run_id, r.tx_id) for r in out["dataset"].collect()] == [("r", "1")]
    assert sorted((r.kind, r.seq, r.relative_path) for r in out["missing_documents"].collect()) == [(runs.REPORTS, 0, "x/9.json"), (runs.TRANSACTIONS, 0, "x/0.json")]
    assert [(r.seq, r.relative_path) for r in runs.run_documents(spark, str(tmp_path / "raw"), index).collect()] == [(1, "x/1.json")]
