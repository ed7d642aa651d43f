"""Expressions that must be worked out once per row, and tasks that must not take all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import cascade, learning, stage
from ledgerloom.operators.stage import computed

TX = ("tx_id string, customer_id long, seq long, description string, cents long, provider_category string, third_party string")
ROWS = [("a", 1, 1, "WOOLWORTHS 1234 ASHWOOD", -500, "Groceries", None), ("b", 1, 2, "ODD SHOP 77", -700, None, None),
        ("c", 2, 3, "ODD SHOP 78", -100, None, None), ("d", 2, 4, None, 300, None, None)]


@pytest.fixture
def shared(monkeypatch, tmp_path):
    monkeypatch.setattr(stage, "shared_folder", lambda spark: f"file://{tmp_path}")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def filters(df):
    return [line for line in plan(df).split("\n") if line.lstrip(" :+-").startswith("Filter")]


def patterns(spark):
    return spark.createDataFrame([("odd shop", "EXP-031", 0.9, "x", "2025", 0, None, ["ODD SHOP 1"])], learning.PATTERN_SCHEMA)


def test_computed_columns_stay_below_a_filter(spark):
    df = computed(spark.range(5), {"a": F.regexp_replace(F.col("id").cast("string"), "1", "x"), "b": F.col("id") * 2}).filter("a <> 'x'")
    assert not any("regexp" in f for f in filters(df))
    assert sorted((r.id, r.a, r.b) for r in df.collect()) == [(0, "0", 0), (2, "2", 4), (3, "3", 6), (4, "4", 8)]


@pytest.mark.parametrize("how", [cascade.categorize, cascade.categorize_tiers, cascade.categorize_hybrid])
def test_filters_on_the_result_do_not_repeat_the_matching(spark, how):
    tx = spark.createDataFrame(ROWS, TX)
    wrong = how(tx).filter((F.col("branch") == "uncategorised") & (F.col("code") != "EXP-016"))
    assert not any("regexp" in f or "contains" in f for f in filters(wrong))
    assert {r.tx_id for r in wrong.collect()} >= {"b", "c"}


def test_rows_made_of_the_users_are_work_for_every_core(spark):
    from ledgerloom.queries import base

    many = base.users(spark, "/root/testdata/sf0.001")
    assert many.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert many.count() == many.distinct().count()


def test_forms_of_lookups_and_answers_are_worked_out_once(spark, shared):
    tx = spark.createDataFrame(ROWS, TX)
    found = learning.lookup_patterns(tx, patterns(spark))
    assert "regexp_replace" not in plan(found)
    assert sorted((r.tx_id, r.learned_code) for r in found.collect() if r.learned_code) == [("b", "EXP-031"), ("c", "EXP-031")]
    answers = spark.createDataFrame([("odd shop", '{"category": "EXP-054", "confidence": 0.9}')], "form string, answer string")
    told = learning.attach_answers(tx, answers)
    assert "regexp_extract" not in plan(told)
    assert sorted((r.tx_id, r.answer_code) for r in told.collect() if r.answer_code) == [("b", "EXP-054"), ("c", "EXP-054")]


def test_a_batch_is_read_once_for_its_patterns(spark, shared):
    batch = spark.createDataFrame([(2, "ODD SHOP 78", "EXP-1", 0.9, "s"), (1, "ODD SHOP 77", "EXP-2", 0.95, "t"), (3, "ODD SHOP 78", "EXP-3", 0.99, "s"),
                                   (4, "ODD SHOP 79", "EXP-3", 0.2, "s"), (5, None, "EXP-3", 0.99, "s")],
                                  "seq long, description string, category string, confidence double, source string")
    out = learning.batch_patterns(batch, learned_at="x")
    assert "regexp_replace" not in plan(out)
    assert [(r.pattern, r.category, r.confidence, r.source, r.examples) for r in out.collect()] == [
        ("odd shop", "EXP-2", 0.99, "t", ["ODD SHOP 77", "ODD SHOP 78"])]


def test_the_queue_of_open_merchants_is_made_once(spark, shared):
    rows = cascade.categorize(spark.createDataFrame(ROWS, TX))
    queue = learning.review_queue(rows, patterns(spark))
    assert "regexp_replace" not in plan(queue)
    assert [(r.form, r.n, r.cents, r.example, [s.pattern for s in r.similar]) for r in queue.collect()] == [
        ("odd shop", 2, -800, "ODD SHOP 77", ["odd shop"])]


def test_statement_files_are_few(spark):
    """A file for some dozen rows is a file for every user and more; their number made the folder slow."""
    from ledgerloom.queries import ingest

    docs = ingest.json_documents(spark, "/root/testdata/sf0.01", per_document=ingest.STATEMENT)
    assert ingest.STATEMENT >= 100 * ingest.DOC
    assert docs.count() * 20 < ingest.json_documents(spark, "/root/testdata/sf0.01").count()


def test_short_and_long_texts_match_as_all_pairs_do(spark):
    """Texts of 1 to 9 words at the same place, in every mix of needs; and single words and pairs are made only where they decide."""
    import datetime as dt
    import random

    from ledgerloom.operators import matching

    rng, vocabulary = random.Random(5), [f"w{i}" for i in range(12)]
    text = lambda: " ".join(rng.sample(vocabulary, rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 9])))
    day = dt.date(2024, 7, 1)
    left = [(f"t{i}", rng.choice([1, 2, None]), day + dt.timedelta(rng.randrange(6)), rng.randrange(4), text() or None) for i in range(300)]
    right = [(rng.choice([1, 2, None]), rng.randrange(60), dt.datetime(2024, 7, 1 + rng.randrange(6), rng.choice([0, 5])), rng.randrange(4),
              rng.choice(["A", "B"]), text()) for i in range(120)]
    found = matching.fuzzy_match(
        spark.createDataFrame(left, "tx_id string, customer_id long, tx_date date, cents long, description string"),
        spark.createDataFrame(right, "customer_id long, seq long, ts timestamp_ntz, cents long, code string, description string"))
    got = {r.tx_id: (r.match_seq, r.match_code, r.match_description) for r in found.collect()}

    def first(c, d, cents, a):
        hits = []
        for rc, seq, ts, r_cents, code, b in right:
            days = (dt.datetime.combine(d, dt.time()) - ts) // dt.timedelta(1)
            x, y = set((a or "").split()), set(b.split())
            if c is not None and c == rc and abs(cents - r_cents) <= 1 and abs(days) <= 2 and x and y and len(x & y) * 5 >= 2 * min(len(x), len(y)):
                hits.append((seq, code, b))
        return min(hits, default=(None, None, None))

    assert got == {i: first(c, d, cents, a) for i, c, d, cents, a in left}
    row = spark.createDataFrame([(["a", "b", "c", "d", "e", "f"], 3, False, True), (["a", "b"], 1, False, False), (["a", "b", "c"], 2, True, False)],
                                "words array<string>, need int, l1 boolean, l2 boolean")
    made = [sorted({e.k for e in r.e}) for r in row.select(matching._keys("l").alias("e")).collect()]
    assert made == [[2], [1], [1, 2]]


def test_documents_are_parsed_once(spark):
    """A generator's expression and the filter made of it would parse a text several times."""
    from ledgerloom.sources import api_json

    docs = spark.createDataFrame([("r", "p", 0, '{"data": [{"id": "a"}]}'), ("r", "q", 1, '{"data": [], "transactions": [{"id": "b"}]}'),
                                  ("r", "s", 2, '[{"id": "c"}]'), ("r", "t", 3, '{"data": ['), ("r", "u", 4, None)],
                                 "run_id string, path string, seq int, value string")
    rows = api_json.transaction_items(docs)
    assert plan(rows).count("from_json(") == 2  # a bare list, or an object
    assert sorted((r.path, r.pos, r.id) for r in rows.collect()) == [("p", 0, "a"), ("q", 0, "b"), ("s", 0, "c")]


def test_dataset_from_files_parses_documents_once(spark, shared, tmp_path, monkeypatch):
    import json

    from ledgerloom.operators import labels
    from ledgerloom.plans import jobs

    item = {"id": "1", "amount": "-5.00", "direction": "debit", "description": "Shop", "transactionDate": "2024-07-01"}
    group = {"id": "EXP-016", "transactions": [{"id": "1", "description": "Shop", "amount": "-5.00", "date": "2024-07-01"}]}
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "t.json").write_text(json.dumps({"data": [item]}))
    (tmp_path / "raw" / "r.json").write_text(json.dumps({"data": {"groups": [group]}}))
    index = spark.createDataFrame([("a", ["t.json"], ["r.json"], "Ann", True)], "run_id string, tx_files array<string>, affordability_files array<string>, "
                                  "persona string, has_affordability_report boolean")
    given, label = [], labels.label_transactions
    monkeypatch.setattr(labels, "label_transactions", lambda api, records, *more: given.extend((api, records)) or label(api, records, *more))
    out = jobs.dataset_from_files(spark, str(tmp_path / "raw"), index)["dataset"]
    assert [(r.tx_id, r.label_group_code, r.label_source) for r in out.collect()] == [("1", "EXP-016", "report_id")]
    assert len(given) == 2 and not any("from_json" in plan(df) for df in given)
    joined = label(*given)
    assert "min_by(struct(" not in plan(joined) and joined.collect()
    assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert not any("regexp" in f for f in filters(labels.with_key(given[1], F.col("date")).filter("k_day is not null")))
