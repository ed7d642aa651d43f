"""Metrics from kept partial sums: the same as from the transactions, whatever the batches and the window end."""

import datetime as dt
import random

import pytest

from ledgerloom.config import MetricParams
from ledgerloom.operators import metrics, stage
from ledgerloom.sources import tables
from ledgerloom.streaming import statements as streams

SCHEMA = "tx_id string, customer_id long, tx_date date, description string, cents long, code string"
CODES = ["INC-009", "INC-009", "INC-007", "INC-012", "EXP-033", "EXP-056", "EXP-057", "EXP-016", "EXP-009", "EXP-001", None]


def some(n=900, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        code = rnd.choice(CODES)
        sign = 1 if (code or "").startswith("INC") else -1
        cents = rnd.choice([0, None, sign * rnd.randint(1, 90_000), sign * rnd.randint(1, 90_000), -sign * 5])
        day = None if rnd.random() < 0.02 else dt.date(2024, 1, 1) + dt.timedelta(7 * rnd.randint(0, 50))
        out.append((f"t{i}", rnd.choice([1, 1, 1, 1, 2, 3, 4]), day, rnd.choice([" Acme", "acme ", "Lender", "other job", None]), cents, code))
    return out + [("u", 9, None, "x", -5, "EXP-016")]


def found(df):
    return {r.customer_id: r for r in df.drop("calculation_date").collect()}


def direct(spark, rows, params=MetricParams()):
    return found(metrics.customer_metrics(spark.createDataFrame(rows, SCHEMA), params=params))


@pytest.mark.parametrize("as_of, days", [(None, 180), ("2024-09-17", 180), (dt.date(2024, 6, 30), 30), ("2023-01-01", 180)])
def test_any_end_from_added_batches(spark, tmp_path, as_of, days):
    rows, params = some(), MetricParams(period_days=days)
    for b in range(3):
        part = spark.createDataFrame(rows[b::3], SCHEMA)
        assert tables.write_partials(metrics.partials(part, params), str(tmp_path), f"b{b}")
    parts = tables.read_partials(spark, str(tmp_path))
    stop = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    known = [r for r in rows if stop is None or r[2] is None or r[2] <= stop]
    assert found(metrics.metrics_at(parts, as_of, params=params)) == direct(spark, known, params)


def test_a_second_end_reads_no_transactions(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame(some(50), SCHEMA)
    rows.write.parquet(str(tmp_path / "statements"))
    monkeypatch.setattr(stage, "shared_folder", lambda _: str(tmp_path / "cp"))
    out = metrics.customer_metrics(spark.read.parquet(str(tmp_path / "statements")))
    # What follows the partial sums is planned from their table alone.
    files = [f for f in out.inputFiles()]
    assert files and not [f for f in files if "/statements/" in f]
    assert found(out) == direct(spark, some(50))


def test_a_batch_counts_once(spark, tmp_path, monkeypatch):
    folder, rows = str(tmp_path), some(60)
    parts = metrics.partials(spark.createDataFrame(rows, SCHEMA))
    assert tables.read_partials(spark, folder).count() == 0
    real = tables._hadoop

    def dies(s, path):
        system, at = real(s, path)

        class Lost:
            exists = system.exists

            def create(self, *_):
                raise RuntimeError("lost")

        return Lost(), at

    monkeypatch.setattr(tables, "_hadoop", dies)
    with pytest.raises(RuntimeError):
        tables.write_partials(parts, folder, "one")
    monkeypatch.undo()
    assert tables.read_partials(spark, folder).count() == 0
    assert tables.write_partials(parts, folder, "one") and not tables.write_partials(parts, folder, "one")
    (tmp_path / "done" / "two.txt").write_text("data/12")
    assert found(metrics.metrics_at(tables.read_partials(spark, folder))) == direct(spark, rows)
    assert tables.write_partials(parts.limit(0), folder, "two") and not tables.write_partials(parts, folder, "two")
    assert found(metrics.metrics_at(tables.read_partials(spark, folder))) == direct(spark, rows)
    with pytest.raises(ValueError, match="batch name"):
        tables.write_partials(parts, folder, "../x")


def test_partials_of_a_stream(spark, tmp_path):
    source, folder, cp = (str(tmp_path / n) for n in ("in", "sums", "cp"))
    rows = some(90)
    for i in range(3):
        spark.createDataFrame(rows[i::3], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    w = streams.partials_stream(streams.statement_stream(spark, source, SCHEMA.replace("long", "bigint"), 1), folder, cp).start()
    w.processAllAvailable()
    w.stop()
    assert len(list((tmp_path / "sums" / "done").glob("stream-*.txt"))) == 3
    assert found(metrics.metrics_at(tables.read_partials(spark, folder))) == direct(spark, rows)


def test_nothing(spark):
    empty = metrics.partials(spark.createDataFrame([], SCHEMA))
    assert metrics.metrics_at(metrics.merge(empty, empty)).count() == 0
