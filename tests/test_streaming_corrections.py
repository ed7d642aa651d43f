"""Daily totals of a stream whose files come in any order."""

import datetime as dt
import itertools
import os
import random

import pytest

from ledgerloom.operators import series
from ledgerloom.streaming import statements as streams

DAYS = [f"2024-{m:02}-{d:02}" for m in (1, 2) for d in (1, 9, 20)]


@pytest.fixture(autouse=True)
def rocksdb(spark):
    old = spark.conf.get(streams.ROCKSDB[0])
    spark.conf.set(*streams.ROCKSDB)
    yield
    spark.conf.set(streams.ROCKSDB[0], old)


def emitted(spark, root, name, files, delay, horizon):
    """What the stream emits when each list of rows (day, cents) is one file and one batch."""
    os.makedirs(root)
    stream = streams.corrected_totals_stream(streams.statement_stream(spark, root, max_files=1), delay, horizon)
    for i, rows in enumerate(files):
        data = [(f"{i}-{j}", 1, d and dt.date.fromisoformat(d), "x", c, None, None) for j, (d, c) in enumerate(rows)]
        spark.createDataFrame(data, streams.TX_SCHEMA).coalesce(1).write.mode("append").parquet(root)
        if not i:
            q = stream.writeStream.format("memory").queryName(name).outputMode("append").start()
        q.processAllAvailable()
    q.stop()
    return spark.sql(f"select * from {name}")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_gives_the_batch_result(spark, tmp_path, seed):
    rnd = random.Random(seed)
    files = [[(rnd.choice(DAYS), 1 << (3 * i + j)) for j in range(3)] for i in range(6)]
    rnd.shuffle(files)
    out = emitted(spark, str(tmp_path / "in"), f"any{seed}", [*files, [("2024-06-01", 0), (None, 5)]], 2, 90)
    rows = [(1, dt.date.fromisoformat(d), c) for d, c in itertools.chain(*files)]
    batch = series.monthly_totals(spark.createDataFrame(rows, "customer_id long, tx_date date, cents long"))
    want = {r.month: r.total for r in batch.collect()}
    got = {r.month: r.total for r in streams.monthly_totals(streams.newest_totals(out)).collect()}
    assert got == want and not [r for r in out.collect() if r.kind == "dropped"]


def test_corrections_and_dropped_rows(spark, tmp_path):
    files = [[("2024-01-05", 1), ("2024-01-05", 2)], [("2024-01-20", 4)], [("2024-01-05", 8)], [("2024-05-01", 16)], [("2024-01-05", 32), ("2024-01-05", 64), ("2024-04-29", 128)], [("2024-07-01", 0)]]
    out = [(r.tx_date.isoformat()[5:], r.kind, r.version, r.total, r.rows) for r in emitted(spark, str(tmp_path / "in"), "fixed", files, 3, 30).collect()]
    assert sorted(x for x in out if x[0] == "01-05") == [("01-05", "correction", 2, 11, 3), ("01-05", "dropped", None, 96, 2), ("01-05", "total", 1, 3, 2)]
    assert sorted(x for x in out if x[0] != "01-05") == [("01-20", "total", 1, 4, 1), ("04-29", "total", 1, 128, 1), ("05-01", "total", 1, 16, 1)]
