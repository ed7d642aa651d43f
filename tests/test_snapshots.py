"""Dictionary snapshots: commits by manifest, and batches that come again."""

import pytest
from pyspark.errors import StreamingQueryException

from ledgerloom.sources import sinks, tables
from ledgerloom.streaming import statements as streams

REVIEWED = "seq long, description string, category string, confidence double, source string"


def rows(spark, i, text, category, confidence=0.95):
    return spark.createDataFrame([(i, text, category, confidence, "review")], REVIEWED)


def state(spark, folder):
    return sorted((r.pattern, r.category, r.confidence, tuple(r.examples)) for r in tables.read_patterns(spark, folder).collect())


def test_a_replayed_batch_changes_nothing(spark, tmp_path, monkeypatch):
    source, folder, cp = (str(tmp_path / n) for n in ("in", "dict", "cp"))
    sinks.write_parquet(rows(spark, 1, "KFC SYDNEY", "EXP-008"), source)
    stream = streams.statement_stream(spark, source, REVIEWED.replace("long", "bigint"), 1)
    w = streams.learn_stream(stream, folder, cp).start()
    w.processAllAvailable()
    w.stop()
    first = state(spark, folder)
    rows(spark, 2, "ALDI STORES", "EXP-016").coalesce(1).write.mode("append").parquet(source)
    # The second batch is written, then the query dies before its checkpoint.
    real = streams.write_patterns

    def dies(*args):
        real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(streams, "write_patterns", dies)
    with pytest.raises(StreamingQueryException, match="lost"):
        w = streams.learn_stream(stream, folder, cp).start()
        w.processAllAvailable()
    monkeypatch.setattr(streams, "write_patterns", real)
    second, n = state(spark, folder), len(list((tmp_path / "dict" / "manifest").glob("*.json")))
    assert len(second) == len(first) + 1 and n == 2
    w = streams.learn_stream(stream, folder, cp).start()
    w.processAllAvailable()
    rows(spark, 3, "SHELL", "EXP-002").coalesce(1).write.mode("append").parquet(source)
    w.processAllAvailable()
    w.stop()
    assert len(list((tmp_path / "dict" / "manifest").glob("*.json"))) == 3
    assert set(second) < set(state(spark, folder)) and len(state(spark, folder)) == 3


def test_a_batch_that_dies_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "dict")
    one = streams.learning.upsert_patterns(tables.read_patterns(spark, folder), rows(spark, 1, "KFC", "EXP-008"))
    assert tables.write_patterns(one, folder, "s", 0) == 1
    monkeypatch.setattr(tables, "_hadoop", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        tables.write_patterns(one.filter("false"), folder, "s", 1)
    monkeypatch.undo()
    assert len(state(spark, folder)) == 1 and tables.committed(spark, folder, "s", 0) and not tables.committed(spark, folder, "s", 1)
    (tmp_path / "dict" / "manifest" / "0000000002.json").write_text('{"version": 2, "pa')
    assert len(state(spark, folder)) == 1
    # Another stream's commits keep what is known of this one.
    (tmp_path / "dict" / "manifest" / "0000000002.json").unlink()
    assert tables.write_patterns(one, folder, "t", 7) == 2
    assert tables.committed(spark, folder, "s", 0) and tables.committed(spark, folder, "t", 7) and not tables.committed(spark, folder, "t", 8)


def test_snapshots_of_the_older_form_are_read(spark, tmp_path):
    folder = str(tmp_path / "dict")
    one = streams.learning.upsert_patterns(tables.read_patterns(spark, folder), rows(spark, 1, "KFC", "EXP-008"))
    one.write.parquet(f"{folder}/version=0000000004")
    assert len(state(spark, folder)) == 1 and tables.write_patterns(one.filter("false"), folder) == 5 and state(spark, folder) == []
