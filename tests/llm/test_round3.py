"""Placement as a function of the rows; likeness that bears words put in."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import multiset_hash as mh
from ledgerloom.llm import sharding


def placed(docs, **bounds):
    out = sharding.shuffle_into_shards(docs, shards=4, **bounds)
    return sorted(out.select("record.doc_id", "record.text", "record.more", "shard", "slot").collect(), key=str)


@pytest.mark.parametrize("bounds", [{"bucket_rows": 40}, {"bucket_rows": 2048}])
def test_placement_follows_from_the_rows(spark, bounds):
    # A third of the rows repeat one id and text, some of them with another third column.
    rows = [(i, f"text {i}", 0) for i in range(400)] + [(7, "hot", i % 3) for i in range(200)] + [(None, None, None)] * 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, more int")
    want = placed(docs.repartition(4), **bounds)
    assert sorted((r.doc_id, r.text, r.more) for r in want if r.text) == sorted(r for r in rows if r[1])
    assert sorted((r.slot, r.shard) for r in want) == [(i // 4, i % 4) for i in range(len(rows))]
    random.Random(1).shuffle(rows)
    again = spark.createDataFrame(rows, "doc_id bigint, text string, more int")
    assert placed(again.repartition(9), **bounds) == want
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert placed(again.repartition(3), **bounds) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_placement_of_rows_with_maps(spark):
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"), F.create_map(F.lit("k"), F.col("id")).alias("m"))
    same_id = docs.withColumn("doc_id", F.lit(1).cast("bigint"))
    for d in (docs, same_id):
        got = sharding.shuffle_into_shards(d, shards=4, bucket_rows=20).select("record.m").collect()
        assert sorted(r.m["k"] for r in got) == list(range(60))


def cosine(x, y):
    """Of the counts of neighbouring word pairs and last words of lines."""
    def counts(text):
        out = collections.Counter()
        for line in text.split("\n"):
            w = line.split()
            out.update(zip(w, [*w[1:], None]))
        return out

    a, b = counts(x), counts(y)
    norm = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    return sum(a[k] * b[k] for k in a) / norm if norm else 0.0


def test_likeness_estimates_the_cosine_of_pieces(spark):
    line = " ".join(f"w{i}" for i in range(400))
    other = " ".join(f"v{i}" for i in range(400))
    half = " ".join(f"w{i}" for i in range(200)) + " " + " ".join(f"v{i}" for i in range(200))
    pairs = [(line, "new " + line), (line, line.replace("w200 ", "")), (line, line.replace("w9 ", "w9 new ")), (line, other), (line, half),
             (line + "\n" + other, other + "\n" + line), (line, line), ("", ""), ("", line), ("a", "a b"), (" ", "\n"), ("a  b", "a\tb")]
    rows = [(i, k, t) for i, p in enumerate(pairs) for k, t in enumerate(p)]
    f = mh.fingerprints(spark.createDataFrame(rows, "i int, k int, text string"), ["i", "k"])
    side = lambda k, n: f.filter(f"k = {k}").select("i", F.struct("pieces", "wide", "narrow").alias(n))
    got = {r.i: r.like for r in side(0, "x").join(side(1, "y"), "i").select("i", mh.likeness("x", "y").alias("like")).collect()}
    assert min(got[0], got[1], got[2]) > 0.95
    assert got[5] == got[6] == got[7] == 1.0 and got[8] == 0.0
    for i in range(6):
        assert abs(got[i] - cosine(*pairs[i])) < 0.3, i
    # Other white space is another text, though it has the same pieces.
    assert got[11] == pytest.approx(1.0)
