"""Fuzzy matches of long texts: equal to comparing all pairs, with few pairs compared."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import matching

LEFT = "customer_id long, tx_id string, tx_date date, cents long, description string"
RIGHT = "customer_id long, seq long, ts timestamp_ntz, cents long, description string, code string"
DAY = dt.date(2024, 7, 3)


def frames(spark, left, right):
    """Texts of one customer, amount and day."""
    ldf = spark.createDataFrame([(1, f"t{i}", DAY, 500, d) for i, d in enumerate(left)], LEFT)
    rdf = spark.createDataFrame([(1, i, dt.datetime(2024, 7, 3, 10), 500, d, f"c{i}") for i, d in enumerate(right)], RIGHT)
    return ldf, rdf


def brute(left, right):
    out = {}
    for i, a in enumerate(left):
        a = set(a.split())
        out[f"t{i}"] = next((j for j, b in enumerate(map(lambda d: set(d.split()), right)) if 5 * len(a & b) >= 2 * min(len(a), len(b))), None)
    return out


@pytest.mark.parametrize("pool", [8, 25, 120])
def test_long_texts_against_all_pairs(spark, pool):
    rnd = random.Random(pool)
    texts = [" ".join({f"w{rnd.randrange(pool)}" for _ in range(rnd.randrange(1, 16))} | {f"u{k}x{i}" for i in range(rnd.randrange(0, 9))}) for k in range(160)]
    left, right = texts[:80], texts[80:]
    got = {r.tx_id: r.match_seq for r in matching.fuzzy_match(*frames(spark, left, right)).collect()}
    assert got == brute(left, right)


def sides(spark, texts):
    """The two sides as ``_long_matches`` gets them."""
    rows = spark.createDataFrame([(1, 500, DAY, DAY, sorted(set(t.split())), s, i) for s, side in enumerate(texts) for i, t in enumerate(side)],
                                 "customer_id long, cents long, day date, near_day date, words array<string>, side int, i int")
    rows = matching._need(rows, 2, 5)
    return rows.filter("side = 0").drop("side", "i"), rows.filter("side = 1").select("customer_id", "cents", "near_day", "words", "need", F.struct("i").alias("m"))


def joined(spark, texts):
    """Rows that the join on prefix words makes."""
    met = matching._long_matches(*sides(spark, texts))[1]
    met.collect()
    plan = met._jdf.queryExecution().executedPlan()
    total, todo = 0, [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if "Join" in name and "l_need" in node.verboseString(10_000):
            total += node.metrics().apply("numOutputRows").value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return total


@pytest.mark.parametrize("kind", ["template", "names"])
def test_pairs_grow_with_the_rows(spark, kind):
    """Everybody's words in every text, and words of their own; or words of a few texts."""
    def texts(m):
        rnd = random.Random(1)
        if kind == "template":
            return [[f"card payment to merchant number {s}a{i} {s}b{i} {s}c{i} {s}d{i}" for i in range(m)] for s in "lr"]
        return [["card payment " + " ".join(f"n{rnd.randrange(4 * m)}" for _ in range(7)) for _ in range(m)] for _ in "lr"]

    one, two = joined(spark, texts(1000)), joined(spark, texts(2000))
    assert two <= 3 * max(one, 100) and two < 20_000
