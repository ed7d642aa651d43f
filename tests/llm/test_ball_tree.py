"""Ball-tree search against scores of all documents; the query is held to its SQL in test_queries.py."""

import collections
import math
import random
import re

import numpy as np
import pytest

from ledgerloom.llm import ball_tree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def truth(docs, queries, k=10):
    found = [(i, collections.Counter(terms(t))) for i, t in docs]
    n_docs, n_words = sum(bool(c) for _, c in found), sum(c.total() for _, c in found)
    df = collections.Counter(t for _, c in found for t in c)
    out = []
    for item, text in queries:
        scores = []
        for i, c in found:
            m = 10 + 90 * c.total() * n_docs // n_words if n_words else 10
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def got(spark, docs, queries, k=10):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in ball_tree.search(ball_tree.build(docs), queries, k).collect()), key=str)


@pytest.mark.parametrize(("tree", "leaf", "block"), [(4096, 128, 2048), (50, 4, 3), (7, 1, 1)])
def test_search_equals_scoring_all(spark, odd, odd_rows, empty, monkeypatch, tree, leaf, block):
    monkeypatch.setattr(ball_tree, "TREE_DOCS", tree)
    monkeypatch.setattr(ball_tree, "BLOCK_QUERIES", block)
    monkeypatch.setattr(ball_tree.plant, "__defaults__", (leaf,))
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(4000)]
    docs = [(r[0], r[1]) for r in odd_rows] + [(100 + i, " ".join(rng.sample(words, rng.randrange(1, 60)))) for i in range(300)]
    docs += [(500 + i, docs[40][1]) for i in range(25)]     # ties beyond the tenth place
    queries = [(1, "w1 w2 w3 W7"), (2, docs[40][1]), (3, None), (4, "nowhere"), (5, "ÉTÉ été a1 B3"), (6, ""), (7, "w1 w1 w1"), (8, " ".join(words[:200])), (2, "x y"), (None, "w5")]
    df = odd.select("doc_id", "text", "score").union(spark.createDataFrame([(i, t, "x") for i, t in docs[len(odd_rows):]], "doc_id bigint, text string, score string")).repartition(5)
    q = spark.createDataFrame([(i, t, "x") for i, t in queries], "item_id bigint, text string, rank string")
    assert got(spark, df, q) == truth(docs, queries)
    assert got(spark, empty, q) == [] and got(spark, df, q.filter("false")) == []
    assert got(spark, df.filter("text is null"), q) == []


def test_no_document_scores_above_its_bound():
    """Every node's bound holds for all its documents, and a far node goes unscored."""
    rng = np.random.default_rng(5)
    size = rng.integers(1, 30, 600)
    at = np.concatenate([np.sort(rng.choice(np.arange(200) + (0 if i < 300 else 200), n, replace=False)) for i, n in enumerate(size)])
    value = rng.integers(1, 1_000_000, size.sum())
    docs = ball_tree._Docs(size, at, value)
    order, nodes = ball_tree.plant(docs, 400, leaf=8)
    dense = np.zeros((600, 400), dtype=np.int64)
    dense[np.repeat(np.arange(600), size), at] = value
    for _ in range(20):
        q = np.where(rng.random(400) < 0.05, rng.integers(0, 9000, 400), 0)
        norm = ball_tree._ceil_root(int((q * q).sum()))
        for start, stop, radius, (c_at, c_value) in zip(nodes["start"], nodes["stop"], nodes["radius"], nodes["centre"]):
            assert (dense[order[start:stop]] @ q).max() <= int((q[c_at] * c_value).sum()) + norm * radius
    assert sorted(order) == list(range(600)) and max(b - a for a, b, x in zip(nodes["start"], nodes["stop"], nodes["left"]) if x < 0) <= 8


def test_subtrees_are_pruned():
    """Few terms and groups of like documents: most leaves lie below the tenth score."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 900_000, (40, 12))
    rows = np.clip(np.repeat(base, 50, axis=0) + rng.integers(-2000, 2000, (2000, 12)), 1, 999_999)
    docs = ball_tree._Docs(np.full(2000, 12), np.tile(np.arange(12), 2000), rows.ravel())
    order, nodes = ball_tree.plant(docs, 12, leaf=16)
    docs = docs.take(order)
    at, value = (np.concatenate([c[k] for c in nodes["centre"]]) for k in (0, 1))
    row = {"doc_id": order.tolist(), "term": [f"t{i}" for i in range(12)], **{k: nodes[k] for k in ("start", "stop", "left", "right", "radius")},
           "centre_size": ball_tree._pack(np.array([len(c[0]) for c in nodes["centre"]])), "centre_at": ball_tree._pack(at), "centre_value": ball_tree._pack(value),
           "size": ball_tree._pack(np.diff(docs.to)), "at": ball_tree._pack(docs.at), "value": ball_tree._pack(docs.value)}
    tree = ball_tree._Tree(row, {f"t{i}": i for i in range(12)})
    for _ in range(10):
        w, best = rng.integers(0, 9000, 12), []
        scored = tree.search(np.arange(12), w, best, 10)
        s = rows @ w
        assert sorted(best, reverse=True) == sorted(((int(x), -i) for i, x in enumerate(s)), reverse=True)[:10]
        assert scored < len(tree.leaf) / 3
