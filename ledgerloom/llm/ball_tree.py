"""Exact ranked lexical search: sparse ball trees over documents, searched best-first."""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from math import isqrt, log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import Scratch

TREE_DOCS = 4096         # documents of one tree, fewer where texts are long
TREE_BYTES = 8 << 20
LEAF = 128
COMMON = 16              # a centre holds the terms that a node's documents have one in COMMON at least
BLOCK_QUERIES, BLOCK_TERMS = 2048, 1 << 18   # queries searched in one pass over the trees
NOT_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

POSTINGS = "doc_id array<bigint>, n array<bigint>, term array<string>, df array<bigint>, size binary, at binary, tf binary"
TREES = ("doc_id array<bigint>, term array<string>, start array<int>, stop array<int>, left array<int>, right array<int>, radius array<bigint>, "
         "centre_size binary, centre_at binary, centre_value binary, size binary, at binary, value binary")


def _pack(x: np.ndarray) -> bytes:
    return zstandard.compress(x.astype("<u4").tobytes())


def _numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), dtype="<u4").astype(np.int64)


def _row(fields: str, values: list) -> pa.RecordBatch:
    kinds = {"array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()), "binary": pa.binary()}
    names, types = zip(*(f.split(" ") for f in fields.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[t]) for v, t in zip(values, types)], names=names)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block of documents: their lengths, the block's terms with the number of its documents
    that hold them, and (size per document) term numbers and frequencies."""
    def block(ids, found):
        place: dict[bytes, int] = {}
        size = [len(c) for c in found]
        at = np.fromiter((place.setdefault(t, len(place)) for c in found for t in c), dtype=np.int64, count=sum(size))
        tf = np.fromiter(chain.from_iterable(c.values() for c in found), dtype=np.int64, count=sum(size))
        return _row(POSTINGS, [ids, [c.total() for c in found], [t.decode("utf-8", "replace") for t in place],
                               np.bincount(at, minlength=len(place)), _pack(np.array(size, dtype=np.int64)), _pack(at), _pack(tf)])

    for batch in batches:
        ids, found, held = [], [], 0
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for i, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                if found and (len(found) == TREE_DOCS or held + len(text or "") > TREE_BYTES):
                    yield block(ids, found)
                    ids, found, held = [], [], 0
                ids.append(i)
                found.append(Counter(tokens.terms(text)))
                held += len(text or "")
        if found:
            yield block(ids, found)


class _Docs:
    """Sparse integer vectors, one after the other."""

    def __init__(self, size: np.ndarray, at: np.ndarray, value: np.ndarray):
        self.to = np.r_[0, np.cumsum(size)]
        self.at, self.value = at, value

    def sums(self, x: np.ndarray) -> np.ndarray:
        s = np.r_[0, np.cumsum(x)]
        return s[self.to[1:]] - s[self.to[:-1]]

    def take(self, which: np.ndarray) -> "_Docs":
        n = (self.to[1:] - self.to[:-1])[which]
        flat = np.repeat(self.to[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return _Docs(n, self.at[flat], self.value[flat])


def _ceil_root(x: int) -> int:
    return isqrt(x - 1) + 1 if x > 0 else 0


def plant(docs: _Docs, n_terms: int, leaf: int = LEAF) -> tuple[np.ndarray, dict]:
    """A ball tree: the order of the documents, and nodes (start and stop in that order, children,
    integer centre, radius rounded up). A node is split halfway between its documents' distances to
    two far ones, so depth is the logarithm of the number of documents and equal documents part."""
    n = len(docs.to) - 1
    order = np.arange(n)
    square = docs.sums(docs.value * docs.value)
    nodes = {k: [] for k in ("start", "stop", "left", "right", "radius", "centre")}
    dense = np.zeros(n_terms, dtype=np.int64)

    def far(own: _Docs, own_square: np.ndarray, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Squared distances, in whole numbers."""
        dense[at] = value
        out = own_square - 2 * own.sums(own.value * dense[own.at]) + int((value * value).sum())
        dense[at] = 0
        return out

    open_ = [(0, n, docs, None, "")]
    while open_:
        start, stop, own, parent, side = open_.pop()
        k, m = len(nodes["start"]), stop - start
        if parent is not None:
            nodes[side][parent] = k
        mine = square[order[start:stop]]
        held = np.bincount(own.at, minlength=n_terms)
        at = np.flatnonzero(held * COMMON >= m)
        value = np.bincount(own.at, weights=own.value, minlength=n_terms)[at].astype(np.int64) // max(m, 1)
        at, value = at[value > 0], value[value > 0]
        away = far(own, mine, at, value)
        for key, x in (("start", start), ("stop", stop), ("left", -1), ("right", -1), ("radius", _ceil_root(int(away.max(initial=0)))), ("centre", (at, value))):
            nodes[key].append(x)
        if m <= leaf:
            continue
        ends = []
        for _ in range(2):
            p = int(away.argmax())
            away = far(own, mine, own.at[own.to[p]:own.to[p + 1]], own.value[own.to[p]:own.to[p + 1]])
            ends.append(away)
        by = np.argsort(ends[0] - ends[1], kind="stable")
        order[start:stop] = order[start:stop][by]
        half = m // 2
        for x, y, which, side in ((start, start + half, by[:half], "left"), (start + half, stop, by[half:], "right")):
            open_.append((x, y, own.take(which), k, side))
    return order, nodes


def _trees(n_docs: int, n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n"]
                size, at, tf = (_numbers(row[c]) for c in ("size", "at", "tf"))
                m = np.repeat(np.array([10 + 90 * x * n_docs // n_words if n_words else 10 for x in n], dtype=np.int64), size)
                docs = _Docs(size, at, 1_000_000_000 * tf // (1000 * tf + 8 * m))
                some = np.flatnonzero(size)
                docs, ids = docs.take(some), [row["doc_id"][i] for i in some]
                if not ids:
                    continue
                order, nodes = plant(docs, len(row["term"]))
                docs = docs.take(order)
                at, value = (np.concatenate([c[k] for c in nodes["centre"]]) for k in (0, 1))
                yield _row(TREES, [[ids[i] for i in order], row["term"], *(nodes[k] for k in ("start", "stop", "left", "right", "radius")),
                                   _pack(np.array([len(c[0]) for c in nodes["centre"]])), _pack(at), _pack(value), _pack(np.diff(docs.to)), _pack(docs.at), _pack(docs.value)])

    return run


@dataclass
class Index:
    """Trees over all documents, the documents that hold each term, and the two totals of the weights."""

    trees: DataFrame
    terms: DataFrame
    n_docs: int
    n_words: int


def build(docs: DataFrame, scratch: Scratch | None = None) -> Index:
    """An index of all rows of ``docs`` (doc_id, text); rows without a term are counted nowhere.
    Vectors are whole numbers (a term's saturated frequency in millionths)."""
    scratch = scratch or Scratch(docs.sparkSession)
    rows = scratch.write(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_postings, POSTINGS), "postings")
    number = rows.select(F.explode("n").alias("n")).agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = rows.select(F.explode(F.arrays_zip("term", "df")).alias("t")).groupBy("t.term").agg(F.sum("t.df").alias("df"))
    terms = scratch.write(held, "terms")
    trees = scratch.write(rows.mapInArrow(_trees(*number), TREES), "trees")
    scratch.drop(rows)
    return Index(trees, terms, *number)


class _Tree:
    """One tree as far as the terms of the queries go."""

    def __init__(self, row: dict, place: dict[str, int]):
        self.ids = row["doc_id"]
        self.start, self.stop, self.left, self.right = (row[c] for c in ("start", "stop", "left", "right"))
        self.radius = np.array(row["radius"], dtype=np.int64)
        number = np.array([place.get(t, -1) for t in row["term"]], dtype=np.int64)
        own = np.flatnonzero(number >= 0)
        self.own = np.full(len(place), -1, dtype=np.int64)
        self.own[number[own]] = np.arange(len(own))
        local = np.full(len(number), -1, dtype=np.int64)
        local[own] = np.arange(len(own))
        self.width = len(own)
        self.centres = np.zeros((len(self.start), self.width), dtype=np.int64)
        at = local[_numbers(row["centre_at"])]
        node = np.repeat(np.arange(len(self.start)), _numbers(row["centre_size"]))
        self.centres[node[at >= 0], at[at >= 0]] = _numbers(row["centre_value"])[at >= 0]
        # Postings by (leaf, term).
        self.leaf = {k: i for i, k in enumerate(k for k, x in enumerate(self.left) if x < 0)}
        of_doc = np.zeros(len(self.ids), dtype=np.int64)
        for k, i in self.leaf.items():
            of_doc[self.start[k]:self.stop[k]] = i
        size = _numbers(row["size"])
        at, doc = local[_numbers(row["at"])], np.repeat(np.arange(len(size)), size)
        key = of_doc[doc[at >= 0]] * self.width + at[at >= 0]
        by = np.argsort(key, kind="stable")
        self.doc, self.value = doc[at >= 0][by], _numbers(row["value"])[at >= 0][by]
        self.to = np.r_[0, np.cumsum(np.bincount(key, minlength=len(self.leaf) * self.width))]
        # Per node and term how far above 0 its documents reach: parents come before their children.
        self.reach = np.zeros((len(self.start), self.width), dtype=np.int64)
        filled = np.flatnonzero(np.diff(self.to))
        if len(filled):
            top = np.zeros(len(self.leaf) * self.width, dtype=np.int64)
            top[filled] = np.maximum.reduceat(self.value, self.to[:-1][filled])
            self.reach[list(self.leaf)] = top.reshape(len(self.leaf), self.width)
        for k in range(len(self.start) - 1, -1, -1):
            if self.left[k] >= 0:
                np.maximum(self.reach[self.left[k]], self.reach[self.right[k]], out=self.reach[k])

    def scores(self, k: int, ids: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Exact scores of a leaf's documents."""
        at = self.leaf[k] * self.width + ids
        lo, n = self.to[at], self.to[at + 1] - self.to[at]
        flat = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out = np.zeros(self.stop[k] - self.start[k], dtype=np.int64)
        np.add.at(out, self.doc[flat] - self.start[k], self.value[flat] * np.repeat(w, n))
        return out

    def search(self, at: np.ndarray, w: np.ndarray, best: list, k: int) -> int:
        """Put the documents into ``best``, a heap of at most ``k`` (score, -doc_id); the number of leaves scored.

        No document of a node scores more than query times centre plus length of the query times
        radius. Along the query's own terms, which are few, the ball is cut to the stretch that the
        node's documents reach on each (one-dimensional balls), which binds where documents share
        few terms. All are whole numbers, both lengths rounded up, so the bounds are safe; a node
        goes only if it lies below the k-th score, so that equal scores are still settled by id."""
        ids = self.own[at]
        ids, w = ids[ids >= 0], w[ids >= 0]
        if not len(ids):
            return 0
        ball = self.centres[:, ids] @ w + _ceil_root(int((w * w).sum())) * self.radius
        bound = np.minimum(ball, self.reach[:, ids] @ w).tolist()
        open_, scored = [(-bound[0], 0)], 0
        while open_:
            b, node = heapq.heappop(open_)
            if len(best) == k and -b < best[0][0]:
                break
            if self.left[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    if len(best) < k or bound[child] >= best[0][0]:
                        heapq.heappush(open_, (-bound[child], child))
                continue
            scored += 1
            s = self.scores(node, ids, w)
            for d in np.flatnonzero(s >= max(1, best[0][0] if len(best) == k else 1)).tolist():
                i = self.ids[self.start[node] + d]
                item = (int(s[d]), -i if i is not None else -(1 << 63) - 1)
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return scored


HITS = "query bigint, item_id bigint, doc_id bigint, score bigint"


def _search(queries: list[tuple], n_docs: int, k: int):
    """Each task carries its best ``k`` of every query from tree to tree and gives them at its end."""
    place: dict[str, int] = {}
    asked = []
    for query, item, terms in queries:
        at = [place.setdefault(t, len(place)) for t, _ in terms]
        w = [int(1000 * log((2 * n_docs + 2) / (2 * df + 1))) for _, df in terms]
        asked.append((query, item, np.array(at, dtype=np.int64), np.array(w, dtype=np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in asked]
        for batch in batches:
            for j in range(batch.num_rows):
                tree = _Tree(batch.slice(j, 1).to_pylist()[0], place)
                for (_, _, at, w), own in zip(asked, best):
                    tree.search(at, w, own, k)
        rows = [(q, item, -d if d >= -(1 << 63) else None, s) for (q, item, *_), own in zip(asked, best) for s, d in own]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "item_id", "doc_id", "score"])

    return run


def search(index: Index, queries: DataFrame, k: int = 10) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): per row of ``queries`` (item_id, text) its ``k``
    highest-scoring documents with a score above 0, equal scores by ascending id.

    Queries are taken in blocks of at most about BLOCK_QUERIES rows and BLOCK_TERMS terms, which travel
    with the tasks; each block is one pass over the trees. A task's best ``k`` of a query meet
    those of the other tasks in one window. A repeated query is answered again; queries without
    text or with no known term give no rows; documents without an id come last among equals; an
    empty table on either side gives no rows; other columns are ignored.
    """
    spark = queries.sparkSession
    scratch = Scratch(spark)
    every = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(f"({NOT_TERM})"), F.lit(1))
    asked = scratch.write(queries.select(F.col("item_id").cast("bigint"), F.array_distinct(every).alias("terms"))
                          .withColumn("query", F.monotonically_increasing_id()), "queries")
    rows, total = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    blocks = max(-(-rows // BLOCK_QUERIES), -(-total // BLOCK_TERMS), 1)
    each = asked.select("query", "item_id", F.explode("terms").alias("term")).join(index.terms, "term")
    known = scratch.write(each.groupBy("query", "item_id").agg(F.sort_array(F.collect_list(F.struct("term", "df"))).alias("terms"))
                          .withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks))), "weighed")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    out = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for b in range(blocks):
        held = [(r.query, r.item_id, [(t.term, t.df) for t in r.terms]) for r in known.filter(F.col("block") == b).collect()]
        if held:
            hits = index.trees.mapInArrow(_search(held, index.n_docs, k), HITS)
            ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            out = out.union(ranked.select("item_id", "rank", "doc_id", "score"))
    return out
