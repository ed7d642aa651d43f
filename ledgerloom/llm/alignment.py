"""Cross-tokenizer alignment: groups between shared token ends, links between overlapping tokens."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain, count, islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .encoders import PLAIN, Encoder

BLOCK_BYTES = 8 << 20    # text of one block of documents, whose pairs are counted before Spark sees them
BLOCK_DOCS = 8192
SHIFT = 32               # a pair's code: id of B, then id of A
CACHE = 200_000          # units a worker remembers
# A unit starts with a space that follows no white space (the first: with the space before the text).
WHITE = " \t\n\x0b\x0c\r"
UNIT = re.compile(r" [^ ]*(?:(?<=[\t-\r ]) [^ ]*)*")


class Pair:
    """Two tokenizers over the same bytes: A byte-level BPE (``tokenizers`` file), B a sentencepiece
    model that puts a space before a text. Strings of special tokens are plain text for both.

    Texts are aligned unit by unit, and a worker remembers units, where both tokenizers cut before
    every unit whatever stands around it: A's splitting pattern never crosses from other
    characters into a space, nor does any piece of B (``apart``). Texts whose characters leave
    doubt about A's pattern are one unit each, encoded by the libraries as a whole.
    """

    def __init__(self, a: str, b: str):
        import sentencepiece

        self.a = Encoder(a)
        self.a.tokenizer.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        # Byte-level entries write a printable byte as itself and the n-th other byte as character 256 + n.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(x): x for x in printable} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in printable)}
        with open(a, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            if all(c in byte_of for c in piece):
                bytes_a[i] = bytes(map(byte_of.__getitem__, piece))
        pieces = list(map(self.b.id_to_piece, range(self.b.get_piece_size())))
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id("\u2581")
        self.apart = self.a.fast is not None and bytes_b[self.space] == b" " and not any("\u2581" in p.lstrip("\u2581") for p in pieces)
        self.bytes_a, self.bytes_b = (np.array(t, dtype=object) for t in (bytes_a, bytes_b))
        self.len_a, self.len_b = (np.array(list(map(len, t)), dtype=np.int64) for t in (bytes_a, bytes_b))
        self.n_a, self.n_b = len(bytes_a), len(bytes_b)
        self.marks = np.array([b"%d%s" % (i, end) for n, ends in ((self.n_a, (b",", b"|")), (self.n_b, (b",", b";"))) for end in ends for i in range(n)], dtype=object)
        self.known: dict = {}

    def units(self, text: str | None) -> list[str]:
        """The text with a space before it, cut into units; none of no text."""
        if not text:
            return []
        return UNIT.findall(" " + text) if self.apart and PLAIN.fullmatch(text) else [" " + text]

    def ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both over units that follow each other, or None where either does not give their
        bytes back."""
        text = "".join(units)
        if self.a.fast and PLAIN.fullmatch(text):
            a = self.a.fast.encode_ordinary(text)
        else:
            a = self.a.tokenizer.encode(text, add_special_tokens=False).ids
        b = [self.space] if text == " " else self.b.encode(text[1:])
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        return (a, b) if b"".join(self.bytes_a[a].tolist()) == text.encode() == b"".join(self.bytes_b[b].tolist()) else None

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per group the number of A and of B tokens up to its end: the ends that both have, found
        as common keys of two dictionaries from byte offset to token index."""
        at_a, at_b = (dict(zip(np.cumsum(n[x]).tolist(), count(1))) for n, x in ((self.len_a, a), (self.len_b, b)))
        common = sorted(at_a.keys() & at_b.keys())
        return tuple(np.fromiter(map(at.__getitem__, common), dtype=np.int64, count=len(common)) for at in (at_a, at_b))

    def links(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token indices (of A, of B) of every overlapping pair. In a slice where one side is a
        single token it meets all of the other side; elsewhere each stretch between neighbouring
        ends of either side is one pair."""
        ca, cb = np.diff(end_a, prepend=0), np.diff(end_b, prepend=0)
        one = np.minimum(ca, cb) == 1
        n = (ca * cb)[one]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        ia = np.repeat((end_a - ca)[one], n) + np.where(np.repeat(ca[one] > 1, n), inside, 0)
        ib = np.repeat((end_b - cb)[one], n) + np.where(np.repeat(cb[one] > 1, n), inside, 0)
        if one.all():
            return ia, ib
        own_a, own_b = (np.repeat(~one, c) for c in (ca, cb))
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        cuts = np.union1d(ends_a[own_a], ends_b[own_b])
        return np.r_[ia, np.searchsorted(ends_a, cuts)], np.r_[ib, np.searchsorted(ends_b, cuts)]

    def measure(self, units: list[str]) -> list[tuple | None]:
        """Per unit: tokens of A and B, groups, links, its groups as ``a1,a2|b1;a3|b2,b3;`` and the
        codes of its links; None for a unit that is not given back. The units must be such that
        both tokenizers cut between them: they are encoded and aligned as one text."""
        ids = self.ids(units)
        if ids is None:
            return [None] if len(units) == 1 else [x for u in units for x in self.measure([u])]
        a, b = ids
        end_a, end_b = self.groups(a, b)
        ia, ib = self.links(a, b, end_a, end_b)
        order = np.argsort(ia, kind="stable")
        codes = (b[ib] << SHIFT | a[ia])[order]
        ends = np.cumsum([0, *(len(u.encode()) for u in units)])
        to_a, to_b = (np.searchsorted(np.cumsum(np.r_[0, n[x]]), ends) for n, x in ((self.len_a, a), (self.len_b, b)))
        to_link, to_group = np.searchsorted(ia[order], to_a), np.searchsorted(end_a, to_a, side="right")
        mark_a, mark_b = a.copy(), b + 2 * self.n_a
        mark_a[end_a - 1] += self.n_a
        mark_b[end_b - 1] += self.n_b
        mark = np.empty(len(a) + len(b), dtype=np.int64)
        mark[np.arange(len(a)) + np.repeat(np.r_[0, end_b[:-1]], np.diff(end_a, prepend=0))] = mark_a
        mark[np.arange(len(b)) + np.repeat(end_a, np.diff(end_b, prepend=0))] = mark_b
        marks, to_mark, raw = self.marks[mark].tolist(), (to_a + to_b).tolist(), codes.tobytes()
        sizes = zip(*(np.diff(x).tolist() for x in (to_a, to_b, to_group, to_link)))
        cuts = (8 * to_link).tolist()
        return [(*n, b"".join(marks[x:y]), raw[s:e]) for n, x, y, s, e in zip(sizes, to_mark, to_mark[1:], cuts, cuts[1:])]

    def look_up(self, units: list[str]) -> list[tuple | None]:
        new = [u for u in units if u not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = units
        made: dict = {}
        # Units that end in white space, and whole texts, are not put before others.
        joined = [u for u in new if u[-1] not in WHITE and PLAIN.fullmatch(u)] if self.apart else []
        for at in range(0, len(joined), 4096):
            made.update(zip(joined[at:at + 4096], self.measure(joined[at:at + 4096])))
        made.update((u, self.measure([u])[0]) for u in new if u not in made)
        out = [made[u] if u in made else self.known[u] for u in units]
        # Long units are mostly whole texts, which do not come again.
        self.known.update(islice(((u, x) for u, x in made.items() if len(u) <= 64), CACHE))
        return out


_pairs: dict = {}


def pair(a: str, b: str) -> Pair:
    """One per worker process and two files."""
    if (a, b) not in _pairs:
        _pairs[a, b] = Pair(a, b)
    return _pairs[a, b]


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """Lists (ids, texts) of at most BLOCK_DOCS documents and about BLOCK_BYTES of text."""
    ids, texts, size = [], [], 0
    for at in range(0, batch.num_rows, 256):
        part = batch.slice(at, 256)
        for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
            if texts and (size + len(t or "") > BLOCK_BYTES or len(texts) == BLOCK_DOCS):
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t or "")
    if texts:
        yield ids, texts


BLOCK = ("block bigint, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, "
         "groups_sha256 array<string>, n_units array<bigint>, n_codes array<bigint>, code array<bigint>, total array<bigint>, unit binary, at binary")


def _squeezed(x: np.ndarray) -> pa.Array:
    return pa.array([zstandard.compress(x.astype("<u4").tobytes())], pa.binary())


def _numbers(column: str, row: dict) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(row[column]), dtype="<u4").astype(np.int64)


def _encode(a: str, b: str):
    """Blocks: per document its figures and, in ``unit``, the numbers of its units within the block; per unit the
    numbers, in ``at``, of its links' codes; ``code`` and ``total``, the block's pairs and how many links hold each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        two, number = pair(a, b), count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for ids, texts in _blocks(batch):
                units: dict[str, int] = {}
                docs = [[units.setdefault(u, len(units)) for u in two.units(t)] for t in texts]
                found = two.look_up(list(units))
                bad = {i for i, x in enumerate(found) if x is None}
                docs = [[] if bad and not bad.isdisjoint(d) else d for d in docs]
                n_units = np.array(list(map(len, docs)), dtype=np.int64)
                flat = np.fromiter(chain.from_iterable(docs), dtype=np.int64, count=n_units.sum())
                to = np.cumsum(np.r_[0, n_units])
                each = np.array([x[:4] if x else (0, 0, 0, 0) for x in found], dtype=np.int64).reshape(-1, 4)
                figures = [(lambda s: s[to[1:]] - s[to[:-1]])(np.r_[0, np.cumsum(each[flat, k])]) for k in range(4)]
                marks = [x[4] if x else b"" for x in found]
                digests = [hashlib.sha256(b"".join(map(marks.__getitem__, d))[:-1]).hexdigest() if d else "" for d in docs]
                codes = np.frombuffer(b"".join(x[5] for x in found if x), dtype=np.int64)
                code, at = np.unique(codes, return_inverse=True)
                used = np.repeat(np.bincount(flat, minlength=len(found)), each[:, 3])
                total = np.bincount(at, weights=used, minlength=len(code)).astype(np.int64)
                lists = [np.array(ids, dtype=object), *figures, digests, n_units, each[:, 3], code, total]
                kinds = [pa.string() if k == 5 else pa.int64() for k in range(len(lists))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([next(number)], pa.int64()),
                     *(pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, k)) for x, k in zip(lists, kinds)),
                     _squeezed(flat), _squeezed(at)], names=[c.split()[0] for c in BLOCK.split(", ")])

    return run


RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


def _score(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a block with the corpus-wide counts of its pairs added up."""
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.string() if c == "groups_sha256" else pa.int64() for c in names]
    if not left.num_rows:
        return pa.table([pa.array([], k) for k in kinds], names=names)
    row = left.to_pylist()[0]
    place = right.column("pos").to_numpy()
    made = {}
    for name, column in (("n_best", "best"), ("count_sum", "n")):
        value = np.zeros(len(place), dtype=np.int64)
        value[place] = right.column(column).to_numpy()
        for inner, ends in (("at", "n_codes"), ("unit", "n_units")):  # of units, then of documents
            to = np.cumsum([0, *row[ends]])
            value = np.r_[0, np.cumsum(value[_numbers(inner, row)])]
            value = value[to[1:]] - value[to[:-1]]
        made[name] = value
    return pa.table([pa.array(made.get(c, row.get(c)), k) for c, k in zip(names, kinds)], names=names)


def align(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Per document: tokens of A and B, groups between byte offsets where tokens of both end, links
    (token pairs whose bytes overlap), links whose id pair is the commonest of its B id in the
    corpus (``n_best``, ties included), the corpus-wide counts of its links added up
    (``count_sum``), and the digest of its groups.

    Documents are encoded once, in blocks; a block leaves each distinct pair with its number of
    links, so that a frequent pair is one row per block, whatever its share of all links. Pairs are summed over all blocks, the
    commonest count of each B id is a table of at most B's vocabulary, and every block gets the
    counts of its own pairs back.

    Texts that are null, empty or not given back by either tokenizer have zeros and ''. Every row
    is a document, also one that repeats another; null ids come back; other columns are ignored;
    an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    blocks = scratch.write(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_encode(a, b), BLOCK), "blocks")
    pairs = blocks.select("block", F.posexplode(F.arrays_zip("code", "total")).alias("pos", "p")).select("block", "pos", "p.code", "p.total")
    counts = scratch.write(pairs.groupBy("code").agg(F.sum("total").alias("n")), "pairs")
    most = counts.groupBy(F.shiftright("code", SHIFT).alias("b")).agg(F.max("n").alias("most"))
    # One row for each id of B at most.
    known = counts.join(F.broadcast(most), F.shiftright("code", SHIFT) == F.col("b")).select("code", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))
    back = pairs.join(known, "code").select(F.col("block").alias("of_block"), "pos", "n", "best")
    small = blocks.drop("code", "total")
    return small.groupBy("block").cogroup(back.groupBy("of_block")).applyInArrow(_score, RESULT)


def links(docs: DataFrame, a: str, b: str) -> DataFrame:
    """The pairs themselves: rows (a, b, n), how many links of the corpus hold id ``a`` linked to ``b``."""
    blocks = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_encode(a, b), BLOCK)
    pairs = blocks.select(F.explode(F.arrays_zip("code", "total")).alias("p")).groupBy("p.code").agg(F.sum("p.total").alias("n"))
    return pairs.select(F.col("code").bitwiseAND(F.lit((1 << SHIFT) - 1)).alias("a"), F.shiftright("code", SHIFT).alias("b"), "n")


def groups(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (doc_id, groups): per group the ids of A and those of B over the same bytes; null where
    a text has no tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = pair(a, b)
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))]))
        for batch in batches:
            for ids, texts in _blocks(batch):
                out = []
                for text in texts:
                    got = two.ids([" " + text]) if text else None
                    out.append(got and [{"a": x, "b": y} for x, y in zip(*(np.split(x, end[:-1]) for x, end in zip(got, two.groups(*got))))])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, kind)], names=["doc_id", "groups"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, groups array<struct<a:array<bigint>,b:array<bigint>>>")
