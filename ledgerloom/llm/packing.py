"""Best-two-fit packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoders import encoder


def pieces(docs: DataFrame, tokenizer: str, length: int = 2048, end: int = 0) -> DataFrame:
    """Token pieces: rows (doc_id, piece, start, length, ids, slot). A document is the ids of its
    text (null: empty) and the id ``end``. Longer ones are cut so that all pieces but the first
    are full. ``ids`` are little-endian 32-bit; ``slot`` numbers the pieces, the same in a rerun
    of the task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, slot = encoder(tokenizer), TaskContext.get().partitionId() << 40
        for b in batches:
            for at in range(0, len(b), 256):
                out = []
                for i, ids in zip(b["doc_id"].iloc[at:at + 256], enc.ids([t or "" for t in b["text"].iloc[at:at + 256]])):
                    ids = np.append(ids, np.array([end], dtype="<u4")).astype("<u4")
                    first = len(ids) - (len(ids) - 1) // length * length
                    cuts = [0, *range(first, len(ids) + 1, length)]
                    for p, (x, y) in enumerate(zip(cuts, cuts[1:])):
                        out.append((i, p, x, y - x, ids[x:y].tobytes(), slot))
                        slot += 1
                yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids", "slot"]).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(run, "doc_id bigint, piece int, start bigint, length bigint, ids binary, slot bigint")


def best_two_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset for each length (1..size).

    A bin takes the longest length that fits its gap until none does. Then its shortest member
    is weighed against two lengths still unpacked: if two of them fill the gap that it would
    leave more tightly than it does, they take its place and it goes back.
    """
    order = np.argsort(lengths, kind="stable")
    count = np.bincount(lengths, minlength=size + 1)
    mask = sum(1 << int(x) for x in np.flatnonzero(count))
    bins: list[list[int]] = []

    def take(x):
        nonlocal mask
        count[x] -= 1
        if not count[x]:
            mask &= ~(1 << x)

    def give(x):
        nonlocal mask
        count[x] += 1
        mask |= 1 << x

    def fitting(gap):
        return (mask & ((1 << (gap + 1)) - 1)).bit_length() - 1 if gap > 0 else -1

    while mask:
        held, gap = [], size
        while (x := fitting(gap)) > 0:
            take(x)
            held.append(x)
            gap -= x
        if gap and mask and len(held) > 1:
            least = held[-1]
            pair = _best_pair(count, gap + least)
            if pair and sum(pair) > least:
                held.pop()
                give(least)
                for x in pair:
                    take(x)
                held += pair
        bins.append(held)
    # Lengths back to members: equal lengths are interchangeable.
    flat = np.array([x for b in bins for x in b])
    number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    place = np.concatenate([np.cumsum([0, *b[:-1]]) for b in bins])
    by = np.argsort(flat, kind="stable")
    bin_of, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    bin_of[order], offset[order] = number[by], place[by]
    return bin_of, offset


def _best_pair(count: np.ndarray, room: int) -> list[int] | None:
    """Two available lengths of the greatest sum up to ``room``."""
    room = min(room, len(count) - 1)
    have = np.flatnonzero(count[: room + 1])
    have = have[have > 0]
    if not len(have):
        return None
    below = np.zeros(room + 1, dtype=np.int64)
    below[have] = have
    below = np.maximum.accumulate(below)
    # The second length is at most the first, and another one if the first occurs once.
    limit = np.minimum(room - have, np.where(count[have] > 1, have, have - 1))
    other = np.where(limit > 0, below[np.maximum(limit, 0)], 0)
    total = np.where(other > 0, have + other, 0)
    i = int(np.argmax(total))
    return [int(have[i]), int(other[i])] if total[i] else None


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end: int = 0, bucket_pieces: int = 4096) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids, sequence_id,
    offset. Sequences hold at most ``length`` tokens, without gaps.

    Pieces are dealt by a hash of their number into buckets of about ``bucket_pieces`` (as many
    as rows and text bytes ask for), each packed by ``best_two_fit`` in one task of bounded
    memory. A random bucket of that size has lengths of all kinds, so the loss against one
    bucket is a fraction of a sequence each. No joins: null ids, repeated rows and ties are
    pieces like others. Only ``doc_id`` and ``text`` are read; an empty table gives no rows.
    """
    rows, text = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    buckets = max(1, round((rows + (text or 0) / (4 * length)) / bucket_pieces))

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("slot", kind="stable")
        bins, offset = best_two_fit(p["length"].to_numpy(), length)
        return p.assign(sequence_id=p["bucket"].to_numpy(dtype=np.int64) * (1 << 32) + bins, offset=offset).drop(columns=["slot", "bucket"])

    dealt = pieces(docs, tokenizer, length, end).withColumn("bucket", F.pmod(F.xxhash64("slot"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandas(run, "doc_id bigint, piece int, start bigint, length bigint, ids binary, sequence_id bigint, offset bigint")
