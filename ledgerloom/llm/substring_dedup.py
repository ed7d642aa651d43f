"""Repeated passages across documents: seed on winnowed anchors, extend, keep maximal repeats."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import Scratch, map_texts

SEED = 20  # words of an anchor


def _anchors(h: np.ndarray, length: int) -> np.ndarray:
    """For each window of ``length`` words its anchor: the least hash of its SEED-word grams. It
    depends on the window's words alone, so equal windows have equal anchors."""
    if len(h) < length:
        return np.empty(0, dtype=np.uint64)
    return tokens.sliding_min(tokens.rolling(h, min(SEED, length)), length - min(SEED, length) + 1)


def _seeds(length: int):
    def run(texts: list) -> dict:
        out = {"n": [], "same": [], "anchors": []}
        for text in texts:
            w = tokens.split(text)
            out["n"].append(len(w))
            out["same"].append(tokens.identity(w))
            out["anchors"].append(np.unique(_anchors(tokens.hashes(w), length)).view(np.int64) if len(w) >= length else None)
        return out

    return run


def _extended(length: int):
    """The grown windows around each shared seed of a document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i, text, shared in zip(b["doc_id"], b["text"], b["anchors"]):
                h = tokens.hashes(tokens.split(text))
                anchor = _anchors(h, length)
                at = np.flatnonzero(np.isin(anchor, np.asarray(shared, dtype=np.int64).view(np.uint64)))
                yield pd.DataFrame({"anchor": anchor[at].view(np.int64), "grown": tokens.rolling(h, length)[at].view(np.int64),
                                    "doc_id": np.full(len(at), i, dtype=np.int64), "at": at.astype(np.int32)})

    return run


def _runs(length: int):
    """Starts of removed windows as maximal runs of words [start, end)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for starts in b["starts"]:
                s = np.sort(np.asarray(starts))
                cut = np.flatnonzero(np.diff(s) > length)
                first, last = s[np.concatenate(([0], cut + 1))], s[np.concatenate((cut, [len(s) - 1]))]
                out.append([{"start": int(x), "end": int(y) + length} for x, y in zip(first, last)])
            yield pd.DataFrame({"doc_id": b["doc_id"], "repeats": out})

    return run


def repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """Maximal repeated runs: rows (doc_id, repeats array<struct<start, end>>) for documents that
    have any. A run is a union of windows of ``length`` words whose word sequence also starts in
    a document of smaller id, as the input has it.

    Equal word sequences are one class: copies of its least id are repeats as a whole. In the
    others, each window's anchor (winnowing: its least hashed gram of 20 words) seeds the match.
    Documents are joined on anchors; an anchor that only one document has ends there. Around
    each shared seed a document extends both ways to the windows that hold the seed, and the
    extensions of all documents meet by seed and grown hash (128 bits), where the least id
    wins. So a passage that m documents share costs m rows per window, not m * m pairs, and
    hot anchors and windows are minima, taken before the shuffle.

    Null text and texts under ``length`` words have no repeats. Rows without ``doc_id`` neither
    lose words nor make others lose any. Rows that repeat an id must repeat its text; they are
    not repeats of each other. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint"), "text").filter("doc_id is not null")
    seeds = scratch.write(map_texts(texts, _seeds(length), "n bigint, same binary, anchors array<bigint>", ["doc_id"]).filter(F.col("n") >= length), "seeds")
    classes = scratch.write(seeds.groupBy("same").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("greatest")), "classes")
    firsts = seeds.join(classes.select("same", F.col("rep").alias("doc_id")), ["same", "doc_id"], "left_semi").select("doc_id", "anchors")
    placed = scratch.write(firsts.select(F.explode("anchors").alias("anchor"), "doc_id"), "anchors")
    shared = placed.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("anchor")
    grow = placed.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    grow = scratch.write(grow, "shared")
    scratch.drop(placed)

    # The same plan at every size: texts are sorted by id, not sent to a broadcast of the seeds.
    windows = texts.hint("merge").join(grow, "doc_id").mapInPandas(_extended(length), "anchor bigint, grown bigint, doc_id bigint, at int")
    windows = scratch.write(windows, "windows")
    least = windows.groupBy("anchor", "grown").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").drop("hi")
    later = windows.join(least, ["anchor", "grown"]).filter("doc_id > lo")
    starts = later.groupBy("doc_id").agg(F.collect_set("at").alias("starts"))
    span = "array<struct<start:int,end:int>>"
    partly = starts.mapInPandas(_runs(length), f"doc_id bigint, repeats {span}")
    copies = (seeds.join(classes.filter("rep < greatest"), "same").filter("doc_id > rep")
              .select("doc_id", F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("end"))).cast(span).alias("repeats")).distinct())
    out = scratch.write(partly.union(copies), "repeats")
    scratch.keep_only(out)
    return out


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            b = whole.slice(at, 256)
            total, gone, kept = [], [], []
            for text, spans in zip(b.column("text").to_pylist(), b.column("repeats").to_pylist()):
                w = tokens.split(text)
                keep, end = [], 0
                for s in spans or []:
                    keep += w[end:s["start"]]
                    end = s["end"]
                keep += w[end:]
                total.append(len(w))
                gone.append(len(w) - len(keep))
                kept.append(b" ".join(keep).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """Every row's ``doc_id``, ``n_words``, ``n_removed`` and ``kept_text``: the words outside
    ``repeats``, joined by one space (empty for null text)."""
    found = repeats(docs, length)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").hint("merge").join(found, "doc_id", "left")
    return rows.mapInArrow(_without, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def cut_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """``docs`` with their columns, without their repeats: texts that lose nothing are unchanged,
    the others are their kept words joined by one space (``n_chars`` follows), and documents of
    which no word is left are dropped."""
    names = docs.columns
    found = repeats(docs, length).select(F.col("doc_id").alias("_id"), "repeats")
    rows = docs.hint("merge").join(found, F.col("doc_id") == F.col("_id"), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for text, spans in zip(b.column("text").to_pylist(), b.column("repeats").to_pylist()):
                w, keep, end = tokens.split(text), [], 0
                for s in spans:
                    keep += w[end:s["start"]]
                    end = s["end"]
                texts.append(b" ".join(keep + w[end:]).decode("utf-8", "surrogatepass"))
            at = b.schema.get_field_index("text")
            yield b.set_column(at, "text", pa.array(texts, pa.string())).select(names)

    changed = rows.filter("repeats is not null").select(*docs.columns, "repeats").mapInArrow(cut, docs.schema).filter("text <> ''")
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.filter("repeats is null").select(*docs.columns).unionByName(changed)
