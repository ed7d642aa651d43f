"""Exact token counts, with huge texts cut into overlapping chunks that are spliced again."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, map_texts, text_of
from .encoders import encoder

SPACE = " \t\n\x0b\x0c\r"


def _whole(tokenizer: str):
    return lambda texts: {"n_tokens": encoder(tokenizer).counts(texts)}


def _chunks(tokenizer: str):
    """Per chunk: its token count, and the stable boundaries in the overlap before (``left``) and
    after (``right``) it: at (character of the text), id of the token that starts there, and the
    number of the chunk's tokens before it."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer).tokenizer
        for b in batches:
            out = []
            for row, i, start, width, last, text in zip(b["row"], b["i"], b["start"], b["overlap"], b["last"], b["text"]):
                e = enc.encode(text, add_special_tokens=False)
                offsets = e.offsets
                # A token that follows white space: both chunks see the same text from there on,
                # and no rule of the tokenizer looks across white space.
                stable = [(start + s, t, n) for n, ((s, _), t) in enumerate(zip(offsets, e.ids))
                          if s > 0 and text[s - 1] in SPACE and (n == 0 or offsets[n - 1][1] <= s)]
                left = [x for x in stable if i > 0 and x[0] < start + width]
                right = [x for x in stable if not last and x[0] >= start + len(text) - width]
                out.append((row, i, len(offsets), *([{"at": a, "id": t, "before": n} for a, t, n in side] for side in (left, right))))
            yield pd.DataFrame(out, columns=["row", "i", "n", "left", "right"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, chunk: int = 1 << 15, overlap: int = 256) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens): the tokens of every whole text as the tokenizer counts
    them (null text: empty), without special tokens added.

    Texts over ``chunk`` characters become chunk rows, each with the first ``overlap``
    characters of the next, spread over all tasks and encoded with offsets. Two neighbours are
    spliced at the first boundary both have: the same token starts at the same character after
    white space. A text with two neighbours that share none is encoded again with overlaps four
    times as wide, at last as one chunk. The tokenizer must treat texts apart at white space (as
    splitters that drop it do); others need ``chunk`` above the longest text.

    Repeated rows are counted each; null ids come back; other columns are ignored; an empty table
    gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint"), text_of("text").alias("text")).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    long = F.length("text") > chunk
    short = map_texts(rows.filter(~long), _whole(tokenizer), "n_tokens bigint", ["doc_id", "n_bytes"])
    open_ = scratch.write(rows.filter(long).withColumn("row", F.monotonically_increasing_id()), "long")
    done, width = [short], overlap
    while not open_.isEmpty():
        n = F.length("text")
        # Where overlaps would reach the chunk size, chunks grow with them.
        size = max(chunk, 2 * width)
        last = F.greatest(F.floor((n - 1) / size), F.lit(0)).cast("int")
        cut = open_.select("row", "text", last.alias("z"), F.explode(F.sequence(F.lit(0), last)).alias("i"))
        cut = cut.select("row", "i", (F.col("i").cast("bigint") * size).alias("start"), F.lit(width).alias("overlap"), (F.col("i") == F.col("z")).alias("last"),
                         F.col("text").substr(F.col("i") * size + 1, F.lit(size + width)).alias("text"))
        side = "array<struct<at:bigint,id:bigint,before:bigint>>"
        parts = cut.repartition(F.col("row"), F.col("i")).mapInPandas(_chunks(tokenizer), f"row bigint, i int, n bigint, left {side}, right {side}")
        order = Window.partitionBy("row").orderBy("i")
        parts = parts.withColumn("next", F.lead("left").over(order))
        # Where both chunks have a boundary: tokens before it in this one and in the next.
        same = F.filter("right", lambda x: F.exists("next", lambda y: (y["at"] == x["at"]) & (y["id"] == x["id"])))
        parts = parts.withColumn("met", F.get(same, F.lit(0)))
        behind = F.get(F.filter("next", lambda y: y["at"] == F.col("met.at")), F.lit(0))["before"]
        open_end = F.col("next").isNotNull()
        counted = F.when(open_end, F.col("met.before") - behind).otherwise(F.col("n"))
        total = parts.groupBy("row").agg(F.sum(counted).alias("n_tokens"), F.max((open_end & F.col("met").isNull()).cast("int")).alias("failed"))
        total = scratch.write(total, "spliced")
        joined = open_.join(total, "row")
        done.append(joined.filter("failed = 0").select("doc_id", "n_bytes", "n_tokens"))
        open_ = scratch.write(joined.filter("failed = 1").select(*open_.columns), "open")
        width *= 4
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out
