"""Chat transcripts as one training string per conversation, with Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, SEP, NEWLINE = "<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|nl|>"


def escape(text: Column) -> Column:
    """No control string is left in the text: ``<|`` gets a backslash inside, and what already
    looks so gets one more. ``unescape`` takes one away."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``mask``, the spans (start,
    length; code points of ``formatted``) that carry loss: the texts of ``loss_role``.

    Turn structs are collected and sorted by turn, then role, then text; adjacent turns of one
    role share a header and are kept apart by ``<|im_sep|>``, so that every turn can be read
    back. Null roles and texts are empty; null turns come first; rows without ``conv_id`` form
    a conversation; repeated rows stay. Other columns are ignored. An empty table gives no
    rows. A conversation is one string, which Spark bounds at 2 GB; no task holds more than
    the conversations of its own rows.
    """
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    n = F.size("turns")

    def segment(t, i):
        same_before = (i > 0) & (F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"] == t["role"])
        same_after = (i < n - 1) & (F.col("turns")[F.least(i + 1, n - 1)]["role"] == t["role"])
        head = F.when(same_before, F.lit(SEP)).otherwise(F.concat(F.lit(START), _role(t["role"]), F.lit("\n")))
        tail = F.when(same_after, F.lit("")).otherwise(F.lit(END + "\n"))
        return F.struct(head.alias("head"), escape(t["text"]).alias("body"), tail.alias("tail"), (t["role"] == loss_role).alias("loss"))

    cut = chats.select("conv_id", F.transform("turns", segment).alias("segments"))
    formatted = F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"], s["tail"])), "")
    # Running code point offsets: the fold appends one span per segment.
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint,loss:boolean>>").alias("spans"))
    lengths = F.transform("segments", lambda s: F.struct(F.length(s["head"]).cast("bigint").alias("h"), F.length(s["body"]).cast("bigint").alias("b"),
                                                         F.length(s["tail"]).cast("bigint").alias("t"), s["loss"].alias("loss")))
    # Sums of earlier segments by a fold over at most 512 at a time, so that appending stays linear.
    def fold(part, at):
        start = F.struct(at.alias("at"), zero["spans"].alias("spans"))
        return F.aggregate(part, start, lambda acc, s: F.struct(
            (acc["at"] + s["h"] + s["b"] + s["t"]).alias("at"),
            F.concat(acc["spans"], F.array(F.struct((acc["at"] + s["h"]).alias("start"), s["b"].alias("length"), s["loss"].alias("loss")))).alias("spans")))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size("lengths") - 1) / 512).cast("int")), lambda i: F.slice("lengths", i * 512 + 1, 512))
    sums = F.transform("chunks", lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, s: a + s["h"] + s["b"] + s["t"]))
    spans = F.flatten(F.transform("chunks", lambda c, i: fold(c, F.aggregate(F.slice("sums", F.lit(1), i), F.lit(0).cast("bigint"), lambda a, x: a + x))["spans"]))
    return (cut.select("conv_id", formatted.alias("formatted"), lengths.alias("lengths"))
            .withColumn("chunks", chunks).withColumn("sums", sums)
            .select("conv_id", "formatted", F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"], s["length"])).alias("mask")))


def read_back(chats: DataFrame) -> DataFrame:
    """``turns`` (role, text) parsed from ``formatted``, and ``loss_text``: what lies under the
    mask, unescaped."""
    blocks = F.slice(F.split("formatted", r"<\|im_start\|>"), 2, 1 << 30)

    def turns(block):
        role = F.substring_index(block, "\n", 1)
        body = block.substr(F.length(role) + 2, F.length(block) - F.length(role) - 1 - len(END) - 1)
        name = unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")))
        return F.transform(F.split(body, r"<\|im_sep\|>"), lambda t: F.struct(name.alias("role"), unescape(t).alias("text")))

    under = F.transform("mask", lambda m: unescape(F.col("formatted").substr((m["start"] + 1).cast("int"), m["length"].cast("int"))))
    return chats.select("*", F.flatten(F.transform(blocks, turns)).alias("turns"), F.array_join(under, "").alias("loss_text"))
