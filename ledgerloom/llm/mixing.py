"""Mixing sources to target weights, by blocks of words drawn without a global shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, count_words, words

WEIGHTS = (3, 1, 2)
MAX_SOURCES = 100_000
CHUNK = 4096


def targets(sizes: dict, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> dict:
    """Words to take per source. Sources by code point, null last, get the weights in turn;
    together they take ``share`` of all words. A source stops at ``most`` times its size and
    what it cannot take goes to the others by weight, until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, out = share * sum(sizes.values()), list(order), {}
    while free:
        total = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in free}
        for s in full:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in full)
        free = [s for s in free if s not in full]
    return out


def permuted(k: Column, n: Column, *seed: Column, rounds: int = 24) -> Column:
    """A pseudorandom permutation of 0..n-1, for any n: the swap-or-not shuffle. Each round
    pairs k with (key - k) mod n and swaps the pair on one hashed bit of its larger member."""
    def step(x, i):
        other = F.pmod(F.xxhash64(*seed, i) - x, n)
        return F.when(F.xxhash64(F.greatest(x, other), i, *seed).bitwiseAND(F.lit(1)) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), k, step)


def word_positions(docs: DataFrame, scratch: Scratch, bucket_rows: int = 10_000) -> tuple[DataFrame, dict]:
    """Each document's place (``start``) in the sequence of all words of its source, and the
    sources' sizes. Running sums are taken inside hash buckets of a source and the buckets'
    totals are summed before them, so no task sees a whole source."""
    sized = scratch.write(docs.select("doc_id", "source", count_words("text").alias("size"),
                                      F.xxhash64("doc_id", "text").alias("h")), "sizes")
    parts = max(1, -(-sized.count() // bucket_rows))
    sized = sized.withColumn("part", F.pmod(F.xxhash64(F.lit(5), "h"), F.lit(parts)))
    per = scratch.write(sized.groupBy("source", "part").agg(F.sum("size").alias("n")), "parts")
    sizes = {r[0]: int(r[1]) for r in per.groupBy("source").agg(F.sum("n")).limit(MAX_SOURCES + 1).collect()}
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "part").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (sized.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(per, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
              .select("doc_id", "h", "source", "size", (F.col("base") + F.col("inner")).alias("start")))
    return placed, sizes


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, block: int = 64,
        shard_words: int = 1 << 20, seed: int = 29) -> tuple[DataFrame, DataFrame]:
    """Draw words of all documents into output shards in the ratio of the sources' targets.

    The words of a source, one document after the other, are packed into blocks of ``block``
    words. A source with target T over W words gets floor(T / W) slots for every block and
    one more for the first blocks of a further random order until the rest of T is reached
    (the last one is cut short), so it misses T by less than a block. Each slot falls into a
    shard by a seeded hash: over the shards a source's counts are a multinomial draw given
    its total. Slot k of a pass is block ``permuted(k)``; slots meet blocks in a join on
    (source, block), whose keys each hold one block, however large the source.

    Returns ``placed`` (doc_id, h, source, size, start, source_size, target: one row per input
    row) and ``spans`` (shard, place, sid, pass, block, doc_id, h, start, first, n: words
    first..first+n of a document at ``place`` of a shard's order). Documents without words, or
    of null text, are placed and never drawn. Null sources form a source, last in order; null
    ids and repeated rows count as documents. An empty table gives empty tables. The source
    list (at most 100,000) is the only thing that passes the driver or is broadcast.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    placed, sizes = word_positions(docs, scratch)
    goal = targets(sizes, weights, share, most)
    rows = [(i, s, sizes[s], float(goal[s])) for i, s in enumerate(goal)]
    sources = F.broadcast(spark.createDataFrame(rows, "sid int, s string, source_size bigint, target double"))
    placed = placed.join(sources, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = scratch.write(placed, "placed")

    last = F.col("start") + F.col("size") - 1
    pieces = (placed.filter("size > 0")
              .select("sid", "doc_id", "h", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor(last / block))).alias("block"))
              .select("sid", "block", "doc_id", "h", "start",
                      (F.greatest(F.col("start"), F.col("block") * block) - F.col("start")).alias("first"),
                      (F.least(last, F.col("block") * block + block - 1) - F.col("start")).alias("until")))

    slots, total = [], 0
    for sid, _, size, target in rows:
        if size:
            want = int(target)
            n, passes, rest = -(-size // block), want // size, want % size
            slots.append((sid, n, passes, n * passes + -(-rest // block), rest))
            total += want
    shards = max(1, -(-total // shard_words))
    drawn = spark.createDataFrame(slots, "sid int, blocks bigint, passes bigint, slots bigint, rest bigint")
    drawn = drawn.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / CHUNK))).alias("chunk")) if slots else drawn.withColumn("chunk", F.lit(0).cast("bigint"))
    # Chunk rows are tiny and grow when exploded: a fixed number of tasks, and no broadcast of them.
    tasks = max(1, sum(-(-x[3] // CHUNK) for x in slots) // 4)
    drawn = (drawn.filter("slots > 0").repartition(tasks, F.col("sid"), F.col("chunk"))
             .select("*", F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(F.col("chunk") * CHUNK + CHUNK, F.col("slots")) - 1)).alias("k")))
    in_pass = F.pmod("k", "blocks")
    drawn = (drawn.withColumn("pass", F.floor(F.col("k") / F.col("blocks")))
             .select("sid", "pass", permuted(in_pass, F.col("blocks"), F.lit(seed), F.col("sid"), F.col("pass")).alias("block"),
                     F.when((F.col("pass") == F.col("passes")) & (F.col("k") == F.col("slots") - 1),
                            F.col("rest") - in_pass * block).otherwise(block).alias("take"),
                     F.pmod(F.xxhash64(F.lit(seed + 1), "sid", "k"), F.lit(shards)).cast("int").alias("shard"),
                     F.xxhash64(F.lit(seed + 2), "sid", "k").alias("place")))
    end = F.least(F.col("until") + 1, F.col("block") * block + F.col("take") - F.col("start"))
    spans = (drawn.hint("merge").join(pieces, ["sid", "block"])
             .select("shard", "place", "sid", "pass", "block", "doc_id", "h", "start", "first", (end - F.col("first")).alias("n"))
             .filter("n > 0"))
    return placed, spans


def taken(placed: DataFrame, spans: DataFrame) -> DataFrame:
    """``placed`` with the number of words that the mix takes of each row, repeats counted."""
    per = spans.groupBy("sid", "start").agg(F.sum("n").alias("taken"))
    drawn = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("bigint")
    return placed.join(per, ["sid", "start"], "left").withColumn("taken", drawn)


def mixed_documents(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The mix as documents: one row for each pass that takes words of a document, with the
    columns of ``docs``. Where a pass takes all its words the text stays as it is, otherwise
    it is the taken words, in order, joined by one space; ``n_chars`` follows."""
    per = (spans.groupBy("doc_id", "h", "start", "pass")
           .agg(F.sort_array(F.collect_list(F.struct("first", "n"))).alias("_runs"), F.sum("n").alias("_n"))
           .select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "_runs", "_n"))
    keyed = docs.withColumn("_h2", F.xxhash64("doc_id", "text")).dropDuplicates(["doc_id", "_h2"])
    w = words("text")
    cut = F.transform("_runs", lambda r: F.array_join(F.slice(F.col("_w"), (r["first"] + 1).cast("int"), r["n"].cast("int")), " "))
    out = keyed.join(per, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h2") == F.col("_h"))).withColumn("_w", w)
    out = out.withColumn("text", F.when(F.size("_w") == F.col("_n"), F.col("text")).otherwise(F.array_join(cut, " ")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
