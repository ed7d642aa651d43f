"""Two-pass external shuffle into shards of equal row counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

# A broadcast of bucket offsets holds at most this many rows of 24 bytes.
BROADCAST_BUCKETS = 100_000
# Up to so many buckets each is a task of its own; beyond, a task takes at most so many.
SMALL_TASKS, BUCKETS_A_TASK = 2_000, 32
# Buckets summed up as one before the running sum over all.
BLOCK = 4_096


def _offsets(counts: DataFrame) -> DataFrame:
    """Rows before each bucket: running sums inside blocks of buckets, and over the blocks' totals,
    of which there is one for 4,096 buckets or some eight million rows."""
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("block", F.floor(F.col("bucket") / BLOCK))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("n"))
    blocks = blocks.select("block", earlier(Window.orderBy("block")).alias("base"))
    inside = counts.select("block", "bucket", earlier(Window.partitionBy("block").orderBy("bucket")).alias("inner"))
    return inside.join(blocks, "block").select("bucket", (F.col("base") + F.col("inner")).alias("offset"))


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 17, bucket_rows: int = 2048,
                        bucket_bytes: int = 8 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A random permutation of all rows, dealt round robin into ``shards``.

    Pass one scatters the records by a seeded hash of id and text into as many buckets as it
    takes for a bucket to hold about ``bucket_rows`` rows and ``bucket_bytes`` bytes of text.
    Pass two shuffles each bucket (Spark's array ``shuffle`` is Fisher-Yates). Buckets follow
    one another, so a row's rank is its bucket's offset plus its place there; shard and slot
    are the remainder and quotient of rank by ``shards``: counts differ by one at most.

    Returns the given columns as struct ``record`` with ``shard`` (int) and ``slot`` (long,
    gapless from 0). Null ids and texts are rows like others. Rows that repeat an id spread
    over the buckets by their texts. Rows of one id and text that would fill a quarter of a
    bucket are counted by their content, and each kind's copies, which are interchangeable, are
    numbered 1 to n and spread by number and content. An empty table gives no rows.

    Placement is a function of the rows, the seed and the bounds alone, however the input is
    split and wherever a task runs again: a bucket is put in the order of a hash of its rows,
    the number of tasks follows from the number of buckets, and each task takes its buckets in
    order, so the shuffle draws the same numbers for the same bucket.
    """
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint")
    n_rows, total = docs.select(size.alias("n")).agg(F.count(F.lit(1)), F.sum("n")).first()
    buckets = max(1, -(-n_rows // bucket_rows), -(-(total or 0) // bucket_bytes))
    content = [F.to_json(F.struct(f.name)) if "map" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema.fields]
    rows = docs.select(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("key"), size.alias("size"),
                       F.xxhash64(F.lit(seed + 1), *content).alias("order"), F.struct(*docs.columns).alias("record"))
    bucket = lambda *salt: F.pmod(F.xxhash64(F.lit(seed), "key", *salt), F.lit(buckets)).cast("int").alias("bucket")
    # At most eight keys a bucket, or four for each of the two bounds.
    repeats = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
               .filter((F.col("n") > 1) & ((F.col("n") * 4 > bucket_rows) | (F.col("n") * F.col("size") * 4 > bucket_bytes))))
    scratch = Scratch(docs.sparkSession)
    repeats = scratch.write(repeats.select(F.col("key").alias("repeated")), "repeats")
    if repeats.isEmpty():
        scratch.drop(repeats)
        rows = rows.select(bucket(), "order", "record")
    else:
        hot = F.broadcast(repeats) if buckets <= BROADCAST_BUCKETS else repeats
        match = F.col("key") == F.col("repeated")
        # The counts begin in the tasks that read, so a hot key shuffles one row a kind and task.
        kinds = rows.join(hot, match, "left_semi").groupBy("key", "order").agg(F.count(F.lit(1)).alias("n"), F.first("record").alias("record"))
        copies = kinds.select("key", "order", "record", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("number"))
        spread = copies.select(bucket("order", "number"), F.xxhash64("order", "number").alias("order"), "record")
        rows = rows.join(hot, match, "left_anti").select(bucket(), "order", "record").union(spread)

    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    offsets = _offsets(counts)
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)

    tasks = max(min(buckets, SMALL_TASKS), -(-buckets // BUCKETS_A_TASK))
    filled = rows.select("bucket", F.struct("order", "record").alias("r"))
    filled = filled.repartition(tasks, F.col("bucket")).groupBy("bucket").agg(F.collect_list("r").alias("rows")).sortWithinPartitions("bucket")
    by_order = F.array_sort("rows", lambda x, y: F.when(x["order"] < y["order"], -1).when(x["order"] > y["order"], 1).otherwise(0))
    dealt = filled.select("bucket", F.posexplode(F.shuffle(by_order, F.lit(seed))).alias("place", "r")).join(offsets, "bucket")
    rank = F.col("offset") + F.col("place")
    return dealt.select("r.record", F.pmod(rank, F.lit(shards)).cast("int").alias("shard"),
                        F.floor(rank / shards).cast("bigint").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard with its records in slot order. A shard's rows are range-split by
    slot, so that no task holds a whole shard; file names follow slot order."""
    flat = sharded.select("record.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    (flat.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
     .write.partitionBy("_shard").parquet(path))
