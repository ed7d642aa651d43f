"""Scratch tables in the shared folder, word splitting and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One separator class for every operator: space and the ASCII controls 9 to 13.
SEPARATORS = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. A folder of its own is made only for a local
    master, where driver and executors are one process; a cluster must name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerloom-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """Written intermediate tables of one operator run. Writing cuts the lineage: a lost
    executor costs the tasks it held, not the stages before the table."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
        self.n = 0
        self.tables: list[DataFrame] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        self.tables.append(out)
        return out

    def keep_only(self, *tables: DataFrame) -> None:
        """Delete all tables but those that the result still reads."""
        kept = {t._scratch for t in tables}
        self.drop(*[t for t in self.tables if t._scratch not in kept])

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later plan reads."""
        for t in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(t._scratch)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        gone = {t._scratch for t in tables}
        self.tables = [t for t in self.tables if t._scratch not in gone]


def map_texts(df: DataFrame, fn: Callable[[list[str | None]], dict], fields: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``df`` as they are, and ``fields`` (a DDL list) that ``fn`` makes of a
    list of texts. Columns pass as Arrow, so null and large integers stay exact; ``fn`` sees at
    most 256 texts at a time."""
    made = df.sparkSession.createDataFrame([], fields).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(made)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                out = fn(b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(out[f.name], type=f.type) for f in kinds], names=[*keep, *kinds.names])

    schema = type(made)([df.schema[c] for c in keep] + list(made))
    return df.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def words(text: Column | str) -> Column:
    """Words of a text as an array; no text, no words."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def count_words(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.size(words(text)).cast("bigint")


def text_of(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(text, F.lit(""))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``edges`` (a, b: bigint) as rows (id, component): the smallest
    id reachable. Isolated ids do not occur in the result.

    Alternating large-star and small-star: every node points its larger neighbours to its
    smallest one, then its smaller ones, until nothing moves. Minima are pre-aggregated
    before the shuffle, so a node with most of the edges is one aggregate row per task.
    """
    pair = F.struct(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a"))
    now = scratch.write(edges.filter("a <> b").select(pair.alias("p")).select("p.a", "p.b").distinct(), "edges")
    before = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a")
        small = (moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        after = scratch.write(small, "stars")
        mark = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        scratch.drop(now)
        now = after
        if mark == before:
            break
        before = mark
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
