"""A training corpus from documents: five stages, each one operator over what its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import mixing, near_dup, packing, substring_dedup, toxicity
from ledgerloom.llm.common import Scratch

TOXIC = 0.3
NEAR = 80, 100   # least similarity of near duplicates, as a fraction
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the classifier learns from all labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs, labels, F.lit(True))
    return toxicity.score(docs, model, docs.columns, "_toxic_score").filter(F.col("_toxic_score") < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates (similarity 0.8 or
    more of their five-word shingles). Rows that repeat an id leave one row; rows without an id stay."""
    kept = near_dup.link(docs, *NEAR).filter("kept and doc_id is not null").select(F.col("doc_id").alias("_kept_id")).distinct()
    rest = docs.join(kept, F.col("doc_id") == F.col("_kept_id"), "left_semi").dropDuplicates(["doc_id"])
    return rest.unionByName(docs.filter("doc_id is null"))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document has. Texts that lose nothing stay as
    they are; what is left of the others is joined by one space; without a word left, a document
    that lost some goes."""
    return substring_dedup.cut_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in the ratio of their targets: a row for each pass that takes words of a document."""
    return mixing.mixed_documents(docs, mixing.mix(docs)[1])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 2048 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_duplicates), ("substring_dedup", drop_repeats),
          ("source_mix", mix_sources), ("packing", pack_sequences)]

# Trained scores, hashed sketches and token ids are beyond SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
