"""File inventory, manifest and run index (SRC13, SRC14, STR16, AGG17-AGG20)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.values import artefact_type, name_timestamp, path_included, run_of_path
from ..operators.skew import attach

CHUNK = 1024 * 1024


def list_files(spark: SparkSession, root: str, globs: list[str] | None = None) -> DataFrame:
    """SRC13: relative path, size and change time of every file below a root; no content is read."""
    base = root.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    out = files.select(relative_to(base, F.col("path")).alias("relative_path"), "path", F.col("length").alias("size_bytes"),
                       F.col("modificationTime").alias("modified_at"))
    return out.filter(path_included(F.col("relative_path"), globs)) if globs else out


def relative_to(root: str, path: Column) -> Column:
    """The path below a root, whatever scheme either is written with."""
    return F.regexp_extract(path, "^(?:[a-z0-9]+:)?/*" + _quote(root.rstrip("/").split(":")[-1].lstrip("/")) + "/(.*)$", 1)


def _quote(text: str) -> str:
    return r"\Q" + text + r"\E"


def _hash_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import hashlib

    from pyarrow import fs

    for batch in batches:
        sums = []
        for path in batch["path"]:
            system, inner = fs.FileSystem.from_uri(path)
            h = hashlib.sha256()
            with system.open_input_stream(inner) as f:
                while block := f.read(CHUNK):
                    h.update(block)
            sums.append(h.hexdigest())
        yield batch.assign(sha256=sums)


def manifest(spark: SparkSession, root: str, include_hash: bool = False) -> DataFrame:
    """SRC14: path and size per file, with a checksum on request.

    Files are hashed in blocks inside the tasks, so no file has to fit a row or memory.
    """
    files = list_files(spark, root).select("relative_path", "path", "size_bytes")
    if not include_hash:
        return files.drop("path")
    hashed = files.repartition("path").mapInPandas(
        _hash_files, "relative_path string, path string, size_bytes bigint, sha256 string")
    return hashed.drop("path")


# -- run index ------------------------------------------------------------------------------

# fixed values: index columns by artefact type
INDEX_COLUMNS = [
    ("tx_files", "StatementCapture/retrieve-transactions"),
    ("account_files", "StatementCapture/retrieve-accounts"),
    ("verify_files", "StatementCapture/verify-credentials"),
    ("affordability_files", "AffordabilityReports"),
    ("credit_assessment_files", "CreditAssessment"), ("loan_agreement_files", "LoanAgreement")]
FILES_PER_RECORD = 10_000


def classify_files(files: DataFrame) -> DataFrame:
    """STR15/STR16: adds run_id, artefact type and time; files less than three deep are left out."""
    name = F.element_at(F.split("relative_path", "/"), -1)
    return (files.withColumns({"run_id": run_of_path(F.col("relative_path")),
                               "artifact_type": artefact_type(F.col("relative_path")),
                               "created_at": F.coalesce(name_timestamp(name), "modified_at")})
            .filter(F.col("run_id").isNotNull()))


def inventory(files: DataFrame) -> DataFrame:
    """SNK3: the inventory rows, sorted for the sink."""
    return classify_files(files).select("run_id", "artifact_type", "relative_path", "size_bytes", "modified_at").orderBy(
        "run_id", "artifact_type", "relative_path")


def personas(documents: DataFrame) -> DataFrame:
    """SRC15: documents(run_id, relative_path, value) to the first name in path order per run."""
    from .api_json import persona_name

    named = documents.withColumn("persona", persona_name(F.col("value"))).filter(F.col("persona").isNotNull())
    return named.groupBy("run_id").agg(F.min_by("persona", "relative_path").alias("persona"))


def run_facts(files: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """AGG17: one narrow row per run: file counts, earliest time, report flag, persona."""
    known = [t for _, t in INDEX_COLUMNS]
    t = F.col("artifact_type")
    runs = classify_files(files).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("files"), *[F.count_if(t == v).alias(c) for c, v in INDEX_COLUMNS],
        F.count_if(~t.isin(*known)).alias("other_files"), F.min("created_at").alias("run_created_at"))
    runs = runs.withColumn("has_affordability_report", F.col("affordability_files") > 0)
    if names is None:
        return runs.withColumn("persona", F.lit(None).cast("string"))
    return runs.join(names, "run_id", "left")


def run_index(files: DataFrame, names: DataFrame | None = None, per_record: int = FILES_PER_RECORD) -> DataFrame:
    """AGG17: index records with path lists by type, in the shape of the JSON lines.

    A run with very many files is written as several records (part, parts), so no record
    outgrows a row.
    """
    facts = run_facts(files, names)
    parts = facts.select("run_id", F.ceil(F.col("files") / per_record).cast("int").alias("parts"),
                         F.col("files").alias("_n"))
    rows = attach(classify_files(files).select("run_id", "artifact_type", "relative_path"), parts.drop("_n"),
                  ["run_id"], ["relative_path"], counts=parts)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("relative_path"), "parts").cast("int"))
    by_type = rows.groupBy("run_id", "part", "parts", "artifact_type").agg(
        F.array_sort(F.collect_list("relative_path")).alias("p"))
    maps = by_type.groupBy("run_id", "part", "parts").agg(F.map_from_entries(F.array_sort(
        F.collect_list(F.struct("artifact_type", "p")))).alias("paths"))
    known = [t for _, t in INDEX_COLUMNS]
    none = F.array().cast("array<string>")
    other = F.array_sort(F.flatten(F.map_values(F.map_filter("paths", lambda k, _: ~k.isin(*known)))))
    lists = {c: F.coalesce(F.try_element_at("paths", F.lit(t)), none) for c, t in INDEX_COLUMNS}
    return maps.withColumns({**lists, "other_files": other, "run_prefix": F.concat(F.lit("demo/"), "run_id", F.lit("/"))}).join(
        facts.select("run_id", "persona", "run_created_at", "has_affordability_report"), "run_id")


def index_summary(facts: DataFrame) -> DataFrame:
    """AGG18: one row of run counts."""
    return facts.agg(
        F.count(F.lit(1)).alias("run_count"), F.count_if("has_affordability_report").alias("runs_with_affordability"),
        F.count_if(F.col("tx_files") > 0).alias("runs_with_transactions"),
        F.count_if(F.col("tx_files") == 0).alias("runs_missing_transactions"), F.count("persona").alias("persona_available"))


def artefact_counts(files: DataFrame) -> DataFrame:
    """AGG18: files per artefact type."""
    return classify_files(files).groupBy("artifact_type").agg(F.count(F.lit(1)).alias("n"))


# fixed values: weight of an artefact for the completeness of a run, in hundredths
COMPLETENESS = [("tx_files", 40), ("affordability_files", 40), ("verify_files", 10),
                ("account_files", 5), ("credit_assessment_files", 5)]
TX_PER_FILE = 500


def run_quality(facts: DataFrame) -> DataFrame:
    """AGG19: completeness in hundredths and the estimated number of transactions."""
    score: Column = F.lit(0)
    for c, weight in COMPLETENESS:
        score = score + F.when(F.col(c) > 0, weight).otherwise(0)
    return facts.withColumns({"completeness": score, "estimated_transactions": F.col("tx_files") * TX_PER_FILE})


def best_runs(quality: DataFrame, n: int = 5) -> DataFrame:
    """TOP3: the best runs per persona by completeness, then size, then id."""
    w = W.partitionBy("persona").orderBy(F.desc("completeness"), F.desc("estimated_transactions"), F.asc("run_id"))
    return quality.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def persona_summary(quality: DataFrame) -> DataFrame:
    """AGG20: one row per persona with its best runs."""
    q = quality.withColumn("persona", F.coalesce("persona", F.lit("unknown")))
    top = best_runs(q).groupBy("persona").agg(F.array_sort(F.collect_list(F.struct(
        "rank", "run_id", "estimated_transactions", "completeness", "has_affordability_report", "run_created_at"))).alias("best_runs"))
    sums = q.groupBy("persona").agg(
        F.count(F.lit(1)).alias("run_count"), F.sum("estimated_transactions").alias("estimated_transactions"),
        F.round(F.sum("completeness") / F.count(F.lit(1)) / 100, 3).alias("avg_completeness"),
        F.count_if("has_affordability_report").alias("runs_with_affordability"),
        F.min("run_created_at").alias("first_run"), F.max("run_created_at").alias("last_run"))
    return sums.join(top, "persona")
