"""Documents of runs, found through the run index (SRC9-SRC11, SNK3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import api_json
from .files import list_files, relative_to

# fixed values: index columns of the two kinds of documents
TRANSACTIONS, REPORTS = "tx_files", "affordability_files"


def listed_documents(index: DataFrame) -> DataFrame:
    """Rows (run_id, kind, seq, relative_path): the transaction and report files the index lists,
    ``seq`` being a path's place among its run's distinct paths of that kind in path order."""
    out = None
    for kind in (TRANSACTIONS, REPORTS):
        paths = F.array_sort(F.array_distinct(F.coalesce(kind, F.array().cast("array<string>"))))
        rows = index.filter(F.coalesce("run_id", F.lit("")) != "").select("run_id", F.lit(kind).alias("kind"), F.posexplode(paths).alias("seq", "relative_path"))
        out = rows if out is None else out.unionByName(rows)
    return out


def run_documents(spark: SparkSession, root: str, index: DataFrame, glob: str = "*.json") -> DataFrame:
    """The listed documents with their text: run_id, kind, seq, relative_path, value. One read of the
    files below ``root`` that match ``glob``; files that the index does not list drop out in the
    join, whose keys (paths) are unique, so neither side can be skewed."""
    base = root.rstrip("/")
    texts = (spark.read.options(recursiveFileLookup=True, pathGlobFilter=glob).text(base, wholetext=True)
             .select("value", relative_to(base, F.col("_metadata.file_path")).alias("relative_path")))
    return listed_documents(index).join(texts, "relative_path")


def missing_documents(spark: SparkSession, root: str, index: DataFrame) -> DataFrame:
    """Listed paths without a file."""
    return listed_documents(index).join(list_files(spark, root).select("relative_path"), "relative_path", "left_anti")


def api_rows(documents: DataFrame) -> DataFrame:
    """SRC9: rows of the transaction documents as ``labels.label_transactions`` reads them."""
    docs = documents.filter(F.col("kind") == TRANSACTIONS)
    return api_json.api_transactions(docs.select("run_id", F.col("relative_path").alias("path"), "value"))


def _reports(documents: DataFrame) -> DataFrame:
    docs = documents.filter(F.col("kind") == REPORTS)
    return docs.select("run_id", F.col("seq").alias("report_seq"), F.col("relative_path").alias("report_path"), "value")


def report_rows(documents: DataFrame) -> DataFrame:
    """SRC10: report records with run, place of the report in its run, and path."""
    return api_json.report_records(_reports(documents))


def report_groups(documents: DataFrame) -> DataFrame:
    """SRC10: the totals the reports state."""
    return api_json.report_totals_raw(_reports(documents)).select("run_id", "report_path", "code", "total")
