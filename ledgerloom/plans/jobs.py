"""End-to-end jobs. Each is one Spark plan over all customers; stages that are read more than
once are written to a shared folder first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CascadeParams, MetricParams
from ..functions.text import merchant_pattern
from ..functions.values import cents
from ..operators import cascade, filters, labels, learning, metrics, transfers
from ..operators.rules import RuleBook
from ..operators.stage import written
from ..sources import api_json, files, runs as run_files, sinks


def categorise(tx: DataFrame, rules: RuleBook | DataFrame | None = None, mapping: DataFrame | None = None,
               learn_accounts: bool = False, params: CascadeParams = CascadeParams()) -> DataFrame:
    """CLS13: scored statement rows with category names."""
    flag = None
    if learn_accounts:
        tx, flag = transfers.flag_own_transfers(tx), "is_own_transfer"
    out = cascade.categorize(tx, rules, None, mapping, params, flag)
    return cascade.statement_output(out)


def categorise_card(card: DataFrame, mapping: DataFrame | None = None, patterns: DataFrame | None = None) -> DataFrame:
    """CLS14: card rows with their pattern and the hybrid cascade's category."""
    tx = card.withColumns({
        "cents": cents(F.col("amount")), "pattern": merchant_pattern(F.col("description")),
        "provider_category": F.lit(None).cast("string"), "third_party": F.lit(None).cast("string")})
    if patterns is not None:
        tx = learning.lookup_patterns(tx, patterns)
    return cascade.categorize_hybrid(tx, mapping)


def customer_metrics(tx: DataFrame, rules: RuleBook | DataFrame | None = None, mapping: DataFrame | None = None,
                     accounts: DataFrame | None = None, params: MetricParams = MetricParams()) -> DataFrame:
    """Categorise, write the partial sums, then all metrics of all customers."""
    categorised = cascade.categorize(tx, rules, None, mapping).select(*metrics.REQUIRED)
    return metrics.customer_metrics(categorised, accounts, params)


def labelled_dataset(api: DataFrame, records: DataFrame, groups: DataFrame, runs: DataFrame,
                     taxonomy: DataFrame | None = None, overrides: DataFrame | None = None) -> dict[str, DataFrame]:
    """DST4: dataset, coverage, reconciliation and splits of all runs together.

    Rows that fail validation are ``rejected`` with a reason. With a taxonomy the default codes
    come from it (``default_codes`` says whether one is the fallback) and ``unknown_codes`` lists
    labels outside it. ``runs`` with ``has_affordability_report`` tells which runs have a report.
    """
    good, rejected = filters.validate_api_rows(api)
    codes = labels.default_codes(taxonomy, overrides) if taxonomy is not None else None
    dataset = written(labels.label_transactions(good, records, labels.as_defaults(codes) if codes is not None else None))
    splits = labels.persona_splits(runs)
    reports = runs.filter("has_affordability_report") if "has_affordability_report" in runs.columns else None
    more = {} if codes is None else {"default_codes": codes, "unknown_codes": labels.check_labels(dataset, records, taxonomy)}
    return {"dataset": dataset, "rejected": rejected, **more, "coverage": labels.coverage(dataset, records, reports),
            "reconciliation": labels.reconcile(dataset, groups), "splits": splits,
            "manifest": labels.split_manifest(splits), "split_personas": labels.split_personas(splits)}


def index_folder(spark: SparkSession, root: str, out: str) -> DataFrame:
    """AGG17/SNK3: the run index of a folder of artefacts, written below ``out`` and read again. Names
    of customers come from the documents of verified credentials."""
    found = written(files.list_files(spark, root))
    verified = files.classify_files(found).filter(F.col("artifact_type") == dict(files.INDEX_COLUMNS)["verify_files"]).select("run_id", "relative_path")
    texts = (spark.read.options(recursiveFileLookup=True, pathGlobFilter="*.json").text(root.rstrip("/"), wholetext=True)
             .select("value", files.relative_to(root, F.col("_metadata.file_path")).alias("relative_path")))
    sinks.write_run_index(found, out, files.personas(verified.join(texts, "relative_path")))
    return api_json.read_run_index(spark, out + "/runs")


def dataset_from_files(spark: SparkSession, root: str, index: DataFrame, taxonomy: DataFrame | None = None,
                       overrides: DataFrame | None = None, glob: str = "*.json") -> dict[str, DataFrame]:
    """DST4 from raw files: the documents that ``index`` (``read_run_index``) lists below ``root``, to what
    ``labelled_dataset`` gives; besides, ``rejected_documents`` (run, path, reason) that are not JSON
    and ``missing_documents`` that are listed and not there. Neither ends the job.

    Files are read once, and their documents parsed once for their rows, where a shared folder takes
    the texts and the rows. A report's place among its run's paths orders its records, so the label of a
    key with conflicts does not depend on tasks.
    """
    docs = written(run_files.run_documents(spark, root, index, glob))
    # A scan deals files by size, so documents of one kind are in the same few tasks; they are dealt anew.
    dealt = docs.repartition("relative_path")
    api, records = written(run_files.api_rows(dealt)), written(run_files.report_rows(dealt))
    out = labelled_dataset(api, records, run_files.report_groups(docs), index, taxonomy, overrides)
    return {**out, "rejected_documents": api_json.rejected_documents(docs), "missing_documents": run_files.missing_documents(spark, root, index)}


def dataset_from_folder(spark: SparkSession, root: str, out: str, taxonomy: DataFrame | None = None,
                        overrides: DataFrame | None = None) -> dict[str, DataFrame]:
    """From a folder of artefacts, ``group/run/kind/file``, to the dataset; the index is written below ``out``."""
    return dataset_from_files(spark, root, index_folder(spark, root, out), taxonomy, overrides)
