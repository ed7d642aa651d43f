"""Dimension tables from files, dictionary snapshots and kept partial sums (SRC12, LRN11, MET0)."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.learning import PATTERN_SCHEMA
from ..operators.metrics import PARTIAL_SCHEMA, merge

RULE_SCHEMA = "seq int, rule_seq int, keyword string, code string, confidence double, reason string"


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule list as CSV with the columns of RULE_SCHEMA; ``seq`` is the match order."""
    return spark.read.options(header=True, enforceSchema=False).schema(RULE_SCHEMA).csv(path)


def read_taxonomy(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, str]]:
    """SRC12: (codes with names, uncategorised overrides) from one YAML document of ``groups``.

    The file is a configuration of some dozen lines; it is read by one task and parsed there.
    """
    import pyarrow as pa

    from .. import tables

    text = spark.read.text(path, wholetext=True).first()["value"]
    data = _yaml(text)
    rows = [(str(g["code"]), str(g.get("name") or g.get("title") or ""), str(g["code"]).split("-")[0])
            for g in data.get("groups", []) if g.get("code")]
    frame = tables.frame(spark, [("code", pa.string()), ("name", pa.string()), ("kind", pa.string())], rows)
    return frame, dict(data.get("uncategorised") or {})


def _yaml(text: str) -> dict:
    try:
        import yaml
    except ImportError:
        # Without the YAML package the same document can be given as JSON.
        return json.loads(text)
    return yaml.safe_load(text) or {}


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Provider category mapping as written by ``sinks.write_json`` of AGG10."""
    return spark.read.schema(
        "provider_category string, code string, confidence double, matched_count bigint, "
        "total_count bigint, provenance string").json(path)


def read_patterns(spark: SparkSession, folder: str) -> DataFrame:
    """LRN11: the newest complete snapshot of the dictionary; an empty one if there is none."""
    versions = _versions(spark, folder)
    if not versions:
        return spark.createDataFrame([], PATTERN_SCHEMA)
    return spark.read.schema(PATTERN_SCHEMA).parquet(f"{folder.rstrip('/')}/{versions[-1]['path']}")


def write_patterns(patterns: DataFrame, folder: str, stream: str | None = None, batch: int | None = None) -> int:
    """LRN11: writes the next snapshot next to the old ones and returns its number.

    The rows go to a folder of their own that no reader looks at; a manifest written last, never
    over another, makes them the next version. A writer that dies before leaves nothing, and of
    two that want the same number one fails. With ``stream`` and ``batch`` the manifest also says which
    micro-batch it holds, see ``committed``.
    """
    spark, root = patterns.sparkSession, folder.rstrip("/")
    versions = _versions(spark, folder)
    number = versions[-1]["version"] + 1 if versions else 1
    path = f"data/{uuid.uuid4().hex}"
    patterns.write.mode("errorifexists").parquet(f"{root}/{path}")
    done = versions[-1].get("batches", {}) if versions else {}
    if stream is not None:
        done = {**done, stream: batch}
    text = json.dumps({"version": number, "path": path, "batches": done})
    system, at = _hadoop(spark, f"{root}/manifest/{number:010d}.json")
    out = system.create(at, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    return number


def committed(spark: SparkSession, folder: str, stream: str, batch: int) -> bool:
    """Whether a snapshot holds this micro-batch of a stream, or a later one. Every manifest carries the
    last batch of each stream on, so the newest one knows."""
    versions = _versions(spark, folder)
    return bool(versions) and versions[-1].get("batches", {}).get(stream, -1) >= batch


def snapshot_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """LRN11: number of patterns and total usage of the newest snapshot."""
    return read_patterns(spark, folder).agg(
        F.count(F.lit(1)).alias("total_patterns"), F.coalesce(F.sum("usage_count"), F.lit(0)).alias("total_usage"),
        F.max("last_used").alias("last_used"))


def write_partials(parts: DataFrame, folder: str, batch: str) -> bool:
    """MET0: adds the partial sums of one batch of transactions, unless the batch is there already.

    The rows go to a folder of their own; a marker written last, never over another, makes them
    count. A writer that dies before leaves nothing that is read, and a batch that comes again adds
    nothing. What was added before is neither read nor written.
    """
    if not re.fullmatch(r"[A-Za-z0-9_-]+", batch):
        raise ValueError(f"batch name {batch!r} is not made of letters, digits, _ and -")
    spark, root = parts.sparkSession, folder.rstrip("/")
    system, at = _hadoop(spark, f"{root}/done/{batch}.txt")
    if system.exists(at):
        if _finished(spark, f"{root}/done/{batch}.txt"):
            return False
        system.delete(at, False)
    path = f"data/{uuid.uuid4().hex}"
    parts.write.mode("errorifexists").parquet(f"{root}/{path}")
    out = system.create(at, False)
    try:
        out.write(bytearray(path, "utf-8"))
    finally:
        out.close()
    return True


def _finished(spark: SparkSession, markers: str) -> list[str]:
    named = spark.read.text(markers).filter(F.col("value").rlike("^data/[0-9a-f]{32}$"))
    return sorted(r.value for r in named.collect())


def read_partials(spark: SparkSession, folder: str) -> DataFrame:
    """MET0: the partial sums of all batches of a folder added up; no rows if there are none. A
    marker that was cut off names no folder and counts as absent, so its batch is taken again."""
    root = folder.rstrip("/")
    system, at = _hadoop(spark, f"{root}/done/*.txt")
    if not system.globStatus(at):
        return spark.createDataFrame([], PARTIAL_SCHEMA)
    paths = [f"{root}/{p}" for p in _finished(spark, f"{root}/done")]
    if not paths:
        return spark.createDataFrame([], PARTIAL_SCHEMA)
    return merge(spark.read.parquet(*paths))


def _hadoop(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _versions(spark: SparkSession, folder: str) -> list[dict]:
    """Finished snapshots in order: those with a manifest, and those of older form, whose folders have a
    success marker. A manifest that was cut off is none."""
    root = folder.rstrip("/")
    system, at = _hadoop(spark, f"{root}/version=*/_SUCCESS")
    old = [f.getPath().getParent().getName() for f in system.globStatus(at) or []]
    found = [{"version": int(name.split("=")[1]), "path": name} for name in old]
    system, at = _hadoop(spark, f"{root}/manifest/*.json")
    names = [f.getPath().getName() for f in system.globStatus(at) or []]
    # Only the newest that can be read matters.
    for name in sorted(names, reverse=True):
        try:
            made = json.loads("\n".join(r.value for r in spark.read.text(f"{root}/manifest/{name}").collect()))
        except ValueError:
            continue
        found.append(made)
        break
    return sorted(found, key=lambda v: v["version"])
