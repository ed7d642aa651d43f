"""Writers (SNK1-SNK3). Every one writes in parallel, one file per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import artefact_counts, index_summary, inventory, run_facts, run_index


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats without nesting."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
                       for f in df.schema])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK1: CSV with header."""
    flat(df).write.mode(mode).options(header=True, escape='"').csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK2: one JSON object per line."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", by: list[str] | None = None) -> None:
    """The format for tables that later jobs read."""
    (df.write.mode(mode).partitionBy(*by) if by else df.write.mode(mode)).parquet(path)


def write_run_index(files: DataFrame, folder: str, names: DataFrame | None = None) -> None:
    """SNK3: run index, summary, artefact counts and inventory."""
    write_json(run_index(files, names), f"{folder}/runs")
    write_json(index_summary(run_facts(files, names)), f"{folder}/runs_summary")
    write_json(artefact_counts(files), f"{folder}/artifact_counts")
    write_csv(inventory(files), f"{folder}/file_inventory")
