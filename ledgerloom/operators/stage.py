"""Written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str | None:
    """The folder all executors see, as the session or the cluster names it."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The same rows from a written table, so that later passes do not repeat the plan and a
    lost executor costs only its own tasks. Without a shared folder the plan is used as it is."""
    folder = folder or shared_folder(df.sparkSession)
    if not folder:
        return df
    path = f"{folder.rstrip('/')}/ledgerloom/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that every row works out once. A filter on a plain column is moved below the
    projection, a copy of the whole expression at each place that names it; it does not pass the
    generator that stands here."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
