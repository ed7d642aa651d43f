"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot above 1/HOT_SHARE of all rows and above MIN_ROWS rows. Whatever the data size
# there are fewer than HOT_SHARE hot keys; that bounds what is fetched and broadcast here.
HOT_SHARE = 2048
MIN_ROWS = 200_000


def hot_keys(counts: DataFrame, keys: list[str], n: str, min_rows: int | None = None) -> DataFrame | None:
    """Hot keys with the number of salts each needs, or None; ``counts`` has one row per key."""
    min_rows = MIN_ROWS if min_rows is None else min_rows
    known = counts.filter(_all_set(keys))
    total, most = known.agg(F.sum(n), F.max(n)).first()
    limit = max((total or 0) / HOT_SHARE, min_rows)
    if not most or most <= limit:
        return None
    rows = (known.filter(F.col(n) > limit)
            .select(*keys, F.ceil(F.col(n) / F.lit(limit)).cast("bigint").alias("_salts")))
    return counts.sparkSession.createDataFrame(rows.toArrow())


def attach(rows: DataFrame, per_key: DataFrame, keys: list[str], spread: list[str],
           how: str = "inner", counts: DataFrame | None = None, n: str = "_n",
           min_rows: int | None = None, hint: str | None = None) -> DataFrame:
    """Join ``rows`` to a table with one row per key; hot keys are salted.

    One small job asks first how many rows each key has (``counts`` with column ``n`` if the
    caller has them) and reads back only two numbers. Without hot keys this is a plain join,
    left to Catalyst and AQE. ``spread`` names columns that tell rows of one key apart (an id);
    the salt is a hash of them, so a task that runs twice gives the same salt. A ``hint`` says how the
    tables are joined; only the hot keys are broadcast then.
    """
    hinted = (lambda df: df.hint(hint)) if hint else (lambda df: df)
    if counts is None:
        counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    hot = hot_keys(counts, keys, n, min_rows)
    if hot is None:
        return rows.join(hinted(per_key), keys, how)
    hot = F.broadcast(hot)
    salts = F.coalesce(F.col("_salts"), F.lit(1).cast("bigint"))
    left = (rows.join(hot, keys, "left")
            .withColumn("_salt", F.pmod(F.xxhash64(*spread), salts)).drop("_salts"))
    right = (per_key.join(hot, keys, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
             .drop("_salts"))
    return left.join(hinted(right), [*keys, "_salt"], how).drop("_salt")


def _all_set(keys):
    c = F.lit(True)
    for k in keys:
        c = c & F.col(k).isNotNull()
    return c
