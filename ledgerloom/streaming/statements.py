"""Categorising statement files as they arrive. The operators are those of the batch jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor

from ..config import MetricParams
from ..operators import cascade, learning, metrics, series
from ..operators.rules import RuleBook
from ..sources.tables import committed, read_patterns, write_partials, write_patterns

# Setting and value for streams with state of their own.
ROCKSDB = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

TX_SCHEMA = ("tx_id string, customer_id bigint, tx_date date, description string, cents bigint, "
             "provider_category string, third_party string")


def statement_stream(spark: SparkSession, folder: str, schema: str = TX_SCHEMA, max_files: int = 1000) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(folder)


def categorise_stream(stream: DataFrame, rules: RuleBook | None = None, mapping: DataFrame | None = None) -> DataFrame:
    """CLS8 on a stream: stateless, so every row leaves with its own micro-batch."""
    return cascade.categorize(stream, rules, None, mapping)


def daily_totals_stream(stream: DataFrame, late: str = "40 days") -> DataFrame:
    """STX2: total per customer and day, final once the newest row is ``late`` past that day; rows
    that come later than that are left out. In append mode each day leaves once, so the state
    holds only open days. ``monthly_totals`` of what was written gives AGG1."""
    timed = (stream.filter(F.col("tx_date").isNotNull()).withColumn("at", F.timestamp_seconds(F.unix_date("tx_date").cast("bigint") * 86_400))
             .withWatermark("at", late))
    days = timed.groupBy("customer_id", F.window("at", "1 day").alias("day")).agg(F.sum("cents").alias("total"))
    return days.select("customer_id", F.date_from_unix_date(F.floor(F.unix_seconds("day.start") / 86_400).cast("int")).alias("tx_date"), "total")


def monthly_totals(daily: DataFrame) -> DataFrame:
    """STX2/AGG1: monthly totals of the days that are final."""
    return series.monthly_totals(daily, cents="total")


def learn_stream(reviewed: DataFrame, folder: str, checkpoint: str, stream: str | None = None) -> DataStreamWriter:
    """LRN2 per micro-batch: reviewed(seq, description, category, confidence, source) grows the
    dictionary; each batch writes the next snapshot.

    A snapshot names the batch it holds. A batch that comes again, because the query died between the
    snapshot and its own checkpoint, finds itself there and changes nothing. ``stream`` names the
    stream among those that feed one dictionary; batch ids count per checkpoint, so by default
    that is its name.
    """
    name = stream or checkpoint

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if not committed(spark, folder, name, number) and not batch.isEmpty():
            write_patterns(learning.upsert_patterns(read_patterns(spark, folder), batch), folder, name, number)

    return reviewed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def partials_stream(categorised: DataFrame, folder: str, checkpoint: str, stream: str = "stream",
                    params: MetricParams = MetricParams()) -> DataStreamWriter:
    """MET0 on a stream: each micro-batch of categorised rows adds its partial sums to ``folder``, once however
    often it comes; ``metrics.metrics_at(tables.read_partials(...))`` has the metrics of all that came.
    ``stream`` names the stream among those that feed one folder."""

    def add(batch: DataFrame, number: int) -> None:
        write_partials(metrics.partials(batch, params), folder, f"{stream}-{number}")

    return categorised.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)


DAY_MS = 86_400_000
CORRECTED = "customer_id bigint, tx_date date, kind string, version int, total bigint, rows bigint"


class DayTotals(StatefulProcessor):
    """One customer's day. It is emitted ``delay`` days after its end, by a timer; each later batch with
    rows of it emits a correction; ``horizon`` days after its end its state goes, and what still
    comes is told as dropped, with its sum and count."""

    def __init__(self, delay: int, horizon: int):
        self.delay, self.horizon = delay, horizon

    def init(self, handle) -> None:
        self.handle = handle
        self.day = handle.getValueState("day", "total bigint, rows bigint, version int")

    def _out(self, key, kind, version, total, rows) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"customer_id": [key[0]], "tx_date": [key[1]], "kind": [kind], "version": pd.array([version], dtype="Int32"), "total": [total], "rows": [rows]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end = ((key[1] - dt.date(1970, 1, 1)).days + 1) * DAY_MS
        total, n = 0, 0
        for frame in rows:
            total, n = total + int(frame["cents"].sum()), n + int(frame["cents"].count())
        # The watermark lies ``horizon`` behind the newest row.
        mark = timerValues.getCurrentWatermarkInMs()
        known = self.day.get() if self.day.exists() else None
        if known is None and mark > end:
            yield from self._out(key, "dropped", None, total, n)
            return
        if known is None:
            self.handle.registerTimer(max(end + (self.delay - self.horizon) * DAY_MS, 1))
            self.handle.registerTimer(end + 1)
        before, seen, version = known or (0, 0, 0)
        if version:
            version += 1
            yield from self._out(key, "correction", version, before + total, seen + n)
        self.day.update((before + total, seen + n, version))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.day.exists():
            return
        total, n, version = self.day.get()
        if not version:
            self.day.update((total, n, 1))
            yield from self._out(key, "total", 1, total, n)
        if expiredTimerInfo.getExpiryTimeInMs() > ((key[1] - dt.date(1970, 1, 1)).days + 1) * DAY_MS:
            self.day.clear()

    def close(self) -> None:
        pass


def corrected_totals_stream(stream: DataFrame, delay: int = 3, horizon: int = 40) -> DataFrame:
    """STX2 with corrections: rows (customer_id, tx_date, kind, version, total, rows) per customer and day.

    ``total`` leaves once the newest row is ``delay`` days past the day; a row that comes later, up to
    ``horizon`` days, leaves a ``correction`` with the new total and the next version, in whatever
    order files arrive; what comes after that leaves as ``dropped``, with its sum and number, and
    changes nothing. Rows without a date are left out. State holds the days within the horizon. The
    session needs the RocksDB state store (``ROCKSDB``).
    """
    timed = (stream.filter(F.col("tx_date").isNotNull()).withColumn("at", F.timestamp_seconds(F.unix_date("tx_date").cast("bigint") * 86_400))
             .withWatermark("at", f"{horizon} days"))
    # Without the timed column the operator gets late rows too, and can tell them.
    rows = timed.select("customer_id", "tx_date", F.coalesce("cents", F.lit(0)).alias("cents"))
    return rows.groupBy("customer_id", "tx_date").transformWithStateInPandas(DayTotals(delay, horizon), CORRECTED, "append", "eventtime")


def newest_totals(emitted: DataFrame) -> DataFrame:
    """The last word on every day: (customer_id, tx_date, total)."""
    return (emitted.filter(F.col("kind") != "dropped").groupBy("customer_id", "tx_date").agg(F.max_by("total", "version").alias("total")))
