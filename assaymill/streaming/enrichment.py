"""A stream joined with a stored table that may be replaced while the stream runs.

A plain stream-static join reads a path that its plan fixed at the start, with the join it chose
then. Here every micro-batch asks which version of the table stands, measures it if it is a new one,
and joins with that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.functions.timestamps import date_key
from assaymill.operators.joins import measured_bytes
from assaymill.session import BROADCAST_LIMIT_BYTES
from assaymill.streaming.merge_view import Batch, Sink, stream_into

VERSION = "static_version"


def columns_of(static: Batch, columns: Sequence[str]) -> Batch:
    """The same table, narrowed to some columns; its identity stays."""

    def found(spark: SparkSession) -> tuple[str, DataFrame | None]:
        version, df = static(spark)
        return version, None if df is None else df.select(*columns)

    return found


def no_batch(spark: SparkSession) -> tuple[str, None]:
    """For views that hold streamed rows only."""
    return "none", None


class StaticFollower:
    """Left join with the version of ``static`` that stands when a micro-batch is joined.

    ``static`` has one row per ``key``; so a micro-batch keeps its rows. It is broadcast while its
    measured size allows, which is looked at anew for each version. ``VERSION`` names the version
    a row met; before the table is there, rows pass without its columns.
    """

    def __init__(self, static: Batch, key: str, limit_bytes: int = BROADCAST_LIMIT_BYTES):
        self.static, self.key, self.limit_bytes = static, key, limit_bytes
        self._measured: tuple[str, bool] = ("", False)

    def join(self, micro_batch: DataFrame) -> DataFrame:
        version, table = self.static(micro_batch.sparkSession)
        if table is None:
            return micro_batch.withColumn(VERSION, F.lit(None).cast("string"))
        if self._measured[0] != version:
            self._measured = (version, measured_bytes(table) <= self.limit_bytes)
        table = F.broadcast(table) if self._measured[1] else table
        short = hashlib.md5(version.encode()).hexdigest()[:12]
        return micro_batch.join(table, self.key, "left").withColumn(VERSION, F.lit(short))

    def into(self, sink: Sink) -> Sink:
        """A sink that passes joined micro-batches on."""

        def joined(df: DataFrame, run_id: str, batch_id: int) -> object:
            return sink(self.join(df), run_id, batch_id)

        return joined


def run_enrichment(
    readings: DataFrame,
    daily_sales: Batch,
    sink: Sink,
    checkpoint: str,
    time_col: str = "datetime_utc",
    trigger: dict | None = None,
    wait: bool = True,
):
    """Readings with that calendar day's sales context, as the newest sales table has it."""
    stream = readings.withColumn("date_key", date_key(time_col))
    follower = StaticFollower(daily_sales, "date_key")
    return stream_into(stream, follower.into(sink), checkpoint, trigger, wait)
