"""Unified view of batch and real-time weather.

The stream writes each micro-batch into a real-time store under its ``batch_id``, so a replayed
batch replaces itself. The view is always derived from batch table and store together, never
from the current micro-batch alone, and only the months a batch touched are rewritten.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce
from hashlib import md5

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from assaymill.operators.clean import latest_by_key
from assaymill.sources.loads import MISSING, read_if_exists
from assaymill.sources.tables import write_table
from assaymill.sources.versions import Folder

KEYS = ("city_name", "unix_timestamp")
PARTS = ("year", "month")
#: Batch id of compacted rows.
COMPACTED = -1


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that a streaming query keeps in its checkpoint; None where there is none yet."""
    folder = Folder(spark, checkpoint)
    if not any(name == "metadata" for name, _, _ in folder.entries()):
        return None
    return json.loads(folder.read("metadata"))["id"]


def unify(
    batch: DataFrame | None, realtime: DataFrame, keys: Sequence[str] = KEYS
) -> DataFrame:
    """One row per key: the batch row if there is one, else the latest micro-batch's row.

    Frames are aligned on the columns of ``realtime``; column ``origin`` tells the side.
    """
    order_col = "batch_id" if "batch_id" in realtime.columns else None
    columns = [c for c in realtime.columns if c != "batch_id"]
    arrival = F.col(order_col).cast("bigint") if order_col else F.lit(0).cast("bigint")
    rows = realtime.select(
        *columns, F.lit("stream").alias("origin"), F.lit(0).alias("_side"), arrival.alias("_at")
    )
    if batch is not None:
        rows = rows.unionByName(
            batch.select(
                *columns,
                F.lit("batch").alias("origin"),
                F.lit(1).alias("_side"),
                F.lit(0).cast("bigint").alias("_at"),
            )
        )
    rest = [F.col(c).desc_nulls_last() for c in columns if c not in keys]
    newest = [F.col("_side").desc(), F.col("_at").desc(), *rest]
    return latest_by_key(rows, keys, newest).drop("_side", "_at")


def _month_path(root: str, month: Row) -> str:
    """Folder of one month; a missing time has Hive's default partition name."""
    named = {p: "__HIVE_DEFAULT_PARTITION__" if month[p] is None else month[p] for p in PARTS}
    return "/".join([root, *[f"{p}={v}" for p, v in named.items()]])


def _read_months(spark: SparkSession, root: str, months: Sequence[Row]) -> DataFrame | None:
    """The given months of a partitioned table; no other folder is listed."""
    found = []
    for month in months:
        try:
            found.append(
                spark.read.option("basePath", root).parquet(_month_path(root, month))
            )
        except AnalysisException as e:
            if e.getCondition() not in MISSING:
                raise
    return reduce(DataFrame.unionByName, found) if found else None


class UnifiedView:
    """The store, the batch table and the published view of one unified table.

    The store is laid out by month, then ``batch_id``.
    """

    def __init__(
        self, batch_path: str, store_path: str, view_path: str, keys: Sequence[str] = KEYS
    ):
        self.batch_path, self.store_path, self.view_path = batch_path, store_path, view_path
        self.keys = tuple(keys)

    def store(self, micro_batch: DataFrame, batch_id: int, path: str | None = None) -> None:
        """Put a micro-batch into the real-time store, replacing an earlier attempt."""
        (
            micro_batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTS, "batch_id")
            .parquet(path or self.store_path)
        )

    def current(self, spark: SparkSession) -> DataFrame | None:
        """The view as batch and store stand now, without publishing it."""
        batch, realtime = (read_if_exists(spark, p) for p in (self.batch_path, self.store_path))
        return batch if realtime is None else unify(batch, realtime, self.keys)

    def publish(self, spark: SparkSession, months: Sequence[Row]) -> None:
        """Rewrite the given months of the view from batch table and store."""
        realtime = _read_months(spark, self.store_path, months)
        if realtime is not None:
            batch = _read_months(spark, self.batch_path, months)
            write_table(unify(batch, realtime, self.keys), self.view_path, PARTS)

    def on_micro_batch(self, micro_batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` callback; safe to run again with the same batch.

        The batch is read twice, so it is kept while the callback runs: decoding and stateful
        steps before it are not repeated. The months it touches are a handful of rows.
        """
        micro_batch = micro_batch.persist()
        try:
            months = micro_batch.select(*PARTS).distinct().collect()
            if months:
                self.store(micro_batch, batch_id)
                self.publish(micro_batch.sparkSession, months)
        finally:
            micro_batch.unpersist()

    def compact_store(self, spark: SparkSession, target: str) -> None:
        """Merge all micro-batches into one per month in a sibling folder.

        Each key keeps its latest row under the id ``COMPACTED``, which no micro-batch has and
        which sorts before all of them. A batch that is replayed on ``target`` so adds its rows
        beside the merged ones and replaces none of them.
        """
        realtime = read_if_exists(spark, self.store_path)
        if realtime is None:
            return
        self.store(unify(None, realtime, self.keys).drop("origin"), COMPACTED, target)

    def _first_batch(self, spark: SparkSession, checkpoint: str) -> int:
        """The store's id for batch 0 of a checkpoint, kept in a folder name beside the data.

        A checkpoint is known by the query id in it, so one that was lost and began anew at the same
        path is another one; before a query ran, by its path.
        """
        path = spark._jvm.org.apache.hadoop.fs.Path
        runs = path(f"{self.store_path}/_runs")
        system = runs.getFileSystem(spark._jsc.hadoopConfiguration())
        system.mkdirs(runs)
        known_by = query_id(spark, checkpoint) or checkpoint.rstrip("/")
        run = md5(known_by.encode()).hexdigest()
        for status in system.listStatus(runs):
            name, _, first = status.getPath().getName().partition("-")
            if name == run:
                return int(first)
        stored = read_if_exists(spark, self.store_path)
        last = stored.agg(F.max("batch_id").alias("last")).first()["last"] if stored is not None else None
        first = 0 if last is None else max(last, COMPACTED) + 1
        system.mkdirs(path(f"{self.store_path}/_runs/{run}-{first}"))
        return first

    def run(
        self,
        stream: DataFrame,
        checkpoint: str,
        trigger: dict | None = None,
        wait: bool = True,
    ):
        """Start the stream of conformed rows into store and view.

        The trigger interval also sets how often touched months are rewritten. A checkpoint
        that this store hasn't seen counts its batches from 0 again; they are stored after those
        that are there, so a lost checkpoint overwrites nothing.
        """
        first: list[int] = []

        def stored(df: DataFrame, batch_id: int) -> None:
            # The query has written its id by now; at its start it may not have.
            if not first:
                first.append(self._first_batch(df.sparkSession, checkpoint))
            self.on_micro_batch(df, first[0] + batch_id)

        query = (
            stream.writeStream.foreachBatch(stored)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
        if wait:
            try:
                query.awaitTermination()
            finally:
                query.stop()
        return query
