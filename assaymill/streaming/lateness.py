"""Rows that come too late, counted and kept aside instead of dropped in silence.

``LateLedger`` splits each micro-batch by a watermark of its own: the latest event time of all earlier
micro-batches less the delay. It is stored with the results, so it outlives a lost checkpoint. For
every micro-batch ``read = kept + late + untimed`` holds, and late rows are in a side table.

``DroppedRows`` counts what Spark's own stateful operators drop, where those are used.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from assaymill.sources.versions import Folder
from assaymill.streaming.merge_view import Sink, run_number, stream_into

ACCOUNT = (
    "run int, batch bigint, read bigint, kept bigint, late bigint, untimed bigint, "
    "before bigint, after bigint, folder string"
)
REASON, MARK = "_late_reason", "_watermark"


class LateLedger:
    """Accounts and late rows below ``root``; one query writes at a time.

    A micro-batch is closed by a marker that appears whole and once, after its rows were delivered. A
    replay before that repeats the same split, one after it finds the marker and splits by the
    watermark noted there; the sink ignores what it holds already. Rows without an event time can't
    be placed in time and go to the side table too.
    """

    def __init__(self, root: str, time_col: str, delay: str = "2 hours"):
        self.root, self.time_col, self.delay = root.rstrip("/"), time_col, delay

    def _markers(self, spark: SparkSession) -> tuple[Folder, list[str]]:
        marks = Folder(spark, f"{self.root}/marks")
        return marks, sorted(name for name, _, _ in marks.entries() if name.endswith(".json"))

    def deliver(self, micro_batch: DataFrame, sink: Sink, run_id: str, batch_id: int) -> None:
        """Give the rows in time to ``sink``, store the others, close the account."""
        spark = micro_batch.sparkSession
        run = run_number(spark, self.root, run_id)
        marks, names = self._markers(spark)
        own = f"-{run:06d}-{batch_id:012d}.json"
        done = next((name for name in names if name.endswith(own)), None)
        if done:
            before = json.loads(marks.read(done))["before"]
        else:
            before = json.loads(marks.read(names[-1]))["after"] if names else None
        # Read for the account, the late rows and the sink; nothing of it is needed later.
        micro_batch = micro_batch.persist()
        try:
            time = F.unix_micros(F.col(self.time_col).cast("timestamp"))
            late = F.lit(False) if before is None else time < before
            if not done:
                account = self._account(micro_batch, time, late, before)
                account |= {"run": run, "batch": batch_id, "folder": None}
                if account["late"] + account["untimed"]:
                    account["folder"] = f"{run:06d}-{batch_id:012d}-{uuid.uuid4().hex[:8]}"
                    self._keep_aside(micro_batch, time, late, before, account["folder"])
            sink(micro_batch.filter(time.isNotNull() & ~late), run_id, batch_id)
            if not done:
                number = int(names[-1].partition("-")[0]) + 1 if names else 1
                marker = account | {"schema": json.loads(micro_batch.schema.json())}
                if not marks.put_if_absent(f"{number:012d}{own}", json.dumps(marker)):
                    raise RuntimeError(f"another query writes to {self.root}")
        finally:
            micro_batch.unpersist()

    def _account(self, df: DataFrame, time, late, before: int | None) -> dict:
        latest = F.max(F.col(self.time_col).cast("timestamp"))
        found = df.agg(
            F.count(F.lit(1)).alias("read"),
            F.count(F.when(time.isNotNull() & ~late, 1)).alias("kept"),
            F.count(F.when(late, 1)).alias("late"),
            F.count(F.when(time.isNull(), 1)).alias("untimed"),
            F.unix_micros(latest - F.expr(f"INTERVAL {self.delay}")).alias("after"),
        ).first()
        account = found.asDict() | {"before": before}
        account["after"] = max((t for t in (before, found["after"]) if t is not None), default=None)
        return account

    def _keep_aside(self, df: DataFrame, time, late, before: int | None, folder: str) -> None:
        reason = F.when(time.isNull(), "no time").otherwise("late")
        mark = F.timestamp_micros(F.lit(before).cast("bigint"))
        aside = df.filter(time.isNull() | late).withColumns({REASON: reason, MARK: mark})
        aside.write.parquet(f"{self.root}/late/folder={folder}")

    def run(
        self,
        stream: DataFrame,
        sink: Sink,
        checkpoint: str,
        trigger: dict | None = None,
        wait: bool = True,
    ):
        """Start a stream whose rows in time go to ``sink``."""

        def on_batch(df: DataFrame, run_id: str, batch_id: int) -> None:
            self.deliver(df, sink, run_id, batch_id)

        return stream_into(stream, on_batch, checkpoint, trigger, wait)

    def accounts(self, spark: SparkSession) -> DataFrame:
        """One row per closed micro-batch; ``before`` and ``after`` are watermarks in microseconds."""
        if not self._markers(spark)[1]:
            return spark.createDataFrame([], ACCOUNT)
        return spark.read.schema(ACCOUNT).json(f"{self.root}/marks")

    def late_rows(self, spark: SparkSession) -> DataFrame | None:
        """The side table: rows of closed micro-batches, with the reason and the watermark they missed.

        Folders of attempts that were not closed are left out. None before the first micro-batch.
        """
        marks, names = self._markers(spark)
        if not names:
            return None
        schema = T.StructType.fromJson(json.loads(marks.read(names[-1]))["schema"])
        schema = T.StructType([*schema.fields, T.StructField(REASON, T.StringType()),
                               T.StructField(MARK, T.TimestampType())])
        if not Folder(spark, f"{self.root}/late").entries():
            return spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField("folder", T.StringType())])
        closed = self.accounts(spark).select("folder")
        rows = spark.read.schema(stored).parquet(f"{self.root}/late")
        return rows.join(closed, "folder", "left_semi").select(*schema.fieldNames())


class DroppedRows(StreamingQueryListener):
    """Rows read and dropped by stateful operators, per query id, over restarts of this session.

    ``late`` rows were behind the watermark, ``repeated`` ones had a key that was there already, so
    ``read - late - repeated`` rows went on from a query with one stateful operator.
    """

    def __init__(self):
        self.totals: dict[str, Counter] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.totals.setdefault(str(event.id), Counter())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        total = self.totals.setdefault(str(progress.id), Counter())
        total["read"] += progress.numInputRows
        for operator in progress.stateOperators:
            total["late"] += operator.numRowsDroppedByWatermark
            total["repeated"] += operator.customMetrics.get("numDroppedDuplicateRows", 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


def watch_drops(session: SparkSession) -> DroppedRows:
    """Count drops of all queries of a session; streams belong to the session of their source."""
    listener = DroppedRows()
    session.streams.addListener(listener)
    return listener
