"""Merge-on-read view of batch and real-time rows.

A micro-batch is appended as one delta and changes nothing else: no month is read or rewritten per
trigger. Readers merge at read time: the folded base, the deltas since, and the batch table, which
wins. A job folds deltas into the base now and then, rewriting only the months they touch, and
publishes base and fold marks as one version.

* A delta is a folder and a marker, ``log/<run>-<batch>.json``, that names it. The marker appears
  whole and once, so a replayed micro-batch finds it and adds nothing.
* A run is a query id, as the checkpoint's ``metadata`` file holds it. A lost checkpoint, also at the
  same path, is a new run; its batches sort after those of earlier runs.
* ``stream`` keeps the latest streamed row of each key, ``view`` what readers see of it and the batch
  table. While the batch table stands as at the last fold, reading overlays the unfolded deltas on
  ``view`` without a shuffle of the base; after it changed, both are merged anew.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.operators.clean import latest_by_key
from assaymill.operators.joins import BROADCAST_LIMIT_BYTES, measured_bytes
from assaymill.session import materialize, scratch_scope
from assaymill.sources.loads import read_if_exists
from assaymill.sources.tables import file_listing
from assaymill.sources.versions import Folder, Version, VersionedLayer, partition_name
from assaymill.streaming.unified import KEYS, PARTS, query_id, unify

#: When a streamed row arrived: its run's number above this bit, its micro-batch below.
RUN_SHIFT = 40
AT = "_at"

Batch = Callable[[SparkSession], tuple[str, DataFrame | None]]
#: Takes a micro-batch, its run's id and its number; a second call with the same two adds nothing.
Sink = Callable[[DataFrame, str, int], object]


def batch_at(path: str) -> Batch:
    """A plain Parquet table as the batch side; known by its files' names and lengths."""

    def found(spark: SparkSession) -> tuple[str, DataFrame | None]:
        df = read_if_exists(spark, path)
        if df is None:
            return "none", None
        files = file_listing(spark, path).agg(F.sum(F.xxhash64("path", "length").cast("decimal(38,0)")))
        return str(files.first()[0]), df

    return found


def batch_of(layer: VersionedLayer, name: str) -> Batch:
    """A published table as the batch side; known by its folders, so other tables don't matter."""

    def found(spark: SparkSession) -> tuple[str, DataFrame | None]:
        version = layer.version()
        if name not in version.tables:
            return "none", None
        return "|".join(sorted(version.tables[name].folders)), layer.read(name, version)

    return found


@dataclass(frozen=True)
class Delta:
    run: int
    batch: int
    folder: str
    schema: T.StructType


def _same(columns: Sequence[str], prefix: str) -> Column:
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in columns])


def run_number(spark: SparkSession, root: str, run_id: str) -> int:
    """The number of a run, from 1 on, given when the run is first seen below ``root``."""
    runs = Folder(spark, f"{root}/runs")
    while True:
        seen = sorted(name for name, _, _ in runs.entries() if name.endswith(".run"))
        for name in seen:
            if runs.read(name) == run_id:
                return int(name.removesuffix(".run"))
        number = int(seen[-1].removesuffix(".run")) + 1 if seen else 1
        if runs.put_if_absent(f"{number:06d}.run", run_id):
            return number


def stream_into(
    stream: DataFrame, sink: Sink, checkpoint: str, trigger: dict | None = None, wait: bool = True
):
    """Start a stream whose micro-batches go to ``sink`` with the run's id and their number."""
    ids: list[str] = []

    def on_micro_batch(df: DataFrame, batch_id: int) -> None:
        # The query writes its id before its first batch.
        if not ids:
            ids.append(query_id(df.sparkSession, checkpoint))
        sink(df, ids[0], batch_id)

    query = (
        stream.writeStream.foreachBatch(on_micro_batch)
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


class MergeOnReadView:
    """Delta log, folded base and merged view below ``root``."""

    def __init__(
        self, root: str, batch: Batch, keys: Sequence[str] = KEYS, parts: Sequence[str] = PARTS
    ):
        self.root, self.batch = root.rstrip("/"), batch
        self.keys, self.parts = tuple(keys), tuple(parts)

    def _layer(self, spark: SparkSession) -> VersionedLayer:
        return VersionedLayer(spark, f"{self.root}/base")

    # --- writing -----------------------------------------------------------------------------

    def run_number(self, spark: SparkSession, run_id: str) -> int:
        return run_number(spark, self.root, run_id)

    def append(self, micro_batch: DataFrame, run_id: str, batch_id: int) -> bool:
        """Append a micro-batch as a delta; False if this run's batch is there already."""
        spark = micro_batch.sparkSession
        run = self.run_number(spark, run_id)
        log, marker = Folder(spark, f"{self.root}/log"), f"{run:06d}-{batch_id:012d}.json"
        if any(name == marker for name, _, _ in log.entries()):
            return False
        folder = f"{run:06d}-{batch_id:012d}-{uuid.uuid4().hex[:8]}"
        at = F.lit((run << RUN_SHIFT) + batch_id).cast("bigint").alias(AT)
        micro_batch.select("*", at).write.parquet(f"{self.root}/delta/{folder}")
        found = {"folder": folder, "schema": json.loads(micro_batch.schema.json())}
        return log.put_if_absent(marker, json.dumps(found))

    def run(
        self, stream: DataFrame, checkpoint: str, trigger: dict | None = None, wait: bool = True
    ):
        """Start the stream of conformed rows into the delta log."""
        return stream_into(stream, self.append, checkpoint, trigger, wait)

    # --- reading -----------------------------------------------------------------------------

    def deltas(self, spark: SparkSession, version: Version) -> list[Delta]:
        """Deltas that the version's base does not hold; bounded by how often deltas are folded."""
        log, marks = Folder(spark, f"{self.root}/log"), version.notes.get("marks", {})
        found = []
        for name, _, _ in sorted(log.entries()):
            run, _, batch = name.removesuffix(".json").partition("-")
            if name.endswith(".json") and int(batch) > marks.get(str(int(run)), -1):
                marker = json.loads(log.read(name))
                schema = T.StructType.fromJson(marker["schema"])
                found.append(Delta(int(run), int(batch), marker["folder"], schema))
        return found

    def _rows(self, spark: SparkSession, deltas: Sequence[Delta]) -> DataFrame | None:
        """The rows of deltas with their arrival; columns that came later are NULL before."""
        if not deltas:
            return None
        fields = {f.name: f for d in deltas for f in d.schema.fields}
        schema = T.StructType([*fields.values(), T.StructField(AT, T.LongType())])
        return spark.read.schema(schema).parquet(*[f"{self.root}/delta/{d.folder}" for d in deltas])

    def _latest(self, rows: DataFrame) -> DataFrame:
        rest = [F.col(c).desc_nulls_last() for c in rows.columns if c not in (*self.keys, AT)]
        return latest_by_key(rows, self.keys, [F.col(AT).desc(), *rest])

    def _merged(self, batch: DataFrame | None, stream: DataFrame) -> DataFrame:
        if batch is not None:
            types = {f.name: f.dataType for f in stream.schema.fields if f.name != AT}
            lacking = {c: F.lit(None).cast(t) for c, t in types.items() if c not in batch.columns}
            batch = batch.withColumns(lacking) if lacking else batch
        return unify(batch, stream.withColumnRenamed(AT, "batch_id"), self.keys)

    def read(self, spark: SparkSession) -> DataFrame | None:
        """The view as base, deltas and batch table stand now, with column ``origin``."""
        layer = self._layer(spark)
        version = layer.version()
        fresh = self._rows(spark, self.deltas(spark, version))
        batch_id, batch = self.batch(spark)
        if "view" in version.tables and version.notes["batch"] == batch_id:
            view = layer.read("view", version)
            return view if fresh is None else self._overlaid(view, self._latest(fresh))
        held = layer.read("stream", version, hidden=True) if "stream" in version.tables else None
        streamed = [df for df in (held, fresh) if df is not None]
        if streamed:
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), streamed)
            return self._merged(batch, rows)
        return None if batch is None else batch.withColumn("origin", F.lit("batch"))

    def _overlaid(self, view: DataFrame, fresh: DataFrame) -> DataFrame:
        """``view`` with the fresh rows in place of streamed rows of the same key.

        The fresh keys are broadcast behind a check of their size; the view is only scanned, and
        filters on it reach its scan.
        """
        keys = fresh.select(*[F.col(k).alias(f"_f_{k}") for k in self.keys])
        if measured_bytes(keys) <= BROADCAST_LIMIT_BYTES:
            keys = F.broadcast(keys)
        match = _same(self.keys, "_f_")
        batch = F.col("origin") == "batch"
        kept = view.join(keys.withColumn("_f", F.lit(True)), match, "left").filter(
            batch | F.col("_f").isNull()
        ).select(*view.columns)
        # Fresh rows whose key the batch table holds lose; there are at most as many as fresh rows.
        beaten = view.filter(batch).join(keys, match, "left_semi")
        beaten = beaten.select(*[F.col(k).alias(f"_f_{k}") for k in self.keys])
        won = fresh.drop(AT).join(beaten, match, "left_anti").withColumn("origin", F.lit("stream"))
        return kept.unionByName(won, allowMissingColumns=True)

    # --- folding -----------------------------------------------------------------------------

    def fold(self, spark: SparkSession) -> Version | None:
        """Bring all deltas there are into the base; None if nothing changed since the last fold.

        Only the months of the deltas are rewritten, as long as the batch table stands and every key
        keeps its month. Where a key shows up in two months, this and all later folds rewrite all.
        """
        layer = self._layer(spark)
        with scratch_scope(spark), layer.publication() as publication:
            version = publication.base
            deltas = self.deltas(spark, version)
            batch_id, batch = self.batch(spark)
            known = "view" in version.tables and version.notes["batch"] == batch_id
            if (known or not version.tables) and not deltas:
                return None
            marks = dict(version.notes.get("marks", {}))
            for d in deltas:
                marks[str(d.run)] = max(d.batch, marks.get(str(d.run), -1))
            fresh = self._rows(spark, deltas)
            fresh = None if fresh is None else materialize(self._latest(fresh), "fold-fresh")
            crossing = version.notes.get("crossing", False)
            if known and not crossing:
                crossing = self._crosses(layer, version, fresh)
            if known and not crossing:
                self._fold_months(publication, fresh, batch)
            else:
                crossing = self._fold_all(publication, fresh, batch)
            return publication.commit(job="fold", marks=marks, batch=batch_id, crossing=crossing)

    def _crosses(self, layer: VersionedLayer, version: Version, fresh: DataFrame) -> bool:
        """Whether a key has rows in two months: in the fresh rows and in what is there."""
        columns = [*self.keys, *self.parts]
        named = fresh.select(*[F.col(c).alias(f"_f_{c}") for c in columns])
        if measured_bytes(named) <= BROADCAST_LIMIT_BYTES:
            named = F.broadcast(named)
        elsewhere = _same(self.keys, "_f_") & ~_same(self.parts, "_f_")
        return any(
            not layer.read(name, version).select(*columns).join(named, elsewhere, "left_semi").isEmpty()
            for name in ("view", "stream")
        )

    def _fold_months(self, publication, fresh: DataFrame, batch: DataFrame | None) -> None:
        months = [r.asDict() for r in fresh.select(*self.parts).distinct().collect()]
        touched = [partition_name(m) for m in months]
        held = publication.layer.read("stream", publication.base, True, touched)
        rows = self._latest(held.unionByName(fresh, allowMissingColumns=True))
        self._stage(publication, "stream", rows, "partitions")
        stream = publication.staged("stream", True, touched)
        if batch is not None:
            same = [reduce(and_, [F.col(p).eqNullSafe(F.lit(m[p])) for p in self.parts]) for m in months]
            batch = batch.filter(reduce(or_, same))
        self._stage(publication, "view", self._merged(batch, stream), "partitions")

    def _fold_all(self, publication, fresh: DataFrame | None, batch: DataFrame | None) -> bool:
        base = publication.base
        held = publication.layer.read("stream", base, hidden=True) if "stream" in base.tables else None
        parts = [df for df in (held, fresh) if df is not None]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        stream = self._stage(publication, "stream", self._latest(rows), "table")
        self._stage(publication, "view", self._merged(batch, stream), "table")
        if batch is None:
            return False
        columns = [*self.keys, *self.parts]
        other = batch.select(*[F.col(c).alias(f"_f_{c}") for c in columns])
        crossing = stream.join(other, _same(self.keys, "_f_") & ~_same(self.parts, "_f_"), "left_semi")
        return not crossing.isEmpty()

    def _stage(self, publication, name: str, df: DataFrame, replace: str) -> DataFrame:
        publication.stage(name, df, self.parts, replace)
        return publication.staged(name, hidden=True)

    def expire(self, spark: SparkSession, older_than_hours: float = 24.0) -> int:
        """Delete folded deltas and base snapshots that no reader can still need; the deltas' number."""
        layer = self._layer(spark)
        marks = layer.version().notes.get("marks", {})
        log, limit, gone = Folder(spark, f"{self.root}/log"), time.time() - older_than_hours * 3600, 0
        data = Folder(spark, f"{self.root}/delta")
        there = {name for name, _, _ in data.entries()}
        for name, _, changed in log.entries():
            run, _, batch = name.removesuffix(".json").partition("-")
            if name.endswith(".json") and changed <= limit and int(batch) <= marks.get(str(int(run)), -1):
                folder = json.loads(log.read(name))["folder"]
                # The marker stays without its data, so that a late replay still finds it.
                if folder in there:
                    data.delete(folder)
                    gone += 1
        layer.vacuum(older_than_hours=older_than_hours)
        return gone
