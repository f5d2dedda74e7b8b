"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MB = 1024 * 1024
BROADCAST_LIMIT_BYTES = 50 * MB

# Settings that hold on one machine and on a cluster alike.
COMMON_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(50 * MB),
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.mergeSchema": "false",
    # Dedup state of a long stream does not have to fit on the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Shuffle width is only the starting point: AQE merges small partitions afterwards.
MODE_CONF = {
    "local": {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"},
    "single": {"spark.sql.shuffle.partitions": "32"},
    "cluster": {
        "spark.sql.shuffle.partitions": "200",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.files.maxPartitionBytes": str(256 * MB),
    },
}


def build_session(
    app_name: str, mode: str = "local", conf: dict[str, str] | None = None
) -> SparkSession:
    """Create (or get) a session for ``local``, ``single`` (one node) or ``cluster`` use.

    ``conf`` wins over the defaults, so object-store and catalog settings stay the caller's.
    """
    settings = COMMON_CONF | MODE_CONF[mode] | (conf or {})
    builder = SparkSession.builder.appName(app_name)
    if mode == "local":
        builder = builder.master(settings.pop("spark.master", "local[*]"))
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_base: str | None = None
_scope: ContextVar[str] = ContextVar("scratch scope", default="")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared ``spark.checkpoint.dir``.

    Only a session whose driver and tasks share one machine may fall back to a local folder.
    """
    root = _scope.get() or _scratch_root(spark)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_root(spark: SparkSession) -> str:
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        _local_base = _local_base or tempfile.mkdtemp(prefix="assaymill-")
        base = _local_base
    return f"{base.rstrip('/')}/assaymill/{spark.sparkContext.applicationId}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Scratch tables made inside are dropped at the end, once nothing reads them any more.

    For jobs whose results are written before they return; a frame that is still lazy when
    the scope ends would lose its input.
    """
    folder = scratch_path(spark, "scope")
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def literal_rows(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A handful of constant rows that Catalyst sees as literals, without a Python stage."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, r)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    The result has a one-step lineage, so a lost executor costs one re-read; it never
    depends on executor-local blocks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
