"""Table scans and writers."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.session import MB

TARGET_FILE_MB = 128
SYNC_DATE = r"/(\d{4})/(\d{2})/(\d{2})/[^/]+$"


@dataclass(frozen=True)
class Lake:
    """Where the layers live. The one place that turns a table name into a path."""

    root: str
    table_prefix: str = ""

    def raw(self, source: str, table: str, sync_date: str | None = None) -> str:
        path = f"{self.root}/raw/{source}/{self.table_prefix}{table}"
        return path if sync_date is None else f"{path}/{sync_date.replace('-', '/')}"

    def silver(self, table: str) -> str:
        return f"{self.root}/processed/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def raw_stream(self, table: str) -> str:
        return f"{self.root}/raw-streaming/{table}"

    def silver_stream(self, table: str) -> str:
        return f"{self.root}/processed-streaming/{table}"


def scan_bronze(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sync_dates: Sequence[str] | None = None,
    with_sync_date: bool = False,
    merge_schema: bool = False,
) -> DataFrame:
    """Read a raw table laid out as ``<path>/YYYY/MM/DD/*.parquet``.

    ``sync_dates`` limits the listing to those days' folders. A declared ``schema`` saves the
    footer read; without it Spark takes the schema from a file, or with ``merge_schema`` the
    columns of all files.
    """
    paths = [path] if sync_dates is None else [f"{path}/{d.replace('-', '/')}" for d in sync_dates]
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(*paths)
    if not with_sync_date:
        return df
    file = F.col("_metadata.file_path")
    day = F.concat_ws("-", *[F.regexp_extract(file, SYNC_DATE, i) for i in (1, 2, 3)])
    return df.select("*", day.try_cast("date").alias("sync_date"))


def scan_silver(spark: SparkSession, path: str) -> DataFrame:
    """Read a modelled table; partition columns prune by folder."""
    return spark.read.parquet(path)


@contextmanager
def _file_sizing(spark: SparkSession, mb: int, merged: bool = True):
    """Let AQE cut the rebalanced partitions of one write by bytes; ``merged``: also merge small ones.

    The settings hold for all shuffles of the write's job, not only for the last one. Merging by bytes
    alone would leave the windows and joins before a write to one task for each ``mb`` of compressed rows.
    """
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(mb * MB)}
    if merged:
        wanted["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def repartition_for_write(df: DataFrame, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Shuffle rows so that each output partition becomes few files of sound size.

    ``rebalance`` lets AQE merge small partitions and cut a hot one into several, by the bytes
    it saw in the shuffle.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_cols])


def ordering(names: Sequence[str]) -> list[Column]:
    """Sort columns from names; a leading ``-`` is for descending, with NULL last."""
    return [F.col(n[1:]).desc_nulls_last() if n.startswith("-") else F.col(n).asc() for n in names]


def cluster_for_write(
    df: DataFrame, order: Sequence[str], partition_cols: Sequence[str] = ()
) -> DataFrame:
    """Shuffle rows by ranges of ``order`` inside each partition and sort them.

    Files follow each other in the order given, so the row group statistics of the first columns are
    narrow and a filter on them skips most of a table. A hot partition spans several ranges; AQE
    merges small ones. Each range is sorted by a task of its own, with no global sort after it.
    """
    by = [*[F.col(c) for c in partition_cols], *ordering(order)]
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def write_table(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = (),
    target_file_mb: int = TARGET_FILE_MB,
    mode: str = "overwrite",
    replace: str = "partitions",
    order: Sequence[str] = (),
) -> None:
    """Write Parquet in files of about ``target_file_mb`` at most.

    Partitioned overwrites replace only the partitions that occur in ``df``; with ``replace``
    as ``table`` they replace the whole table, as a full recompute must. With ``order`` the rows are
    stored in that order, a leading ``-`` for descending columns.
    """
    if order:
        laid_out = cluster_for_write(df, order, partition_cols)
    else:
        laid_out = repartition_for_write(df, partition_cols)
    writer = laid_out.write.mode(mode)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
        if mode == "overwrite":
            how = "static" if replace == "table" else "dynamic"
            writer = writer.option("partitionOverwriteMode", how)
    # Rebalanced by its columns, an output partition lies in one task, merged with others or not.
    with _file_sizing(df.sparkSession, target_file_mb, merged=bool(order) or not partition_cols):
        writer.parquet(path)


def is_folder(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.getFileStatus(target).isDirectory()


def file_listing(
    spark: SparkSession, path: str | Sequence[str], pattern: str = "*.parquet"
) -> DataFrame:
    """``(path, length)`` of the files below folders, from the listing alone."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path if isinstance(path, str) else list(path))
        .select("path", "length")
    )


def compact_small_files(
    spark: SparkSession,
    source: str,
    target: str,
    partition_cols: Sequence[str] = ("ingestion_year", "ingestion_month"),
    target_file_mb: int = TARGET_FILE_MB,
) -> DataFrame:
    """Rewrite a table of many small files into a sibling folder and check the row count.

    Returns the compacted table. The source stays as it is, for the caller to retire.
    """
    df = spark.read.parquet(source)
    write_table(df, target, partition_cols, target_file_mb)
    compacted = spark.read.schema(df.schema).parquet(target)
    before, after = df.count(), compacted.count()
    if before != after:
        raise RuntimeError(f"compaction of {source} kept {after} of {before} rows")
    return compacted
