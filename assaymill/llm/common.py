"""Helpers shared by the operators: table paths, Arrow column maps, small guards."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.session import scratch_path, scratch_scope

Arrays = list[pa.Array]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build`` gives, written and read back; tables written on the way are dropped."""
    path = scratch_path(spark, name)
    with scratch_scope(spark):
        df = build()
        df.write.parquet(path)
    schema = df.schema
    del df
    drop_shuffles(spark)
    return spark.read.schema(schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished queries, which stay until the driver's garbage is collected."""
    gc.collect()
    spark._jvm.System.gc()


#: Bytes of a batch that are worked on at a time (a single row may be larger).
SLICE_BYTES = 4 << 20


def give_back_memory() -> None:
    """Return freed memory to the system: workers are reused, and the next task may differ."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once per application.

    The same as submitting with ``--py-files``; workers need no installed copy.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="assaymill-"), "assaymill_sources.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.join("assaymill", os.path.relpath(path, top)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def append_columns(
    df: DataFrame,
    inputs: Sequence[str],
    fields: Sequence[T.StructField],
    start: Callable[[], Callable[..., Arrays]],
) -> DataFrame:
    """Compute ``fields`` from the columns ``inputs``, one Arrow batch at a time.

    ``start`` runs once per task and returns the function for one batch: it gets the input
    arrays and returns one array per field. Input columns stay, except those whose name (in
    any case) is that of a new field, which the new field replaces.
    """
    ship_package(df.sparkSession)
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    schema = T.StructType([*kept, *fields])
    names = schema.fieldNames()
    n_inputs = len(inputs)
    fed = df.select(
        *[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(inputs)],
        *[F.col(f"`{f.name}`") for f in kept],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            rows = max(1, SLICE_BYTES * batch.num_rows // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                made = step(*part.columns[:n_inputs])
                yield pa.RecordBatch.from_arrays([*part.columns[n_inputs:], *made], names=names)
        del step
        give_back_memory()

    return fed.mapInArrow(run, schema)


def chunks(texts: Sequence[str | None], most_chars: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that hold about ``most_chars`` characters, one text at least."""
    begin = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > most_chars:
            yield begin, i
            begin, size = i, 0
        size += len(t or "")
    if begin < len(texts):
        yield begin, len(texts)


def residue(column: str, modulus: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``modulus``; a NULL id counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(modulus))


def low_hash(key: Column, most: int, count: int) -> Column:
    """Whether a row is among about ``most`` of ``count``: its hash lies in that share of 64 bits."""
    if count <= most:
        return F.lit(True)
    return F.xxhash64(key) < F.lit((most << 64) // count - (1 << 63))


def bounded_sample(df: DataFrame, key: Column, most: int, count: int) -> DataFrame:
    """About ``most`` of ``count`` rows, the same ones on every run: those with a low key hash."""
    return df.where(low_hash(key, most, count))
