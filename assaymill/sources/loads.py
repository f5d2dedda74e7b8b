"""Loading raw tables: CSV, incremental append, full refresh."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.operators.clean import blank_to_null, require_keys
from assaymill.operators.joins import insert_if_absent
from assaymill.session import scratch_scope
from assaymill.sources.csv_splits import CORRUPT, read_csv_splits

# Error conditions that mean there is no table yet.
MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None where there is no such path or no file yet.

    Every other error is the caller's to see.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in MISSING:
            return None
        raise


def refuse_open_quotes(spark: SparkSession, path: str) -> None:
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), quotes.alias("n"))
    odd = lines.groupBy("file").agg(F.sum("n").alias("n")).where("n % 2 = 1").select("file").take(5)
    if odd:
        raise ValueError(f"odd number of quotes in {', '.join(r.file for r in odd)}")


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """CSV rows with a header, trimmed and blank as NULL; unreadable rows in ``CORRUPT``.

    Quotes inside quoted text are doubled, and quoted text may hold line breaks. Such a file can't
    be split over tasks; ``multi_line=False`` is for files known to have no breaks in their text.
    A quote that is never closed would take all rows up to the end of its file, so a file with
    an odd number of quotes is refused.
    """
    if multi_line:
        refuse_open_quotes(spark, path)
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .schema(with_corrupt)
        .csv(path)
    )
    text = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return blank_to_null(df, text)


def load_csv(
    spark: SparkSession,
    csv_path: str,
    schema: T.StructType,
    target: str,
    keys: Sequence[str] = (),
    multi_line: bool = True,
    splits: bool = False,
) -> int:
    """Append the well-formed CSV rows whose key the target does not hold yet.

    ``splits`` reads large files by many tasks (``read_csv_splits``). Unreadable rows are appended to ``<target>_rejects`` as they are; returns their number.
    """
    if splits:
        rows = read_csv_splits(spark, csv_path, schema)
    else:
        rows = read_csv(spark, csv_path, schema, multi_line)
    rejects = Observation()
    (
        rows.filter(F.col(CORRUPT).isNotNull())
        .observe(rejects, F.count(F.lit(1)).alias("rows"))
        .write.mode("append")
        .parquet(f"{target}_rejects")
    )
    rows = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    existing = read_if_exists(spark, target)
    with scratch_scope(spark):
        if keys and existing is None:
            rows = require_keys(rows, keys).dropDuplicates(list(keys))
        elif keys:
            rows = insert_if_absent(existing, rows, keys, prune=True)
        rows.write.mode("append").parquet(target)
    return rejects.get["rows"]


def incremental_append(
    source: DataFrame, target: str, cursor: str, sync_date: str, keys: Sequence[str] = ()
) -> None:
    """Append what the target lacks as partition ``sync_date``.

    Rows from the high-water mark of earlier dates on, and rows without a cursor value, are
    candidates; those that another date holds already, by ``keys`` (all columns if none are
    given) and cursor, are left out. So ties at the mark and late rows with its value load once,
    rows without a cursor load once, and a late re-run of an old date takes nothing that newer
    dates hold. A repeated run replaces its date, also by nothing.
    """
    spark = source.sparkSession
    existing = read_if_exists(spark, target)
    if existing is not None:
        day, today = F.col("sync_date"), F.lit(sync_date).cast("date")
        # Reads one column of the earlier dates, whose row group statistics skip most of it.
        mark = existing.filter(day < today).agg(F.max(cursor).alias("mark")).first()["mark"]
        late = F.lit(True) if mark is None else F.col(cursor).isNull() | (F.col(cursor) >= F.lit(mark))
        same = list(dict.fromkeys([*(keys or source.columns), cursor]))
        held = existing.filter(day != today).filter(late).select(*[F.col(c).alias(f"_{c}") for c in same])
        matches = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same])
        source = source.filter(late).join(held, matches, "left_anti")
    source.write.mode("overwrite").parquet(f"{target}/sync_date={sync_date}")


def full_refresh(source: DataFrame, target: str) -> None:
    """Replace the target by the current snapshot of the source."""
    source.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(target)


def jdbc_source(spark: SparkSession, url: str, table: str, split: dict | None = None, **options):
    """A database table as a frame; ``split`` gives Spark's column, bounds and partition count.

    Filters such as the incremental cursor are pushed into the database by Spark.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split:
        reader = reader.options(
            partitionColumn=split["column"],
            lowerBound=split["lower"],
            upperBound=split["upper"],
            numPartitions=split["partitions"],
        )
    return reader.load()
