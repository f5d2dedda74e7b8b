"""One large CSV file with quoted line breaks, read by many tasks.

Spark's line reader splits a file anywhere, but a line may lie inside quoted text. Whether it does is the
parity of the quotes before it. So the quotes of each file block are counted first; running
parities over the blocks of a file (one row per block) tell each block whether it begins inside quotes
and which record it goes on with. Then every block finds its record starts by itself. Records of one
line, nearly all, stay where they are; only the lines of longer records are brought together.

Files follow the doubled-quote rule: quotes stand around a field or doubled inside one. Lines end with
LF or CR LF. A file whose quotes do not pair up is refused, as nobody can tell its records apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.operators.clean import blank_to_null
from assaymill.session import literal_rows, materialize

CORRUPT = "_corrupt_record"
_BLOCK = ("_file", "_block")
_MARK = "﻿"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with file, block and place in the block; odd tells an odd number of quotes."""
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        (quotes % 2).alias("_odd"),
        "value",
    )


def _within():
    """Lines of a block before the current one."""
    return Window.partitionBy(*_BLOCK).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)


def _blocks(lines: DataFrame) -> DataFrame:
    """Per block: whether it begins inside quotes, and how many records began in the file before it."""
    inside = F.coalesce(F.sum("_odd").over(_within()), F.lit(0)) % 2
    counted = (
        lines.select(*_BLOCK, "_odd", inside.alias("_inside"))
        .groupBy(*_BLOCK)
        .agg(
            (F.sum("_odd") % 2).alias("_parity"),
            # Record starts if the block begins outside quotes, and if it begins inside.
            F.count_if(F.col("_inside") == 0).alias("_starts0"),
            F.count_if(F.col("_inside") == 1).alias("_starts1"),
        )
    )
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    known = counted.withColumn("_open", F.coalesce(F.sum("_parity").over(earlier), F.lit(0)) % 2)
    starts = F.when(F.col("_open") == 0, F.col("_starts0")).otherwise(F.col("_starts1"))
    return known.withColumn("_starts", starts).select(
        *_BLOCK,
        "_open",
        "_parity",
        F.coalesce(F.sum("_starts").over(earlier), F.lit(0)).alias("_records"),
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, number, record)``: whole records as text, numbered from 1 in each file.

    Blank lines between records are left out, as Spark's own reader does.
    """
    lines = _lines(spark, path)
    blocks = materialize(_blocks(lines), "csv-blocks")  # one row per file block
    torn = blocks.groupBy("_file").agg((F.sum("_parity") % 2).alias("odd")).filter("odd = 1").take(5)
    if torn:
        raise ValueError(f"odd number of quotes in {', '.join(r['_file'] for r in torn)}")
    inside = (F.col("_open") + F.coalesce(F.sum("_odd").over(_within()), F.lit(0))) % 2
    placed = lines.join(blocks, list(_BLOCK)).withColumn("_inside", inside)
    begun = F.count_if(F.col("_inside") == 0).over(_within().rowsBetween(Window.unboundedPreceding, 0))
    placed = placed.withColumn("_number", F.col("_records") + begun)
    whole = (F.col("_inside") == 0) & (F.col("_odd") == 0)
    single = placed.filter(whole).select("_file", "_number", F.col("value").alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("_block", "_at", "value")))
    longer = (
        placed.filter(~whole)
        .groupBy("_file", "_number")
        .agg(pieces.alias("_pieces"))
        .select("_file", "_number", F.array_join("_pieces.value", "\n").alias("record"))
    )
    text = F.regexp_replace("record", r"\r$", "")
    first = F.when(F.col("_number") == 1, F.ltrim(text, F.lit(_MARK))).otherwise(text)
    return (
        single.unionByName(longer)
        .select(F.col("_file").alias("file"), F.col("_number").alias("number"), first.alias("record"))
        .filter((F.trim("record") != "") | (F.col("number") == 1))
    )


def read_csv_splits(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV rows as ``read_csv`` gives them, from files that many tasks share.

    The first record of each file is its header and must name the columns of ``schema``.
    """
    records = csv_records(spark, path)
    names = ", ".join(f"`{n}` string" for n in schema.fieldNames())
    headers = records.filter("number = 1").select("record").distinct().take(10)
    wanted = [n.lower() for n in schema.fieldNames()]
    if headers:
        read = literal_rows(spark, ["record"], [(h["record"],) for h in headers])
        for found in read.select(F.from_csv("record", names).alias("h")).collect():
            if [(v or "").strip().lower() for v in found["h"]] != wanted:
                raise ValueError(f"header {list(found['h'])} does not name {schema.fieldNames()}")
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "quote": '"',
        "escape": '"',
        "multiLine": "true",
    }
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in with_corrupt.fields)
    rows = records.filter("number > 1").select(F.from_csv("record", ddl, options).alias("_row"))
    # As a generator the parser runs once per record.
    parsed = rows.select(F.inline(F.array("_row")))
    return blank_to_null(parsed, [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)])
