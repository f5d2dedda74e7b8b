"""Event sources, decoding and the stateful steps of the weather stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.functions.timestamps import date_key
from assaymill.operators.joins import broadcast_join
from assaymill.operators.weather import EVENT_SCHEMA

MALFORMED = "malformed"


def stream_source(spark: SparkSession, kind: str, **options) -> DataFrame:
    """A stream with a ``value`` column (Kafka) or the file format's own columns.

    ``kind='kafka'`` takes ``servers`` and ``topic``; any other kind is a file format and takes
    ``path``, ``schema`` and reader options such as ``maxFilesPerTrigger``.
    """
    if kind == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", options.pop("servers"))
            .option("subscribe", options.pop("topic"))
            .option("startingOffsets", options.pop("startingOffsets", "latest"))
            .option("failOnDataLoss", options.pop("failOnDataLoss", "false"))
        )
        return reader.options(**options).load()
    path, schema = options.pop("path"), options.pop("schema", None)
    reader = spark.readStream.format(kind).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def decode_events(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON bytes to the eleven event fields plus ``MALFORMED``.

    A field of the wrong type becomes NULL. A document with no readable field at all is
    malformed; ``raw`` holds its text.
    """
    fields = EVENT_SCHEMA.fieldNames()
    # As a generator the parser runs once per document; as a plain expression it would be
    # copied into every field access and every filter that is pushed below it.
    decoded = df.select(*keep, F.col(value).cast("string").alias("raw")).select(
        "*", F.inline(F.array(F.from_json("raw", EVENT_SCHEMA)))
    )
    nothing = F.coalesce(*[F.col(f).cast("string") for f in fields]).isNull()
    return decoded.select(
        *keep,
        *fields,
        nothing.alias(MALFORMED),
        F.when(nothing, F.col("raw")).alias("raw"),
    )


def well_formed(decoded: DataFrame) -> DataFrame:
    return decoded.filter(~F.col(MALFORMED)).drop(MALFORMED, "raw")


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(MALFORMED)).select("raw")


def with_ingestion_parts(df: DataFrame, arrival=None) -> DataFrame:
    """Arrival year, month, day and hour; processing time unless ``arrival`` is given."""
    arrival = F.current_timestamp() if arrival is None else arrival
    return df.withColumns(
        {
            "ingestion_year": F.year(arrival),
            "ingestion_month": F.month(arrival),
            "ingestion_day": F.dayofmonth(arrival),
            "ingestion_hour": F.hour(arrival),
        }
    )


def within_watermark(
    stream: DataFrame, time_col: str, keys: Sequence[str], delay: str = "2 hours"
) -> DataFrame:
    """Drop rows later than ``delay`` and repeated keys inside it, with bounded state.

    ``time_col`` must be a ``timestamp`` and the frame a stream: a watermark on a static frame
    has no effect.
    """
    if not stream.isStreaming:
        raise ValueError("a watermark needs a streaming frame")
    if not isinstance(stream.schema[time_col].dataType, T.TimestampType):
        stream = stream.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))


def stateful_session(spark: SparkSession) -> SparkSession:
    """A sibling session whose stateful queries get one state partition per core.

    The width is fixed in a query's checkpoint at its first start, so it follows the cluster
    and not the batch shuffle setting.
    """
    session = spark.newSession()
    session.conf.set(
        "spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone")
    )
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return session


def run_to_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_cols: Sequence[str] = (),
    trigger: dict | None = None,
    wait: bool = True,
):
    """Append a stream to Parquet. ``trigger`` defaults to working off what is there.

    With ``wait`` the call returns when the query ends and stops it in any case.
    """
    writer = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    query = writer.start()
    if wait:
        try:
            query.awaitTermination()
        finally:
            query.stop()
    return query


INGESTION_PARTS = ("ingestion_year", "ingestion_month", "ingestion_day", "ingestion_hour")


def raw_stream_append(
    decoded: DataFrame,
    path: str,
    checkpoint: str,
    arrival=None,
    partition_cols: Sequence[str] = INGESTION_PARTS,
    trigger: dict | None = None,
    wait: bool = True,
):
    """Log every event as it came, by arrival time, well formed or not.

    Live batches touch one or two arrival hours; use fewer partition columns for a backfill
    that spans many.
    """
    stamped = with_ingestion_parts(decoded, arrival)
    return run_to_files(stamped, path, checkpoint, partition_cols, trigger, wait)


def enrich_with_sales(stream: DataFrame, daily_sales: DataFrame, time_col: str) -> DataFrame:
    """Stream-static left join: each reading gets that calendar day's sales context.

    ``daily_sales`` has one row per ``date_key`` and should be a stored table: every
    micro-batch reads it. It is broadcast if its measured size allows.
    """
    return broadcast_join(
        stream.withColumn("date_key", date_key(time_col)), daily_sales, "date_key"
    )
