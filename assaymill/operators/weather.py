"""Weather feed: flatten, project and conform. Shared by the batch and the streaming side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.functions.timestamps import parse_weather_time
from assaymill.operators.clean import latest_by_key

# Station used where the payload names none.
DEFAULT_CITY, DEFAULT_LAT, DEFAULT_LON = "Patagonia", -41.81, -68.91

KEYS = ("city_name", "unix_timestamp")

# Fields and types of a live event.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("dt", T.IntegerType()),
        T.StructField("dt_iso", T.StringType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("temp", T.DoubleType()),
        T.StructField("humidity", T.IntegerType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("weather_main", T.StringType()),
        T.StructField("weather_description", T.StringType()),
        T.StructField("ingestion_timestamp", T.StringType()),
    ]
)

# One record of the nested feed; every level may also carry the flat form of a value.
RECORD_DDL = """
  dt BIGINT, dt_iso STRING, city_name STRING, lat DOUBLE, lon DOUBLE,
  temp DOUBLE, feels_like DOUBLE, temp_min DOUBLE, temp_max DOUBLE, pressure DOUBLE,
  humidity BIGINT, wind_speed DOUBLE, rain_1h DOUBLE,
  main STRUCT<temp: DOUBLE, feels_like: DOUBLE, temp_min: DOUBLE, temp_max: DOUBLE,
              pressure: DOUBLE, humidity: BIGINT>,
  wind STRUCT<speed: DOUBLE>, rain STRUCT<`1h`: DOUBLE>,
  weather ARRAY<STRUCT<main: STRING, description: STRING>>,
  weather_main STRING, weather_description STRING,
  name STRING, city STRUCT<name: STRING, coord: STRUCT<lat: DOUBLE, lon: DOUBLE>>
"""


def flatten_weather_json(df: DataFrame, payload: str = "payload", keep: list[str] = ()) -> DataFrame:
    """Nested JSON documents to flat rows.

    A document is either one record or holds an array ``list`` of records; both give one row
    per record, with the nested value preferred over the flat one. As an outer explode it keeps a
    row without values for a document without records; ``flatten_documents`` tells those apart.
    """
    record = T.StructType.fromDDL(RECORD_DDL)
    schema = T.StructType([*record.fields, T.StructField("list", T.ArrayType(record))])
    doc = F.from_json(F.col(payload), schema)
    single = F.struct(*[F.col("_doc")[name].alias(name) for name in record.fieldNames()])
    records = df.select(*keep, doc.alias("_doc")).select(
        *keep,
        F.col("_doc.city").alias("_city"),
        F.explode_outer(F.coalesce(F.col("_doc.list"), F.array(single))).alias("_r"),
    )

    def nested(group: str, name: str, flat: str | None = None) -> Column:
        flat = flat or name
        return F.coalesce(F.col(f"_r.{group}.`{name}`"), F.col(f"_r.{flat}")).alias(flat)

    first = F.try_element_at(F.col("_r.weather"), F.lit(1))
    return records.select(
        *keep,
        F.col("_r.dt").alias("dt"),
        F.coalesce(
            F.col("_r.dt_iso"),
            F.date_format(F.timestamp_seconds("_r.dt"), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        ).alias("dt_iso"),
        F.coalesce("_r.city_name", "_r.name", "_r.city.name", "_city.name", F.lit(DEFAULT_CITY)).alias("city_name"),
        F.coalesce("_r.lat", "_r.city.coord.lat", "_city.coord.lat", F.lit(DEFAULT_LAT)).alias("lat"),
        F.coalesce("_r.lon", "_r.city.coord.lon", "_city.coord.lon", F.lit(DEFAULT_LON)).alias("lon"),
        *[
            nested("main", c)
            for c in ["temp", "feels_like", "temp_min", "temp_max", "pressure", "humidity"]
        ],
        nested("wind", "speed", "wind_speed"),
        nested("rain", "1h", "rain_1h"),
        F.coalesce(first["main"], F.col("_r.weather_main")).alias("weather_main"),
        F.coalesce(first["description"], F.col("_r.weather_description")).alias("weather_description"),
    )


#: Where a field of a record may be, best place first; ``doc:`` starts at the whole document.
PLACES: dict[str, tuple[str, tuple[str, ...]]] = {
    "dt": ("bigint", ("$.dt",)),
    "dt_iso": ("string", ("$.dt_iso", "$.dt_txt")),
    "city_name": ("string", ("$.city_name", "$.name", "$.city.name", "doc:$.city.name", "doc:$.name")),
    "lat": ("double", ("$.lat", "$.coord.lat", "doc:$.city.coord.lat", "doc:$.lat")),
    "lon": ("double", ("$.lon", "$.coord.lon", "doc:$.city.coord.lon", "doc:$.lon")),
    "temp": ("double", ("$.main.temp", "$.temp")),
    "feels_like": ("double", ("$.main.feels_like", "$.feels_like")),
    "temp_min": ("double", ("$.main.temp_min", "$.temp_min")),
    "temp_max": ("double", ("$.main.temp_max", "$.temp_max")),
    "pressure": ("double", ("$.main.pressure", "$.pressure")),
    "humidity": ("bigint", ("$.main.humidity", "$.humidity")),
    "wind_speed": ("double", ("$.wind.speed", "$.wind_speed")),
    "rain_1h": ("double", ('$.rain["1h"]', "$.rain_1h")),
    "weather_main": ("string", ("$.weather[0].main", "$.weather_main")),
    "weather_description": ("string", ("$.weather[0].description", "$.weather_description")),
}


def flatten_documents(
    df: DataFrame, payload: str = "payload", keep: list[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Weather documents of any known form as flat rows, and those that give none as dead letters.

    Each document is parsed once, into a VARIANT. It may be a record, an array of records, or an object
    whose ``list`` holds them, with the place in ``city``; values may be nested or flat and are found
    by ``PLACES``. A value of the wrong type becomes NULL, and so does the next place's, if there is
    none. Dead letters have the columns ``keep``, ``raw`` and ``reason``: ``broken`` for text that is no
    JSON, ``empty`` for a document without records, ``unknown`` for records without any known field.
    """
    # As generators the parser and the field accesses run once each; as plain expressions they would be
    # copied into every filter that is pushed below them.
    def once(**columns: Column) -> Column:
        return F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))

    parsed = df.select(*keep, F.col(payload).alias("_raw"), once(_doc=F.try_parse_json(payload)))
    listed = [F.try_variant_get("_doc", path, "array<variant>") for path in ("$.list", "$")]
    found = parsed.select("*", once(_list=F.coalesce(*listed, F.array("_doc"))))
    records = found.filter(F.col("_doc").isNotNull()).select(*keep, "_raw", "_doc", F.explode("_list").alias("_r"))

    def place(path: str, kind: str) -> Column:
        side, _, rest = path.rpartition("doc:")
        return F.try_variant_get("_doc" if path.startswith("doc:") else "_r", rest, kind)

    fields = {
        name: F.coalesce(*[place(path, kind) for path in paths]) for name, (kind, paths) in PLACES.items()
    }
    rows = records.select(*keep, "_raw", once(**fields))
    own = [c for c in PLACES if c not in ("city_name", "lat", "lon")]
    nothing = F.coalesce(*[F.col(c).cast("string") for c in own]).isNull()
    iso = F.date_format(F.timestamp_seconds("dt"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    defaults = {
        "dt_iso": iso, "city_name": F.lit(DEFAULT_CITY), "lat": F.lit(DEFAULT_LAT), "lon": F.lit(DEFAULT_LON),
    }
    flat = rows.filter(~nothing).select(
        *keep,
        *[F.coalesce(F.col(c), defaults[c]).alias(c) if c in defaults else F.col(c) for c in PLACES],
    )
    reason = F.when(F.col("_doc").isNull(), "broken").when(F.size("_list") == 0, "empty")
    lost = found.select(*keep, F.col("_raw").alias("raw"), reason.alias("reason")).filter("reason IS NOT NULL")
    unknown = rows.filter(nothing).select(*keep, F.col("_raw").alias("raw"), F.lit("unknown").alias("reason"))
    return flat, lost.unionByName(unknown)


def _typed(columns: set[str], name: str, type_name: str) -> Column:
    """A raw column in its silver type, NULL where the feed does not deliver it."""
    return F.col(name).try_cast(type_name) if name in columns else F.lit(None).cast(type_name)


def weather_projection(df: DataFrame) -> DataFrame:
    """Flat raw rows to the 18 typed silver columns; missing rain counts as none."""
    have = set(df.columns)
    doubles = {
        "lat": "lat",
        "lon": "lon",
        "temp": "temperature_celsius",
        "feels_like": "feels_like_celsius",
        "temp_min": "temp_min_celsius",
        "temp_max": "temp_max_celsius",
        "pressure": "pressure_hpa",
    }
    # As a generator the time is parsed once; as a plain expression it would be copied, with whatever
    # makes its text, into the filters that are pushed below it.
    parsed = parse_weather_time("dt_iso", _typed(have, "dt", "bigint"))
    projected = df.select(
        _typed(have, "dt", "int").alias("unix_timestamp"),
        F.inline(F.array(F.struct(parsed.alias("datetime_utc")))),
        "city_name",
        *[_typed(have, raw, "double").alias(name) for raw, name in doubles.items()],
        _typed(have, "humidity", "int").alias("humidity_pct"),
        _typed(have, "wind_speed", "double").alias("wind_speed_ms"),
        F.coalesce(_typed(have, "rain_1h", "double"), F.lit(0.0)).alias("rain_1h_mm"),
        _typed(have, "weather_main", "string").alias("weather_category"),
        _typed(have, "weather_description", "string").alias("weather_description"),
    )
    time = F.col("datetime_utc")
    return projected.withColumns(
        {"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time)}
    )


def highest_reading(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Of several readings for a key the one with the highest values, compared column by column.

    So a re-run picks the same row, also if readings are reduced in several steps.
    """
    order = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    # The time goes first in the sort: it tells rows apart by one number, the station's name hardly does.
    return latest_by_key(df, keys[::-1], order)


def build_weather_enriched(raw: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Silver weather: dated rows, the highest reading per station and second."""
    return highest_reading(weather_projection(raw).filter(F.col("datetime_utc").isNotNull()), keys)


def conform_weather(df: DataFrame) -> DataFrame:
    """Decoded events to the silver names; readings without a temperature are dropped.

    Works on static and streaming frames alike.
    """
    time = F.col("datetime_utc")
    return (
        df.filter(F.col("temp").isNotNull())
        .withColumn("datetime_utc", parse_weather_time("dt_iso", "dt"))
        .select(
            F.col("dt").alias("unix_timestamp"),
            "datetime_utc",
            "city_name",
            "lat",
            "lon",
            F.col("temp").alias("temperature_celsius"),
            F.col("humidity").alias("humidity_pct"),
            F.col("wind_speed").alias("wind_speed_ms"),
            F.col("weather_main").alias("weather_category"),
            F.year(time).alias("year"),
            F.month(time).alias("month"),
        )
    )
