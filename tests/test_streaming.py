import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from assaymill.operators import weather
from assaymill.session import scratch_path
from assaymill.streaming import events
from assaymill.streaming.unified import UnifiedView, unify

SCHEMA = "k string, ts timestamp"


@pytest.fixture
def topic(spark):
    """A folder as topic, with functions to add rows and to open a stream over it."""
    path = scratch_path(spark, "topic")

    def add(rows, schema=SCHEMA):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    def stream(schema=SCHEMA, **options):
        from pyspark.sql.types import StructType

        return events.stream_source(
            events.stateful_session(spark),
            "parquet",
            path=path,
            schema=StructType.fromDDL(schema),
            **options,
        )

    return add, stream


def _at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


def test_late_rows_and_repeats_are_dropped_across_restarts(spark, topic):
    add, stream = topic
    sink, checkpoint = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")

    def run():
        events.run_to_files(events.within_watermark(stream(), "ts", ["k"]), sink, checkpoint)
        return {r.k for r in spark.read.parquet(sink).collect()}

    add([("a", _at(9)), ("b", _at(10)), ("a", _at(9))])
    assert run() == {"a", "b"}
    add([("late", _at(6)), ("fine", _at(8, 30)), ("b", _at(10))])
    assert run() == {"a", "b", "fine"}
    assert spark.read.parquet(sink).count() == 3


def test_watermark_needs_a_stream(spark):
    static = spark.createDataFrame([("a", _at(1))], SCHEMA)
    with pytest.raises(ValueError):
        events.within_watermark(static, "ts", ["k"])


def test_decode_routes_malformed(spark):
    good = {"dt": 1506906000, "dt_iso": "2017-10-02 01:00:00 +0000 UTC", "temp": 8.16}
    docs = [json.dumps(good), "notjson", json.dumps({**good, "temp": "cold"}), None]
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    decoded = events.decode_events(df.withColumn("value", F.col("value").cast("binary")))
    rows = decoded.collect()
    assert [r.malformed for r in rows] == [False, True, False, True]
    assert [r.temp for r in rows] == [8.16, None, None, None]
    assert events.well_formed(decoded).columns == weather.EVENT_SCHEMA.fieldNames()
    assert [r.raw for r in events.dead_letters(decoded).collect()] == ["notjson", None]
    conformed = weather.conform_weather(events.well_formed(decoded)).collect()
    assert [(r.temperature_celsius, r.year, r.month) for r in conformed] == [(8.16, 2017, 10)]


def test_flatten_shapes(spark):
    record = {"dt": 10, "main": {"temp": 1.5}, "wind": {"speed": 2.0}, "weather": [{"main": "Rain"}]}
    docs = [json.dumps(record), json.dumps({"list": [record, {"dt": 20, "temp": 3.0}]}), '{"list": []}']
    df = spark.createDataFrame([(d,) for d in docs], "payload string")
    rows = weather.flatten_weather_json(df).collect()
    assert [(r.dt, r.temp, r.wind_speed, r.weather_main) for r in rows] == [
        (10, 1.5, 2.0, "Rain"), (10, 1.5, 2.0, "Rain"), (20, 3.0, None, None), (None,) * 4,
    ]
    assert rows[0].city_name == "Patagonia" and rows[2].dt_iso == "1970-01-01T00:00:20Z"


VIEW = (
    "unix_timestamp int, datetime_utc timestamp, city_name string, lat double, lon double, "
    "temperature_celsius double, humidity_pct int, wind_speed_ms double, "
    "weather_category string, year int, month int"
)


def _reading(second, temp, city="X", month=1):
    return (second, _at(0), city, 0.0, 0.0, temp, 1, 1.0, "Rain", 2024, month)


def _view(spark):
    paths = [scratch_path(spark, n) for n in ("batch", "store", "view")]
    return UnifiedView(*paths), paths


def _content(spark, path):
    return {
        (r.city_name, r.unix_timestamp): (r.temperature_celsius, r.origin)
        for r in spark.read.parquet(path).collect()
    }


def test_unified_view_keeps_earlier_batches_and_survives_replay(spark):
    view, (_, _, target) = _view(spark)
    first = spark.createDataFrame([_reading(1, 1.0), _reading(2, 2.0)], VIEW)
    second = spark.createDataFrame([_reading(2, 9.0), _reading(3, 3.0)], VIEW)
    view.on_micro_batch(first, 0)
    view.on_micro_batch(second, 1)
    expected = {("X", 1): (1.0, "stream"), ("X", 2): (9.0, "stream"), ("X", 3): (3.0, "stream")}
    assert _content(spark, target) == expected
    view.on_micro_batch(second, 1)
    view.on_micro_batch(first, 0)
    assert _content(spark, target) == expected
    assert view.current(spark).count() == 3


def test_batch_wins_and_other_months_stay(spark):
    view, (batch, _, target) = _view(spark)
    history = [_reading(1, 5.0), _reading(1, 7.0, "Y"), _reading(40, 4.0, month=2)]
    spark.createDataFrame(history, VIEW).write.partitionBy("year", "month").parquet(batch)
    view.on_micro_batch(spark.createDataFrame([_reading(40, 8.0, month=2)], VIEW), 0)
    assert _content(spark, target) == {("X", 40): (4.0, "batch")}
    view.on_micro_batch(spark.createDataFrame([_reading(1, 1.0), _reading(2, 2.0)], VIEW), 1)
    assert _content(spark, target) == {
        ("X", 1): (5.0, "batch"),
        ("Y", 1): (7.0, "batch"),
        ("X", 2): (2.0, "stream"),
        ("X", 40): (4.0, "batch"),
    }


def test_compacted_store_gives_the_same_view(spark):
    view, (batch, _, target) = _view(spark)
    for i, temp in enumerate((1.0, 2.0, 3.0)):
        rows = [_reading(1, temp), _reading(10 + i, temp, month=2)]
        view.on_micro_batch(spark.createDataFrame(rows, VIEW), i)
    before = sorted(map(str, view.current(spark).collect()))
    compacted = scratch_path(spark, "compacted")
    view.compact_store(spark, compacted)
    again = UnifiedView(batch, compacted, scratch_path(spark, "view"))
    assert sorted(map(str, again.current(spark).collect())) == before
    assert spark.read.parquet(compacted).select("batch_id").distinct().count() == 1
    again.on_micro_batch(spark.createDataFrame([_reading(1, 9.0)], VIEW), 3)
    assert _content(spark, again.view_path)[("X", 1)] == (9.0, "stream")


def test_replay_after_compaction_keeps_everything(spark):
    view, (batch, _, _) = _view(spark)
    batches = [[_reading(2 * i, 1.0), _reading(2 * i + 1, 1.0)] for i in range(3)]
    for i, rows in enumerate(batches):
        view.on_micro_batch(spark.createDataFrame(rows, VIEW), i)
    compacted = scratch_path(spark, "compacted")
    view.compact_store(spark, compacted)
    again = UnifiedView(batch, compacted, scratch_path(spark, "view"))
    before = again.current(spark).count()
    again.on_micro_batch(spark.createDataFrame(batches[2], VIEW), 2)
    assert again.current(spark).count() == before == view.current(spark).count()


def test_new_checkpoint_continues_after_the_store(spark):
    view, _ = _view(spark)
    first = scratch_path(spark, "one")
    assert view._first_batch(spark, first) == 0
    view.on_micro_batch(spark.createDataFrame([_reading(1, 1.0)], VIEW), 0)
    assert view._first_batch(spark, scratch_path(spark, "two")) == 1
    assert view._first_batch(spark, first) == 0


def test_reading_without_a_time_is_kept(spark):
    view, (_, _, target) = _view(spark)
    row = (7, None, "X", 0.0, 0.0, 1.0, 1, 1.0, "Rain", None, None)
    view.on_micro_batch(spark.createDataFrame([row, _reading(1, 1.0)], VIEW), 0)
    assert set(_content(spark, target)) == {("X", 7), ("X", 1)}


def test_empty_micro_batch_changes_nothing(spark):
    view, (_, store, target) = _view(spark)
    empty = spark.createDataFrame([], VIEW)
    view.on_micro_batch(empty, 0)
    assert view.current(spark) is None or view.current(spark).count() == 0
    view.on_micro_batch(spark.createDataFrame([_reading(1, 1.0)], VIEW), 1)
    view.on_micro_batch(empty, 2)
    assert set(_content(spark, target)) == {("X", 1)}


def test_unify_without_batch(spark):
    rows = spark.createDataFrame([_reading(1, 1.0), _reading(1, 2.0)], VIEW)
    assert [r.temperature_celsius for r in unify(None, rows).collect()] == [2.0]


def test_stream_equals_batch(spark, sf_dir):
    """One file per trigger and one batch over everything conform to the same rows."""
    source = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.unix_timestamp(F.col("ts").cast("timestamp")).cast("int").alias("dt"),
        F.lit(None).cast("string").alias("dt_iso"),
        F.lit("X").alias("city_name"),
        F.lit(0.0).alias("lat"),
        F.lit(0.0).alias("lon"),
        F.col("value").alias("temp"),
        F.lit(1).alias("humidity"),
        F.lit(1.0).alias("wind_speed"),
        F.col("event_type").alias("weather_main"),
    )
    path = scratch_path(spark, "files")
    source.repartition(5).write.parquet(path)
    stream = events.stream_source(
        spark, "parquet", path=path, schema=source.schema, maxFilesPerTrigger=1
    )
    sink = scratch_path(spark, "stream-sink")
    events.run_to_files(weather.conform_weather(stream), sink, scratch_path(spark, "c"))
    got = sorted(map(str, spark.read.parquet(sink).collect()))
    assert got == sorted(map(str, weather.conform_weather(source).collect()))
