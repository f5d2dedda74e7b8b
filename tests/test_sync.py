"""Load, sync and enrichment jobs over a whole lake."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from assaymill import __main__ as cli
from assaymill.plans import sync
from assaymill.plans.bronze_views import raw_view
from assaymill.session import scratch_path
from assaymill.sources.schemas import RAW_TABLES
from assaymill.sources.tables import Lake
from assaymill.sources.versions import VersionedLake, publish_snapshot
from assaymill.streaming import events
from assaymill.streaming.enrichment import no_batch
from assaymill.streaming.lateness import LateLedger
from assaymill.streaming.merge_view import MergeOnReadView


def test_sync_follows_the_declared_cursors(spark, sf_dir):
    lake = Lake(scratch_path(spark, "lake"))
    by_cursor = next(n for n, t in RAW_TABLES.items() if t.cursor and t.source == "ecommerce")
    replaced = next(n for n, t in RAW_TABLES.items() if not t.cursor)
    tables = sync.chosen(names=[by_cursor, replaced])

    def read(name):
        return raw_view(spark, sf_dir, name)

    counts = {}
    for day in ("2001-12-30", "2001-12-31"):
        done = sync.run_sync(lake, read, tables, day)
        assert done == {by_cursor: "incremental", replaced: "full refresh"}
        for name, table in tables.items():
            counts.setdefault(name, []).append(spark.read.parquet(lake.raw(table.source, name)).count())
    for name, (first, second) in counts.items():
        assert first == second == read(name).count()


def test_only_declared_tables(spark):
    assert sync.chosen("weather").keys() < sync.chosen().keys()
    with pytest.raises(ValueError):
        sync.chosen(names=["orders", "nothing"])


def test_csv_loads_add_once_and_report_rejects(spark, sf_dir, monkeypatch):
    lake, folder = Lake(scratch_path(spark, "lake")), scratch_path(spark, "csv")
    table = RAW_TABLES["customers"]
    rows = raw_view(spark, sf_dir, "customers").select(*table.columns).limit(50)
    rows.write.option("header", True).option("escape", '"').csv(f"{folder}/customers.csv")
    args = cli.parse_args(["load", "--root", lake.root, "--csv", folder, "--only", "customers"])
    for _ in range(2):
        assert cli.run_loads(spark, lake, args) == 0
    loaded = spark.read.parquet(lake.raw(table.source, "customers"))
    assert loaded.count() == rows.select(*table.key).distinct().count()


@pytest.mark.parametrize("lake_type", [Lake, VersionedLake])
def test_enrichment_job(spark, lake_type):
    lake, topic = lake_type(scratch_path(spark, "lake")), scratch_path(spark, "topic")
    args = cli.parse_args(["stream-enrich", "--root", lake.root])
    schema = "unix_timestamp int, city_name string, datetime_utc timestamp, year int, month int"

    def publish(orders):
        kpi = spark.createDataFrame([("20240101", orders, 1.0)], "date_key string, total_orders int, avg_temp_c double")
        if lake_type is VersionedLake:
            publish_snapshot(kpi, lake.layer(spark, "gold"), "kpi_weather_sales_impact")
        else:
            kpi.write.mode("overwrite").parquet(lake.gold("kpi_weather_sales_impact"))

    for orders, hours in ((5, [10]), (7, [11, 2])):
        publish(orders)
        rows = [(h, "X", dt.datetime(2024, 1, 1, h), 2024, 1) for h in hours]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(topic)
        stream = events.stream_source(spark, "parquet", path=topic, schema=T.StructType.fromDDL(schema))
        cli.run_enrich(spark, lake, args, stream, {"availableNow": True}, wait=True)
    root = lake.silver_stream("weather_sales")
    view = MergeOnReadView(root, no_batch).read(spark)
    assert {(r.unix_timestamp, r.total_orders) for r in view.collect()} == {(10, 5), (11, 7)}
    late = LateLedger(f"{root}_late", "datetime_utc").late_rows(spark)
    assert [r.unix_timestamp for r in late.collect()] == [2]
    assert "avg_temp_c" not in view.columns
