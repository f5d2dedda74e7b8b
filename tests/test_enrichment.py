"""A stream that follows a stored table: new versions, sizes, a table that comes later."""

from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.session import scratch_path
from assaymill.sources.versions import VersionedLayer, publish_snapshot
from assaymill.streaming import events
from assaymill.streaming.enrichment import VERSION, StaticFollower, columns_of, no_batch, run_enrichment
from assaymill.streaming.merge_view import MergeOnReadView, batch_at, batch_of

READING = "unix_timestamp int, city_name string, datetime_utc timestamp, year int, month int"


def sales(spark, *rows):
    return spark.createDataFrame(list(rows), "date_key string, total_orders int, other int")


def readings(spark, *seconds):
    return spark.createDataFrame([(s,) for s in seconds], "unix_timestamp int").selectExpr(
        "unix_timestamp", "'X' AS city_name", "timestamp_seconds(unix_timestamp) AS datetime_utc",
        "2024 AS year", "1 AS month",
    )


def test_a_new_version_is_seen_by_a_running_query(spark):
    layer = VersionedLayer(spark, scratch_path(spark, "gold"))
    topic = scratch_path(spark, "topic")
    sink = MergeOnReadView(scratch_path(spark, "enriched"), no_batch)
    readings(spark, 1).write.parquet(topic)
    stream = events.stream_source(spark, "parquet", path=topic, schema=T.StructType.fromDDL(READING))
    static = columns_of(batch_of(layer, "daily"), ["date_key", "total_orders"])
    query = run_enrichment(
        stream, static, sink.append, scratch_path(spark, "ckpt"),
        trigger={"processingTime": "100 milliseconds"}, wait=False,
    )
    try:
        query.processAllAvailable()
        for number, second in ((5, 2), (7, 3)):
            publish_snapshot(sales(spark, ("19700101", number, 0)), layer, "daily")
            readings(spark, second).write.mode("append").parquet(topic)
            query.processAllAvailable()
    finally:
        query.stop()
    got = {r.unix_timestamp: (r.total_orders, r[VERSION]) for r in sink.read(spark).collect()}
    assert [got[s][0] for s in (1, 2, 3)] == [None, 5, 7]
    assert got[1][1] is None and len({got[2][1], got[3][1], None}) == 3
    assert "other" not in sink.read(spark).columns


def test_broadcast_only_while_the_version_is_small(spark):
    path = scratch_path(spark, "daily")
    follower = StaticFollower(batch_at(path), "date_key", limit_bytes=400)
    # Not a literal: an outer join on a constant key is planned as a nested loop.
    batch = readings(spark, 1, 2).withColumn("date_key", F.concat(F.lit("d"), "unix_timestamp"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales(spark, ("d1", 3, 0)).write.parquet(path)
        assert "BroadcastHashJoin" in plan_of(follower.join(batch))
        many = [(f"d{i}", i, 0) for i in range(100)]
        sales(spark, *many).write.mode("overwrite").parquet(path)
        spark.catalog.refreshByPath(path)
        joined = follower.join(batch)
        assert "BroadcastHashJoin" not in plan_of(joined)
        assert sorted(r.total_orders for r in joined.collect()) == [1, 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_version_is_measured_once(spark, monkeypatch):
    from assaymill.streaming import enrichment

    measured = []
    monkeypatch.setattr(enrichment, "measured_bytes", lambda df: measured.append(1) or 1)
    layer = VersionedLayer(spark, scratch_path(spark, "gold"))
    follower = StaticFollower(batch_of(layer, "daily"), "date_key")
    batch = readings(spark, 1).withColumn("date_key", F.lit("d1"))
    for _ in range(2):
        publish_snapshot(sales(spark, ("d1", 3, 0)), layer, "daily")
        for _ in range(3):
            assert follower.join(batch).count() == 1
    assert len(measured) == 2
