"""Merge-on-read view: appended deltas, replay, lost checkpoints, folds."""

import datetime as dt
import itertools
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from assaymill.session import scratch_path
from assaymill.sources.versions import VersionedLayer, publish_snapshot
from assaymill.streaming import events
from assaymill.streaming.merge_view import MergeOnReadView, batch_at, batch_of
from assaymill.streaming.unified import UnifiedView, query_id, unify

VIEW = "unix_timestamp int, city_name string, temp double, year int, month int"


def reading(second, temp, city="X", month=1, year=2024):
    return (second, city, temp, year, month)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), VIEW)


@pytest.fixture
def paths(spark):
    return scratch_path(spark, "batch"), scratch_path(spark, "merge")


@pytest.fixture
def view(paths):
    return MergeOnReadView(paths[1], batch_at(paths[0]))


def content(df):
    found = [((r.city_name, r.unix_timestamp, r.month), (r.temp, r.origin)) for r in df.collect()]
    assert len(found) == len(dict(found))
    return dict(found)


def files(spark, path):
    return {r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").load(path).select("path").collect()}


def test_deltas_show_at_once_and_replay_adds_nothing(spark, view, paths):
    assert view.read(spark) is None and view.fold(spark) is None
    assert view.append(frame(spark, reading(1, 1.0), reading(2, 2.0)), "run-a", 0)
    assert view.append(frame(spark, reading(2, 9.0), reading(3, 3.0)), "run-a", 1)
    expected = {("X", 1, 1): (1.0, "stream"), ("X", 2, 1): (9.0, "stream"), ("X", 3, 1): (3.0, "stream")}
    assert content(view.read(spark)) == expected
    before = files(spark, f"{paths[1]}/delta")
    assert not view.append(frame(spark, reading(2, 2.0)), "run-a", 0)
    assert files(spark, f"{paths[1]}/delta") == before and content(view.read(spark)) == expected
    view.fold(spark)
    assert content(view.read(spark)) == expected
    # A batch that is replayed after its fold, or after its data went, adds nothing either.
    assert view.expire(spark, older_than_hours=0) == 2
    assert not view.append(frame(spark, reading(2, 2.0)), "run-a", 1)
    assert content(view.read(spark)) == expected and view.fold(spark) is None
    assert view.expire(spark, older_than_hours=0) == 0


def test_batch_wins_and_a_new_batch_table_is_seen(spark, view, paths):
    frame(spark, reading(1, 5.0), reading(40, 4.0, month=2)).write.partitionBy("year", "month").parquet(paths[0])
    assert content(view.read(spark)) == {("X", 1, 1): (5.0, "batch"), ("X", 40, 2): (4.0, "batch")}
    view.append(frame(spark, reading(1, 1.0), reading(2, 2.0)), "r", 0)
    expected = {("X", 1, 1): (5.0, "batch"), ("X", 2, 1): (2.0, "stream"), ("X", 40, 2): (4.0, "batch")}
    assert content(view.read(spark)) == expected
    view.fold(spark)
    assert content(view.read(spark)) == expected
    view.append(frame(spark, reading(1, 8.0), reading(40, 8.0, month=2), reading(2, 7.0)), "r", 1)
    expected[("X", 2, 1)] = (7.0, "stream")
    assert content(view.read(spark)) == expected
    # The batch table drops a row: the latest streamed one comes back, before and after a fold.
    frame(spark, reading(2, 6.0), reading(40, 4.0, month=2)).write.mode("overwrite").partitionBy("year", "month").parquet(paths[0])
    expected = {("X", 1, 1): (8.0, "stream"), ("X", 2, 1): (6.0, "batch"), ("X", 40, 2): (4.0, "batch")}
    assert content(view.read(spark)) == expected
    assert view.fold(spark) is not None and view.fold(spark) is None
    assert content(view.read(spark)) == expected


def test_no_month_is_touched_by_a_trigger_and_a_fold_rewrites_only_its_own(spark, view, paths):
    view.append(frame(spark, *[reading(100 * m, 1.0, month=m) for m in range(1, 7)]), "r", 0)
    view.fold(spark)
    layer = VersionedLayer(spark, f"{paths[1]}/base")
    base, first = files(spark, f"{paths[1]}/base"), layer.version()
    view.append(frame(spark, reading(201, 2.0, month=2)), "r", 1)
    assert files(spark, f"{paths[1]}/base") == base
    view.fold(spark)
    for table in ("stream", "view"):
        old, new = set(first.tables[table].folders), set(layer.version().tables[table].folders)
        assert len(new) == 6 and {f.split("/", 1)[1] for f in old - new} == {"year=2024/month=2"}
    assert len(content(view.read(spark))) == 7


def test_filters_reach_the_base_and_it_is_not_shuffled(spark, view):
    view.append(frame(spark, *[reading(100 * m, 1.0, month=m) for m in range(1, 7)]), "r", 0)
    view.fold(spark)
    view.append(frame(spark, reading(201, 2.0, month=2)), "r", 1)
    plan = plan_of(view.read(spark).filter("month = 2 AND origin = 'stream'"))
    assert "PartitionFilters: [isnotnull(month" in plan and "SortMergeJoin" not in plan


def test_a_lost_checkpoint_at_the_same_path_loses_nothing(spark, view, paths):
    topic, checkpoint = scratch_path(spark, "topic"), scratch_path(spark, "ckpt")
    copies = itertools.count()

    def run(target, path):
        stream = events.stream_source(spark, "parquet", path=path, schema=frame(spark).schema)
        return target.run(stream, checkpoint)

    frame(spark, reading(1, 1.0)).coalesce(1).write.parquet(topic)
    run(view, topic)
    first_id = query_id(spark, checkpoint)
    fresh = scratch_path(spark, f"topic-{next(copies)}")
    frame(spark, reading(2, 2.0)).coalesce(1).write.parquet(fresh)
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    run(view, fresh)
    assert query_id(spark, checkpoint) != first_id
    assert set(content(view.read(spark))) == {("X", 1, 1), ("X", 2, 1)}
    # A later run of the same checkpoint goes on with the run it belongs to.
    frame(spark, reading(2, 7.0)).coalesce(1).write.mode("append").parquet(fresh)
    run(view, fresh)
    assert content(view.read(spark))[("X", 2, 1)] == (7.0, "stream")
    assert view.run_number(spark, first_id) == 1 and view.run_number(spark, query_id(spark, checkpoint)) == 2


def test_a_lost_checkpoint_does_not_overwrite_the_partitioned_store(spark):
    store, target, checkpoint = (scratch_path(spark, n) for n in ("store", "view", "ckpt"))
    unified = UnifiedView(scratch_path(spark, "none"), store, target)
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    for second in (1, 2):
        topic = scratch_path(spark, f"topic-{second}")
        frame(spark, reading(second, 1.0)).coalesce(1).write.parquet(topic)
        stream = events.stream_source(spark, "parquet", path=topic, schema=frame(spark).schema)
        unified.run(stream, checkpoint)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    assert spark.read.parquet(store).count() == spark.read.parquet(target).count() == 2


def test_keys_without_time_and_keys_that_cross_months(spark, view, paths):
    frame(spark, reading(7, 5.0, month=3)).write.partitionBy("year", "month").parquet(paths[0])
    view.append(frame(spark, (None, "X", 1.0, None, None), reading(1, 1.0)), "r", 0)
    view.fold(spark)
    view.append(frame(spark, (None, "X", 2.0, None, None), reading(1, 3.0, month=2)), "r", 1)
    expected = {("X", None, None): (2.0, "stream"), ("X", 1, 2): (3.0, "stream"), ("X", 7, 3): (5.0, "batch")}
    assert content(view.read(spark)) == expected
    view.fold(spark)
    assert content(view.read(spark)) == expected
    view.append(frame(spark, reading(7, 1.0, month=4)), "r", 2)
    view.append(frame(spark, reading(9, 1.0, month=4)), "r", 3)
    expected[("X", 9, 4)] = (1.0, "stream")
    for _ in range(2):
        assert content(view.read(spark)) == expected
        view.fold(spark)


def test_added_column(spark, view):
    view.append(frame(spark, reading(1, 1.0)), "r", 0)
    view.fold(spark)
    view.append(frame(spark, reading(2, 2.0)).withColumn("note", F.lit("new")), "r", 1)
    view.fold(spark)
    assert {r.unix_timestamp: r.note for r in view.read(spark).collect()} == {1: None, 2: "new"}


def test_a_published_table_as_batch_side(spark, paths):
    layer = VersionedLayer(spark, paths[0])
    view = MergeOnReadView(paths[1], batch_of(layer, "weather"))
    view.append(frame(spark, reading(1, 1.0)), "r", 0)
    view.fold(spark)
    publish_snapshot(frame(spark, reading(1, 5.0)), layer, "weather", ["year", "month"])
    assert content(view.read(spark)) == {("X", 1, 1): (5.0, "batch")}
    view.fold(spark)
    publish_snapshot(frame(spark, reading(1, 5.0)), layer, "other")
    assert view.fold(spark) is None  # another table of the layer changed


@pytest.mark.parametrize("seed", range(2))
def test_any_order_of_folds_equals_one_merge(spark, view, paths, seed):
    rng = random.Random(seed)

    def some(n):
        return [reading(s, rng.random(), rng.choice("XY"), s % 3 + 1) for s in (rng.randrange(12) for _ in range(n))]

    frame(spark, *some(5)).dropDuplicates(["city_name", "unix_timestamp"]).write.partitionBy("year", "month").parquet(paths[0])
    everything = []
    for batch_id in range(4):
        rows = some(4)
        everything.append(frame(spark, *rows).withColumn("batch_id", F.lit(batch_id)))
        view.append(frame(spark, *rows), "r", batch_id)
        if rng.random() < 0.5:
            view.fold(spark)
    merged = everything[0]
    for df in everything[1:]:
        merged = merged.unionByName(df)
    assert content(view.read(spark)) == content(unify(spark.read.parquet(paths[0]), merged))
