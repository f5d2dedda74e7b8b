"""Late rows are counted and kept: own watermark, replays, lost checkpoints, Spark's own drops."""

import datetime as dt
import time

import pytest
from pyspark.sql import types as T

from assaymill.session import scratch_path
from assaymill.streaming import events
from assaymill.streaming.lateness import MARK, REASON, DroppedRows, LateLedger, watch_drops

SCHEMA = "k string, ts timestamp"


def at(hour, minute=0):
    return dt.datetime(2024, 1, 1, hour, minute)


@pytest.fixture
def ledger(spark):
    return LateLedger(scratch_path(spark, "ledger"), "ts")


class Delivered:
    """An idempotent sink."""

    def __init__(self):
        self.batches = {}

    def __call__(self, df, run_id, batch_id):
        self.batches.setdefault((run_id, batch_id), sorted(r.k for r in df.collect()))

    def keys(self):
        return sorted(k for batch in self.batches.values() for k in batch)


def balanced(spark, ledger):
    for r in ledger.accounts(spark).collect():
        assert r.read == r.kept + r.late + r.untimed
    return ledger.accounts(spark).count()


def test_kept_and_late_are_all_that_was_read(spark, ledger):
    sink, frame = Delivered(), lambda *rows: spark.createDataFrame(list(rows), SCHEMA)
    assert ledger.accounts(spark).count() == 0 and ledger.late_rows(spark) is None
    # Inside the first micro-batch nothing is late, however old: there is no watermark yet.
    ledger.deliver(frame(("old", at(1)), ("b", at(10))), sink, "run", 0)
    assert ledger.late_rows(spark).count() == 0
    ledger.deliver(frame(("late", at(7, 59)), ("edge", at(8)), ("x", None), ("c", at(12))), sink, "run", 1)
    ledger.deliver(frame(("b", at(9, 59)), ("d", at(11))), sink, "run", 2)
    assert sink.keys() == ["b", "c", "d", "edge", "old"]
    late = {(r.k, r[REASON], r[MARK]) for r in ledger.late_rows(spark).collect()}
    assert late == {("late", "late", at(8)), ("x", "no time", at(8)), ("b", "late", at(10))}
    assert balanced(spark, ledger) == 3


def test_a_replay_splits_alike_and_counts_once(spark, ledger):
    sink = Delivered()
    first = spark.createDataFrame([("a", at(10))], SCHEMA)
    second = spark.createDataFrame([("late", at(1)), ("b", at(20))], SCHEMA)
    ledger.deliver(first, sink, "run", 0)

    def breaks(df, run_id, batch_id):
        sink(df, run_id, batch_id)
        raise OSError("lost")

    with pytest.raises(OSError):
        ledger.deliver(second, breaks, "run", 1)
    # Not closed: its late rows do not show, and neither does its account.
    assert ledger.accounts(spark).count() == 1 and ledger.late_rows(spark).count() == 0
    again = Delivered()
    for _ in range(2):
        ledger.deliver(second, again, "run", 1)
    assert again.batches == {("run", 1): ["b"]} and sink.keys() == ["a", "b"]
    assert [r.k for r in ledger.late_rows(spark).collect()] == ["late"]
    assert balanced(spark, ledger) == 2


def test_the_watermark_outlives_its_checkpoint_and_never_falls(spark, ledger):
    sink, frame = Delivered(), lambda *rows: spark.createDataFrame(list(rows), SCHEMA)
    ledger.deliver(frame(("a", at(20))), sink, "first", 0)
    ledger.deliver(frame(("b", at(3))), sink, "second", 0)
    ledger.deliver(frame(("c", at(17)), ("d", at(19))), sink, "first", 1)
    assert sink.keys() == ["a", "d"]
    assert sorted(r.k for r in ledger.late_rows(spark).collect()) == ["b", "c"]
    assert {r.after for r in ledger.accounts(spark).collect()} == {int(at(18).timestamp() * 1e6)}


def test_empty_and_untimed_batches_and_new_columns(spark, ledger):
    sink = Delivered()
    ledger.deliver(spark.createDataFrame([], SCHEMA), sink, "run", 0)
    ledger.deliver(spark.createDataFrame([("x", None)], SCHEMA), sink, "run", 1)
    wider = spark.createDataFrame([("y", None, 1)], f"{SCHEMA}, extra int")
    ledger.deliver(wider, sink, "run", 2)
    assert sink.keys() == []
    assert sorted((r.k, r.extra) for r in ledger.late_rows(spark).collect()) == [("x", None), ("y", 1)]
    assert balanced(spark, ledger) == 3


def test_a_running_query(spark, ledger):
    topic, checkpoint = scratch_path(spark, "topic"), scratch_path(spark, "ckpt")
    sink = Delivered()
    for rows in ([("a", at(9)), ("b", at(10))], [("late", at(6)), ("fine", at(8, 30))]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(topic)
        stream = events.stream_source(spark, "parquet", path=topic, schema=T.StructType.fromDDL(SCHEMA))
        ledger.run(stream, sink, checkpoint)
    assert sink.keys() == ["a", "b", "fine"]
    assert [r.k for r in ledger.late_rows(spark).collect()] == ["late"]
    assert balanced(spark, ledger) == 2


def test_drops_of_the_engine_are_counted(spark):
    topic, sink, checkpoint = (scratch_path(spark, n) for n in ("topic", "sink", "ckpt"))
    session = events.stateful_session(spark)
    drops = watch_drops(session)
    assert isinstance(drops, DroppedRows)
    for rows in ([("a", at(9)), ("b", at(10)), ("a", at(9))], [("late", at(6)), ("fine", at(8, 30)), ("b", at(10))]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(topic)
        stream = events.stream_source(session, "parquet", path=topic, schema=T.StructType.fromDDL(SCHEMA))
        events.run_to_files(events.within_watermark(stream, "ts", ["k"]), sink, checkpoint)
    for _ in range(100):
        if len(drops.ended) == 2:
            break
        time.sleep(0.1)
    session.streams.removeListener(drops)
    (total,) = drops.totals.values()
    kept = spark.read.parquet(sink).count()
    assert total == {"read": 6, "late": 1, "repeated": 2} and kept == 3
