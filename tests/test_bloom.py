"""Bloom-pruned anti joins: nothing that matches is lost, little else is shuffled."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from assaymill.operators import bloom, joins
from assaymill.session import materialize
from assaymill.sources import loads


def test_all_matches_and_few_others_pass(spark):
    history = spark.range(200_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("part"))
    few = spark.range(0, 200_000, 100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("part"))
    passed = bloom.possible_matches(history, few, ["k", "part"], 2_000)
    assert passed.columns == ["k", "part"]
    rows = passed.agg(F.count("*"), F.count(F.when(F.col("k") % 100 == 0, 1))).first()
    assert rows[1] == 2_000
    assert rows[0] - rows[1] < 0.02 * 198_000
    plan = plan_of(passed)
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def test_underestimated_filters_and_empty_sides_lose_nothing(spark):
    history = spark.range(1_000).select(F.col("id").alias("k"))
    crowded = bloom.possible_matches(history, history, ["k"], 1)
    assert crowded.count() == 1_000
    assert bloom.possible_matches(history, history.limit(0), ["k"], 0).count() == 0
    assert bloom.possible_matches(history.limit(0), history, ["k"], 1_000).count() == 0


def test_null_keys_and_text_keys(spark):
    rows = [("a", None), (None, 1), ("b", 2), ("b", 2), ("", 3)]
    df = spark.createDataFrame(rows, "s string, n int")
    assert bloom.possible_matches(df, df, ["s", "n"], 5).count() == 5
    other = spark.createDataFrame([("b", 2)], "s string, n int")
    assert [tuple(r) for r in bloom.possible_matches(df, other, ["s", "n"], 1).collect()] == [("b", 2)] * 2


@pytest.mark.parametrize("kind", ["bigint", "double", "string"])
def test_unlike_types_are_joined_without_a_filter(spark, kind):
    history = spark.sql(f"SELECT cast(id AS {kind}) AS k FROM range(10)")
    few = spark.sql("SELECT cast(id AS int) AS k FROM range(5, 15)")
    got = joins.insert_if_absent(history, few, ["k"], prune=True)
    assert sorted(r.k for r in got.collect()) == list(range(10, 15))
    assert bloom.possible_matches(history, few, ["k"], 10) is history
    zero = spark.sql("SELECT cast('-0.0' AS double) AS k")
    assert not bloom.prunable(zero, zero, ["k"])


def test_filters_beyond_the_limit_are_not_built(spark):
    df = spark.range(10).select(F.col("id").alias("k"))
    assert bloom.possible_matches(df, df, ["k"], 10**12) is df


def test_pruned_insert_equals_the_plain_one(spark):
    history = spark.range(5_000).select((F.col("id") % 1_777).cast("string").alias("k"), F.lit("old").alias("v"))
    incoming = spark.range(300).select(
        F.when(F.col("id") % 9 != 0, (F.col("id") % 200 + 1_700).cast("string")).alias("k"), F.lit("new").alias("v")
    )
    plain = joins.insert_if_absent(history, incoming, ["k"])
    pruned = joins.insert_if_absent(history, incoming, ["k"], prune=True)
    assert sorted(plain.collect()) == sorted(pruned.collect()) and pruned.count() > 0


def test_only_possible_matches_of_the_history_are_shuffled(spark):
    path_rows = spark.range(100_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    history = materialize(path_rows, "long-history")
    fresh = materialize(spark.range(99_990, 100_010).select(F.col("id").alias("k")), "few")
    passed = bloom.possible_matches(history, fresh, ["k"], 20)
    assert passed.count() < 100
    plan = plan_of(fresh.join(passed.select("k").dropDuplicates(), ["k"], "left_anti"))
    # The history's scan meets the broadcast filter before any exchange of its keys.
    assert "ReadSchema: struct<k:bigint>" in plan and "BroadcastHashJoin" in plan


def test_pruned_orphans_equal_the_plain_ones(spark):
    child = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    frames = {"child": child, "empty": child.limit(0), "parent": parent}
    references = [("child", "k", "parent"), ("empty", "k", "parent")]
    plain, pruned = (joins.count_orphans(frames, references, prune) for prune in (False, True))
    assert sorted(plain.collect()) == sorted(pruned.collect())


def test_loads_add_only_what_is_absent(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "table")
    schema = spark.createDataFrame([], "k int, v string").schema
    for first, last in ((0, 50), (25, 75), (25, 75)):
        rows = spark.range(first, last).selectExpr("cast(id AS int) AS k", f"'{first}' AS v")
        rows.write.mode("overwrite").option("header", True).csv(source)
        assert loads.load_csv(spark, source, schema, target, ["k"]) == 0
    got = {(r.k, r.v) for r in spark.read.parquet(target).collect()}
    assert got == {(k, "0" if k < 50 else "25") for k in range(75)}
