from conftest import plan_of
from pyspark.sql import functions as F

from assaymill.operators import facts, joins, kpis


def _skewed(spark):
    """A third of the rows share one key."""
    big = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 1000 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 700).cast("string")))
        .alias("k"),
        F.col("id").alias("v"),
    )
    unique = (
        spark.range(0, 650)
        .select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.lit(1).alias("x"))
        .unionByName(spark.createDataFrame([("hot", 2)], "k string, x int"))
    )
    return big, unique


def _rows(df):
    return sorted(map(tuple, df.select("k", "v", "x").collect()), key=str)


def test_skew_join_equals_plain_join(spark):
    big, unique = _skewed(spark)
    for how in ("inner", "left"):
        ours = joins.skew_join(big, unique, "k", how)
        assert _rows(ours) == _rows(big.join(unique, "k", how))
        assert "Union" in plan_of(ours)


def test_skew_join_hot_key_without_partner(spark):
    big, unique = _skewed(spark)
    lonely = unique.filter("k <> 'hot'")
    for how in ("inner", "left"):
        ours = joins.skew_join(big, lonely, "k", how)
        assert _rows(ours) == _rows(big.join(lonely, "k", how))


def test_null_keys_pass_beside_the_join(spark):
    big, unique = _skewed(spark)
    big = big.unionByName(big.limit(7).withColumn("k", F.lit(None).cast("string")))
    for how in ("inner", "left"):
        assert _rows(joins.skew_join(big, unique, "k", how)) == _rows(big.join(unique, "k", how))


def test_heavy_keys(spark):
    big, _ = _skewed(spark)
    assert joins.heavy_keys(big, "k", 0.02) == ["hot"]
    assert joins.heavy_keys(big.limit(0), "k", 0.02) == []


def test_broadcast_only_below_the_limit(spark):
    large, small = spark.range(1000).withColumn("s", F.lit("x" * 50)), spark.range(100)
    assert "BroadcastHashJoin" in plan_of(joins.broadcast_join(large, small, "id"))
    assert joins.measured_bytes(small) == 1600
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = joins.broadcast_join(large, small, "id", limit_bytes=100)
        assert "BroadcastHashJoin" not in plan_of(shuffled)
        assert shuffled.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_insert_if_absent(spark):
    have = spark.createDataFrame([("a", 1)], ["k", "v"])
    new = spark.createDataFrame([("a", 2), ("b", 3), ("b", 3), (None, 4)], "k string, v long")
    assert [tuple(r) for r in joins.insert_if_absent(have, new, ["k"]).collect()] == [("b", 3)]


def test_count_orphans(spark):
    child = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    got = joins.count_orphans(
        {"child": child, "empty": child.limit(0), "parent": parent},
        [("child", "k", "parent"), ("empty", "k", "parent")],
    )
    assert {tuple(r) for r in got.collect()} == {
        ("child", "k", "parent", 3, 1),
        ("empty", "k", "parent", 0, 0),
    }


def test_order_totals_aggregate_before_the_shuffle(spark, sf_dir):
    df = spark.createDataFrame([("o", 1.5), ("o", 2.25)], ["order_id", "payment_value"])
    totals = facts.order_totals(df)
    assert totals.first()["total_cents"] == 375
    plan = plan_of(totals)
    assert plan.index("partial_sum") > plan.index("Exchange")
