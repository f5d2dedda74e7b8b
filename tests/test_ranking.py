import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from assaymill.operators import kpis, ranking


def _tied(spark, n, partitions=7):
    """Values where one holds most rows, as order counts per customer do."""
    return spark.range(0, n, 1, partitions).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias("key"),
        F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 5).cast("bigint").alias("v"),
        F.when(F.col("id") % 11 != 0, F.col("id") * 7919 % 101).alias("w"),
    )


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 1003])
def test_ntile_equals_window(spark, n):
    df = _tied(spark, n)
    order = [F.col("v").desc(), F.col("key").asc()]
    ours = ranking.with_ntile(df, order, 5)
    theirs = df.withColumn("tile", F.ntile(5).over(Window.orderBy(*order)))
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(map(tuple, theirs.collect()), key=str)


def test_rank_equals_window(spark):
    df = _tied(spark, 501)
    order = [F.col("v").asc(), F.col("key").asc()]
    ours = {(r.key, r["rank"]) for r in ranking.with_rank(df, order).collect()}
    numbered = df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    assert ours == {(r.key, r["rank"]) for r in numbered.collect()}


@pytest.mark.parametrize("n", [0, 2, 4, 5, 999])
def test_cuts_equal_windows(spark, n):
    df = _tied(spark, n)
    tiles = {"a": "v", "b": "w"}
    plain = df.withColumns(
        {
            t: F.ntile(5).over(Window.orderBy(F.col(m).asc_nulls_first(), F.col("key").asc()))
            for t, m in tiles.items()
        }
    )
    cut = ranking.with_tiles(df, "key", tiles, 5)
    cols = ["key", "a", "b"]
    assert sorted(map(tuple, plain.select(cols).collect())) == sorted(
        map(tuple, cut.select(cols).collect())
    )


def test_distributed_tiles_need_no_single_partition(spark):
    df = _tied(spark, 500)
    cut = ranking.with_tiles(df, "key", {"a": "v"}, 5)
    assert "Window" not in cut._jdf.queryExecution().executedPlan().toString()


def test_rfm_scores_are_window_tiles(spark):
    orders = spark.range(0, 400, 1, 5).select(
        F.col("id").cast("string").alias("order_id"),
        (F.col("id") % 90).cast("string").alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.lit(2017).alias("year"),
        F.lit(1).alias("month"),
        F.lit(3).alias("delivery_days"),
        F.timestamp_seconds(F.lit(1_500_000_000) + F.col("id") * 50_000).alias(
            "order_purchase_timestamp"
        ),
    )
    payments = spark.range(0, 600, 1, 5).select(
        (F.col("id") % 380).cast("string").alias("order_id"),
        (F.col("id") % 37 + 0.25).alias("payment_value"),
    )
    values = kpis.order_values(orders, payments)
    for best_is_five in (True, False):
        scored = kpis.rfm_segments(values, best_is_five=best_is_five)
        spent = F.col("monetary_brl") if best_is_five else -F.col("monetary_brl")
        tile = F.ntile(5).over(Window.orderBy(spent.asc_nulls_first(), F.col("customer_id").asc()))
        assert scored.withColumn("want", tile).filter("want <> m_score").count() == 0
    best = kpis.rfm_segments(values).orderBy(F.col("rfm_score").desc()).first()
    assert best.customer_segment == "Champions"
