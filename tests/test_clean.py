import datetime as dt

from conftest import logical_plan_of, plan_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from assaymill.functions.exact import cents, mean_amount, ratio
from assaymill.functions.labels import price_band, quarter_label, rfm_segment, temperature_class
from assaymill.functions.timestamps import parse_iso_millis, parse_weather_time
from assaymill.operators import clean, facts


def test_drop_duplicates_by_key(spark):
    rows = [
        ("o1", "a", "delivered"),
        ("o1", "a", "delivered"),
        ("o2", "b", "shipped"),
    ]
    df = spark.createDataFrame(rows, ["order_id", "customer_id", "status"])
    before, after = Observation("before"), Observation("after")
    result = clean.drop_duplicates_by_key(df, ["order_id"], before, after)
    assert result.count() == 2
    assert before.get["rows"] == 3 and after.get["rows"] == 2


def test_require_keys(spark):
    df = spark.createDataFrame([("o1", "a"), (None, "b"), ("o3", None)], ["order_id", "customer_id"])
    assert clean.require_keys(df, ["order_id"]).count() == 2
    assert clean.require_keys(df, ["order_id", "customer_id"]).count() == 1


def test_normalize_strings(spark):
    df = spark.createDataFrame([("  São Paulo  ",), ("RIO DE JANEIRO",), ("",), ("   ",), (None,)], ["city"])
    got = [r.city for r in clean.normalize_string_columns(df, ["city", "absent"]).collect()]
    assert got == ["são paulo", "rio de janeiro", None, None, None]


def test_cast_timestamps_null_on_bad_text(spark):
    values = ["2017-10-02T10:56:33.000Z", "2017-10-02", "nonsense", "", None, "2017-13-02T10:56:33.000Z"]
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r.t for r in clean.cast_timestamp_columns(df, ["t", "absent"]).collect()]
    assert got == [dt.datetime(2017, 10, 2, 10, 56, 33), None, None, None, None, None]
    assert df.select(parse_iso_millis("t")).schema[0].dataType.simpleString() == "timestamp"


def test_weather_time_shapes(spark):
    rows = [
        ("2017-10-02 01:00:00 +0000 UTC", None),
        ("2017-10-02 01:00:00 +0000", None),
        ("2017-10-02 01:00:00 -0300", None),
        ("2017-10-02T01:00:00Z", None),
        ("2017-10-02T01:00:00.123456Z", None),
        ("bad", 1506906000),
        ("bad", None),
        (None, 1506906000),
    ]
    df = spark.createDataFrame(rows, "s string, e bigint")
    got = [r[0] for r in df.select(parse_weather_time("s", "e")).collect()]
    one = dt.datetime(2017, 10, 2, 1)
    assert got == [one, one, one.replace(hour=4), one, one.replace(microsecond=123456), one, None, one]


def test_latest_by_key_prefers_newest_and_limits_before_shuffle(spark):
    rows = [("a", "1", "2020"), ("a", "2", "2021"), ("b", "3", None), ("b", "4", "2019")]
    df = spark.createDataFrame(rows, "k string, v string, updated_at string")
    latest = clean.newest_version(df, ["k"])
    assert {(r.k, r.v) for r in latest.collect()} == {("a", "2"), ("b", "4")}
    plan = plan_of(latest)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_equal_versions_are_settled(spark):
    rows = [("o", 1, f"p{i}", float(i), 0.0, "v1") for i in range(5)] + [("o", 1, "old", 9.0, 0.0, "v0")]
    schema = (
        "order_id string, order_item_id long, product_id string, price double, "
        "freight_value double, updated_at string"
    )
    raw = spark.createDataFrame(rows, schema).withColumns(
        {"seller_id": F.lit("s"), "shipping_limit_date": F.lit(None).cast("string")}
    )
    for parts in (1, 3):
        items = facts.build_fact_order_items(raw.repartition(parts), newest_only=True).collect()
        assert [r.product_id for r in items] == ["p4"]
    assert facts.build_fact_order_items(raw).count() == 6


def test_latest_by_key_prunes_unused_columns(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    latest = clean.newest_version(df, ["o_custkey"], "o_orderdate").select("o_custkey")
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan_of(latest)


def test_surrogate_key_is_unique(spark):
    df = clean.add_surrogate_key(spark.range(0, 1000, 1, 7))
    assert df.select("sk_id").distinct().count() == 1000


def test_exact_money(spark):
    df = spark.createDataFrame([(0.29,), (4.35,), (10.1,), (-3.33,), (None,)], "x double")
    assert [r[0] for r in df.select(cents("x")).collect()] == [29, 435, 1010, -333, None]
    one = spark.range(1)
    pick = lambda c: one.select(c).first()[0]
    assert pick(mean_amount(F.lit(203), F.lit(2))) == 1.02
    assert pick(ratio(F.lit(1), F.lit(3), 2)) == 0.33
    assert pick(ratio(F.lit(-5), F.lit(2))) == -3.0
    assert pick(ratio(F.lit(5), F.lit(0))) is None


def test_labels(spark):
    prices = spark.createDataFrame([(0.0,), (49.99,), (50.0,), (299.0,), (500.0,), (None,)], "p double")
    assert [r[0] for r in prices.select(price_band("p")).collect()] == [
        "0-50 BRL", "0-50 BRL", "50-150 BRL", "150-300 BRL", "+500 BRL", None,
    ]
    temps = spark.createDataFrame([(-3.0,), (10.0,), (20.0,), (None,)], "t double")
    assert [r[0] for r in temps.select(temperature_class("t")).collect()] == [
        "Cold", "Mild", "Warm", "Unknown",
    ]
    months = spark.range(1, 13)
    assert [r[0] for r in months.select(quarter_label("id")).collect()] == (
        ["Q1"] * 3 + ["Q2"] * 3 + ["Q3"] * 3 + ["Q4"] * 3
    )
    scores = spark.createDataFrame([(3,), (4,), (7,), (10,), (13,)], "s int")
    assert [r[0] for r in scores.select(rfm_segment(F.col("s"))).collect()] == [
        "Lost", "Needs Attention", "At Risk", "Loyal Customers", "Champions",
    ]


def test_key_filter_reaches_parquet(spark, sf_dir):
    df = clean.require_keys(spark.read.parquet(f"{sf_dir}/orders.parquet"), ["o_orderkey"])
    assert "PushedFilters: [IsNotNull(o_orderkey)]" in plan_of(df)
    assert "isnotnull" in logical_plan_of(df)
