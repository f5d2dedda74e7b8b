"""What the physical plans must and must not contain."""

import pytest
from conftest import plan_of

from assaymill.plans.catalog import Inputs
from assaymill.operators import facts, kpis
from assaymill.session import scratch_path
from assaymill.sources.tables import write_table

LAZY_KPIS = {
    "kpi_top_products_by_category": lambda s: kpis.kpi_top_products_by_category(
        s["items"], s["products"], s["orders"]
    ),
    "kpi_revenue_by_region": lambda s: kpis.kpi_revenue_by_region(
        s["orders"], s["payments"], s["customers"]
    ),
    "kpi_new_vs_returning": lambda s: kpis.kpi_new_vs_returning(s["orders"], s["customers"]),
    "kpi_price_volume": lambda s: kpis.kpi_price_volume(s["items"], s["products"]),
    "kpi_payment_methods": lambda s: kpis.kpi_payment_methods(s["payments"], s["orders"]),
    "top_products": lambda s: kpis.top_products_per_category(
        s["items"], s["products"], s["orders"]
    ),
    "monthly_ticket": lambda s: kpis.customer_monthly_ticket(s["orders"], s["payments"]),
}


@pytest.fixture(scope="module")
def silver(spark, sf_dir):
    """The modelled tables as stored, the way the gold job sees them."""
    x = Inputs(spark, sf_dir)
    stored = {}
    for name, df, parts in [
        ("orders", x.orders, ["year", "month"]),
        ("items", x.items, []),
        ("payments", x.payments, []),
        ("customers", x.customers, []),
        ("products", x.products, []),
    ]:
        path = scratch_path(spark, f"silver-{name}")
        write_table(df, path, parts)
        stored[name] = spark.read.parquet(path)
    return stored


@pytest.mark.parametrize("name", list(LAZY_KPIS))
def test_no_single_task_and_no_python(name, silver):
    plan = plan_of(LAZY_KPIS[name](silver))
    for bad in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in plan


@pytest.mark.parametrize("name", list(LAZY_KPIS))
def test_large_inputs_are_shuffled_not_broadcast(name, silver, spark):
    """Beyond the size check every join takes the shuffled way."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastExchange" not in plan_of(LAZY_KPIS[name](silver))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_status_filter_and_columns_reach_the_scan(silver):
    plan = plan_of(kpis.kpi_payment_methods(silver["payments"], silver["orders"]))
    assert "EqualTo(order_status,delivered)" in plan
    assert "ReadSchema: struct<order_id:string,order_status:string>" in plan


def test_range_filters_reach_the_scan(spark, sf_dir):
    path = scratch_path(spark, "raw-items")
    Inputs(spark, sf_dir).raw("order_items").write.parquet(path)
    plan = plan_of(facts.build_fact_order_items(spark.read.parquet(path)).select("order_id"))
    assert "GreaterThanOrEqual(price,0.0)" in plan and "IsNotNull(order_id)" in plan
    assert "ReadSchema: struct<order_id:string,price:double>" in plan


def test_month_filter_prunes_partitions(silver):
    plan = plan_of(silver["orders"].filter("year = 1999 and month = 3").select("order_id"))
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "ReadSchema: struct<order_id:string>" in plan


def test_sort_is_not_paid_for_before_a_write(silver):
    """The writer's rebalance makes a preceding global sort pointless; Catalyst removes it."""
    from assaymill.sources.tables import repartition_for_write

    sorted_kpi = kpis.kpi_payment_methods(silver["payments"], silver["orders"])
    assert "rangepartitioning" in plan_of(sorted_kpi)
    assert "rangepartitioning" not in plan_of(repartition_for_write(sorted_kpi, ["year"]))


def test_partitioning_of_the_input_does_not_matter(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    raw_orders, raw_payments = x.raw("orders"), x.raw("order_payments")
    results = []
    for n in (1, 13):
        orders = facts.build_fact_orders(raw_orders.repartition(n))
        payments = facts.build_fact_payments(raw_payments.repartition(n))
        results.append(sorted(map(tuple, kpis.kpi_payment_methods(payments, orders).collect())))
    assert results[0] == results[1]


def test_aqe_splits_a_skewed_join(spark, silver):
    """A hot order among the items is split by AQE when it is worth it."""
    from pyspark.sql import functions as F

    items = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("order_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("product_id"),
    )
    orders = spark.range(0, 300_000, 1, 8).select(F.col("id").alias("order_id"), (F.col("id") % 12).alias("month"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = items.join(orders, "order_id").groupBy("month").count()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_weather_time_is_made_and_parsed_once(spark, sf_dir):
    plan = plan_of(Inputs(spark, sf_dir).weather)
    assert plan.count("date_format(") == 1
