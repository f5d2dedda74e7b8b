"""Incremental silver against a full recompute, and what each load touches."""

import random

import pytest
from pyspark.sql import functions as F

from assaymill.operators import facts
from assaymill.plans import incremental, jobs
from assaymill.plans.bronze_views import raw_view
from assaymill.plans.jobs import SilverOptions
from assaymill.session import scratch_path
from assaymill.sources.schemas import RAW_TABLES
from assaymill.sources.versions import VersionedLake, VersionedLayer

ORDERS = "order_id string, customer_id string, order_status string, order_purchase_timestamp string, updated_at string"
TIMES = ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"]


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def orders(spark, *found):
    df = spark.createDataFrame(list(found), ORDERS)
    return df.withColumns({c: F.lit(None).cast("string") for c in TIMES})


def order(i, month, status="shipped", updated="2018-01-01", customer="c"):
    bought = None if month is None else f"2018-{month:02d}-03T10:00:00.000Z"
    return (None if i is None else f"o{i}", customer, status, bought, updated)


@pytest.fixture
def layer(spark):
    return VersionedLayer(spark, scratch_path(spark, "silver"))


def load(layer, *, raw=None, fresh=None, moves=True):
    with layer.publication() as p:
        incremental.merge_orders(p, raw, fresh, moves)
        return p.commit() if p.names() else None


def test_only_the_months_of_a_load_are_rewritten(spark, layer):
    first = orders(spark, *[order(i, i % 6 + 1) for i in range(30)], order(90, None))
    load(layer, raw=first)
    before = layer.version()
    fresh = orders(spark, order(1, 2, "delivered", "2018-02-01"), order(50, 2))
    load(layer, fresh=fresh)
    after = layer.version()
    for table in ("fact_orders", incremental.ORDER_STATE):
        new = set(after.tables[table].folders) - set(before.tables[table].folders)
        assert {f.partition("/")[2] for f in new} == {"year=2018/month=2"}
        assert len(after.tables[table].folders) == 7
    assert rows(layer.read("fact_orders")) == rows(facts.build_fact_orders(first.unionByName(fresh)))


def test_older_versions_ties_moves_and_repeats(spark, layer):
    days = [
        [order(1, 1, "b", "2018-01-05"), order(2, 1, "x"), order(3, 3), order(4, None)],
        [order(1, 1, "a", "2018-01-04"), order(1, 1, "c", "2018-01-05"), order(2, 2, "y", "2018-03-01")],
        [order(4, 4, "z", "2018-09-01"), order(None, 1), order(3, 3, "s", None)],
        [order(2, 2, "y", "2018-03-01")],
        [order(5, 1, customer=None)],
    ]
    load(layer, raw=orders(spark, *days[0]))
    for i, day in enumerate(days[1:], 2):
        load(layer, fresh=orders(spark, *day))
        everything = orders(spark, *[r for d in days[:i] for r in d])
        assert rows(layer.read("fact_orders")) == rows(facts.build_fact_orders(everything))
    # The month that order 2 left has no folder any more but for the other order in it.
    assert layer.read("fact_orders").filter("month = 1").count() == 1


@pytest.mark.parametrize("seed", range(2))
def test_random_loads_equal_a_full_recompute(spark, layer, seed):
    rng = random.Random(seed)
    everything = None
    for step in range(4):
        day = orders(spark, *[
            order(rng.randrange(12), rng.choice([1, 2, 3, None]), rng.choice("abc"), f"2018-0{rng.randrange(1, 4)}-01")
            for _ in range(6)
        ])
        load(layer, **({"fresh": day} if step else {"raw": day}))
        everything = day if everything is None else everything.unionByName(day)
        assert rows(layer.read("fact_orders")) == rows(facts.build_fact_orders(everything))


def test_a_promise_that_keys_stay_saves_the_key_scan(spark, layer, monkeypatch):
    load(layer, raw=orders(spark, order(1, 1), order(2, 2)))
    asked = []
    monkeypatch.setattr(incremental, "measured_bytes", lambda df: asked.append(df) or 0)
    load(layer, fresh=orders(spark, order(1, 1, "new", "2019")), moves=False)
    assert asked == [] and rows(layer.read("fact_orders").filter("order_status = 'new'").select("order_id")) == ["Row(order_id='o1')"]
    load(layer, fresh=orders(spark, order(2, 2, "new", "2019")))
    assert len(asked) == 1


@pytest.fixture
def lake(spark):
    return VersionedLake(scratch_path(spark, "lake"))


def add_day(spark, sf_dir, lake, day, part, of, mode="errorifexists"):
    """The ``part``-th of ``of`` slices of each raw table as one sync date; small tables whole."""
    for name, table in RAW_TABLES.items():
        df = raw_view(spark, sf_dir, name)
        key = table.key[0] if table.key else df.columns[0]
        if table.cursor:
            df = df.filter(F.pmod(F.crc32(F.concat_ws("|", *df.columns)), F.lit(of)) == part)
        elif part:
            continue
        if name == "orders" and part:  # a changed version of some earlier orders
            changed = df.filter(F.pmod(F.crc32(key), F.lit(5)) == 0)
            df = df.unionByName(changed.withColumns({"order_status": F.lit("restated"), "updated_at": F.lit("2030")}))
        df.write.mode(mode).parquet(lake.raw(table.source, name, day))


@pytest.mark.parametrize("newest_only", [True, False])
def test_job_equals_the_full_job(spark, sf_dir, lake, newest_only):
    options = SilverOptions(newest_only=newest_only)
    silver = lake.layer(spark, "silver")

    def same_as_full():
        raw = jobs.read_raw(spark, lake)
        built = jobs.build_silver(spark, raw, options)
        return [n for n, df in built.items() if rows(df) != rows(silver.read(n))]

    add_day(spark, sf_dir, lake, "2019-01-01", 0, 2)
    assert incremental.run_incremental(spark, lake, options).number == 1
    assert same_as_full() == []
    before = silver.version()
    assert incremental.run_incremental(spark, lake, options) is None

    add_day(spark, sf_dir, lake, "2019-01-02", 1, 2)
    incremental.run_incremental(spark, lake, options)
    assert same_as_full() == []
    now = silver.version()
    for name in ("dim_customers", "dim_sellers", "dim_geolocation", "dim_products", "dim_date"):
        assert now.tables[name] == before.tables[name]
    assert (len(now.tables["fact_payments"].folders) == 2) == (not newest_only)

    # A day that is loaded again is found by its files and the tables are built anew.
    add_day(spark, sf_dir, lake, "2019-01-02", 1, 3, mode="overwrite")
    incremental.run_incremental(spark, lake, options)
    assert same_as_full() == []


def test_days_from_the_listing(spark, lake):
    spark.range(3).write.parquet(lake.raw("ecommerce", "orders", "2019-01-01"))
    spark.range(3).write.parquet(lake.raw("ecommerce", "orders", "2019-01-02"))
    days = incremental.raw_days(spark, lake)
    assert set(days["orders"]) == {"2019-01-01", "2019-01-02"} and days["sellers"] == {}
    assert incremental.new_days({}, days["orders"]) == ["2019-01-01", "2019-01-02"]
    assert incremental.new_days(days["orders"], days["orders"]) == []
    assert incremental.new_days({**days["orders"], "2018-12-31": "1"}, days["orders"]) is None
    assert incremental.new_days(None, days["orders"]) is None
