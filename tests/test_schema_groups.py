"""Raw tables whose files disagree on types."""

import pytest
from pyspark.sql import types as T

from assaymill.operators import validation
from assaymill.plans import incremental, jobs
from assaymill.plans.bronze_views import raw_view
from assaymill.session import scratch_path
from assaymill.sources import schema_groups as sg
from assaymill.sources.schemas import RAW_TABLES
from assaymill.sources.tables import Lake
from assaymill.sources.versions import VersionedLake


def day(spark, path, n, ddl, *rows):
    spark.createDataFrame(list(rows), ddl).coalesce(1).write.mode("append").parquet(f"{path}/2018/01/{n:02d}")


def test_one_schema_is_one_probe(spark, monkeypatch):
    path = scratch_path(spark, "raw")
    for n in range(1, 5):
        day(spark, path, n, "k string, n int" if n < 3 else "k string, extra double", ("a", 1) if n < 3 else ("b", 2.0))
    asked = []
    probe = sg._merged
    monkeypatch.setattr(sg, "_merged", lambda s, p: asked.append(p) or probe(s, p))
    (group,) = sg.schema_groups(spark, path)
    assert asked == [[path]] and group.schema.fieldNames() == ["k", "n", "extra"]
    assert sg.schema_groups(spark, path + "-none") == []


def test_a_change_of_type_is_found_by_halving(spark, monkeypatch):
    path = scratch_path(spark, "raw")
    for n in range(1, 17):
        late = n > 11
        day(spark, path, n, "k string, v string" if late else "k string, v bigint", (f"k{n}", "x7" if late else n))
    asked = []
    probe = sg._merged
    monkeypatch.setattr(sg, "_merged", lambda s, p: asked.append(len(p)) or probe(s, p))
    groups = sg.schema_groups(spark, path)
    assert len(groups) == 2 and sorted(len(g.paths) for g in groups) == [5, 11]
    assert len(asked) <= 2 * 4 + 2
    rows = {r.k: r.v for r in sg.read_groups(spark, groups).collect()}
    assert len(rows) == 16 and rows["k3"] == "3" and rows["k12"] == "x7"
    declared = {r.k: r.v for r in sg.read_groups(spark, groups, {"v": T.LongType()}).collect()}
    assert declared["k3"] == 3 and declared["k12"] is None


def test_clash_inside_one_day(spark):
    path = scratch_path(spark, "raw")
    day(spark, path, 1, "v int", (1,))
    day(spark, path, 1, "v bigint", (1 << 40,))
    day(spark, path, 1, "v string, w struct<a:int>", ("x", (1,)))
    day(spark, path, 2, "v int, w string", (5, "y"))
    got = sg.scan_raw(spark, path)
    assert dict(got.dtypes) == {"v": "string", "w": "string"}
    assert {(r.v, r.w) for r in got.collect()} == {("1", None), (str(1 << 40), None), ("x", '{"a":1}'), ("5", "y")}


@pytest.mark.parametrize(
    "a, b, wide",
    [
        ("int", "bigint", "bigint"), ("smallint", "float", "float"), ("int", "float", "double"),
        ("int", "double", "double"), ("bigint", "double", "string"), ("string", "int", "string"),
        ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(38,9)", "string"),
        ("date", "timestamp", "timestamp"), ("boolean", "int", "string"), ("int", "int", "int"),
        ("void", "int", "int"),
    ],
)
def test_lattice(spark, a, b, wide):
    types = [T.StructType.fromDDL(f"c {t}")["c"].dataType for t in (a, b)]
    assert sg.widened(*types).simpleString() == sg.widened(*types[::-1]).simpleString() == wide


def changed_lake(spark, sf_dir, lake):
    """Two days of every table; on the second one two columns come with another type."""
    for name, table in RAW_TABLES.items():
        df = raw_view(spark, sf_dir, name)
        path = lake.raw(table.source, name, "2001-12-31")
        df.write.parquet(path)
        if name == "customers":
            df.limit(9).withColumn("customer_zip_code_prefix", df["customer_zip_code_prefix"].cast("bigint")).write.parquet(
                lake.raw(table.source, name, "2002-01-01")
            )
        if name == "order_items":
            df.limit(9).withColumn("price", df["price"].cast("string")).write.parquet(
                lake.raw(table.source, name, "2002-01-01")
            )


def test_validation_reports_the_change_and_silver_builds(spark, sf_dir):
    lake = Lake(scratch_path(spark, "lake"))
    changed_lake(spark, sf_dir, lake)
    paths = {name: lake.raw(t.source, name) for name, t in RAW_TABLES.items()}
    report = {
        (r.table_name, r.check_name): (r.passed, r.detail)
        for r in validation.validate_source(spark, paths, RAW_TABLES).collect()
    }
    assert report["customers", "schema_drift"] == (False, "type_changed customer_zip_code_prefix")
    assert report["order_items", "schema_drift"] == (False, "type_changed price")
    assert report["orders", "schema_drift"] == (True, "none")
    groups = sg.schema_groups(spark, paths["customers"])
    (drift,) = validation.drift_over_files(groups, RAW_TABLES["customers"].columns)
    assert drift == ("customer_zip_code_prefix", "type_changed", "string", "string | bigint")
    raw = jobs.read_raw(spark, lake)
    assert dict(raw["customers"].dtypes)["customer_zip_code_prefix"] == "string"
    assert dict(raw["order_items"].dtypes)["price"] == "double"
    silver = jobs.build_silver(spark, raw, jobs.SilverOptions(newest_only=False))
    items = raw_view(spark, sf_dir, "order_items")
    assert silver["fact_order_items"].count() == items.filter("price >= 0").count() + items.limit(9).filter("price >= 0").count()


def test_incremental_load_of_a_day_with_other_types(spark, sf_dir):
    lake = VersionedLake(scratch_path(spark, "lake"))
    for name, table in RAW_TABLES.items():
        raw_view(spark, sf_dir, name).write.parquet(lake.raw(table.source, name, "2001-12-31"))
    incremental.run_incremental(spark, lake)
    orders = raw_view(spark, sf_dir, "orders").limit(5)
    orders.withColumn("customer_id", orders["customer_id"].cast("bigint")).withColumn(
        "updated_at", orders["updated_at"].substr(1, 4).cast("int") + 40
    ).write.parquet(lake.raw("ecommerce", "orders", "2002-01-01"))
    before = lake.layer(spark, "silver").read("fact_orders").count()
    incremental.run_incremental(spark, lake)
    now = lake.layer(spark, "silver").read("fact_orders")
    assert now.count() == before and dict(now.dtypes)["customer_id"] == "string"
