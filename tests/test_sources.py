import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assaymill.operators import validation
from assaymill.operators.clean import latest_by_key
from assaymill.plans import jobs
from assaymill.plans.bronze_views import raw_view
from assaymill.session import materialize, scratch_path, scratch_scope
from assaymill.sources import loads, tables
from assaymill.sources.schemas import RAW_TABLES, types_compatible


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test")


def _files(spark, path):
    return tables.file_listing(spark, path).count()


def test_scan_bronze_by_sync_date(spark, path):
    df = spark.createDataFrame([("a",), ("b",)], ["k"])
    df.write.parquet(f"{path}/2018/01/02")
    df.filter("k = 'a'").write.parquet(f"{path}/2018/01/03")
    scan = tables.scan_bronze(spark, path, with_sync_date=True)
    assert sorted((r.k, str(r.sync_date)) for r in scan.collect()) == [
        ("a", "2018-01-02"), ("a", "2018-01-03"), ("b", "2018-01-02"),
    ]
    assert tables.scan_bronze(spark, path, sync_dates=["2018-01-03"]).count() == 1


def test_partition_overwrite_and_pruning(spark, path):
    df = spark.createDataFrame([(2017, 1), (2018, 2)], ["year", "v"])
    tables.write_table(df, path, ["year"])
    tables.write_table(spark.createDataFrame([(2018, 3)], ["year", "v"]), path, ["year"])
    scan = tables.scan_silver(spark, path)
    assert sorted(map(tuple, scan.select("year", "v").collect())) == [(2017, 1), (2018, 3)]
    plan = scan.filter("year = 2018")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_writer_sizes_files(spark, path):
    df = spark.range(0, 200_000, 1, 16).withColumn("pad", F.sha2(F.col("id").cast("string"), 256))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    tables.write_table(df, f"{path}/one", target_file_mb=128)
    tables.write_table(df, f"{path}/many", target_file_mb=1)
    assert _files(spark, f"{path}/one") == 1
    assert _files(spark, f"{path}/many") > 3
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) == before


def test_hot_output_partition_is_split(spark, path):
    df = spark.range(0, 200_000, 1, 16).select(
        F.when(F.col("id") % 50 == 0, F.lit(1)).otherwise(2).alias("month"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    tables.write_table(df, path, ["month"], target_file_mb=1)
    files = tables.file_listing(spark, path).groupBy(F.col("path").contains("month=1")).count()
    assert {r[0]: r[1] for r in files.collect()}[False] > 3


def test_compaction(spark, path):
    df = spark.range(100).select("id", F.lit(2018).alias("y"))
    df.repartition(20).write.parquet(f"{path}/small")
    compacted = tables.compact_small_files(spark, f"{path}/small", f"{path}/large", ["y"])
    assert compacted.count() == 100
    assert (_files(spark, f"{path}/small"), _files(spark, f"{path}/large")) == (20, 1)


def test_csv_rows_blank_and_corrupt(spark, path):
    text = ["id,city,n", "1,  Rio ,5", "2,   ,6", "3,Lima,notanumber", "4,Quito,7,extra"]
    spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write.text(path)
    schema = "id string, city string, n int"
    rows = loads.read_csv(spark, path, StructType.fromDDL(schema)).collect()
    good = [(r.id, r.city, r.n) for r in rows if r[loads.CORRUPT] is None]
    assert good == [("1", "Rio", 5), ("2", None, 6)]
    assert sum(r[loads.CORRUPT] is not None for r in rows) == 2


def test_incremental_append_and_retry(spark, path):
    def source(n):
        return spark.createDataFrame([(i, f"2018-01-{i:02d}") for i in range(1, n + 1)], ["k", "at"])

    loads.incremental_append(source(3), path, "at", "2018-02-01")
    loads.incremental_append(source(5), path, "at", "2018-02-02")
    loads.incremental_append(source(5), path, "at", "2018-02-02")
    got = spark.read.parquet(path)
    assert sorted((r.k, str(r.sync_date)[-2:]) for r in got.collect()) == [
        (1, "01"), (2, "01"), (3, "01"), (4, "02"), (5, "02"),
    ]


def test_csv_text_with_quotes_and_line_breaks(spark, path):
    rows = [("1", 5, "good\nvery good"), ("2", 4, 'he said "ok", fine'), ("3", 3, "plain")]
    lines = ["id,n,text", '1,5,"good', 'very good"', '2,4,"he said ""ok"", fine"', "3,3,plain", "4,x,bad"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{path}/csv")
    schema = StructType.fromDDL("id string, n int, text string")
    for _ in range(2):
        assert loads.load_csv(spark, f"{path}/csv", schema, f"{path}/t", ["id"], multi_line=True) == 1
    assert sorted(map(tuple, spark.read.parquet(f"{path}/t").collect())) == rows
    assert spark.read.parquet(f"{path}/t_rejects").count() == 2


def test_incremental_append_loses_nothing(spark, path):
    def sync(day, *rows):
        df = spark.createDataFrame(rows, "k string, c int")
        loads.incremental_append(df, path, "c", f"2018-02-0{day}", ["k"])

    def held():
        return sorted((r.k, str(r.sync_date)[-1]) for r in spark.read.parquet(path).collect())

    first = [("a", 10), ("b", 20), ("n", None)]
    sync(1, *first)
    second = [*first, ("tie", 20), ("m", None), ("c", 30)]
    sync(3, *second)
    assert held() == [("a", "1"), ("b", "1"), ("c", "3"), ("m", "3"), ("n", "1"), ("tie", "3")]
    sync(2, *second)  # late: newer dates hold it all
    sync(3, *second)
    assert held() == [("a", "1"), ("b", "1"), ("c", "3"), ("m", "3"), ("n", "1"), ("tie", "3")]
    sync(4, ("o", None))
    sync(5, *second, ("y", 40))
    assert ("y", "5") in held()
    sync(5, *first)  # a re-run that finds nothing
    assert not [k for k, day in held() if day == "5"]


def test_full_recompute_drops_vanished_partitions(spark, path):
    df = spark.createDataFrame([(1, 1), (2, 2)], "v int, month int")
    tables.write_table(df, path, ["month"], replace="table")
    tables.write_table(df.filter("month = 2"), path, ["month"], replace="table")
    assert [r.month for r in spark.read.parquet(path).collect()] == [2]


def test_missing_and_broken_paths(spark, path):
    assert loads.read_if_exists(spark, path) is None
    spark.createDataFrame([("no parquet",)], "value string").write.text(path)
    with pytest.raises(Exception, match="FAILED_READ_FILE|CANNOT_READ_FILE_FOOTER"):
        loads.read_if_exists(spark, path)


def test_type_groups():
    assert types_compatible("string", "large_string") and types_compatible("int64", "int")
    assert types_compatible("double", "float32") and types_compatible("Date", "date")
    assert not types_compatible("string", "int64")


def test_drift():
    expected = {"a": "string", "b": "int64", "c": "double"}
    actual = {"a": "string", "b": "string", "d": "int", "_airbyte_id": "string"}
    assert validation.drift_of(actual, expected) == [
        ("d", "added", None, "int"),
        ("c", "removed", "double", None),
        ("b", "type_changed", "int64", "string"),
    ]
    assert validation.drift_of({"a": "string", "b": "bigint", "c": "float"}, expected) == []


def test_unreadable_table_fails_validation(spark, path):
    report = validation.validate_source(
        spark, {"orders": path}, {"orders": RAW_TABLES["orders"]}
    )
    assert {r.check_name: r.passed for r in report.collect()} == {
        "files_exist": False, "bytes_present": False, "row_count": False, "schema_drift": False,
    }


def test_registry_first_version_has_no_diff(spark, path):
    validation.register_schemas({"t": spark.range(3)}, path, 1)
    assert validation.registry_diff(spark, path).count() == 0
    with pytest.raises(FileNotFoundError):
        validation.registry_diff(spark, path + "-none")


def test_jobs_end_to_end(spark, sf_dir, path):
    lake = tables.Lake(path, table_prefix="shop_")
    for name, table in RAW_TABLES.items():
        raw_view(spark, sf_dir, name).write.parquet(lake.raw(table.source, name, "2001-12-31"))
    report = jobs.run_silver(spark, lake)
    assert {r.passed for r in report.collect()} == {True}
    assert spark.read.parquet(lake.silver("dim_date")).count() == 1096
    jobs.run_gold(spark, lake, "2001-12-31")
    for name in (
        "kpi_top_products_by_category kpi_customer_rfm kpi_revenue_by_region "
        "kpi_new_vs_returning_customers kpi_price_volume_correlation kpi_weather_sales_impact "
        "kpi_payment_methods"
    ).split():
        assert spark.read.parquet(lake.gold(name)).count() > 0
    assert spark.read.parquet(lake.gold("kpi_customer_rfm")).filter("rfm_score > 15").count() == 0


def test_scratch_scope_leaves_nothing_behind(spark):
    outside = materialize(spark.range(3), "outside")
    with scratch_scope(spark) as folder:
        inside = materialize(spark.range(5), "inside")
        assert inside.count() == 5 and folder in inside.inputFiles()[0]
    assert loads.read_if_exists(spark, folder) is None
    assert outside.count() == 3
    assert folder not in scratch_path(spark, "after")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class FakeContext:
        master, applicationId = "yarn", "app"

    class FakeSession:
        conf, sparkContext = Conf(), FakeContext()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(FakeSession(), "x")


def test_steps_before_a_sized_write_keep_their_tasks(spark, path):
    df = spark.range(0, 200_000, 1, 16).select(
        (F.col("id") % 3).alias("month"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pad")
    )
    latest = latest_by_key(df, ["id"], [F.col("pad").desc()]).withColumn("task", F.spark_partition_id())
    tables.write_table(latest, path, ["month"], target_file_mb=128)
    assert spark.read.parquet(path).select("task").distinct().count() > 1
    assert _files(spark, path) == 3
