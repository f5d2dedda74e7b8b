"""Named queries: every operator run over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.functions.labels import price_band
from assaymill.functions.exact import from_cents
from assaymill.operators import clean, dimensions, facts, joins, kpis, quality, ranking
from assaymill.operators import validation, weather
from assaymill.plans import incremental
from assaymill.plans.bronze_views import SOURCE_TABLES, raw_view, source_table, table_path
from assaymill.session import materialize, scratch_path
from assaymill.sources import loads, tables, versions
from assaymill.sources.schemas import RAW_TABLES, RawTable
from assaymill.streaming import enrichment, events, lateness, merge_view, unified

RFM_REFERENCE_DATE = "2001-12-31"
# Splits the weather feed (January 1999) into a history and what arrives later.
HISTORY_ENDS = "1999-01-10"
# Splits the event table (January 2024) into what is on time and what comes late.
LATE_BEFORE = "2024-01-15"
# Splits what is on time once more.
MIDDLE = "2024-01-08"
# Order lines shipped from this day on arrive late.
LATE_SHIPMENTS = "2001-06-01"

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


class Inputs:
    """Lazily built raw and modelled tables over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return source_table(self.spark, self.sf_dir, name)

    def raw(self, name: str) -> DataFrame:
        return raw_view(self.spark, self.sf_dir, name)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    @cached_property
    def orders(self) -> DataFrame:
        return facts.build_fact_orders(self.raw("orders"))

    @cached_property
    def items(self) -> DataFrame:
        return facts.build_fact_order_items(self.raw("order_items"))

    @cached_property
    def payments(self) -> DataFrame:
        return facts.build_fact_payments(self.raw("order_payments"))

    @cached_property
    def customers(self) -> DataFrame:
        return dimensions.build_dim_customers(self.raw("customers"))

    @cached_property
    def products(self) -> DataFrame:
        return dimensions.build_dim_products(
            self.raw("products"), self.raw("product_category_name_translation")
        )

    @cached_property
    def weather(self) -> DataFrame:
        return weather.build_weather_enriched(self.raw("weather_current"))


def portable(df: DataFrame) -> DataFrame:
    """Result types both engines spell alike: bigint, double, string, boolean."""
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return portable(QUERIES[name](Inputs(spark, sf_dir)))


# --- scans, writers, loads ---------------------------------------------------------------


@query
def scan_bronze(x: Inputs) -> DataFrame:
    raw, path = x.raw("orders"), x.scratch("raw-orders")
    is_first = F.col("order_status") == "created"
    raw.filter(is_first).write.parquet(f"{path}/2001/12/30")
    raw.filter(~is_first).write.parquet(f"{path}/2001/12/31")
    return tables.scan_bronze(
        x.spark, path, RAW_TABLES["orders"].schema, with_sync_date=True
    ).select("order_id", "order_status", "updated_at", "sync_date")


@query
def scan_silver(x: Inputs) -> DataFrame:
    path = x.scratch("dim-customers")
    tables.write_table(x.customers, path)
    return tables.scan_silver(x.spark, path)


@query
def write_silver_roundtrip(x: Inputs) -> DataFrame:
    path = x.scratch("fact-orders")
    tables.write_table(x.orders, path, ["year", "month"])
    return tables.scan_silver(x.spark, path).select(
        "order_id", "order_status", "year", "month", "delivery_days", "estimated_vs_actual_days"
    )


@query
def write_gold_roundtrip(x: Inputs) -> DataFrame:
    path = x.scratch("kpi-payment-methods")
    tables.write_table(
        kpis.kpi_payment_methods(x.payments, x.orders), path, ["year", "month"]
    )
    return tables.scan_silver(x.spark, path)


@query
def dynamic_partition_overwrite(x: Inputs) -> DataFrame:
    path = x.scratch("orders-by-year")
    slim = x.orders.select("order_id", "order_status", "year")
    tables.write_table(slim, path, ["year"])
    again = slim.filter(F.col("year") == 1999).withColumn("order_status", F.lit("restated"))
    tables.write_table(again, path, ["year"])
    return tables.scan_silver(x.spark, path)


@query
def repartition_for_write(x: Inputs) -> DataFrame:
    path = x.scratch("sized-orders")
    tables.write_table(x.orders, path, ["year"], target_file_mb=128)
    return (
        x.spark.read.parquet(path)
        .groupBy("year")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct("_metadata.file_path").alias("file_count"),
        )
    )


@query
def compact_small_files(x: Inputs) -> DataFrame:
    source, target = x.scratch("micro-files"), x.scratch("compacted")
    log = events.with_ingestion_parts(
        x.raw("weather_current"), F.to_timestamp(F.timestamp_seconds("dt"))
    )
    # Many writers without a rebalance: the file pattern a busy append stream leaves behind.
    log.repartition(32).write.parquet(source)
    small = tables.file_listing(x.spark, source).agg(F.count(F.lit(1)).alias("n"))
    tables.compact_small_files(x.spark, source, target)
    large = tables.file_listing(x.spark, target).agg(F.count(F.lit(1)).alias("n"))
    fewer = large.first()["n"] < small.first()["n"]
    return (
        x.spark.read.parquet(target)
        .groupBy("ingestion_year", "ingestion_month")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("event_id").alias("event_id_sum"),
            F.sum("humidity").alias("humidity_sum"),
        )
        .withColumn("fewer_files", F.lit(fewer))
    )


@query
def csv_bulk_load(x: Inputs) -> DataFrame:
    csv, target = x.scratch("customers-csv"), x.scratch("customers")
    columns = [c for c in RAW_TABLES["customers"].columns if c != "updated_at"]
    schema = T.StructType([f for f in RAW_TABLES["customers"].schema if f.name in columns])
    x.raw("customers").select(*columns).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).option("escape", '"').csv(csv)
    loads.load_csv(x.spark, csv, schema, target, ["customer_id"])
    loads.load_csv(x.spark, csv, schema, target, ["customer_id"])  # adds nothing
    return x.spark.read.parquet(target)


@query
def csv_documents(x: Inputs) -> DataFrame:
    """Texts with line breaks, quotes and commas through CSV files that are read in small ranges."""
    csv, target = x.scratch("documents-csv"), x.scratch("documents")
    broken = F.when(F.col("doc_id") % 17 == 0, F.concat(F.lit("x"), "doc_id")).otherwise(F.col("doc_id").cast("string"))
    text = F.concat(F.lit('a, "b"\n'), "text")
    x.table("documents").select(broken.alias("doc_id"), text.alias("text"), "lang").write.option(
        "header", True
    ).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(csv)
    schema = T.StructType.fromDDL("doc_id bigint, text string, lang string")
    size = x.spark.conf.get("spark.sql.files.maxPartitionBytes")
    x.spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        rejects = loads.load_csv(x.spark, csv, schema, target, ["doc_id"], splits=True)
    finally:
        x.spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    return x.spark.read.parquet(target).withColumn("rejects", F.lit(rejects))


@query
def insert_if_absent(x: Inputs) -> DataFrame:
    columns = ["order_id", "order_status", "updated_at"]
    raw = x.raw("orders").select(*columns)
    old = raw.filter(F.col("order_status") == "created")
    new = raw.filter(F.col("order_status") != "created")
    return old.unionByName(joins.insert_if_absent(old, new, ["order_id"]))


@query
def bloom_insert_if_absent(x: Inputs) -> DataFrame:
    """A few late shipments, half of them known, against the history of all order lines."""
    keys, lines = ["l_orderkey", "l_linenumber"], x.table("lineitem")
    late = lines.filter(F.col("l_shipdate") >= F.lit(LATE_SHIPMENTS).cast("date")).select(*keys)
    moved = F.when(F.col("l_orderkey") % 2 == 0, -F.col("l_orderkey")).otherwise(F.col("l_orderkey"))
    arriving = late.withColumn("l_orderkey", moved.cast(lines.schema["l_orderkey"].dataType))
    return joins.insert_if_absent(lines, arriving.unionAll(arriving), keys, prune=True)


@query
def incremental_append(x: Inputs) -> DataFrame:
    path, cursor = x.scratch("orders-incremental"), RAW_TABLES["orders"].cursor
    source = x.raw("orders").select("order_id", "order_status", cursor)
    loads.incremental_append(source.filter(F.col(cursor) < "1999"), path, cursor, "2001-12-30")
    loads.incremental_append(source, path, cursor, "2001-12-31")
    loads.incremental_append(source, path, cursor, "2001-12-31")  # a retried sync
    return x.spark.read.parquet(path)


@query
def full_refresh(x: Inputs) -> DataFrame:
    path, source = x.scratch("sellers"), x.raw("sellers")
    loads.full_refresh(source.withColumn("seller_city", F.lit("before")), path)
    loads.full_refresh(source, path)
    return x.spark.read.parquet(path)


@query
def publish_versioned(x: Inputs) -> DataFrame:
    """Rows per version: two tables at once, some partitions of one, an abandoned try, a rollback."""
    layer = versions.VersionedLayer(x.spark, x.scratch("layer"))
    orders = x.orders.select("order_id", "order_status", "year")
    customers = x.customers.select("customer_id", F.col("customer_state").alias("order_status"))
    with layer.publication() as first:
        first.stage("orders", orders.filter("year < 1996"), ["year"])
        first.stage("customers", customers)
        first.commit()
    lost = F.lit("lost").alias("order_status")
    with layer.publication() as abandoned:
        abandoned.stage("orders", orders.filter("year = 1994").select("order_id", lost, "year"), ["year"])
    restated = F.when(F.col("year") == 1995, F.lit("restated")).otherwise(F.col("order_status"))
    later = orders.filter("year >= 1995").withColumn("order_status", restated)
    with layer.publication() as second:
        second.stage("orders", later, ["year"], "partitions", gone=["year=1992"])
        second.commit()
    layer.rollback(1)
    counts = [
        layer.read(name, number)
        .groupBy("order_status", F.lit(number).alias("version"), F.lit(name).alias("table_name"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        for number in layer.numbers()
        for name in ("orders", "customers")
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def incremental_silver(x: Inputs) -> DataFrame:
    """Orders merged in three loads, the middle one with the oldest versions, the last one repeated."""
    layer = versions.VersionedLayer(x.spark, x.scratch("silver"))
    raw, status = x.raw("orders"), F.col("order_status")
    loads_in_turn = [
        raw.filter(status == "delivered"),
        raw.filter(status == "created"),
        raw.filter(~status.isin("delivered", "created")),
        raw.filter(~status.isin("delivered", "created")),
    ]
    for i, load in enumerate(loads_in_turn):
        with layer.publication() as publication:
            incremental.merge_orders(publication, load, None if i == 0 else load)
            publication.commit()
    return layer.read("fact_orders").select(
        "order_id", "order_status", "year", "month", "delivery_days", "estimated_vs_actual_days"
    )


# --- cleaning ----------------------------------------------------------------------------


@query
def dedup_by_key(x: Inputs) -> DataFrame:
    keys = ["order_id", "order_item_id"]
    return clean.drop_duplicates_by_key(x.raw("order_items"), keys).select(*keys)


@query
def latest_by_key(x: Inputs) -> DataFrame:
    return clean.newest_version(x.raw("orders"), ["order_id"]).select(
        "order_id", "order_status", "updated_at"
    )


@query
def cast_timestamps(x: Inputs) -> DataFrame:
    return clean.cast_timestamp_columns(
        x.raw("orders"), [*facts.ORDER_TIMESTAMPS, "no_such_column"]
    )


@query
def normalize_strings(x: Inputs) -> DataFrame:
    columns = ["customer_city", "customer_state", "no_such_column"]
    return clean.normalize_string_columns(x.raw("customers"), columns).select(
        "customer_id", "customer_city", "customer_state"
    )


@query
def surrogate_key_dense(x: Inputs) -> DataFrame:
    ids = x.raw("customers").select("customer_id", "customer_state")
    return ranking.with_rank(ids, [F.col("customer_id").asc()], "customer_sk")


@query
def price_bucket(x: Inputs) -> DataFrame:
    return x.items.groupBy(price_band("price").alias("price_bucket")).agg(
        F.count(F.lit(1)).alias("units"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    )


# --- weather -----------------------------------------------------------------------------


def nested_weather(x: Inputs) -> DataFrame:
    """Weather documents as the feed sends them: single records, and forecasts with a list."""

    def record(ahead: int):
        return F.struct(
            (F.col("dt") + ahead).alias("dt"),
            F.col("dt_iso"),
            F.struct("temp", "humidity", "pressure").alias("main"),
            F.struct(F.col("wind_speed").alias("speed")).alias("wind"),
            F.struct(F.col("rain_1h").alias("1h")).alias("rain"),
            F.array(
                F.struct(
                    F.col("weather_main").alias("main"),
                    F.col("weather_description").alias("description"),
                )
            ).alias("weather"),
        )

    flat = F.struct("dt", "temp", "humidity", "wind_speed", F.lit("Bariloche").alias("city_name"))
    forecast = F.struct(F.array(record(0), record(10800)).alias("list"))
    return x.raw("weather_current").select(
        "event_id",
        F.when(F.col("weather_main") == "Clear", F.to_json(flat))
        .when(F.col("weather_main") == "Rain", F.to_json(forecast))
        .otherwise(F.to_json(record(0)))
        .alias("payload"),
    )


@query
def flatten_weather_json(x: Inputs) -> DataFrame:
    return weather.flatten_weather_json(nested_weather(x), keep=["event_id"]).select(
        "event_id", "dt", "dt_iso", "city_name", "lat", "lon", "temp", "humidity", "pressure",
        "wind_speed", "rain_1h", "weather_main", "weather_description",
    )


@query
def flatten_weather_variant(x: Inputs) -> DataFrame:
    """Nested, flat, listed and unknown forms; dead letters as rows with a reason."""
    docs = nested_weather(x).unionByName(
        x.raw("weather_current").filter("event_id % 10 < 3").select(
            "event_id",
            F.when(F.col("event_id") % 10 == 0, F.concat(F.lit('{"dt": '), "event_id"))
            .when(F.col("event_id") % 10 == 1, F.lit('{"list": [], "city": {"name": "Lima"}}'))
            .otherwise(F.to_json(F.struct(
                F.array(F.struct(F.col("dt").alias("dt"), F.struct(F.col("temp").cast("string").alias("temp")).alias("main"))).alias("list"),
                F.struct(F.lit("Lima").alias("name"), F.struct(F.lit(-12).alias("lat"), F.lit("x").alias("lon")).alias("coord")).alias("city"),
            )))
            .alias("payload"),
        )
    )
    rows, dead = weather.flatten_documents(docs, keep=["event_id"])
    rows = rows.select(
        "event_id", "dt", "dt_iso", "city_name", "lat", "lon", "temp", "humidity", "wind_speed", "weather_main",
        F.lit(None).cast("string").alias("reason"),
    )
    return rows.unionByName(dead.select("event_id", "reason"), allowMissingColumns=True)


@query
def weather_projection(x: Inputs) -> DataFrame:
    return weather.weather_projection(x.raw("weather_current"))


@query
def weather_enriched(x: Inputs) -> DataFrame:
    return x.weather


# --- dimensions and facts ----------------------------------------------------------------


@query
def dim_date(x: Inputs) -> DataFrame:
    return dimensions.date_dimension_for(x.orders, "order_purchase_timestamp")


@query
def dim_customers(x: Inputs) -> DataFrame:
    return x.customers


@query
def dim_products(x: Inputs) -> DataFrame:
    return x.products


@query
def dim_sellers(x: Inputs) -> DataFrame:
    return dimensions.build_dim_sellers(x.raw("sellers"))


@query
def dim_geolocation(x: Inputs) -> DataFrame:
    return dimensions.build_dim_geolocation(x.raw("geolocation"))


@query
def dim_geolocation_per_zip(x: Inputs) -> DataFrame:
    return dimensions.build_dim_geolocation(x.raw("geolocation"), per_zip=True)


@query
def fact_orders(x: Inputs) -> DataFrame:
    return x.orders


@query
def fact_order_items(x: Inputs) -> DataFrame:
    return x.items


@query
def fact_payments(x: Inputs) -> DataFrame:
    return x.payments


@query
def fact_reviews(x: Inputs) -> DataFrame:
    return facts.build_fact_reviews(x.raw("order_reviews"))


# --- joins, aggregates, windows ----------------------------------------------------------


@query
def broadcast_left_join(x: Inputs) -> DataFrame:
    return joins.broadcast_join(
        x.items.select("order_id", "order_item_id", "product_id", "price"),
        x.products.select("product_id", "product_category_name"),
        "product_id",
    )


@query
def fk_orphans(x: Inputs) -> DataFrame:
    # Child, foreign key, parent (referenced by a column of the same name).
    references = [
        ("orders", "customer_id", "customers"),
        ("order_items", "order_id", "orders"),
        ("order_items", "product_id", "products"),
        ("order_items", "seller_id", "sellers"),
        ("order_payments", "order_id", "orders"),
        ("order_reviews", "order_id", "orders"),
    ]
    names = {name for child, _, parent in references for name in (child, parent)}
    return joins.count_orphans({name: x.raw(name) for name in names}, references)


@query
def order_totals(x: Inputs) -> DataFrame:
    return facts.order_totals(x.payments).select(
        "order_id", from_cents("total_cents").alias("order_total")
    )


@query
def ntile_quintiles(x: Inputs) -> DataFrame:
    prices = x.table("orders").select("o_orderkey", "o_totalprice")
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    return ranking.with_ntile(prices, order, 5, "quintile").select("o_orderkey", "quintile")


@query
def pct_of_total(x: Inputs) -> DataFrame:
    n = x.payments.groupBy("payment_type", "payment_installments").agg(
        F.count(F.lit(1)).alias("payments")
    )
    return n.withColumn("pct_of_type", kpis.share_of_total("payments", ["payment_type"]))


@query
def sorted_output(x: Inputs) -> DataFrame:
    return x.payments.orderBy(
        F.col("payment_type").asc(),
        F.col("payment_value").desc(),
        F.col("order_id").asc(),
        F.col("payment_sequential").asc(),
    )


# --- KPIs --------------------------------------------------------------------------------


@query
def kpi_top_products_by_category(x: Inputs) -> DataFrame:
    return kpis.kpi_top_products_by_category(x.items, x.products, x.orders)


@query
def kpi_customer_rfm(x: Inputs) -> DataFrame:
    return kpis.kpi_customer_rfm(x.orders, x.payments, RFM_REFERENCE_DATE)


@query
def kpi_customer_rfm_as_coded(x: Inputs) -> DataFrame:
    return kpis.kpi_customer_rfm(x.orders, x.payments, RFM_REFERENCE_DATE, best_is_five=False)


@query
def kpi_revenue_by_region(x: Inputs) -> DataFrame:
    return kpis.kpi_revenue_by_region(x.orders, x.payments, x.customers)


@query
def kpi_new_vs_returning(x: Inputs) -> DataFrame:
    return kpis.kpi_new_vs_returning(x.orders, x.customers)


@query
def kpi_new_vs_returning_as_coded(x: Inputs) -> DataFrame:
    return kpis.kpi_new_vs_returning(x.orders)


@query
def kpi_price_volume(x: Inputs) -> DataFrame:
    return kpis.kpi_price_volume(x.items, x.products)


@query
def kpi_weather_sales_impact(x: Inputs) -> DataFrame:
    return kpis.kpi_weather_sales_impact(x.orders, x.weather)


@query
def kpi_payment_methods(x: Inputs) -> DataFrame:
    return kpis.kpi_payment_methods(x.payments, x.orders)


@query
def top10_products_per_category(x: Inputs) -> DataFrame:
    return kpis.top_products_per_category(x.items, x.products, x.orders, 10)


@query
def customer_monthly_ticket(x: Inputs) -> DataFrame:
    return kpis.customer_monthly_ticket(x.orders, x.payments)


@query
def weather_condition_revenue(x: Inputs) -> DataFrame:
    return kpis.weather_condition_revenue(x.orders, x.payments, x.weather)


@query
def price_volume_corr(x: Inputs) -> DataFrame:
    corr = kpis.price_volume_corr(x.items, x.products)
    return corr.withColumn("price_volume_corr", F.round("price_volume_corr", 6))


# --- quality -----------------------------------------------------------------------------


@query
def dq_nulls(x: Inputs) -> DataFrame:
    rules = [quality.NotNull("temp", 0.1), quality.NotNull("rain_1h", 0.5), quality.NotNull("dt")]
    return quality.run_suite(x.raw("weather_current"), rules, "weather_current")


@query
def dq_unique(x: Inputs) -> DataFrame:
    return quality.audit(
        {"order_items": x.raw("order_items"), "customers": x.raw("customers")},
        {
            "order_items": [quality.UniqueKey(("order_id", "order_item_id"))],
            "customers": [quality.UniqueKey(("customer_id",))],
        },
    )


@query
def dq_range(x: Inputs) -> DataFrame:
    return quality.audit(
        {"order_items": x.raw("order_items"), "weather_current": x.raw("weather_current")},
        {
            "order_items": [quality.InRange("price", 0, 100000)],
            "weather_current": [quality.InRange("temp", -50, 50), quality.InRange("humidity", 0, 90)],
        },
    )


@query
def dq_allowed_values(x: Inputs) -> DataFrame:
    rules = [
        quality.InSet("order_status", quality.ORDER_STATUSES),
        quality.InSet("order_status", ("delivered", "shipped", "canceled")),
    ]
    return quality.run_suite(x.raw("orders"), rules, "orders").withColumn(
        "column_name", F.concat("column_name", F.lit(" ("), "failed", F.lit(")"))
    )


@query
def dq_silver_audit(x: Inputs) -> DataFrame:
    silver = {
        "dim_customers": x.customers,
        "fact_order_items": x.items,
        "fact_orders": x.orders,
    }
    return quality.audit(silver, quality.SILVER_SUITES)


@query
def dq_expectation_suite(x: Inputs) -> DataFrame:
    rules = [
        *quality.RAW_ORDERS_SUITE,
        quality.OfType("order_id", "string"),
        quality.OfType("order_purchase_timestamp", "timestamp"),
        quality.ParsesAs("order_purchase_timestamp", "timestamp"),
        quality.NotBlank("customer_id"),
        quality.InRange("order_purchase_timestamp", "1995", "2001"),
        quality.NotNull("order_delivered_customer_date", 0.7),
        quality.UniqueKey(("order_id",)),
    ]
    return quality.run_suite(x.raw("orders").drop("updated_at"), rules, "orders")


# --- raw-layer validation ----------------------------------------------------------------


def _changed_customers(x: Inputs) -> DataFrame:
    """The customers feed after an upstream change: one type, one column less, one more."""
    return (
        x.raw("customers")
        .withColumn("customer_zip_code_prefix", F.col("customer_zip_code_prefix").try_cast("int"))
        .withColumn("loyalty_tier", F.nullif(F.trim("customer_city"), F.lit("")))
        .withColumn("_airbyte_emitted_at", F.current_timestamp())
        .drop("customer_city")
    )


@query
def bronze_file_stats(x: Inputs) -> DataFrame:
    paths = {t: table_path(x.sf_dir, t) for t in SOURCE_TABLES}
    counts = validation.row_counts({t: x.table(t) for t in SOURCE_TABLES}, {})
    return (
        validation.file_stats(x.spark, paths)
        .join(counts, "table_name")
        .select(
            "table_name",
            (F.col("file_count") > 0).alias("has_files"),
            (F.col("total_bytes") > 0).alias("has_bytes"),
            "row_count",
        )
    )


@query
def bronze_row_counts(x: Inputs) -> DataFrame:
    raw = {name: x.raw(name) for name in RAW_TABLES}
    return validation.row_counts(raw, {name: t.min_rows for name, t in RAW_TABLES.items()})


@query
def observed_schema(x: Inputs) -> DataFrame:
    return validation.observed_schema({t: x.table(t) for t in SOURCE_TABLES}, non_null=True)


@query
def schema_drift(x: Inputs) -> DataFrame:
    checks = [
        ("orders", x.raw("orders"), RAW_TABLES["orders"]),
        ("customers", _changed_customers(x), RAW_TABLES["customers"]),
        ("weather_current", x.raw("weather_current"), RAW_TABLES["weather_current"]),
    ]
    parts = [validation.schema_drift(df, table, name) for name, df, table in checks]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def bronze_validation_report(x: Inputs) -> DataFrame:
    root = tables.Lake(x.scratch("lake"))
    paths: dict[str, str] = {}
    declared: dict[str, RawTable] = {}
    for name in ("orders", "customers", "sellers", "weather_current"):
        declared[name] = RAW_TABLES[name]
        paths[name] = root.raw(declared[name].source, name)
        x.raw(name).write.parquet(root.raw(declared[name].source, name, "2001-12-31"))
    paths["products"], declared["products"] = root.raw("ecommerce", "products"), RAW_TABLES["products"]
    report = validation.validate_source(x.spark, paths, declared)
    shown = F.when(F.col("check_name").isin("row_count", "schema_drift"), F.col("detail"))
    return report.select("table_name", "check_name", "passed", shown.alias("detail"))


@query
def schema_registry_diff(x: Inputs) -> DataFrame:
    registry = x.scratch("schema-registry")
    validation.register_schemas({"customers": x.raw("customers")}, registry, 1)
    validation.register_schemas(
        {"customers": _changed_customers(x).drop("_airbyte_emitted_at")}, registry, 2
    )
    return validation.registry_diff(x.spark, registry)


# --- streaming ---------------------------------------------------------------------------


def event_stream(x: Inputs, spark: SparkSession | None = None) -> DataFrame:
    """The event table as a file stream; it may be one file or a folder of files."""
    name = "events.parquet"
    schema = x.table("events").schema
    path = table_path(x.sf_dir, "events")
    if tables.is_folder(x.spark, path):
        source = {"path": path}
    else:
        source = {"path": x.sf_dir, "pathGlobFilter": name}
    return events.stream_source(spark or x.spark, "parquet", schema=schema, **source)


def weather_messages(stream: DataFrame) -> DataFrame:
    """Events as a topic would deliver them: JSON bytes, some of them broken or mistyped."""
    moved = F.col("ts") - F.expr("INTERVAL '300' MONTH")
    text = F.date_format(moved, "yyyy-MM-dd HH:mm:ss")
    event = F.struct(
        F.unix_timestamp(moved.cast("timestamp")).alias("dt"),
        F.concat(text, F.lit(" +0000 UTC")).alias("dt_iso"),
        F.lit(weather.DEFAULT_CITY).alias("city_name"),
        F.lit(weather.DEFAULT_LAT).alias("lat"),
        F.lit(weather.DEFAULT_LON).alias("lon"),
        F.when(F.col("user_id") % 17 != 0, F.floor(F.col("value") * 10) / 120 - 5).alias("temp"),
        (F.floor("value") / 50).alias("wind_speed"),
        F.col("event_type").alias("weather_main"),
        F.upper("event_type").alias("weather_description"),
    )
    humidity = F.when(F.col("user_id") % 13 == 0, F.lit('"damp"')).otherwise(
        (F.col("user_id") % 100).cast("string")
    )
    document = F.concat(
        F.rtrim(F.to_json(event), F.lit("}")), F.lit(',"humidity":'), humidity, F.lit("}")
    )
    broken = F.col("user_id") % 19 == 0
    return stream.select(
        "event_id",
        "ts",
        F.when(broken, F.lit("notjson")).otherwise(document).cast("binary").alias("value"),
    )


def _sink(x: Inputs, stream: DataFrame, name: str, partition_cols: list[str] = ()) -> DataFrame:
    path = x.scratch(name)
    events.run_to_files(stream, path, x.scratch(f"{name}-checkpoint"), partition_cols)
    return x.spark.read.schema(stream.schema).parquet(path)


@query
def stream_file_source(x: Inputs) -> DataFrame:
    stream = event_stream(x).select("event_id", "ts", "user_id", "event_type", "value")
    return _sink(x, stream, "stream-source")


@query
def raw_stream_append(x: Inputs) -> DataFrame:
    path = x.scratch("raw-log")
    decoded = events.decode_events(weather_messages(event_stream(x)), keep=["event_id", "ts"])
    events.raw_stream_append(
        decoded,
        path,
        x.scratch("raw-log-checkpoint"),
        F.col("ts").cast("timestamp"),
        events.INGESTION_PARTS[:3],
    )
    return x.spark.read.parquet(path).select(
        "event_id", "dt", "malformed", "raw",
        "ingestion_year", "ingestion_month", "ingestion_day", "ingestion_hour",
    )


@query
def stream_parse_json(x: Inputs) -> DataFrame:
    decoded = events.decode_events(weather_messages(event_stream(x)), keep=["event_id"])
    return _sink(x, decoded, "decoded")


@query
def stream_conform(x: Inputs) -> DataFrame:
    decoded = events.well_formed(events.decode_events(weather_messages(event_stream(x))))
    return _sink(x, weather.conform_weather(decoded), "conformed")


def _staged(x: Inputs, name: str):
    """A folder that plays the topic, a way to add to it, and a stream over it."""
    path = x.scratch(name)
    schema = x.table("events").schema

    def add(df: DataFrame) -> None:
        df.write.mode("append").parquet(path)

    def stream() -> DataFrame:
        session = events.stateful_session(x.spark)
        return events.stream_source(session, "parquet", path=path, schema=schema)

    return add, stream


@query
def stream_late_data(x: Inputs) -> DataFrame:
    """First the recent half, then everything: the old half is late, the rest is repeated."""
    add, stream = _staged(x, "late-topic")
    sink, checkpoint = x.scratch("late-sink"), x.scratch("late-checkpoint")
    everything = x.table("events")
    for arriving in (everything.filter(F.col("ts") >= F.lit(LATE_BEFORE).cast("timestamp_ntz")), everything):
        add(arriving)
        kept = events.within_watermark(stream(), "ts", ["event_id"])
        events.run_to_files(kept, sink, checkpoint)
    return x.spark.read.parquet(sink).select("event_id", "ts", "event_type", "value")


@query
def stream_dedup(x: Inputs) -> DataFrame:
    """Every event arrives twice; one per station and second goes through."""
    add, stream = _staged(x, "twice-topic")
    add(x.table("events"))
    add(x.table("events"))
    seconds = stream().select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit(weather.DEFAULT_CITY).alias("city_name"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("unix_timestamp"),
    )
    kept = events.within_watermark(seconds, "ts", unified.KEYS)
    return _sink(x, kept, "dedup").select(*unified.KEYS)


@query
def lambda_union(x: Inputs) -> DataFrame:
    history = x.weather.filter(F.col("datetime_utc") < HISTORY_ENDS)
    live = weather.conform_weather(x.raw("weather_current"))
    return unified.unify(history, live)


@query
def lambda_unified_view(x: Inputs) -> DataFrame:
    """A batch history and three runs of a stream: two folded into the base, one still a delta."""
    history = x.weather.filter(F.col("datetime_utc") < HISTORY_ENDS)
    batch = x.scratch("batch")
    tables.write_table(history, batch, unified.PARTS)
    add, stream = _staged(x, "live-topic")
    view = merge_view.MergeOnReadView(x.scratch("view"), merge_view.batch_at(batch))
    checkpoint, time = x.scratch("live-checkpoint"), F.col("ts")
    everything = x.table("events")
    late, middle = (F.lit(day).cast("timestamp_ntz") for day in (LATE_BEFORE, MIDDLE))
    for arriving in (everything.filter(time < middle), everything.filter((time >= middle) & (time < late)),
                     everything.filter(time >= late)):
        view.fold(x.spark)
        add(arriving)
        decoded = events.well_formed(events.decode_events(weather_messages(stream())))
        view.run(weather.conform_weather(decoded), checkpoint)
    return view.read(x.spark).select(
        "city_name", "unix_timestamp", "temperature_celsius", "weather_category", "origin",
        "year", "month",
    )


@query
def stream_static_enrich(x: Inputs) -> DataFrame:
    daily = kpis.daily_orders(x.orders).select("date_key", "total_orders")
    sales = materialize(daily, "daily-orders")
    decoded = events.well_formed(events.decode_events(weather_messages(event_stream(x))))
    enriched = events.enrich_with_sales(weather.conform_weather(decoded), sales, "datetime_utc")
    return _sink(
        x,
        enriched.select("unix_timestamp", "date_key", "temperature_celsius", "total_orders"),
        "enriched",
    )


@query
def stream_late_accounted(x: Inputs) -> DataFrame:
    """As ``stream_late_data``, but nothing is dropped: repeats meet in the view, late rows aside."""
    add, stream = _staged(x, "accounted-topic")
    view = merge_view.MergeOnReadView(x.scratch("accounted-view"), enrichment.no_batch, ["event_id"])
    ledger, checkpoint = lateness.LateLedger(x.scratch("ledger"), "ts"), x.scratch("accounted-checkpoint")
    everything = x.table("events")
    for arriving in (everything.filter(F.col("ts") >= F.lit(LATE_BEFORE).cast("timestamp_ntz")), everything):
        add(arriving)
        ledger.run(stream().select("event_id", "ts", "event_type"), view.append, checkpoint)
    late = ledger.late_rows(x.spark).select("event_id", "ts", "event_type", F.lit("late").alias("outcome"))
    kept = view.read(x.spark).select("event_id", "ts", "event_type", F.lit("kept").alias("outcome"))
    account = ledger.accounts(x.spark).agg(F.sum("read"), F.sum("kept"), F.sum("late")).first()
    totals = zip(("rows_read", "rows_kept", "rows_late"), account)
    return kept.unionByName(late).withColumns({name: F.lit(n).cast("bigint") for name, n in totals})


@query
def stream_enrich_versions(x: Inputs) -> DataFrame:
    """The sales table gets a new version between two runs of the stream; the second one sees it."""
    layer = versions.VersionedLayer(x.spark, x.scratch("sales-layer"))
    daily = materialize(kpis.daily_orders(x.orders).select("date_key", "total_orders"), "daily-orders")
    add, stream = _staged(x, "enrich-topic")
    sink = merge_view.MergeOnReadView(x.scratch("enriched-view"), enrichment.no_batch)
    checkpoint, everything = x.scratch("enrich-checkpoint"), x.table("events")
    middle = F.lit(MIDDLE).cast("timestamp_ntz")
    for number, arriving in enumerate((F.col("ts") < middle, F.col("ts") >= middle)):
        sales = daily.withColumn("total_orders", F.col("total_orders") + 1000 * number)
        versions.publish_snapshot(sales, layer, "daily_sales")
        add(everything.filter(arriving))
        decoded = events.well_formed(events.decode_events(weather_messages(stream())))
        readings = weather.conform_weather(decoded).select(
            "city_name", "unix_timestamp", "datetime_utc", "temperature_celsius", "year", "month"
        )
        enrichment.run_enrichment(readings, merge_view.batch_of(layer, "daily_sales"), sink.append, checkpoint)
    return sink.read(x.spark).select("unix_timestamp", "date_key", "temperature_celsius", "total_orders")
