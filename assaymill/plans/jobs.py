"""The two batch jobs: raw to silver, silver to gold."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from assaymill.operators import dimensions, facts, kpis, quality, weather
from assaymill.session import literal_rows, materialize, scratch_scope
from assaymill.sources.schema_groups import scan_raw
from assaymill.sources.schemas import RAW_TABLES
from assaymill.sources.tables import Lake, scan_silver, write_table
from assaymill.sources.versions import VersionedLake

MONTH = ("year", "month")

SILVER_PARTITIONS = {"fact_orders": MONTH, "weather_enriched": MONTH}
GOLD_PARTITIONS = {
    "kpi_top_products_by_category": MONTH,
    "kpi_revenue_by_region": MONTH,
    "kpi_new_vs_returning_customers": MONTH,
    "kpi_weather_sales_impact": MONTH,
    "kpi_payment_methods": MONTH,
}
# Order of the rows in each KPI's files; a leading ``-`` is for descending columns.
GOLD_ORDER = {
    "kpi_top_products_by_category": ("-gross_revenue_brl",),
    "kpi_customer_rfm": ("customer_id",),
    "kpi_revenue_by_region": ("customer_state", "year", "month"),
    "kpi_price_volume_correlation": ("product_category_name", "avg_price_brl"),
    "kpi_weather_sales_impact": ("date_key",),
    "kpi_payment_methods": ("year", "month", "-total_value_brl"),
    "top10_products_per_category": ("product_category_name", "rank_in_category"),
}


@dataclass
class SilverOptions:
    first_day: str = "2016-01-01"
    last_day: str = "2018-12-31"
    fail_on_audit: bool = False
    # Items and payments by declared key, as they are loaded by ``updated_at``: a changed row counts
    # once. Unset it for sources that never send a row again.
    newest_only: bool = True
    suites: dict = field(default_factory=lambda: quality.SILVER_SUITES)


def build_silver(
    spark: SparkSession, raw: dict[str, DataFrame], options: SilverOptions | None = None
) -> dict[str, DataFrame]:
    """The star schema over raw tables named as in ``RAW_TABLES``."""
    options = options or SilverOptions()
    return {
        "dim_date": dimensions.build_date_dimension(spark, options.first_day, options.last_day),
        "dim_customers": dimensions.build_dim_customers(raw["customers"]),
        "dim_products": dimensions.build_dim_products(
            raw["products"], raw.get("product_category_name_translation")
        ),
        "dim_sellers": dimensions.build_dim_sellers(raw["sellers"]),
        "dim_geolocation": dimensions.build_dim_geolocation(raw["geolocation"]),
        "fact_orders": facts.build_fact_orders(raw["orders"]),
        "fact_order_items": facts.build_fact_order_items(
            raw["order_items"], options.newest_only
        ),
        "fact_payments": facts.build_fact_payments(raw["order_payments"], options.newest_only),
        "fact_reviews": facts.build_fact_reviews(raw["order_reviews"]),
        "weather_enriched": weather.build_weather_enriched(raw["weather_current"]),
    }


def read_raw(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """All raw days of all tables; files that disagree on a type are brought to the declared one."""
    return {
        name: scan_raw(spark, lake.raw(table.source, name), table.schema)
        for name, table in RAW_TABLES.items()
    }


def audited(
    spark: SparkSession, staged: dict[str, DataFrame], options: SilverOptions
) -> DataFrame:
    """The audit report as constant rows; with ``fail_on_audit`` a failed rule raises."""
    report = quality.audit({name: staged[name] for name in options.suites}, options.suites)
    found = report.collect()
    report = literal_rows(spark, report.columns, found) if found else report.limit(0)
    if options.fail_on_audit:
        quality.enforce(report)
    return report


def run_silver(spark: SparkSession, lake: Lake, options: SilverOptions | None = None) -> DataFrame:
    """Build and write the silver layer; returns the audit report.

    Tables are staged in shared scratch space, audited there and only then published, so with
    ``fail_on_audit`` a failed rule leaves the old silver layer as it was. Publishing replaces
    whole tables: a month that no longer occurs goes. In a ``VersionedLake`` the tables are staged as
    the next version and appear all at once.
    """
    options = options or SilverOptions()
    if isinstance(lake, VersionedLake):
        with scratch_scope(spark), lake.layer(spark, "silver").publication() as publication:
            staged = {
                name: publication.stage(name, df, SILVER_PARTITIONS.get(name, ()))
                for name, df in build_silver(spark, read_raw(spark, lake), options).items()
            }
            report = audited(spark, staged, options)
            publication.commit(job="silver")
        return report
    with scratch_scope(spark):
        staged = {
            name: materialize(df, f"staged-{name}")
            for name, df in build_silver(spark, read_raw(spark, lake), options).items()
        }
        report = audited(spark, staged, options)
        for name, df in staged.items():
            write_table(df, lake.silver(name), SILVER_PARTITIONS.get(name, ()), replace="table")
    return report


def build_gold(
    silver: dict[str, DataFrame], reference_date: str = "2018-10-17"
) -> dict[str, Callable[[], DataFrame]]:
    """The KPI tables as callables, so that each one is planned when it is written.

    Seven KPIs and four further reports: top ten per category, monthly ticket, revenue by weather
    and price-volume correlation. Orders joined with what was paid feed several KPIs and are stored once: payments are
    shuffled by order a single time.
    """
    orders, items = silver["fact_orders"], silver["fact_order_items"]
    payments, customers = silver["fact_payments"], silver["dim_customers"]
    products, readings = silver["dim_products"], silver["weather_enriched"]
    values = materialize(kpis.order_values(orders, payments), "order-values")
    return {
        "kpi_top_products_by_category": lambda: kpis.kpi_top_products_by_category(
            items, products, orders
        ),
        "kpi_customer_rfm": lambda: kpis.rfm_segments(values, reference_date),
        "kpi_revenue_by_region": lambda: kpis.regional_revenue(values, customers),
        "kpi_new_vs_returning_customers": lambda: kpis.kpi_new_vs_returning(orders, customers),
        "kpi_price_volume_correlation": lambda: kpis.kpi_price_volume(items, products),
        "kpi_weather_sales_impact": lambda: kpis.kpi_weather_sales_impact(orders, readings),
        "kpi_payment_methods": lambda: kpis.kpi_payment_methods(payments, orders),
        "top10_products_per_category": lambda: kpis.top_products_per_category(
            items, products, orders
        ),
        "customer_monthly_ticket": lambda: kpis.monthly_ticket(values),
        "weather_condition_revenue": lambda: kpis.weather_condition_revenue(
            orders, payments, readings
        ),
        "price_volume_corr": lambda: kpis.price_volume_corr(items, products),
    }


def run_gold(spark: SparkSession, lake: Lake, reference_date: str = "2018-10-17") -> None:
    """Compute the KPIs from the silver layer and write them.

    In a ``VersionedLake`` all inputs come from one version of the silver layer, whose number is
    noted, and all KPIs appear together.
    """
    names = (
        "fact_orders",
        "fact_order_items",
        "fact_payments",
        "dim_customers",
        "dim_products",
        "weather_enriched",
    )
    if isinstance(lake, VersionedLake):
        layer = lake.layer(spark, "silver")
        version = layer.version()
        silver = {name: layer.read(name, version) for name in names}
        with scratch_scope(spark), lake.layer(spark, "gold").publication() as publication:
            for name, kpi in build_gold(silver, reference_date).items():
                parts, order = GOLD_PARTITIONS.get(name, ()), GOLD_ORDER.get(name, ())
                publication.stage(name, kpi(), parts, order=order)
            publication.commit(job="gold", silver_version=version.number)
        return
    silver = {name: scan_silver(spark, lake.silver(name)) for name in names}
    with scratch_scope(spark):
        for name, kpi in build_gold(silver, reference_date).items():
            parts, order = GOLD_PARTITIONS.get(name, ()), GOLD_ORDER.get(name, ())
            write_table(kpi(), lake.gold(name), parts, replace="table", order=order)
