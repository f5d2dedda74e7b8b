"""Straightforward formulations of some queries, to time the library against.

They return comparable results by the obvious route: windows over all rows, a self join, distinct
counts after the joins, one job per check, formatter-based parsing, row counts around a dedup.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assaymill.plans.bronze_views import raw_view, source_table

_PARSE = "to_timestamp(%s, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"


def _raw(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: raw_view(spark, sf_dir, n) for n in names}


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after a dedup that is counted before and after."""
    raw = raw_view(spark, sf_dir, "orders").filter("order_id is not null and customer_id is not null")
    raw.count()
    one_each = raw.dropDuplicates(["order_id"])
    one_each.count()
    return spark.sql(
        f"""SELECT *, year(bought) AS year, month(bought) AS month,
              datediff(arrived, bought) AS delivery_days, datediff(arrived, estimated) AS late_days
            FROM (SELECT order_id, customer_id, order_status,
              {_PARSE % 'order_purchase_timestamp'} AS bought, {_PARSE % 'order_approved_at'} AS approved,
              {_PARSE % 'order_delivered_carrier_date'} AS carried,
              {_PARSE % 'order_delivered_customer_date'} AS arrived,
              {_PARSE % 'order_estimated_delivery_date'} AS estimated FROM {{o}})""",
        o=one_each,
    )


def rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """WITH b AS (
             SELECT customer_id, datediff(DATE '2001-12-31', max(bought)) AS r, count(*) AS f,
               round(sum(coalesce(total, 0)), 2) AS m
             FROM {o} LEFT JOIN (SELECT order_id, sum(payment_value) AS total FROM {p} GROUP BY 1)
               USING (order_id) WHERE order_status = 'delivered' GROUP BY customer_id)
           SELECT *, ntile(5) OVER (ORDER BY r) AS r_score, ntile(5) OVER (ORDER BY f DESC) AS f_score,
             ntile(5) OVER (ORDER BY m DESC) AS m_score FROM b""",
        o=_orders(spark, sf_dir),
        p=raw_view(spark, sf_dir, "order_payments"),
    )


def quintiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        "SELECT o_orderkey, ntile(5) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS q FROM {o}",
        o=source_table(spark, sf_dir, "orders"),
    )


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT product_category_name, year, month, count(o.order_id) AS units_sold,
             round(sum(price), 2) AS revenue, round(avg(price), 2) AS mean_price,
             count(DISTINCT i.product_id) AS products, round(sum(freight_value), 2) AS freight
           FROM {i} i JOIN {o} o ON i.order_id = o.order_id
             LEFT JOIN {p} p ON i.product_id = p.product_id
           WHERE order_status = 'delivered' AND price >= 0
           GROUP BY 1, 2, 3 ORDER BY revenue DESC""",
        i=raw_view(spark, sf_dir, "order_items"),
        o=_orders(spark, sf_dir),
        p=raw_view(spark, sf_dir, "products"),
    )


def new_vs_returning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """WITH d AS (SELECT * FROM {o} WHERE order_status = 'delivered'),
             n AS (SELECT customer_id, count(*) AS lifetime FROM d GROUP BY 1)
           SELECT year, month, if(lifetime > 1, 'Returning', 'New') AS customer_type,
             count(*) AS orders, count(DISTINCT d.customer_id) AS customers
           FROM d LEFT JOIN n ON d.customer_id = n.customer_id GROUP BY 1, 2, 3""",
        o=_orders(spark, sf_dir),
    )


def region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT customer_state, year, month, count(*) AS orders, round(sum(total), 2) AS revenue,
             round(avg(total), 2) AS mean_value, round(avg(delivery_days), 1) AS mean_days
           FROM {o} JOIN (SELECT order_id, round(sum(payment_value), 2) AS total FROM {p} GROUP BY 1)
             USING (order_id) LEFT JOIN {c} USING (customer_id)
           WHERE order_status = 'delivered' GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
        o=_orders(spark, sf_dir),
        p=raw_view(spark, sf_dir, "order_payments"),
        c=raw_view(spark, sf_dir, "customers"),
    )


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per check, as separate counts."""
    raw = _raw(spark, sf_dir, "customers", "order_items")
    orders = _orders(spark, sf_dir)
    customers, items = raw["customers"], raw["order_items"].filter("price >= 0")
    counts = [
        customers.count(),
        customers.select("customer_id").distinct().count(),
        customers.count(),
        customers.filter("customer_id is null").count(),
        customers.filter("customer_unique_id is null").count(),
        items.filter("price < 0 or price > 100000").count(),
        orders.filter("order_status not in ('delivered', 'shipped', 'created')").count(),
    ]
    return spark.createDataFrame([(i, n) for i, n in enumerate(counts)], "check_id int, n bigint")


PLAIN: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fact_orders": _orders,
    "ntile_quintiles": quintiles,
    "kpi_customer_rfm": rfm,
    "kpi_top_products_by_category": top_products,
    "kpi_new_vs_returning_as_coded": new_vs_returning,
    "kpi_revenue_by_region": region,
    "dq_silver_audit": audit,
}
