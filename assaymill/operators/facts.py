"""Star-schema facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.functions.exact import cents, from_cents
from assaymill.operators.clean import (
    cast_timestamp_columns,
    drop_duplicates_by_key,
    newest_version,
    require_keys,
)

ORDER_TIMESTAMPS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]


def build_fact_orders(raw: DataFrame) -> DataFrame:
    """Latest version of each order with typed timestamps and delivery metrics."""
    latest = newest_version(
        require_keys(raw, ["order_id", "customer_id"]), ["order_id"], settle_ties=True
    )
    return typed_orders(latest)


def typed_orders(latest: DataFrame) -> DataFrame:
    """``build_fact_orders`` of rows that are the latest version of their order already."""
    bought, arrived = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    return cast_timestamp_columns(latest, ORDER_TIMESTAMPS).withColumns(
        {
            "year": F.year(bought),
            "month": F.month(bought),
            "delivery_days": F.datediff(arrived, bought),
            "estimated_vs_actual_days": F.datediff(
                arrived, F.col("order_estimated_delivery_date")
            ),
        }
    )


def build_fact_order_items(raw: DataFrame, newest_only: bool = False) -> DataFrame:
    """One row per product in an order; negative or missing prices are rejected.

    With ``newest_only`` one row per declared key: of the versions that incremental loads by
    ``updated_at`` bring, the newest. Without it every raw row counts.
    """
    if newest_only:
        raw = newest_version(raw, ["order_id", "order_item_id"], settle_ties=True)
    price, freight = F.col("price").try_cast("double"), F.col("freight_value").try_cast("double")
    return (
        require_keys(raw, ["order_id"])
        .filter(price >= 0)
        .select(
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "shipping_limit_date",
            price.alias("price"),
            freight.alias("freight_value"),
            from_cents(cents(price) + F.coalesce(cents(freight), F.lit(0))).alias(
                "total_item_value"
            ),
        )
    )


def build_fact_payments(raw: DataFrame, newest_only: bool = False) -> DataFrame:
    """Payments, several per order possible; negative or missing amounts are rejected.

    With ``newest_only`` one row per declared key, its newest version.
    """
    if newest_only:
        raw = newest_version(raw, ["order_id", "payment_sequential"], settle_ties=True)
    value = F.col("payment_value").try_cast("double")
    return (
        require_keys(raw, ["order_id"])
        .filter(value >= 0)
        .select(
            "order_id",
            "payment_sequential",
            "payment_type",
            F.col("payment_installments").try_cast("int").alias("payment_installments"),
            value.alias("payment_value"),
        )
    )


def build_fact_reviews(raw: DataFrame) -> DataFrame:
    """Reviews with a score from 1 to 5, one row per (review, order)."""
    score = F.col("review_score").try_cast("int")
    valid = require_keys(raw, ["review_id"]).filter(score.between(1, 5))
    keys = ["review_id", "order_id"]
    newest = (
        newest_version(valid, keys, settle_ties=True)
        if "updated_at" in raw.columns
        else drop_duplicates_by_key(valid, keys)
    )
    return newest.select(
        *keys,
        score.alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
    )


def order_totals(payments: DataFrame) -> DataFrame:
    """Paid amount per order in cents; map-side aggregation shrinks it before any join."""
    return payments.groupBy("order_id").agg(F.sum(cents("payment_value")).alias("total_cents"))
