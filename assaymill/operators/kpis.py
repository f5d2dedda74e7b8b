"""Gold KPIs over the star schema.

Shared pattern: aggregate to the grain of the join key first, join the compact rows, then
aggregate to the reporting grain. A hot product or customer is thereby reduced on the map side
before it is shuffled, and distinct counts become plain counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaymill.functions.exact import cents, from_cents, mean_amount, ratio
from assaymill.functions.labels import price_band, quarter_label, rfm_segment, temperature_class
from assaymill.functions.timestamps import date_key
from assaymill.operators.facts import order_totals
from assaymill.operators.ranking import with_tiles
from assaymill.session import materialize


def _rows() -> Column:
    return F.count(F.lit(1))


def _delivered(orders: DataFrame, *columns: str) -> DataFrame:
    return orders.filter(F.col("order_status") == "delivered").select("order_id", *columns)


def _delivered_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    return items.join(_delivered(orders, "year", "month"), "order_id")


def _categories(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_category_name")


def order_values(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Delivered orders with the amount paid in cents, NULL where nothing was paid.

    The common input of all KPIs about customers, regions and days: a job that computes
    several of them can store it once.
    """
    columns = ["customer_id", "order_purchase_timestamp", "year", "month", "delivery_days"]
    return _delivered(orders, *columns).join(order_totals(payments), "order_id", "left")


def _paid(values: DataFrame) -> DataFrame:
    return values.filter(F.col("total_cents").isNotNull())


def share_of_total(part: str, over: list[str], digits: int = 2) -> Column:
    """Percentage of ``part`` in its sum over the groups ``over``."""
    total = F.sum(part).over(Window.partitionBy(*over))
    return ratio(F.col(part) * 100, total, digits)


# --- sales by product and category -------------------------------------------------------


def _product_month_sales(items: DataFrame, orders: DataFrame) -> DataFrame:
    return (
        _delivered_items(
            items.select("order_id", "product_id", "price", "freight_value"), orders
        )
        .groupBy("product_id", "year", "month")
        .agg(
            _rows().alias("n"),
            F.sum(cents("price")).alias("price_cents"),
            F.sum(cents("freight_value")).alias("freight_cents"),
        )
    )


def kpi_top_products_by_category(
    items: DataFrame, products: DataFrame, orders: DataFrame
) -> DataFrame:
    """Delivered sales per category and month.

    One row per product and month enters the final step, so its count of known products is the
    distinct product count.
    """
    revenue, n = F.sum("price_cents"), F.sum("n")
    return (
        _product_month_sales(items, orders)
        .join(_categories(products), "product_id", "left")
        .groupBy("product_category_name", "year", "month")
        .agg(
            n.alias("units_sold"),
            from_cents(revenue).alias("gross_revenue_brl"),
            mean_amount(revenue, n).alias("avg_price_brl"),
            F.count("product_id").alias("distinct_products"),
            from_cents(F.sum("freight_cents")).alias("total_freight_brl"),
            mean_amount(revenue, n).alias("revenue_per_unit"),
        )
        .orderBy(F.col("gross_revenue_brl").desc())
    )


def top_products_per_category(
    items: DataFrame, products: DataFrame, orders: DataFrame, k: int = 10
) -> DataFrame:
    """The ``k`` best-earning products of each category over delivered orders."""
    sales = (
        items.select("order_id", "product_id", "price")
        .join(_delivered(orders), "order_id")
        .groupBy("product_id")
        .agg(_rows().alias("units_sold"), F.sum(cents("price")).alias("price_cents"))
    )
    best = Window.partitionBy("product_category_name").orderBy(
        F.col("price_cents").desc(), F.col("product_id").asc()
    )
    return (
        sales.join(_categories(products), "product_id", "left")
        .withColumn("rank_in_category", F.row_number().over(best))
        .filter(F.col("rank_in_category") <= k)
        .select(
            "product_category_name",
            "rank_in_category",
            "product_id",
            "units_sold",
            from_cents("price_cents").alias("gross_revenue_brl"),
        )
    )


def kpi_price_volume(items: DataFrame, products: DataFrame) -> DataFrame:
    """Units, mean price and revenue per category and price band, over all items."""
    per_product = items.groupBy("product_id", price_band("price").alias("price_bucket")).agg(
        _rows().alias("n"), F.sum(cents("price")).alias("price_cents")
    )
    n, revenue = F.sum("n"), F.sum("price_cents")
    return (
        per_product.join(_categories(products), "product_id", "left")
        .groupBy("product_category_name", "price_bucket")
        .agg(
            n.alias("units_sold"),
            mean_amount(revenue, n).alias("avg_price_brl"),
            from_cents(revenue).alias("total_revenue_brl"),
        )
        .orderBy("product_category_name", "avg_price_brl")
    )


def price_volume_corr(items: DataFrame, products: DataFrame) -> DataFrame:
    """Correlation of a product's mean price with its units sold, per category."""
    per_product = items.groupBy("product_id").agg(
        _rows().alias("n"), F.sum(cents("price")).alias("price_cents")
    )
    mean_price = from_cents("price_cents") / F.col("n")
    return (
        per_product.join(_categories(products), "product_id", "left")
        .groupBy("product_category_name")
        .agg(
            _rows().alias("products"),
            F.corr(mean_price, F.col("n").cast("double")).alias("price_volume_corr"),
        )
    )


# --- customers ---------------------------------------------------------------------------


def customer_rfm_base(values: DataFrame, reference_date: str) -> DataFrame:
    """Recency, frequency and monetary value per customer over delivered orders."""
    return values.groupBy("customer_id").agg(
        F.datediff(F.to_date(F.lit(reference_date)), F.max("order_purchase_timestamp")).alias(
            "recency_days"
        ),
        _rows().alias("frequency"),
        F.sum(F.coalesce("total_cents", F.lit(0))).alias("monetary_cents"),
    )


def rfm_segments(
    values: DataFrame,
    reference_date: str = "2018-10-17",
    best_is_five: bool = True,
) -> DataFrame:
    """RFM quintile scores and segments from ``order_values``.

    ``best_is_five`` gives the best customers score 5, so that high sums mean good customers.
    Without it the best customers get tile 1, as when the tiles run best first.
    """
    base = materialize(customer_rfm_base(values, reference_date), "rfm")
    worst_first = {
        "_r": -F.col("recency_days"),
        "_f": F.col("frequency"),
        "_m": F.col("monetary_cents"),
    }
    signs = worst_first if best_is_five else {c: -e for c, e in worst_first.items()}
    tiles = {"r_score": "_r", "f_score": "_f", "m_score": "_m"}
    scored = with_tiles(base.withColumns(signs), "customer_id", tiles, 5)
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return scored.select(
        "customer_id",
        "recency_days",
        "frequency",
        from_cents("monetary_cents").alias("monetary_brl"),
        *tiles,
        total.alias("rfm_score"),
        rfm_segment(total).alias("customer_segment"),
    )


def kpi_customer_rfm(
    orders: DataFrame, payments: DataFrame, reference_date: str = "2018-10-17", **options
) -> DataFrame:
    return rfm_segments(order_values(orders, payments), reference_date, **options)


def kpi_new_vs_returning(orders: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Orders and customers per month, split by whether the customer ordered more than once.

    With ``customers`` a person is known by ``customer_unique_id``; without, by
    ``customer_id``. Orders are counted per person and month first: the window then sees at
    most one row per month of a person's history, however many orders they placed.
    """
    person = F.col("customer_id")
    monthly = _delivered(orders, "customer_id", "year", "month").groupBy(
        "customer_id", "year", "month"
    ).agg(_rows().alias("n"))
    if customers is not None:
        monthly = monthly.join(
            customers.select("customer_id", "customer_unique_id"), "customer_id", "left"
        )
        person = F.coalesce("customer_unique_id", "customer_id")
    per_person = monthly.groupBy(person.alias("person"), "year", "month").agg(
        F.sum("n").alias("n")
    )
    lifetime = F.sum("n").over(Window.partitionBy("person"))
    return (
        per_person.withColumn(
            "customer_type", F.when(lifetime > 1, "Returning").otherwise("New")
        )
        .groupBy("year", "month", "customer_type")
        .agg(F.sum("n").alias("orders"), _rows().alias("unique_customers"))
        .withColumn("pct_of_monthly_orders", share_of_total("orders", ["year", "month"]))
    )


def monthly_ticket(values: DataFrame) -> DataFrame:
    """Per customer: active months, paid orders, and the mean over months of the mean ticket.

    A month's ticket is an amount of money and as such rounded to cents.
    """
    monthly = (
        _paid(values)
        .groupBy("customer_id", "year", "month")
        .agg(_rows().alias("n"), F.sum("total_cents").alias("total_cents"))
        .withColumn("ticket_cents", ratio(F.col("total_cents"), F.col("n")).cast("bigint"))
    )
    return monthly.groupBy("customer_id").agg(
        _rows().alias("active_months"),
        F.sum("n").alias("total_orders"),
        mean_amount(F.sum("ticket_cents"), _rows()).alias("avg_monthly_ticket_brl"),
    )


def customer_monthly_ticket(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return monthly_ticket(order_values(orders, payments))


# --- regions, payments -------------------------------------------------------------------


def regional_revenue(values: DataFrame, customers: DataFrame) -> DataFrame:
    """Paid orders, revenue, mean order value and delivery time per state and month."""
    per_customer = (
        _paid(values)
        .groupBy("customer_id", "year", "month")
        .agg(
            _rows().alias("n"),
            F.sum("total_cents").alias("total_cents"),
            F.sum("delivery_days").alias("days"),
            F.count("delivery_days").alias("timed"),
        )
    )
    n, revenue = F.sum("n"), F.sum("total_cents")
    return (
        per_customer.join(
            customers.select("customer_id", "customer_state"), "customer_id", "left"
        )
        .groupBy("customer_state", "year", "month")
        .agg(
            n.alias("total_orders"),
            from_cents(revenue).alias("total_revenue_brl"),
            mean_amount(revenue, n).alias("avg_order_value_brl"),
            ratio(F.sum("days"), F.sum("timed"), 1).alias("avg_delivery_days"),
        )
        .withColumn("quarter", quarter_label("month"))
        .orderBy("customer_state", "year", "month")
    )


def kpi_revenue_by_region(
    orders: DataFrame, payments: DataFrame, customers: DataFrame
) -> DataFrame:
    return regional_revenue(order_values(orders, payments), customers)


def kpi_payment_methods(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Transactions, value and instalments per payment type and month, delivered orders."""
    value = F.sum(cents("payment_value"))
    return (
        payments.select("order_id", "payment_type", "payment_installments", "payment_value")
        .join(_delivered(orders, "year", "month"), "order_id")
        .groupBy("payment_type", "year", "month")
        .agg(
            _rows().alias("transaction_count"),
            from_cents(value).alias("total_value_brl"),
            mean_amount(value, F.count("payment_value")).alias("avg_transaction_brl"),
            ratio(
                F.sum("payment_installments"), F.count("payment_installments"), 1
            ).alias("avg_installments"),
        )
        .orderBy("year", "month", F.col("total_value_brl").desc())
    )


# --- weather -----------------------------------------------------------------------------


def daily_weather(weather: DataFrame) -> DataFrame:
    """Weather per day; the dominant category is the most frequent one, then by name."""
    by_category = weather.groupBy(
        F.to_date("datetime_utc").alias("day"), "year", "month", "weather_category"
    ).agg(
        _rows().alias("n"),
        F.sum("temperature_celsius").alias("temp"),
        F.count("temperature_celsius").alias("temp_n"),
        F.sum(F.col("humidity_pct").cast("bigint")).alias("humidity"),
        F.count("humidity_pct").alias("humidity_n"),
        F.sum("wind_speed_ms").alias("wind"),
        F.count("wind_speed_ms").alias("wind_n"),
        F.sum("rain_1h_mm").alias("rain"),
    )
    rarest_last = F.when(
        F.col("weather_category").isNotNull(), F.struct(-F.col("n"), "weather_category")
    )
    daily = by_category.groupBy("day", "year", "month").agg(
        F.round(F.try_divide(F.sum("temp"), F.sum("temp_n")), 2).alias("avg_temp_c"),
        ratio(F.sum("humidity"), F.sum("humidity_n"), 1).alias("avg_humidity_pct"),
        F.round(F.try_divide(F.sum("wind"), F.sum("wind_n")), 2).alias("avg_wind_ms"),
        F.round(F.sum("rain"), 2).alias("total_rain_mm"),
        F.min_by("weather_category", rarest_last).alias("dominant_weather"),
    )
    return _keyed_by_day(daily)


def _keyed_by_day(daily: DataFrame) -> DataFrame:
    """Replace ``day`` by its text key, once per day instead of once per row."""
    rest = [c for c in daily.columns if c != "day"]
    return daily.select(date_key("day").alias("date_key"), *rest)


def daily_orders(orders: DataFrame) -> DataFrame:
    return _keyed_by_day(
        _delivered(orders, "order_purchase_timestamp", "year", "month")
        .groupBy(F.to_date("order_purchase_timestamp").alias("day"), "year", "month")
        .agg(_rows().alias("total_orders"))
    )


def kpi_weather_sales_impact(orders: DataFrame, weather: DataFrame) -> DataFrame:
    """Delivered orders per day beside that day's weather; days without weather stay."""
    return (
        daily_orders(orders)
        .join(daily_weather(weather), ["date_key", "year", "month"], "left")
        .withColumn("weather_condition", temperature_class("avg_temp_c"))
        .orderBy("date_key")
    )


def weather_condition_revenue(
    orders: DataFrame, payments: DataFrame, weather: DataFrame
) -> DataFrame:
    """Orders and revenue per temperature class and dominant weather."""
    values = order_values(orders, payments)
    daily = _keyed_by_day(
        values.groupBy(F.to_date("order_purchase_timestamp").alias("day"), "year", "month")
        .agg(_rows().alias("n"), F.sum("total_cents").alias("total_cents"))
    )
    return (
        daily.join(daily_weather(weather), ["date_key", "year", "month"], "left")
        .groupBy(
            temperature_class("avg_temp_c").alias("weather_condition"), "dominant_weather"
        )
        .agg(
            _rows().alias("days"),
            F.sum("n").alias("total_orders"),
            from_cents(F.sum("total_cents")).alias("total_revenue_brl"),
        )
    )
