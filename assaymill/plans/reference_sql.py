"""The named queries once more, as plain SQL for DuckDB.

Written from the meaning of each query, not from its Spark plan: windows instead of rank
shuffles, distinct counts instead of pre-aggregation, plain joins instead of skew handling.
"""

from __future__ import annotations

import re

from assaymill.plans.bronze_views import SOURCE_TABLES, VIEWS, duckdb_view

_ISO = "'%Y-%m-%dT%H:%M:%S.%gZ'"


def _shown(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {name or column.rsplit('.', 1)[-1]}"


def _half_up(numerator: str, denominator: str, digits: int = 0) -> str:
    """Quotient of two non-negative integers, rounded half up."""
    scale = 10**digits
    return (
        f"CAST(CAST((({numerator}) * {2 * scale} + ({denominator})) // (2 * ({denominator})) "
        f"AS BIGINT) AS DOUBLE) / {scale}.0"
    )


def _money(total_cents: str) -> str:
    return f"CAST(CAST(({total_cents}) AS BIGINT) AS DOUBLE) / 100.0"


def _mean_money(total_cents: str, n: str) -> str:
    return f"({_half_up(total_cents, n)}) / 100.0"


def _cents(c: str) -> str:
    return f"CAST(round({c} * 100) AS BIGINT)"


_WEATHER_VALUES = """
  CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, temp AS temperature_celsius,
  feels_like AS feels_like_celsius, temp_min AS temp_min_celsius, temp_max AS temp_max_celsius,
  pressure AS pressure_hpa, humidity AS humidity_pct, wind_speed AS wind_speed_ms,
  coalesce(rain_1h, 0.0e0) AS rain_1h_mm, weather_main AS weather_category, weather_description"""

CTES = {
    **{f"raw_{name}": duckdb_view(name) for name in VIEWS},
    "newest_orders": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) AS rn
  FROM raw_orders) WHERE rn = 1""",
    "f_orders": f"""
SELECT order_id, customer_id, order_status, bought, approved, carried, arrived, estimated,
  updated_at, year(bought) AS year, month(bought) AS month,
  CAST(arrived AS DATE) - CAST(bought AS DATE) AS delivery_days,
  CAST(arrived AS DATE) - CAST(estimated AS DATE) AS estimated_vs_actual_days
FROM (SELECT *, strptime(order_purchase_timestamp, {_ISO}) AS bought,
    strptime(order_approved_at, {_ISO}) AS approved,
    strptime(order_delivered_carrier_date, {_ISO}) AS carried,
    strptime(order_delivered_customer_date, {_ISO}) AS arrived,
    strptime(order_estimated_delivery_date, {_ISO}) AS estimated
  FROM newest_orders)""",
    "f_delivered": "SELECT * FROM f_orders WHERE order_status = 'delivered'",
    "f_items": f"""
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value,
  {_money(f"{_cents('price')} + coalesce({_cents('freight_value')}, 0)")} AS total_item_value
FROM raw_order_items WHERE price >= 0""",
    "f_payments": """
SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value
FROM raw_order_payments WHERE payment_value >= 0""",
    "paid": f"""
SELECT order_id, sum({_cents('payment_value')}) AS total_cents FROM f_payments GROUP BY order_id""",
    "d_customers": """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
  nullif(lower(trim(customer_city)), '') AS customer_city,
  nullif(lower(trim(customer_state)), '') AS customer_state FROM raw_customers""",
    "d_products": """
SELECT product_id, coalesce(product_category_name_english, p.product_category_name) AS product_category_name,
  product_name_length, product_description_length, product_photos_qty, product_weight_g,
  product_length_cm, product_height_cm, product_width_cm
FROM raw_products AS p LEFT JOIN raw_product_category_name_translation AS t
  ON p.product_category_name = t.product_category_name""",
    "w_all": f"""
SELECT dt AS unix_timestamp, make_timestamp(dt * 1000000) AS datetime_utc, city_name, {_WEATHER_VALUES}
FROM raw_weather_current""",
    "w_enriched": """
SELECT * EXCLUDE (rn), year(datetime_utc) AS year, month(datetime_utc) AS month, day(datetime_utc) AS day
FROM (SELECT *, row_number() OVER (PARTITION BY city_name, unix_timestamp ORDER BY
    datetime_utc DESC NULLS LAST, lat DESC NULLS LAST, lon DESC NULLS LAST,
    temperature_celsius DESC NULLS LAST, feels_like_celsius DESC NULLS LAST,
    temp_min_celsius DESC NULLS LAST, temp_max_celsius DESC NULLS LAST,
    pressure_hpa DESC NULLS LAST, humidity_pct DESC NULLS LAST, wind_speed_ms DESC NULLS LAST,
    rain_1h_mm DESC NULLS LAST, weather_category DESC NULLS LAST,
    weather_description DESC NULLS LAST) AS rn
  FROM w_all) WHERE rn = 1""",
    "w_days": f"""
SELECT date_key, year, month,
  CASE WHEN count(temperature_celsius) > 0 THEN round(sum(temperature_celsius) / count(temperature_celsius), 2) END AS avg_temp_c,
  {_half_up('sum(humidity_pct)', 'count(humidity_pct)', 1)} AS avg_humidity_pct,
  round(avg(wind_speed_ms), 2) AS avg_wind_ms, round(sum(rain_1h_mm), 2) AS total_rain_mm
FROM (SELECT *, strftime(datetime_utc, '%Y%m%d') AS date_key FROM w_enriched)
GROUP BY date_key, year, month""",
    "w_dominant": """
SELECT date_key, weather_category AS dominant_weather FROM (
  SELECT date_key, weather_category,
    row_number() OVER (PARTITION BY date_key ORDER BY count(*) DESC, weather_category) AS rn
  FROM (SELECT *, strftime(datetime_utc, '%Y%m%d') AS date_key FROM w_enriched)
  WHERE weather_category IS NOT NULL GROUP BY date_key, weather_category) WHERE rn = 1""",
    "sales_days": """
SELECT strftime(bought, '%Y%m%d') AS date_key, year, month, count(*) AS total_orders,
  sum(total_cents) AS total_cents
FROM f_delivered LEFT JOIN paid USING (order_id) GROUP BY ALL""",
    "weather_and_sales": """
SELECT s.date_key, s.year, s.month, total_orders, total_cents, avg_temp_c, avg_humidity_pct,
  avg_wind_ms, total_rain_mm, dominant_weather,
  CASE WHEN avg_temp_c IS NULL THEN 'Unknown' WHEN avg_temp_c < 10 THEN 'Cold'
    WHEN avg_temp_c < 20 THEN 'Mild' ELSE 'Warm' END AS weather_condition
FROM sales_days AS s LEFT JOIN w_days AS w ON s.date_key = w.date_key
  LEFT JOIN w_dominant AS d ON s.date_key = d.date_key""",
    "rfm": """
SELECT customer_id, DATE '2001-12-31' - max(CAST(bought AS DATE)) AS recency_days,
  count(*) AS frequency, sum(coalesce(total_cents, 0)) AS monetary_cents
FROM f_delivered LEFT JOIN paid USING (order_id) GROUP BY customer_id""",
    # What a message says after decoding; see the catalog for how messages are made.
    "messages": """
SELECT event_id, ts, user_id % 19 = 0 AS malformed,
  CAST(floor(epoch(ts - INTERVAL '300' MONTH)) AS BIGINT) AS dt,
  concat(strftime(ts - INTERVAL '300' MONTH, '%Y-%m-%d %H:%M:%S'), ' +0000 UTC') AS dt_iso,
  'Patagonia' AS city_name, -41.81e0 AS lat, -68.91e0 AS lon,
  CASE WHEN user_id % 17 <> 0 THEN floor(value * 10) / 120 - 5 END AS temp,
  CASE WHEN user_id % 13 <> 0 THEN CAST(user_id % 100 AS BIGINT) END AS humidity,
  floor(value) / 50 AS wind_speed, event_type AS weather_main,
  upper(event_type) AS weather_description
FROM events""",
    "conformed": """
SELECT dt AS unix_timestamp, make_timestamp(dt * 1000000) AS datetime_utc, city_name, lat, lon,
  temp AS temperature_celsius, humidity AS humidity_pct, wind_speed AS wind_speed_ms,
  weather_main AS weather_category, year(make_timestamp(dt * 1000000)) AS year,
  month(make_timestamp(dt * 1000000)) AS month, ts
FROM messages WHERE NOT malformed AND temp IS NOT NULL""",
}

_DRIFTED = """
SELECT 'customers' AS table_name, 'loyalty_tier' AS column_name, 'added' AS change,
  CAST(NULL AS STRING) AS expected, 'string' AS actual, count(nullif(trim(customer_city), '')) AS rows_affected
FROM raw_customers
UNION ALL SELECT 'customers', 'customer_city', 'removed', 'string', NULL, count(*) FROM raw_customers
UNION ALL SELECT 'customers', 'customer_zip_code_prefix', 'type_changed', 'string', 'int',
  count(customer_zip_code_prefix) FROM raw_customers"""

_EXTRA_WEATHER = {
    "event_id": "bigint", "lat": "double", "lon": "double", "feels_like": "double",
    "temp_min": "double", "temp_max": "double", "pressure": "double", "wind_speed": "double",
    "rain_1h": "double", "weather_main": "string", "weather_description": "string",
}


def _check(table: str, check: str, column: str, failing: str, source: str, limit: float = 0.0) -> str:
    failed = f"count(*) FILTER (WHERE {failing})"
    return f"""
SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name,
  {failed} AS failed, count(*) AS total,
  CAST({failed} AS DOUBLE) / count(*) AS ratio,
  CAST({failed} AS DOUBLE) / count(*) <= {limit} AS passed
FROM {source}"""


def _unique(table: str, columns: str, source: str) -> str:
    return f"""
SELECT '{table}' AS table_name, 'unique_key' AS check_name, '{columns}' AS column_name,
  count(*) - count(DISTINCT ({columns})) AS failed, count(*) AS total,
  CAST(count(*) - count(DISTINCT ({columns})) AS DOUBLE) / count(*) AS ratio,
  count(*) = count(DISTINCT ({columns})) AS passed
FROM {source}"""


_STATUSES = (
    "'delivered', 'shipped', 'canceled', 'invoiced', 'processing', 'approved', 'unavailable', "
    "'created'"
)


def _rfm(r: str, f: str, m: str) -> str:
    return f"""
SELECT customer_id, recency_days, frequency, {_money('monetary_cents')} AS monetary_brl,
  r_score, f_score, m_score, r_score + f_score + m_score AS rfm_score,
  CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champions'
    WHEN r_score + f_score + m_score >= 10 THEN 'Loyal Customers'
    WHEN r_score + f_score + m_score >= 7 THEN 'At Risk'
    WHEN r_score + f_score + m_score >= 4 THEN 'Needs Attention' ELSE 'Lost' END AS customer_segment
FROM (SELECT *, ntile(5) OVER (ORDER BY recency_days {r}, customer_id) AS r_score,
    ntile(5) OVER (ORDER BY frequency {f}, customer_id) AS f_score,
    ntile(5) OVER (ORDER BY monetary_cents {m}, customer_id) AS m_score FROM rfm)"""


def _new_vs_returning(person: str, source: str) -> str:
    return f"""
SELECT year, month, customer_type, orders, unique_customers,
  {_half_up('orders * 100', 'CAST(sum(orders) OVER (PARTITION BY year, month) AS BIGINT)', 2)} AS pct_of_monthly_orders
FROM (SELECT year, month, CASE WHEN lifetime > 1 THEN 'Returning' ELSE 'New' END AS customer_type,
    count(*) AS orders, count(DISTINCT person) AS unique_customers
  FROM (SELECT year, month, {person} AS person, count(*) OVER (PARTITION BY {person}) AS lifetime
    FROM {source}) GROUP BY ALL)"""


_F_ORDERS_SHOWN = f"""
SELECT order_id, customer_id, order_status, {_shown('bought', 'order_purchase_timestamp')},
  {_shown('approved', 'order_approved_at')}, {_shown('carried', 'order_delivered_carrier_date')},
  {_shown('arrived', 'order_delivered_customer_date')},
  {_shown('estimated', 'order_estimated_delivery_date')}"""

_UNIFY_ORDER = """_side DESC, _at DESC, datetime_utc DESC NULLS LAST, lat DESC NULLS LAST, lon DESC NULLS LAST,
    temperature_celsius DESC NULLS LAST, humidity_pct DESC NULLS LAST, wind_speed_ms DESC NULLS LAST,
    weather_category DESC NULLS LAST"""

_UNIFIED_COLUMNS = """unix_timestamp, datetime_utc, city_name, lat, lon, temperature_celsius, humidity_pct,
    wind_speed_ms, weather_category, year, month"""

_BODIES = {
    "scan_bronze": """
SELECT order_id, order_status, updated_at,
  CASE order_status WHEN 'created' THEN '2001-12-30' ELSE '2001-12-31' END AS sync_date
FROM raw_orders""",
    "scan_silver": "SELECT * FROM d_customers",
    "write_silver_roundtrip": """
SELECT order_id, order_status, year, month, delivery_days, estimated_vs_actual_days FROM f_orders""",
    "dynamic_partition_overwrite": """
SELECT order_id, CASE year WHEN 1999 THEN 'restated' ELSE order_status END AS order_status, year
FROM f_orders""",
    "repartition_for_write": """
SELECT year, count(*) AS row_count, 1 AS file_count FROM f_orders GROUP BY year""",
    "compact_small_files": """
SELECT year(make_timestamp(dt * 1000000)) AS ingestion_year,
  month(make_timestamp(dt * 1000000)) AS ingestion_month, count(*) AS row_count,
  CAST(sum(event_id) AS BIGINT) AS event_id_sum, CAST(sum(humidity) AS BIGINT) AS humidity_sum,
  true AS fewer_files
FROM raw_weather_current GROUP BY ALL""",
    "csv_bulk_load": """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
  nullif(trim(customer_city), '') AS customer_city, customer_state FROM raw_customers""",
    "csv_documents": """
SELECT doc_id, trim('a, "b"' || chr(10) || text) AS text, nullif(trim(lang), '') AS lang,
  (SELECT count(*) FROM documents WHERE doc_id % 17 = 0) AS rejects
FROM documents WHERE doc_id % 17 <> 0""",
    "insert_if_absent": """
SELECT order_id, order_status, updated_at FROM raw_orders WHERE order_status = 'created'
UNION ALL
SELECT order_id, order_status, updated_at FROM raw_orders WHERE order_status <> 'created'
  AND order_id NOT IN (SELECT order_id FROM raw_orders WHERE order_status = 'created')""",
    "bloom_insert_if_absent": """
SELECT DISTINCT l_orderkey, l_linenumber FROM (
  SELECT CASE WHEN l_orderkey % 2 = 0 THEN -l_orderkey ELSE l_orderkey END AS l_orderkey, l_linenumber
  FROM lineitem WHERE l_shipdate >= DATE '2001-06-01') AS a
WHERE NOT EXISTS (SELECT 1 FROM lineitem AS h
  WHERE h.l_orderkey = a.l_orderkey AND h.l_linenumber = a.l_linenumber)""",
    "incremental_append": """
SELECT order_id, order_status, order_purchase_timestamp,
  CASE WHEN order_purchase_timestamp < '1999' THEN '2001-12-30' ELSE '2001-12-31' END AS sync_date
FROM raw_orders""",
    "full_refresh": "SELECT * FROM raw_sellers",
    "incremental_silver": """
SELECT order_id, order_status, year, month, delivery_days, estimated_vs_actual_days FROM f_orders""",
    "publish_versioned": """
SELECT order_status, version, table_name, count(*) AS row_count FROM (
  SELECT order_status, unnest([1, 3]) AS version, 'orders' AS table_name FROM f_orders WHERE year < 1996
  UNION ALL
  SELECT CASE year WHEN 1995 THEN 'restated' ELSE order_status END, 2, 'orders' FROM f_orders WHERE year > 1992
  UNION ALL
  SELECT customer_state, unnest([1, 2, 3]), 'customers' FROM d_customers) GROUP BY ALL""",
    "dedup_by_key": "SELECT DISTINCT order_id, order_item_id FROM raw_order_items",
    "latest_by_key": "SELECT order_id, order_status, updated_at FROM newest_orders",
    "cast_timestamps": f"""
SELECT order_id, customer_id, order_status,
  {_shown(f"strptime(order_purchase_timestamp, {_ISO})", 'order_purchase_timestamp')},
  {_shown(f"strptime(order_approved_at, {_ISO})", 'order_approved_at')},
  {_shown(f"strptime(order_delivered_carrier_date, {_ISO})", 'order_delivered_carrier_date')},
  {_shown(f"strptime(order_delivered_customer_date, {_ISO})", 'order_delivered_customer_date')},
  {_shown(f"strptime(order_estimated_delivery_date, {_ISO})", 'order_estimated_delivery_date')},
  updated_at FROM raw_orders""",
    "normalize_strings": "SELECT customer_id, customer_city, customer_state FROM d_customers",
    "surrogate_key_dense": """
SELECT customer_id, customer_state, row_number() OVER (ORDER BY customer_id) AS customer_sk
FROM raw_customers""",
    "price_bucket": """
SELECT CASE WHEN price < 50 THEN '0-50 BRL' WHEN price < 150 THEN '50-150 BRL'
    WHEN price < 300 THEN '150-300 BRL' WHEN price < 500 THEN '300-500 BRL'
    ELSE '+500 BRL' END AS price_bucket,
  count(*) AS units, min(price) AS min_price, max(price) AS max_price
FROM f_items GROUP BY 1""",
    "flatten_weather_json": """
SELECT event_id, dt, strftime(make_timestamp(dt * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS dt_iso,
  'Bariloche' AS city_name, lat, lon, temp, humidity, CAST(NULL AS DOUBLE) AS pressure, wind_speed,
  CAST(NULL AS DOUBLE) AS rain_1h, CAST(NULL AS STRING) AS weather_main, CAST(NULL AS STRING) AS weather_description
FROM raw_weather_current WHERE weather_main = 'Clear'
UNION ALL
SELECT event_id, dt + ahead, dt_iso, city_name, lat, lon, temp, humidity, pressure, wind_speed,
  rain_1h, weather_main, weather_description
FROM raw_weather_current JOIN (SELECT unnest([0, 10800]) AS ahead) AS a
  ON ahead = 0 OR weather_main = 'Rain' WHERE weather_main <> 'Clear'""",
    "flatten_weather_variant": """
SELECT event_id, dt, strftime(make_timestamp(dt * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS dt_iso,
  'Bariloche' AS city_name, lat, lon, temp, humidity, wind_speed, CAST(NULL AS STRING) AS weather_main,
  CAST(NULL AS STRING) AS reason
FROM raw_weather_current WHERE weather_main = 'Clear'
UNION ALL
SELECT event_id, dt + ahead, dt_iso, city_name, lat, lon, temp, humidity, wind_speed, weather_main, NULL
FROM raw_weather_current JOIN (SELECT unnest([0, 10800]) AS ahead) AS a
  ON ahead = 0 OR weather_main = 'Rain' WHERE weather_main <> 'Clear'
UNION ALL
SELECT event_id, dt, strftime(make_timestamp(dt * 1000000), '%Y-%m-%dT%H:%M:%SZ'), 'Lima', -12.0e0, -68.91e0, temp,
  NULL, NULL, NULL, NULL FROM raw_weather_current WHERE event_id % 10 = 2
UNION ALL
SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
  CASE event_id % 10 WHEN 0 THEN 'broken' ELSE 'empty' END FROM raw_weather_current WHERE event_id % 10 < 2""",
    "weather_projection": f"""
SELECT * EXCLUDE (datetime_utc), {_shown('datetime_utc')}, year(datetime_utc) AS year,
  month(datetime_utc) AS month, day(datetime_utc) AS day FROM w_all""",
    "weather_enriched": f"""
SELECT * EXCLUDE (datetime_utc), {_shown('datetime_utc')} FROM w_enriched""",
    "dim_date": """
SELECT strftime(d, '%Y%m%d') AS date_key, CAST(CAST(d AS DATE) AS STRING) AS full_date, year(d) AS year,
  quarter(d) AS quarter, month(d) AS month, week(d) AS week_of_year, day(d) AS day_of_month,
  dayofweek(d) + 1 AS day_of_week, strftime(d, '%A') AS day_name, strftime(d, '%B') AS month_name,
  dayofweek(d) IN (0, 6) AS is_weekend,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'Summer' WHEN month(d) IN (3, 4, 5) THEN 'Autumn'
    WHEN month(d) IN (6, 7, 8) THEN 'Winter' ELSE 'Spring' END AS season_southern
FROM (SELECT unnest(generate_series(date_trunc('day', min(bought)), date_trunc('day', max(bought)),
  INTERVAL '1' DAY)) AS d FROM f_orders)""",
    "dim_customers": "SELECT * FROM d_customers",
    "dim_products": "SELECT * FROM d_products",
    "dim_sellers": """
SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state FROM raw_sellers""",
    "dim_geolocation": """
SELECT geolocation_zip_code_prefix AS zip_code_prefix, geolocation_city AS city,
  geolocation_state AS state, round(avg(geolocation_lat), 6) AS lat_centroid,
  round(avg(geolocation_lng), 6) AS lon_centroid FROM raw_geolocation GROUP BY ALL""",
    "dim_geolocation_per_zip": """
SELECT geolocation_zip_code_prefix AS zip_code_prefix, round(avg(geolocation_lat), 6) AS lat_centroid,
  round(avg(geolocation_lng), 6) AS lon_centroid FROM raw_geolocation GROUP BY ALL""",
    "fact_orders": f"""
{_F_ORDERS_SHOWN}, updated_at, year, month, delivery_days, estimated_vs_actual_days FROM f_orders""",
    "fact_order_items": "SELECT * FROM f_items",
    "fact_payments": "SELECT * FROM f_payments",
    "fact_reviews": """
SELECT DISTINCT review_id, order_id, review_score, review_comment_title, review_comment_message,
  review_creation_date FROM raw_order_reviews WHERE review_score BETWEEN 1 AND 5""",
    "broadcast_left_join": """
SELECT product_id, order_id, order_item_id, price, product_category_name
FROM f_items LEFT JOIN d_products USING (product_id)""",
    "fk_orphans": "\nUNION ALL\n".join(
        f"""SELECT '{child}' AS child, '{fk}' AS fk, '{parent}' AS parent, count(*) AS child_rows,
  count(*) FILTER (WHERE {fk} NOT IN (SELECT {fk} FROM raw_{parent})) AS orphans FROM raw_{child}"""
        for child, fk, parent in [
            ("orders", "customer_id", "customers"),
            ("order_items", "order_id", "orders"),
            ("order_items", "product_id", "products"),
            ("order_items", "seller_id", "sellers"),
            ("order_payments", "order_id", "orders"),
            ("order_reviews", "order_id", "orders"),
        ]
    ),
    "order_totals": f"SELECT order_id, {_money('total_cents')} AS order_total FROM paid",
    "ntile_quintiles": """
SELECT o_orderkey, ntile(5) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS quintile FROM orders""",
    "pct_of_total": f"""
SELECT payment_type, payment_installments, payments,
  {_half_up('payments * 100', 'CAST(sum(payments) OVER (PARTITION BY payment_type) AS BIGINT)', 2)} AS pct_of_type
FROM (SELECT payment_type, payment_installments, count(*) AS payments FROM f_payments GROUP BY ALL)""",
    "sorted_output": "SELECT * FROM f_payments ORDER BY payment_type, payment_value DESC, order_id, payment_sequential",
    "kpi_top_products_by_category": f"""
SELECT product_category_name, o.year, o.month, count(*) AS units_sold,
  {_money(f"sum({_cents('price')})")} AS gross_revenue_brl,
  {_mean_money(f"sum({_cents('price')})", 'count(*)')} AS avg_price_brl,
  count(DISTINCT i.product_id) AS distinct_products,
  {_money(f"sum({_cents('freight_value')})")} AS total_freight_brl,
  {_mean_money(f"sum({_cents('price')})", 'count(*)')} AS revenue_per_unit
FROM f_items AS i JOIN f_delivered AS o ON i.order_id = o.order_id
  LEFT JOIN d_products AS p ON i.product_id = p.product_id
GROUP BY product_category_name, o.year, o.month""",
    "kpi_customer_rfm": _rfm("DESC", "ASC", "ASC"),
    "kpi_customer_rfm_as_coded": _rfm("ASC", "DESC", "DESC"),
    "kpi_revenue_by_region": f"""
SELECT customer_state, year, month, count(*) AS total_orders,
  {_money('sum(total_cents)')} AS total_revenue_brl,
  {_mean_money('sum(total_cents)', 'count(*)')} AS avg_order_value_brl,
  {_half_up('sum(delivery_days)', 'count(delivery_days)', 1)} AS avg_delivery_days,
  concat('Q', CAST(quarter(make_date(year, month, 1)) AS STRING)) AS quarter
FROM f_delivered JOIN paid USING (order_id) LEFT JOIN d_customers USING (customer_id)
GROUP BY customer_state, year, month""",
    "kpi_new_vs_returning": _new_vs_returning(
        "coalesce(customer_unique_id, customer_id)",
        "f_delivered LEFT JOIN d_customers USING (customer_id)",
    ),
    "kpi_new_vs_returning_as_coded": _new_vs_returning("customer_id", "f_delivered"),
    "kpi_price_volume": f"""
SELECT product_category_name,
  CASE WHEN price < 50 THEN '0-50 BRL' WHEN price < 150 THEN '50-150 BRL'
    WHEN price < 300 THEN '150-300 BRL' WHEN price < 500 THEN '300-500 BRL'
    ELSE '+500 BRL' END AS price_bucket,
  count(*) AS units_sold, {_mean_money(f"sum({_cents('price')})", 'count(*)')} AS avg_price_brl,
  {_money(f"sum({_cents('price')})")} AS total_revenue_brl
FROM f_items LEFT JOIN d_products USING (product_id) GROUP BY 1, 2""",
    "kpi_weather_sales_impact": """
SELECT * EXCLUDE (total_cents) FROM weather_and_sales""",
    "kpi_payment_methods": f"""
SELECT payment_type, year, month, count(*) AS transaction_count,
  {_money(f"sum({_cents('payment_value')})")} AS total_value_brl,
  {_mean_money(f"sum({_cents('payment_value')})", 'count(*)')} AS avg_transaction_brl,
  {_half_up('sum(payment_installments)', 'count(payment_installments)', 1)} AS avg_installments
FROM f_payments JOIN f_delivered USING (order_id) GROUP BY payment_type, year, month""",
    "top10_products_per_category": f"""
SELECT product_category_name, rank_in_category, product_id, units_sold,
  {_money('price_cents')} AS gross_revenue_brl
FROM (SELECT product_category_name, product_id, units_sold, price_cents,
    row_number() OVER (PARTITION BY product_category_name ORDER BY price_cents DESC, product_id) AS rank_in_category
  FROM (SELECT product_category_name, i.product_id, count(*) AS units_sold, sum({_cents('price')}) AS price_cents
    FROM f_items AS i JOIN f_delivered AS o ON i.order_id = o.order_id
      LEFT JOIN d_products AS p ON i.product_id = p.product_id GROUP BY ALL))
WHERE rank_in_category <= 10""",
    "customer_monthly_ticket": f"""
SELECT customer_id, count(*) AS active_months, CAST(sum(n) AS BIGINT) AS total_orders,
  {_mean_money('sum(ticket)', 'count(*)')} AS avg_monthly_ticket_brl
FROM (SELECT customer_id, year, month, count(*) AS n,
    CAST({_half_up('sum(total_cents)', 'count(*)')} AS BIGINT) AS ticket
  FROM f_delivered JOIN paid USING (order_id) GROUP BY customer_id, year, month)
GROUP BY customer_id""",
    "weather_condition_revenue": f"""
SELECT weather_condition, dominant_weather, count(*) AS days,
  CAST(sum(total_orders) AS BIGINT) AS total_orders, {_money('sum(total_cents)')} AS total_revenue_brl
FROM weather_and_sales GROUP BY weather_condition, dominant_weather""",
    "price_volume_corr": f"""
SELECT product_category_name, count(*) AS products, round(corr(mean_price, n), 6) AS price_volume_corr
FROM (SELECT product_id, CAST(count(*) AS DOUBLE) AS n,
    CAST(sum({_cents('price')}) AS DOUBLE) / 100.0 / count(*) AS mean_price FROM f_items GROUP BY product_id)
  LEFT JOIN d_products USING (product_id) GROUP BY product_category_name""",
    "dq_nulls": "\nUNION ALL\n".join(
        [
            _check("weather_current", "not_null", "temp", "temp IS NULL", "raw_weather_current", 0.1),
            _check("weather_current", "not_null", "rain_1h", "rain_1h IS NULL", "raw_weather_current", 0.5),
            _check("weather_current", "not_null", "dt", "dt IS NULL", "raw_weather_current"),
        ]
    ),
    "dq_unique": "\nUNION ALL\n".join(
        [
            _unique("order_items", "order_id,order_item_id", "raw_order_items"),
            _unique("customers", "customer_id", "raw_customers"),
        ]
    ),
    "dq_range": "\nUNION ALL\n".join(
        [
            _check("order_items", "in_range", "price", "price < 0 OR price > 100000", "raw_order_items"),
            _check("weather_current", "in_range", "temp", "temp < -50 OR temp > 50", "raw_weather_current"),
            _check("weather_current", "in_range", "humidity", "humidity < 0 OR humidity > 90", "raw_weather_current"),
        ]
    ),
    "dq_allowed_values": """
SELECT * REPLACE (concat(column_name, ' (', CAST(failed AS STRING), ')') AS column_name) FROM ("""
    + "\nUNION ALL\n".join(
        [
            _check("orders", "in_set", "order_status", f"order_status NOT IN ({_STATUSES})", "raw_orders"),
            _check(
                "orders", "in_set", "order_status",
                "order_status NOT IN ('delivered', 'shipped', 'canceled')", "raw_orders",
            ),
        ]
    )
    + ")",
    "dq_silver_audit": "\nUNION ALL\n".join(
        [
            _unique("dim_customers", "customer_id", "d_customers"),
            _check("dim_customers", "not_null", "customer_id", "customer_id IS NULL", "d_customers"),
            _check("dim_customers", "not_null", "customer_unique_id", "customer_unique_id IS NULL", "d_customers"),
            _check("fact_order_items", "in_range", "price", "price < 0 OR price > 100000", "f_items"),
            _check("fact_orders", "in_set", "order_status", f"order_status NOT IN ({_STATUSES})", "f_orders"),
        ]
    ),
    "dq_expectation_suite": "\nUNION ALL\n".join(
        [
            _check(
                "orders", "columns_in_order",
                "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
                "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date",
                "false", "raw_orders",
            ),
            _check("orders", "not_null", "order_id", "order_id IS NULL", "raw_orders"),
            _check("orders", "not_null", "customer_id", "customer_id IS NULL", "raw_orders"),
            _check("orders", "in_set", "order_status", f"order_status NOT IN ({_STATUSES})", "raw_orders"),
            _check("orders", "of_type", "order_id", "false", "raw_orders"),
            _check("orders", "of_type", "order_purchase_timestamp", "true", "raw_orders"),
            _check(
                "orders", "parses_as", "order_purchase_timestamp",
                f"try_strptime(order_purchase_timestamp, {_ISO}) IS NULL", "raw_orders",
            ),
            _check("orders", "not_blank", "customer_id", "trim(customer_id) = ''", "raw_orders"),
            _check(
                "orders", "in_range", "order_purchase_timestamp",
                "order_purchase_timestamp < '1995' OR order_purchase_timestamp > '2001'", "raw_orders",
            ),
            _check(
                "orders", "not_null", "order_delivered_customer_date",
                "order_delivered_customer_date IS NULL", "raw_orders", 0.7,
            ),
            _unique("orders", "order_id", "raw_orders"),
        ]
    ),
    "bronze_file_stats": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, true AS has_files, true AS has_bytes, count(*) AS row_count FROM {t}"
        for t in SOURCE_TABLES
    ),
    "bronze_row_counts": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, {least} AS min_row_count, "
        f"count(*) >= {least} AS passed FROM raw_{name}"
        for name, least in [
            ("orders", 90000), ("order_items", 100000), ("customers", 90000), ("products", 30000),
            ("sellers", 3000), ("order_payments", 100000), ("order_reviews", 90000),
            ("geolocation", 900000), ("product_category_name_translation", 70),
            ("weather_current", 1),
        ]
    ),
    "schema_drift": _DRIFTED
    + "".join(
        f"\nUNION ALL SELECT 'weather_current', '{c}', 'added', NULL, '{t}', count({c}) FROM raw_weather_current"
        for c, t in _EXTRA_WEATHER.items()
    ),
    "bronze_validation_report": "\nUNION ALL\n".join(
        [
            *[
                f"""SELECT '{name}' AS table_name, check_name, passed, detail FROM (
  SELECT 'files_exist' AS check_name, true AS passed, CAST(NULL AS STRING) AS detail
  UNION ALL SELECT 'bytes_present', true, NULL
  UNION ALL SELECT 'row_count', count(*) >= {least}, concat(CAST(count(*) AS STRING), ' rows, minimum {least}') FROM raw_{name}
  UNION ALL SELECT 'schema_drift', {drift == 'none'}, '{drift}')"""
                for name, least, drift in [
                    ("orders", 90000, "none"),
                    ("customers", 90000, "none"),
                    ("sellers", 3000, "none"),
                    ("weather_current", 1, "; ".join(f"added {c}" for c in _EXTRA_WEATHER)),
                ]
            ],
            """SELECT 'products', check_name, false, detail FROM (
  SELECT 'files_exist' AS check_name, CAST(NULL AS STRING) AS detail
  UNION ALL SELECT 'bytes_present', NULL
  UNION ALL SELECT 'row_count', 'unreadable' UNION ALL SELECT 'schema_drift', 'unreadable')""",
        ]
    ),
    "schema_registry_diff": """
SELECT 'customers' AS table_name, 2 AS version, column_name, change, old_type, new_type, row_count
FROM (SELECT 'customer_city' AS column_name, 'removed' AS change, 'string' AS old_type, CAST(NULL AS STRING) AS new_type
  UNION ALL SELECT 'loyalty_tier', 'added', NULL, 'string'
  UNION ALL SELECT 'customer_zip_code_prefix', 'type_changed', 'string', 'int'),
  (SELECT count(*) AS row_count FROM raw_customers)""",
    "stream_file_source": f"SELECT event_id, {_shown('ts')}, user_id, event_type, value FROM events",
    "raw_stream_append": """
SELECT event_id, CASE WHEN NOT malformed THEN dt END AS dt, malformed,
  CASE WHEN malformed THEN 'notjson' END AS raw, year(ts) AS ingestion_year,
  month(ts) AS ingestion_month, day(ts) AS ingestion_day, hour(ts) AS ingestion_hour FROM messages""",
    "stream_parse_json": """
SELECT event_id, dt, dt_iso, city_name, lat, lon, temp, humidity, wind_speed, weather_main,
  weather_description, CAST(NULL AS STRING) AS ingestion_timestamp, false AS malformed,
  CAST(NULL AS STRING) AS raw FROM messages WHERE NOT malformed
UNION ALL
SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true, 'notjson'
FROM messages WHERE malformed""",
    "stream_conform": f"""
SELECT * EXCLUDE (datetime_utc, ts), {_shown('datetime_utc')} FROM conformed""",
    "stream_late_data": f"""
SELECT event_id, {_shown('ts')}, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-15'""",
    "stream_dedup": """
SELECT DISTINCT 'Patagonia' AS city_name, CAST(floor(epoch(ts)) AS BIGINT) AS unix_timestamp FROM events""",
    "lambda_union": f"""
SELECT * EXCLUDE (rn, _side, _at, datetime_utc), {_shown('datetime_utc')} FROM (
  SELECT *, row_number() OVER (PARTITION BY city_name, unix_timestamp ORDER BY {_UNIFY_ORDER}) AS rn
  FROM (
    SELECT {_UNIFIED_COLUMNS}, 'batch' AS origin, 1 AS _side, 0 AS _at FROM w_enriched
    WHERE datetime_utc < TIMESTAMP '1999-01-10'
    UNION ALL
    SELECT {_UNIFIED_COLUMNS}, 'stream', 0, 0 FROM (
      SELECT *, year(datetime_utc) AS year, month(datetime_utc) AS month FROM w_all)
    WHERE temperature_celsius IS NOT NULL)) WHERE rn = 1""",
    "lambda_unified_view": f"""
SELECT city_name, unix_timestamp, temperature_celsius, weather_category, origin, year, month FROM (
  SELECT *, row_number() OVER (PARTITION BY city_name, unix_timestamp ORDER BY {_UNIFY_ORDER}) AS rn
  FROM (
    SELECT {_UNIFIED_COLUMNS}, 'batch' AS origin, 1 AS _side, 0 AS _at FROM w_enriched
    WHERE datetime_utc < TIMESTAMP '1999-01-10'
    UNION ALL
    SELECT {_UNIFIED_COLUMNS}, 'stream', 0,
      CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END FROM conformed)) WHERE rn = 1""",
    "stream_static_enrich": """
SELECT unix_timestamp, strftime(datetime_utc, '%Y%m%d') AS date_key, temperature_celsius, total_orders
FROM conformed LEFT JOIN sales_days ON strftime(datetime_utc, '%Y%m%d') = date_key""",
    "stream_late_accounted": f"""
WITH judged AS (
  SELECT event_id, ts, event_type, ts >= TIMESTAMP '2024-01-15' AS first,
    ts < (SELECT max(ts) FROM events WHERE ts >= TIMESTAMP '2024-01-15') - INTERVAL '2' HOUR AS late
  FROM events),
account AS (
  SELECT count(*) + count(*) FILTER (WHERE first) AS rows_read,
    count(*) FILTER (WHERE first) + count(*) FILTER (WHERE NOT late) AS rows_kept,
    count(*) FILTER (WHERE late) AS rows_late
  FROM judged)
SELECT event_id, {_shown('ts')}, event_type, outcome, rows_read, rows_kept, rows_late FROM (
  SELECT event_id, ts, event_type, 'kept' AS outcome FROM judged WHERE first OR NOT late
  UNION ALL SELECT event_id, ts, event_type, 'late' FROM judged WHERE late), account""",
    "stream_enrich_versions": """
SELECT unix_timestamp, c.date_key, temperature_celsius,
  total_orders + CASE WHEN datetime_utc < TIMESTAMP '1999-01-08' THEN 0 ELSE 1000 END AS total_orders
FROM (
  SELECT unix_timestamp, datetime_utc, strftime(datetime_utc, '%Y%m%d') AS date_key, temperature_celsius,
    row_number() OVER (PARTITION BY city_name, unix_timestamp ORDER BY temperature_celsius DESC) AS rn
  FROM conformed) AS c
  LEFT JOIN sales_days AS s ON c.date_key = s.date_key
WHERE rn = 1""",
}
_TYPE_NAME = """CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint'
    WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
    WHEN 'FLOAT[]' THEN 'array<float>' ELSE lower(column_type) END"""
_BODIES["observed_schema"] = "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, position, column_name, {_TYPE_NAME} AS type, row_count, non_null
FROM (SELECT row_number() OVER () AS position, column_name, column_type FROM (DESCRIBE {t})) AS d
  JOIN (UNPIVOT (SELECT count(COLUMNS(*)) AS '\\0' FROM {t}) ON COLUMNS(*)
    INTO NAME column_name VALUE non_null) AS n USING (column_name),
  (SELECT count(*) AS row_count FROM {t}) AS r"""
    for t in SOURCE_TABLES
)
_BODIES["write_gold_roundtrip"] = _BODIES["kpi_payment_methods"]

def _used(text: str) -> list[str]:
    """CTE names that occur in a statement, dependencies first."""
    found: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in found and re.search(rf"\b{name}\b", sql):
                visit(CTES[name])
                if name not in found:
                    found.append(name)

    visit(text)
    return found


def statement(name: str) -> str:
    body = _BODIES[name]
    used = _used(body)
    if not used:
        return body.strip()
    return "WITH " + ",\n".join(f"{c} AS ({CTES[c].strip()})" for c in used) + "\n" + body.strip()


def statements() -> dict[str, str]:
    return {name: statement(name) for name in _BODIES}
