"""Raw-layer tables derived from the generic benchmark tables.

Each view is plain SQL that Spark and DuckDB read alike, so that the same raw rows feed the
Spark operators and the reference SQL of the tests. ``{name}`` stands for a source table;
``{dt_iso}`` and ``{epoch}`` for the two expressions the engines spell differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SOURCE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

VIEWS = {
    "customers": """
SELECT CAST(c_custkey AS STRING) AS customer_id,
  concat('U', CAST(c_custkey - c_custkey % 2 AS STRING)) AS customer_unique_id,
  lpad(CAST(c_custkey % 1000 AS STRING), 5, '0') AS customer_zip_code_prefix,
  CASE WHEN c_custkey % 7 = 0 THEN '   ' ELSE concat('  ', c_mktsegment, ' ') END AS customer_city,
  concat('NATION_', CAST(c_nationkey AS STRING)) AS customer_state,
  '2001-12-31T00:00:00.000Z' AS updated_at
FROM {customer}""",
    "products": """
SELECT CAST(p_partkey AS STRING) AS product_id, p_type AS product_category_name,
  CAST(length(p_name) AS BIGINT) AS product_name_length,
  CAST(length(p_brand) * 10 AS BIGINT) AS product_description_length,
  CAST(p_size % 6 AS BIGINT) AS product_photos_qty,
  CAST(p_size * 100 AS BIGINT) AS product_weight_g,
  CAST(p_size + 10 AS BIGINT) AS product_length_cm,
  CAST(p_size % 20 + 2 AS BIGINT) AS product_height_cm,
  CAST(p_size % 30 + 5 AS BIGINT) AS product_width_cm,
  '2001-12-31T00:00:00.000Z' AS updated_at
FROM {part}""",
    "product_category_name_translation": """
SELECT DISTINCT p_type AS product_category_name,
  concat(lower(p_type), '_en') AS product_category_name_english
FROM {part} WHERE p_type <> 'PROMO'""",
    "sellers": """
SELECT CAST(s_suppkey AS STRING) AS seller_id,
  lpad(CAST(s_suppkey % 1000 AS STRING), 5, '0') AS seller_zip_code_prefix,
  n_name AS seller_city, r_name AS seller_state, '2001-12-31T00:00:00.000Z' AS updated_at
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
  JOIN {region} ON n_regionkey = r_regionkey""",
    "geolocation": """
SELECT lpad(CAST(c_custkey % 1000 AS STRING), 5, '0') AS geolocation_zip_code_prefix,
  -10.0e0 - c_nationkey + (c_custkey % 10) / 16.0e0 AS geolocation_lat,
  -40.0e0 - c_nationkey - (c_custkey % 10) / 16.0e0 AS geolocation_lng,
  c_mktsegment AS geolocation_city, concat('NATION_', CAST(c_nationkey AS STRING)) AS geolocation_state
FROM {customer}""",
    # Urgent orders were delivered twice: once when created, and once more later.
    "orders": """
SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
  concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T', lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), ':30:00.000Z') AS order_purchase_timestamp,
  concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T', lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), ':45:00.000Z') AS order_approved_at,
  CASE WHEN o_orderstatus <> 'P' THEN concat(CAST(CAST(o_orderdate + INTERVAL '1' DAY AS DATE) AS STRING), 'T09:00:00.000Z') END AS order_delivered_carrier_date,
  CASE WHEN o_orderstatus = 'F' THEN concat(CAST(CAST(o_orderdate + (o_orderkey % 20) * INTERVAL '1' DAY AS DATE) AS STRING), 'T12:00:00.000Z') END AS order_delivered_customer_date,
  concat(CAST(CAST(o_orderdate + INTERVAL '10' DAY AS DATE) AS STRING), 'T00:00:00.000Z') AS order_estimated_delivery_date,
  concat(CAST(CAST(o_orderdate + INTERVAL '20' DAY AS DATE) AS STRING), 'T00:00:00.000Z') AS updated_at
FROM {orders}
UNION ALL
SELECT CAST(o_orderkey AS STRING), CAST(o_custkey AS STRING), 'created',
  concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T', lpad(CAST(o_orderkey % 24 AS STRING), 2, '0'), ':30:00.000Z'),
  CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING),
  concat(CAST(CAST(o_orderdate + INTERVAL '10' DAY AS DATE) AS STRING), 'T00:00:00.000Z'),
  concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T00:00:00.000Z')
FROM {orders} WHERE o_orderpriority = '1-URGENT'""",
    "order_items": """
SELECT CAST(l_orderkey AS STRING) AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
  CAST(l_partkey AS STRING) AS product_id, CAST(l_suppkey AS STRING) AS seller_id,
  concat(CAST(CAST(l_shipdate AS DATE) AS STRING), 'T00:00:00.000Z') AS shipping_limit_date,
  CASE WHEN l_orderkey % 97 = 0 THEN -1.0e0 ELSE floor(l_extendedprice / 2) / 100 END AS price,
  CASE WHEN l_tax = 0 THEN NULL ELSE floor(l_extendedprice * l_tax / 2) / 100 END AS freight_value,
  concat(CAST(CAST(l_shipdate AS DATE) AS STRING), 'T00:00:00.000Z') AS updated_at
FROM {lineitem}""",
    "order_payments": """
SELECT CAST(l_orderkey AS STRING) AS order_id, CAST(l_linenumber AS BIGINT) AS payment_sequential,
  CASE l_returnflag WHEN 'A' THEN 'boleto' WHEN 'R' THEN 'voucher' ELSE 'credit_card' END AS payment_type,
  CAST(floor(l_quantity) AS BIGINT) % 12 + 1 AS payment_installments,
  floor(l_extendedprice * (1 - l_discount) / 2) / 100 AS payment_value,
  concat(CAST(CAST(l_shipdate AS DATE) AS STRING), 'T00:00:00.000Z') AS updated_at
FROM {lineitem}""",
    "order_reviews": """
SELECT CAST(doc_id AS STRING) AS review_id, CAST(doc_id * 3 AS STRING) AS order_id,
  CAST(doc_id % 7 AS BIGINT) AS review_score, lang AS review_comment_title,
  text AS review_comment_message,
  concat('2001-', lpad(CAST(doc_id % 12 + 1 AS STRING), 2, '0'), '-01T00:00:00.000Z') AS review_creation_date,
  concat('2001-', lpad(CAST(doc_id % 12 + 1 AS STRING), 2, '0'), '-03T00:00:00.000Z') AS review_answer_timestamp,
  '2001-12-31T00:00:00.000Z' AS updated_at
FROM {documents}""",
    # Events moved back 25 years, into the range of the orders.
    "weather_current": """
SELECT event_id, {epoch} AS dt, {dt_iso} AS dt_iso, city_name, lat, lon, temp,
  temp - 1.5e0 AS feels_like, temp - 2 AS temp_min, temp + 2 AS temp_max, pressure,
  humidity, wind_speed, rain_1h, weather_main, lower(weather_main) AS weather_description
FROM (
  SELECT CAST(event_id AS BIGINT) AS event_id, ts - INTERVAL '300' MONTH AS event_ts,
    'Patagonia' AS city_name, -41.81e0 AS lat, -68.91e0 AS lon,
    CASE WHEN user_id % 17 = 0 THEN NULL ELSE floor(value * 10) / 120 - 5 END AS temp,
    1000.0e0 + user_id % 30 AS pressure, CAST(user_id % 100 AS BIGINT) AS humidity,
    floor(value) / 50 AS wind_speed,
    CASE WHEN event_type = 'error' THEN floor(value) / 100 END AS rain_1h,
    CASE event_type WHEN 'error' THEN 'Rain' WHEN 'click' THEN 'Clouds' WHEN 'view' THEN 'Clear'
      WHEN 'signup' THEN 'Mist' ELSE 'Snow' END AS weather_main
  FROM {events}
) AS e""",
}

SPARK_EXPR = {
    "epoch": "unix_timestamp(CAST(event_ts AS TIMESTAMP))",
    "dt_iso": "concat(date_format(event_ts, 'yyyy-MM-dd HH:mm:ss'), ' +0000 UTC')",
}
DUCKDB_EXPR = {
    "epoch": "CAST(floor(epoch(event_ts)) AS BIGINT)",
    "dt_iso": "concat(strftime(event_ts, '%Y-%m-%d %H:%M:%S'), ' +0000 UTC')",
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_schemas: dict[str, T.StructType] = {}


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table; its footer is read for the schema once per process."""
    path = table_path(sf_dir, name)
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def raw_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw table over the Parquet tables in ``sf_dir``."""
    text = VIEWS[name]
    for placeholder, expression in SPARK_EXPR.items():
        text = text.replace("{" + placeholder + "}", expression)
    used = [t for t in SOURCE_TABLES if "{" + t + "}" in text]
    return spark.sql(text, **{t: source_table(spark, sf_dir, t) for t in used})


def duckdb_view(name: str) -> str:
    """The same raw table as SQL text over views named like the tables."""
    return VIEWS[name].format(**{t: t for t in SOURCE_TABLES}, **DUCKDB_EXPR)
