"""The given Parquet tables as inputs of this package.

The SQL runs in Spark and in DuckDB; {names} stand for the tables. The raw texts come
out messy on purpose: padded ids, mixed case, junk prices, impossible dates, numbers that don't
fit. What is planted is a share of the keys, and unknown ids lie beyond the largest known one,
so the shares are the same at every size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillstar import schemas
from tillstar.operators import model

CUSTOMERS_RAW = """
SELECT
  CASE WHEN c_custkey % 109 = 108 THEN '99999999999' WHEN c_custkey % 101 = 100 THEN 'C-' || CAST(c_custkey AS STRING) ELSE ' ' || CAST(c_custkey AS STRING) || ' ' END AS customer_id,
  CASE WHEN c_custkey % 53 = 52 THEN 'n.a.' WHEN c_custkey % 61 = 60 THEN '30000000000' ELSE CAST(c_custkey % 120 AS STRING) END AS age,
  CASE c_custkey % 7 WHEN 0 THEN 'Male' WHEN 1 THEN ' female ' WHEN 2 THEN 'F' WHEN 3 THEN 'N/A' WHEN 4 THEN '' WHEN 5 THEN 'Nonbinary' ELSE 'm' END AS gender,
  CASE c_nationkey % 8 WHEN 0 THEN 'kentucky' WHEN 1 THEN ' New York ' WHEN 2 THEN 'OREGON' WHEN 3 THEN 'ohio' WHEN 4 THEN 'district of columbia' WHEN 5 THEN '' WHEN 6 THEN 'stratford-on-avon' ELSE 'texas' END AS location,
  CASE c_custkey % 8 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'debit card' WHEN 2 THEN 'PayPal' WHEN 3 THEN 'Bank Transfer' WHEN 4 THEN 'VENMO' WHEN 5 THEN ' cash ' WHEN 6 THEN 'Gift' ELSE '' END AS payment_method,
  CASE c_custkey % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'n' WHEN 2 THEN 'TRUE' WHEN 3 THEN '0' WHEN 4 THEN 'maybe' ELSE '' END AS subscription_status,
  CASE WHEN c_custkey % 50 = 49 THEN 'many' ELSE CAST(c_custkey % 40 AS STRING) END AS previous_purchases
FROM {customer}
"""

PRODUCTS_RAW = """
SELECT
  CASE WHEN p_partkey % 103 = 102 THEN '  ' ELSE CAST(p_partkey AS STRING) END AS product_id,
  ' ' || p_name || ' ' AS product_name,
  CASE p_partkey % 5 WHEN 0 THEN p_type || ' | ' || p_brand WHEN 1 THEN p_type || ' > ' || p_brand WHEN 2 THEN '' WHEN 3 THEN '| ' || p_brand ELSE p_type END AS product_category,
  CASE WHEN p_partkey % 107 = 106 THEN '$123456789.00' ELSE CASE p_partkey % 11
    WHEN 0 THEN '$' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING)
    WHEN 1 THEN 'Total price: $ ' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING)
    WHEN 2 THEN CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) || '249.99'
    WHEN 3 THEN '$' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) || ' - $999.99'
    WHEN 4 THEN '$1,' || lpad(CAST(p_partkey % 1000 AS STRING), 3, '0') || '.50'
    WHEN 5 THEN '$1,234' WHEN 6 THEN '' WHEN 7 THEN 'N/A' WHEN 8 THEN '0.00' WHEN 9 THEN '-5.00'
    ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) END END AS selling_price,
  p_brand AS brand_name,
  CASE WHEN p_size % 10 = 0 THEN '' ELSE CAST(p_size AS STRING) END AS model_number,
  'img/' || CAST(p_partkey AS STRING) AS image_url,
  'item/' || CAST(p_partkey AS STRING) AS product_url,
  CASE p_partkey % 5 WHEN 0 THEN 'y' WHEN 1 THEN 'N' WHEN 2 THEN 'true' WHEN 3 THEN '0' ELSE '?' END AS is_amazon_seller
FROM {part}
"""

ORDERS_RAW = """
SELECT
  CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN 'x' || CAST(user_id AS STRING)
       WHEN event_id % 101 = 0 THEN '4000000000'
       WHEN event_id % 83 = 0 THEN CAST((SELECT max(c_custkey) FROM {customer}) + 1 + user_id % 1000 AS STRING)
       ELSE ' ' || CAST(user_id AS STRING) || ' ' END AS user_id,
  CASE WHEN event_id % 79 = 0 THEN ' '
       WHEN event_id % 47 = 0 THEN CAST((SELECT max(p_partkey) FROM {part}) + 1 + event_id % 100 AS STRING)
       ELSE CAST(event_id % (SELECT max(p_partkey) FROM {part}) AS STRING) END AS product_id,
  CASE WHEN event_id % 3 = 0 THEN upper(event_type) ELSE ' ' || event_type END AS interaction_type,
  CASE WHEN event_id % 73 = 0 THEN '' WHEN event_id % 71 = 0 THEN '31/02/2023 8:00'
       WHEN event_id % 67 = 0 THEN day_text || ' ' || hour_text || ':' || minute_text || ':59 (till 7)'
       WHEN event_id % 59 = 0 THEN day_text
       WHEN event_id % 43 = 0 THEN replace(day_text, '/', '-') || '  ' || hour_text
       WHEN event_id % 41 = 0 THEN day_text || ' at noon'
       ELSE day_text || ' ' || hour_text || ':' || minute_text END AS event_ts
FROM (
  SELECT *, CAST(day(d) AS STRING) || '/' || CAST(month(d) AS STRING) || '/' || CAST(year(d) AS STRING) AS day_text,
    CAST(hour(ts) AS STRING) AS hour_text, lpad(CAST(minute(ts) AS STRING), 2, '0') AS minute_text
  FROM (
    SELECT event_id, user_id, event_type, ts, CAST(ts AS DATE) - CAST(CASE WHEN event_id % 4 = 0 THEN 0 ELSE event_id % 500 END AS INT) AS d
    FROM {events}
  ) e
) e
"""

# Customers meet the orders first and the lines after that: so the lines, the largest
# rows by far, are shuffled for two joins and not for three.
FACT = """
SELECT
  md5(concat_ws('::', CAST(b.customer_id AS STRING), CAST(l.l_partkey AS STRING), CAST(b.order_date AS STRING))) AS order_id,
  b.order_date, b.customer_id, l.l_partkey AS product_id, 1 AS quantity,
  CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price,
  CAST(p.p_retailprice AS DECIMAL(12,2)) AS gross_item_value,
  CAST(0 AS DECIMAL(10,2)) AS discount_amount, CAST(0 AS DECIMAL(10,2)) AS tax_amount, CAST(0 AS DECIMAL(10,2)) AS shipping_fee,
  CAST(p.p_retailprice AS DECIMAL(12,2)) AS net_revenue,
  b.region, b.payment_method
FROM {lineitem} l JOIN (
  SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS order_date, o.o_custkey AS customer_id, r.r_name AS region, lower(c.c_mktsegment) AS payment_method
  FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey JOIN {nation} n ON n.n_nationkey = c.c_nationkey JOIN {region} r ON r.r_regionkey = n.n_regionkey
) b ON b.o_orderkey = l.l_orderkey JOIN {part} p ON p.p_partkey = l.l_partkey
"""

FACT_CUSTOMERS = """
SELECT c.c_custkey AS customer_id, r.r_name AS region, lower(c.c_mktsegment) AS payment_method
FROM {customer} c JOIN {nation} n ON n.n_nationkey = c.c_nationkey JOIN {region} r ON r.r_regionkey = n.n_regionkey
"""

FACT_PRODUCTS = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS product_category, CAST(p_retailprice AS DECIMAL(10,2)) AS selling_price
FROM {part}
"""

TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")

_schemas: dict[tuple[str, str], T.StructType] = {}


def _table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; its footer is looked up once per application."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = {t: _table(spark, f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in sql}
    return spark.sql(sql, **used)


_RAW = {
    "raw.customers_raw": CUSTOMERS_RAW,
    "raw.products_raw": PRODUCTS_RAW,
    "raw.orders_raw": ORDERS_RAW,
}
_EXTRACTS = {
    "raw.customers_raw": schemas.CUSTOMER_COLUMNS,
    "raw.products_raw": schemas.PRODUCT_COLUMNS,
    "raw.orders_raw": schemas.ORDER_COLUMNS,
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Messy customers, products or events under their short names."""
    return run(spark, sf_dir, _RAW[name])


def raw_extract(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw table with all columns of its extract, in order and with its headers."""
    df = raw_table(spark, sf_dir, name)
    return df.selectExpr(
        *[
            f"{short if short in df.columns else 'CAST(NULL AS STRING)'} AS `{header}`"
            for header, short in _EXTRACTS[name].items()
        ]
    )


def sales_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Line items as a clean, large fact, or one of its dimensions."""
    if name == "core.dim_calendar":
        days = "SELECT CAST(o_orderdate AS DATE) AS event_date FROM {orders}"
        return model.dim_calendar(run(spark, sf_dir, days))
    sql = {
        "core.fact_sales": FACT,
        "core.dim_customer": FACT_CUSTOMERS,
        "core.dim_product": FACT_PRODUCTS,
    }
    return run(spark, sf_dir, sql[name])
