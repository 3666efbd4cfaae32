"""The KPI views, the quality summary and the 2024 orders as SQL text, for views that outlive the session.

Each text says what the operator of the same name does in DataFrame form, in the same steps: group
first, join after, ranks by bands, hot keys apart. A view names its tables in full.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillstar.functions import domains, money
from tillstar.operators import quality, ranking, skew
from tillstar.sinks.warehouse import require_tables

FACT, CALENDAR = "core.fact_sales", "core.dim_calendar"
CUSTOMERS, PRODUCTS = "core.dim_customer", "core.dim_product"


def _total(column: str) -> str:
    return f"CAST(sum({column}) AS {money.TOTAL})"


def _ratio(num: str, den: str, times: int = 1) -> str:
    """money.ratio: whole hundredths, rounded once, half away from zero."""
    n, d = f"CAST({num} AS {money.TOTAL})", f"nullif(CAST({den} AS {money.TOTAL}), 0)"
    sign = f"if(({n} < 0) != ({d} < 0), -1, 1)"
    hundredths = f"((abs({n}) * {200 * times} + abs({d})) DIV (abs({d}) * 2)) * {sign}"
    return f"CAST(CAST({hundredths} AS DECIMAL(20,0)) * 0.01BD AS {money.RATIO})"


def _ratio_or_zero(num: str, den: str) -> str:
    return f"coalesce({_ratio(num, den)}, CAST(0 AS {money.RATIO}))"


def _shares(groups: str, label: str, *more: str) -> str:
    """Rows of a grouping with their share of revenue; the total is a subquery of one value."""
    columns = ", ".join([label, "orders", "revenue", *more])
    total = "(SELECT struct(sum(orders) AS orders, sum(revenue) AS revenue) FROM g)"
    share = _ratio("revenue", f"{total}.revenue", 100)
    return f"WITH g AS ({groups}) SELECT {columns}, {share} AS revenue_share_pct FROM g"


_SUMS = f"count(*) AS orders, {_total('net_revenue')} AS revenue"
_REGION = "coalesce(region, 'Unknown')"
_METHOD = "coalesce(payment_method, 'other')"

_HEADLINE = f"""
WITH parts AS (
  SELECT bitmap_bucket_number(customer_id) AS part,
    bitmap_count(bitmap_construct_agg(bitmap_bit_position(customer_id))) AS customers, count(*) AS orders,
    {_total("net_revenue")} AS net_revenue, min(order_date) AS min_date, max(order_date) AS max_date
  FROM {FACT} GROUP BY 1
),
products AS (SELECT product_id FROM {FACT} GROUP BY product_id),
sums AS (
  SELECT coalesce(sum(orders), 0) AS orders, CAST(coalesce(sum(customers), 0) AS BIGINT) AS customers,
    coalesce({_total("net_revenue")}, CAST(0 AS {money.TOTAL})) AS net_revenue, min(min_date) AS min_date, max(max_date) AS max_date
  FROM parts
)
SELECT orders, customers, (SELECT count(product_id) FROM products) AS products, net_revenue,
  {_ratio_or_zero("net_revenue", "orders")} AS aov, min_date, max_date
FROM sums"""

_ABOVE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
_LTV = f"""
WITH totals AS (
  SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
    count(*) AS orders_count, {_total("net_revenue")} AS ltv
  FROM {FACT} GROUP BY customer_id
),
ranked AS (
  SELECT t.*, c.region, c.payment_method FROM totals t LEFT JOIN {CUSTOMERS} c USING (customer_id)
),
used AS (SELECT ltv FROM totals WHERE orders_count > 0 OR first_order_date <= last_order_date),
held AS (
  SELECT ltv, ties, coalesce(CAST(floor(ltv * {ranking.BAND}BD) AS BIGINT), 0) AS band
  FROM (SELECT ltv, count(*) AS ties FROM used WHERE ltv IS NOT NULL GROUP BY ltv)
),
bands AS (
  SELECT band, count(*) AS n, band - coalesce(pmod(band, {ranking.ZONE}), 0) AS zone FROM held GROUP BY band
),
zones AS (
  SELECT zone, coalesce(sum(n) OVER (ORDER BY zone DESC {_ABOVE} AS zones_above
  FROM (SELECT zone, sum(n) AS n FROM bands GROUP BY zone)
),
offsets AS (
  SELECT band, bands_above + zones_above AS above FROM (
    SELECT band, zone, coalesce(sum(n) OVER (PARTITION BY zone ORDER BY band DESC {_ABOVE} AS bands_above FROM bands
  ) JOIN zones USING (zone)
),
places AS (
  SELECT ltv, ties, CAST(place + above AS BIGINT) AS ltv_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY band ORDER BY ltv DESC) AS place FROM held
  ) JOIN offsets USING (band)
),
heavy AS (
  SELECT ltv, struct(ltv_rank) AS heavy FROM places WHERE ties * {skew.HOT_SHARE} > (SELECT count(ltv) FROM totals)
),
light AS (
  SELECT ltv, struct(ltv_rank) AS light, CAST(0 AS BIGINT) AS salt FROM places
  WHERE NOT ties * {skew.HOT_SHARE} > (SELECT count(ltv) FROM totals)
),
spread AS (
  SELECT /*+ BROADCAST(heavy) */ ranked.*, heavy,
    coalesce(CASE WHEN heavy IS NOT NULL OR ltv IS NULL THEN xxhash64(customer_id) | 1 END, 0) AS salt
  FROM ranked LEFT JOIN heavy USING (ltv)
)
SELECT customer_id, region, payment_method, first_order_date, last_order_date, orders_count, ltv,
  coalesce(heavy, light).ltv_rank AS ltv_rank
FROM spread LEFT JOIN light USING (ltv, salt)"""

_BY_CATEGORY = f"""
SELECT product_category, sum(orders) AS orders, {_total("revenue")} AS revenue
FROM (SELECT product_id, {_SUMS} FROM {FACT} GROUP BY product_id) JOIN {PRODUCTS} USING (product_id)
GROUP BY product_category"""

_SEASONS = f"""
SELECT year, month, month_name, quarter, season_uk, orders, revenue, {_ratio("revenue", "valued")} AS avg_order_value
FROM (
  SELECT year, month, month_name, quarter, season_uk, sum(orders) AS orders, {_total("revenue")} AS revenue, sum(valued) AS valued
  FROM (
    SELECT order_date AS date, count(order_id) AS orders, count(net_revenue) AS valued, {_total("net_revenue")} AS revenue
    FROM {FACT} GROUP BY order_date
  ) JOIN {CALENDAR} USING (date)
  GROUP BY year, month, month_name, quarter, season_uk
)"""

# {columns} are all of the fact's: each is used in both uses of the salted lines, which so share
# one shuffle
_NEW_REPEAT = f"""
WITH salted AS (
  SELECT /*+ REPARTITION(customer_id, _salt) */ * FROM (
    SELECT {{columns}}, coalesce(CAST(pmod(xxhash64(order_id, product_id, order_date), {skew.SALTS}) AS INT), 0) AS _salt
    FROM {FACT} WHERE customer_id IS NOT NULL
  )
),
per_salt AS (
  SELECT customer_id, _salt, min(CASE WHEN xxhash64({{columns}}) >= -9223372036854775808 THEN order_date END) AS least
  FROM salted GROUP BY customer_id, _salt
),
back AS (
  SELECT customer_id, first_purchase_date, explode(salts) AS _salt
  FROM (SELECT customer_id, min(least) AS first_purchase_date, collect_list(_salt) AS salts FROM per_salt GROUP BY customer_id)
)
SELECT {{columns}}, CASE WHEN order_date = first_purchase_date THEN 'new' ELSE 'repeat' END AS customer_order_type
FROM salted JOIN back USING (customer_id, _salt)"""

_WINDOWS = f"""
SELECT *, days_to_second <= 30 AS repeat_30d, days_to_second <= 60 AS repeat_60d, days_to_second <= 90 AS repeat_90d
FROM (
  SELECT *, date_diff(second_order_date, first_order_date) AS days_to_second FROM (
    SELECT customer_id, min(CASE WHEN place = 1 THEN order_date END) AS first_order_date,
      min(CASE WHEN place = 2 THEN order_date END) AS second_order_date
    FROM (
      SELECT customer_id, order_date, row_number() OVER (PARTITION BY customer_id ORDER BY order_date NULLS LAST) AS place
      FROM {FACT}
    ) WHERE place <= 2 GROUP BY customer_id
  )
)"""

def _rows_of(metrics: dict[str, str]) -> str:
    """One row of named numbers as rows of (metric, number)."""
    return ", ".join(f"'{name}', CAST({number} AS BIGINT)" for name, number in metrics.items())


_PLAIN = [t for t in quality.COUNTED_TABLES if t.startswith("raw.")] + ["stg.stg_customers", CALENDAR]
_KEYED = {CUSTOMERS: "customer_id", PRODUCTS: "product_id"}


def _one_table(table: str) -> str:
    """The checks that need one table only, from one read of it."""
    metrics, source = {quality.COUNTED_TABLES[table]: "count(*)"}, table
    if table in _KEYED:
        metrics = {quality.COUNTED_TABLES[table]: "coalesce(sum(n), 0)"}
        metrics[quality.DUPLICATES[table][1]] = "count_if(n > 1)"
        source = f"(SELECT count(*) AS n FROM {table} GROUP BY {_KEYED[table]})"
    if table == "stg.stg_orders":
        kinds = ", ".join(f"'{kind}'" for kind in domains.INTERACTIONS)
        metrics[quality.BAD_INTERACTIONS] = f"count_if(interaction_type IS NULL OR interaction_type NOT IN ({kinds}))"
    if table == "stg.stg_products":
        metrics[quality.BAD_PRICES] = "count_if(selling_price IS NULL OR selling_price <= 0)"
    return f"SELECT stack({len(metrics)}, {_rows_of(metrics)}) AS (metric, number) FROM {source}"


_FACT_METRICS = {
    quality.DUPLICATES[FACT][1]: "count_if(kind = 'order' AND n > 1)",
    quality.ORPHAN_CUSTOMERS: "coalesce(sum(CASE WHEN kind = 'customer' AND listed IS NULL THEN n END), 0)",
    quality.ORPHAN_PRODUCTS: "coalesce(sum(CASE WHEN kind = 'product' AND listed IS NULL THEN n END), 0)",
    quality.ORPHAN_DAYS: "coalesce(sum(CASE WHEN kind = 'day' AND listed IS NULL THEN n END), 0)",
    quality.DATES_OUTSIDE: "coalesce(sum(CASE WHEN kind = 'day' AND (try_cast(key AS DATE) < span.lo OR try_cast(key AS DATE) > span.hi) THEN n END), 0)",
    quality.NEGATIVE_REVENUE: "coalesce(sum(CASE WHEN kind = 'day' THEN negative END), 0)",
    quality.COUNTED_TABLES[FACT]: "coalesce(sum(CASE WHEN kind = 'day' THEN n END), 0)",
}
_QUALITY = f"""
WITH per_key AS (
  SELECT kind, key, count(*) AS n, sum(negative) AS negative FROM (
    SELECT inline(array(
      struct('order' AS kind, CAST(order_id AS STRING) AS key, 0 AS negative),
      struct('customer' AS kind, CAST(customer_id AS STRING) AS key, 0 AS negative),
      struct('product' AS kind, CAST(product_id AS STRING) AS key, 0 AS negative),
      struct('day' AS kind, CAST(order_date AS STRING) AS key, CAST(net_revenue < 0 AS INT) AS negative)))
    FROM {FACT}
  ) GROUP BY kind, key
),
listed AS (
  SELECT DISTINCT 'customer' AS kind, CAST(customer_id AS STRING) AS key, true AS listed FROM {CUSTOMERS} WHERE customer_id IS NOT NULL
  UNION ALL SELECT DISTINCT 'product', CAST(product_id AS STRING), true FROM {PRODUCTS} WHERE product_id IS NOT NULL
  UNION ALL SELECT DISTINCT 'day', CAST(date AS STRING), true FROM {CALENDAR} WHERE date IS NOT NULL
),
judged AS (
  SELECT *, (SELECT struct(min(date) AS lo, max(date) AS hi) FROM {CALENDAR}) AS span FROM per_key LEFT JOIN listed USING (kind, key)
),
numbers AS (
  {" UNION ALL ".join(_one_table(t) for t in [*_PLAIN, "stg.stg_orders", "stg.stg_products", CUSTOMERS, PRODUCTS])}
  UNION ALL SELECT stack({len(_FACT_METRICS)}, {_rows_of(_FACT_METRICS)}) AS (metric, number) FROM judged
)
SELECT metric, CAST(number AS STRING) AS value, if(startswith(metric, 'rows_'), number > 0, number = 0) AS pass
FROM numbers ORDER BY metric"""

VIEWS = {
    "core.v_kpi_headline": _HEADLINE,
    "core.v_top_customers_ltv": _LTV,
    "core.v_sales_by_category": _shares(_BY_CATEGORY, "product_category"),
    "core.v_sales_by_region": _shares(
        f"SELECT {_REGION} AS region, {_SUMS} FROM {FACT} GROUP BY 1", "region"
    ),
    "core.v_seasonality_monthly": _SEASONS,
    "core.v_payment_mix": _shares(
        f"SELECT {_METHOD} AS payment_method, {_SUMS} FROM {FACT} GROUP BY 1",
        "payment_method",
        f"{_ratio_or_zero('revenue', 'orders')} AS aov",
    ),
    "core.v_customer_first_purchase": f"SELECT customer_id, min(order_date) AS first_purchase_date FROM {FACT} GROUP BY customer_id",
    "core.v_order_new_repeat": _NEW_REPEAT,
    "core.v_customer_repeat_windows": _WINDOWS,
    "core.v_dq_summary": _QUALITY,
    "stg.v_stg_orders_2024": "SELECT * FROM stg.stg_orders WHERE in_2024 = 1",
}
_TABLES = {
    "core.v_dq_summary": list(quality.COUNTED_TABLES),
    "stg.v_stg_orders_2024": ["stg.stg_orders"],
}
_CORE = [FACT, CALENDAR, CUSTOMERS, PRODUCTS]


def create_views(spark: SparkSession, names=None) -> list[str]:
    """Create or replace the views in the catalog, where any session of it can read them.

    How long they live is up to the catalog: a metastore keeps them, Spark's own in-memory one
    has them until the application ends. The tables must be there.
    """
    names = list(VIEWS if names is None else names)
    for name in names:
        require_tables(spark, _TABLES.get(name, _CORE))
        columns = ", ".join(spark.table(FACT).columns) if "{columns}" in VIEWS[name] else ""
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {VIEWS[name].replace('{columns}', columns)}")
    return names
