"""The same answers in DuckDB SQL over the given tables, to check the queries by.

Money is compared in whole cents with integer arithmetic, so no rounding can differ.
"""

from __future__ import annotations

from tillstar.functions.clock import EVENT_PATTERN
from tillstar.functions.money import PRICE_PATTERN
from tillstar.sources import driver_tables
from tillstar.sources.regions import region_values

_BARE = {t: t for t in driver_tables.TABLES}

_STAGING = r"""
WITH customers_raw AS (%(customers)s),
products_raw AS (%(products)s),
orders_raw AS (%(orders)s),
dim_region(state_name, region) AS (VALUES %(regions)s),
customer_text AS (
  SELECT trim(customer_id) AS id, trim(age) AS age, lower(trim(gender)) AS sex,
    regexp_extract_all(lower(trim(location)), '[\p{L}\p{N}]+|[^\p{L}\p{N}]+') AS place,
    lower(trim(payment_method)) AS pay, lower(trim(subscription_status)) AS sub,
    trim(previous_purchases) AS prev
  FROM customers_raw
),
stg_customers AS (
  SELECT try_cast(id AS INTEGER) AS customer_id,
    CASE WHEN try_cast(age AS INTEGER) BETWEEN 13 AND 100 THEN CAST(age AS INTEGER) END AS age,
    CASE left(sex, 1) WHEN 'm' THEN 'male' WHEN 'f' THEN 'female'
      ELSE if(sex IN ('', 'na', 'n/a', 'unknown'), 'unknown', 'other') END AS gender,
    coalesce(nullif(array_to_string(
      list_transform(place, lambda w: upper(w[1]) || w[2:]), ''), ''), 'Unknown') AS location,
    coalesce(map {'credit': 'credit_card', 'debit': 'debit_card', 'paypal': 'paypal',
      'bank': 'bank_transfer', 'venmo': 'venmo', 'cash': 'cash'}[
      regexp_extract(pay, 'credit|debit|paypal|bank|venmo|cash')], 'other') AS payment_method,
    map {'yes': 'yes', 'y': 'yes', 'true': 'yes', '1': 'yes',
      'no': 'no', 'n': 'no', 'false': 'no', '0': 'no'}[sub] AS subscription_status,
    try_cast(prev AS INTEGER) AS previous_purchases
  FROM customer_text
  WHERE regexp_full_match(id, '[0-9]+') AND try_cast(id AS INTEGER) IS NOT NULL
),
stg_products AS (
  SELECT trim(product_id) AS product_id, trim(product_name) AS product_name,
    coalesce(nullif(trim(regexp_extract(product_category, '^[^|>]*')), ''), 'Other') AS product_category,
    try_cast(replace(nullif(regexp_extract(selling_price, '%(price)s', 1), ''), ',', '')
      AS DECIMAL(10,2)) AS selling_price,
    nullif(trim(brand_name), '') AS brand_name, nullif(trim(model_number), '') AS model_number,
    trim(image_url) AS image_url, trim(product_url) AS product_url,
    map {'Y': 'Y', 'YES': 'Y', 'TRUE': 'Y', '1': 'Y',
      'N': 'N', 'NO': 'N', 'FALSE': 'N', '0': 'N'}[upper(trim(is_amazon_seller))] AS is_amazon_seller
  FROM products_raw
  WHERE trim(product_id) <> ''
),
order_text AS (
  SELECT trim(user_id) AS id, trim(product_id) AS product_id, lower(trim(interaction_type)) AS interaction_type,
    trim(event_ts) AS said, regexp_extract(trim(event_ts), '%(time)s', ['d', 'm', 'y', 'h', 'i'], 's') AS t
  FROM orders_raw
),
order_typed AS (
  SELECT *, CASE WHEN regexp_full_match(id, '[0-9]+') THEN try_cast(id AS INTEGER) END AS user_id,
    try_strptime(concat_ws(' ', t.d, t.m, t.y, if(t.h = '', '0', t.h), if(t.i = '', '0', t.i)), '%%d %%m %%Y %%H %%M') AS wall
  FROM order_text
),
stg_orders AS (
  SELECT user_id, product_id, interaction_type,
    timezone('UTC', timezone('Europe/London', wall)) AS event_ts,
    CAST(timezone('Europe/London', timezone('Europe/London', wall)) AS DATE) AS event_date,
    CAST(year(wall) = 2024 AS INTEGER) AS in_2024
  FROM order_typed
  WHERE user_id IS NOT NULL AND product_id <> '' AND wall IS NOT NULL
    AND interaction_type IN ('purchase', 'view', 'like')
),
orders_2024 AS (SELECT * FROM stg_orders WHERE in_2024 = 1),
bad_price AS (SELECT * FROM stg_products WHERE coalesce(selling_price, 0) <= 0),
orphans_products AS (
  SELECT * FROM orders_2024 o WHERE interaction_type = 'purchase'
    AND NOT EXISTS (FROM stg_products p WHERE p.product_id = o.product_id)
),
orphans_customers AS (
  SELECT * FROM orders_2024 o WHERE interaction_type = 'purchase'
    AND NOT EXISTS (FROM stg_customers c WHERE c.customer_id = o.user_id)
),
dim_calendar AS (
  SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
    strftime(d, '%%b') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter,
    CAST(week(d) AS INTEGER) AS week_of_year,
    ['Winter', 'Spring', 'Summer', 'Autumn'][1 + (month(d) %% 12) // 3] AS season_uk
  FROM (SELECT unnest(generate_series(
    date_trunc('year', min(event_date)), date_trunc('year', max(event_date)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
    INTERVAL 1 DAY)) AS d FROM stg_orders)
),
dim_product AS (
  SELECT product_id, product_name, product_category, selling_price
  FROM stg_products WHERE selling_price > 0
),
dim_customer AS (
  SELECT c.customer_id, gender, location, coalesce(region, 'Unknown') AS region, payment_method,
    subscription_status,
    (SELECT min(event_date) FROM stg_orders o
      WHERE o.user_id = c.customer_id AND o.interaction_type = 'purchase') AS first_seen_date
  FROM stg_customers c LEFT JOIN dim_region ON state_name = location
),
sold AS (
  SELECT *, timezone('Europe/London', timezone('UTC', event_ts)) AS here
  FROM stg_orders JOIN dim_product USING (product_id)
    JOIN dim_customer ON customer_id = user_id
  WHERE interaction_type = 'purchase' AND event_date IN (SELECT date FROM dim_calendar)
),
fact_sales AS (
  SELECT md5(user_id || '::' || product_id || '::' || strftime(here, '%%Y-%%m-%%d %%H:%%M:%%S')
      || if(here = event_ts, '+00', '+01')) AS order_id,
    event_date AS order_date, customer_id, product_id, 1 AS quantity, selling_price AS unit_price,
    CAST(selling_price AS DECIMAL(12,2)) AS gross_item_value,
    CAST(0 AS DECIMAL(10,2)) AS discount_amount, CAST(0 AS DECIMAL(10,2)) AS tax_amount,
    CAST(0 AS DECIMAL(10,2)) AS shipping_fee,
    CAST(selling_price AS DECIMAL(12,2)) AS net_revenue, region, payment_method
  FROM sold
)
""" % {
    "customers": driver_tables.CUSTOMERS_RAW.format(**_BARE),
    "products": driver_tables.PRODUCTS_RAW.format(**_BARE),
    "orders": driver_tables.ORDERS_RAW.format(**_BARE),
    "regions": region_values(),
    "price": PRICE_PATTERN,
    "time": EVENT_PATTERN.removeprefix("(?s)"),
}

_SALES = """
WITH fact_sales AS (%s),
dim_customer AS (%s),
dim_product AS (%s)
""" % tuple(
    sql.format(**_BARE)
    for sql in (
        driver_tables.FACT,
        driver_tables.FACT_CUSTOMERS,
        driver_tables.FACT_PRODUCTS,
    )
)

_MONEY = "DECIMAL(22,2)"
_RATIO = "DECIMAL(18,2)"
_SUM = f"CAST(sum(net_revenue) AS {_MONEY})"


def _cents(money: str) -> str:
    return f"CAST(({money}) * 100 AS HUGEINT)"


def _half_up(num: str, den: str) -> str:
    """num / den (integers) rounded half up, as hundredths read back as a decimal."""
    return f"CAST(CAST((2 * ({num}) + ({den})) // (2 * ({den})) AS DECIMAL(20,0)) / 100 AS {_RATIO})"


def _per(money: str, count: str) -> str:
    return _half_up(_cents(money), count)


def _share(column: str, unit=lambda c: f"CAST({c} AS HUGEINT)") -> str:
    return _half_up(f"10000 * {unit(column)}", f"sum({unit(column)}) OVER ()")


_HEADLINE = f"""SELECT count(*) AS orders, count(DISTINCT customer_id) AS customers,
  count(DISTINCT product_id) AS products, {_SUM} AS net_revenue,
  {_per("sum(net_revenue)", "count(*)")} AS aov, min(order_date) AS min_date, max(order_date) AS max_date
FROM fact_sales"""

_LTV = f"""SELECT customer_id, any_value(c.region) AS region, any_value(c.payment_method) AS payment_method,
  min(order_date) AS first_order_date, max(order_date) AS last_order_date, count(*) AS orders_count,
  {_SUM} AS ltv, dense_rank() OVER (ORDER BY sum(net_revenue) DESC) AS ltv_rank
FROM fact_sales f LEFT JOIN dim_customer c USING (customer_id) GROUP BY customer_id"""


def _top(n: int) -> str:
    return f"""SELECT customer_id, region, payment_method, orders_count, ltv, ltv_rank
FROM ({_LTV}) ORDER BY ltv DESC, customer_id LIMIT {n}"""


def _breakdown(label: str, name: str, source: str = "fact_sales") -> str:
    return f"""SELECT {label} AS {name}, count(*) AS orders, {_SUM} AS revenue FROM {source} GROUP BY 1"""


_REVENUE_SHARE = f"{_share('revenue', _cents)} AS revenue_share_pct"

_CATEGORY = f"""SELECT *, {_REVENUE_SHARE} FROM (
{_breakdown("p.product_category", "product_category", "fact_sales f JOIN dim_product p USING (product_id)")})"""
_REGION = f"SELECT *, {_REVENUE_SHARE} FROM ({_breakdown('region', 'region')})"
_PAYMENT = f"""SELECT payment_method, orders, revenue, {_per("revenue", "orders")} AS aov, {_REVENUE_SHARE}
FROM ({_breakdown("payment_method", "payment_method")})"""

_MONTHS = f"""SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
  strftime(any_value(order_date), '%b') AS month_name,
  CAST(any_value(quarter(order_date)) AS INTEGER) AS quarter,
  any_value(CASE WHEN month(order_date) IN (12, 1, 2) THEN 'Winter' WHEN month(order_date) <= 5 THEN 'Spring'
    WHEN month(order_date) <= 8 THEN 'Summer' ELSE 'Autumn' END) AS season_uk,
  count(*) AS orders, {_SUM} AS revenue, {_per("sum(net_revenue)", "count(*)")} AS avg_order_value
FROM fact_sales GROUP BY 1, 2"""

_NEW_REPEAT = """SELECT *, if(order_date = min(order_date) OVER (PARTITION BY customer_id), 'new', 'repeat')
  AS customer_order_type FROM fact_sales"""

_SPLIT = f"""SELECT *, {_share("orders")} AS orders_share_pct, {_REVENUE_SHARE} FROM (
{_breakdown("customer_order_type", "customer_order_type", f"({_NEW_REPEAT})")})"""

_WINDOWS = """SELECT customer_id, d[1] AS first_order_date, d[2] AS second_order_date,
  CAST(d[2] - d[1] AS INTEGER) AS days_to_second, d[2] - d[1] <= 30 AS repeat_30d,
  d[2] - d[1] <= 60 AS repeat_60d, d[2] - d[1] <= 90 AS repeat_90d
FROM (SELECT customer_id, list(order_date ORDER BY order_date) AS d FROM fact_sales GROUP BY customer_id)"""

_PROFILE = """SELECT unnest(['fact_sales', 'distinct_customers', 'distinct_products', 'min_date', 'max_date']) AS metric,
  unnest([count(*)::VARCHAR, count(DISTINCT customer_id)::VARCHAR, count(DISTINCT product_id)::VARCHAR,
    min(order_date)::VARCHAR, max(order_date)::VARCHAR]) AS value
FROM fact_sales"""


def _counts(tables: dict[str, str], name: str, value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS {name}, count(*) AS {value} FROM {table}"
        for label, table in tables.items()
    )


_COUNTED = {
    "raw.customers_raw": "customers_raw",
    "raw.products_raw": "products_raw",
    "raw.orders_raw": "orders_raw",
    "stg.stg_customers": "stg_customers",
    "stg.stg_products": "stg_products",
    "stg.stg_orders": "stg_orders",
    "core.dim_customer": "dim_customer",
    "core.dim_product": "dim_product",
    "core.dim_calendar": "dim_calendar",
    "core.fact_sales": "fact_sales",
}
_STAGES = {
    "customers_raw": "customers_raw",
    "products_raw": "products_raw",
    "orders_raw": "orders_raw",
    "stg_customers": "stg_customers",
    "stg_products": "stg_products",
    "stg_orders": "stg_orders",
    "dq_invalid_price": "bad_price",
    "dq_orphans_products": "orphans_products",
    "dq_orphans_customers": "orphans_customers",
    "dim_region": "dim_region",
    "dim_calendar": "dim_calendar",
    "dim_product": "dim_product",
    "dim_customer": "dim_customer",
    "fact_sales": "fact_sales",
}


def _repeated(table: str, key: str) -> str:
    return f"(SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)"


_UNIQUE = {
    "dupe_dim_customer": _repeated("dim_customer", "customer_id"),
    "dupe_dim_product": _repeated("dim_product", "product_id"),
    "dupe_fact_sales_order_id": _repeated("fact_sales", "order_id"),
}
_REFERENCES = {
    "fact→dim_customer_orphans": "fact_sales ANTI JOIN dim_customer USING (customer_id)",
    "fact→dim_product_orphans": "fact_sales ANTI JOIN dim_product USING (product_id)",
    "fact→dim_calendar_orphans": "fact_sales ANTI JOIN dim_calendar ON date = order_date",
}
_DOMAIN = {
    "invalid_interaction_type": "stg_orders WHERE interaction_type NOT IN ('purchase', 'view', 'like')",
    "invalid_or_missing_price": "bad_price",
    "negative_net_revenue": "fact_sales WHERE net_revenue < 0",
}
_TEMPORAL = {
    "fact_dates_outside_calendar": "fact_sales WHERE order_date NOT BETWEEN "
    "(SELECT min(date) FROM dim_calendar) AND (SELECT max(date) FROM dim_calendar)",
}
_ROW_METRICS = {
    "rows_" + label.replace(".stg_", "_").replace("core.", "").replace("raw.", "raw_").removesuffix(
        "_raw"
    ): table
    for label, table in _COUNTED.items()
}
_SUMMARY = f"""SELECT metric, CAST(n AS VARCHAR) AS value, (n > 0) = starts_with(metric, 'rows_') AS pass
FROM ({_counts(_ROW_METRICS | _UNIQUE | _REFERENCES | _DOMAIN | _TEMPORAL, "metric", "n")})"""

_TOO_LARGE = "regexp_full_match({0}, '[0-9]+') AND try_cast({0} AS INTEGER) IS NULL"
# the first test that a row fails names its reason
_TESTS = {
    "stg.stg_customers": (
        "customer_text",
        {
            "no_customer_id": "NOT coalesce(regexp_full_match(id, '[0-9]+'), false)",
            "customer_id_too_large": _TOO_LARGE.format("id"),
            "age_too_large": _TOO_LARGE.format("age"),
            "previous_purchases_too_large": _TOO_LARGE.format("prev"),
        },
    ),
    "stg.stg_products": (
        "products_raw",
        {
            "no_product_id": "trim(product_id) = ''",
            "price_too_large": f"""try_cast(replace(nullif(regexp_extract(selling_price, '{PRICE_PATTERN}', 1), ''), ',', '')
              AS DECIMAL(10,2)) IS NULL AND regexp_matches(selling_price, '{PRICE_PATTERN}')""",
        },
    ),
    "stg.stg_orders": (
        "order_typed",
        {
            "no_user_id": "NOT regexp_full_match(id, '[0-9]+')",
            "user_id_too_large": "user_id IS NULL",
            "no_product_id": "product_id = ''",
            "no_interaction": "interaction_type NOT IN ('purchase', 'view', 'like')",
            "no_event_time": "said = ''",
            "bad_event_time": "wall IS NULL",
        },
    ),
    "core.fact_sales": (
        "stg_orders o",
        {
            "unknown_product": "o.product_id NOT IN (SELECT product_id FROM stg_products)",
            "no_price": "o.product_id NOT IN (SELECT product_id FROM dim_product)",
            "unknown_customer": "o.user_id NOT IN (SELECT customer_id FROM dim_customer)",
            "no_calendar_day": "o.event_date NOT IN (SELECT date FROM dim_calendar)",
        },
    ),
}


def _losses() -> str:
    parts = []
    for step, (source, tests) in _TESTS.items():
        cases = " ".join(f"WHEN {test} THEN '{reason}'" for reason, test in tests.items())
        only = "WHERE interaction_type = 'purchase'" if step == "core.fact_sales" else ""
        parts += [
            f"SELECT '{step}' AS step, '{reason}' AS reason, count(*) FILTER (why = '{reason}') AS rows "
            f"FROM (SELECT CASE {cases} END AS why FROM {source} {only})"
            for reason in tests
        ]
    return " UNION ALL ".join(parts)


_ORDER_TEXT = """user_id || '/' || product_id || '/'
  || strftime(timezone('Europe/London', timezone('UTC', event_ts)), '%Y-%m-%d %H:%M:%S')
  || if(timezone('Europe/London', timezone('UTC', event_ts)) = event_ts, '+00', '+01')"""
_SAMPLES = f"""
(SELECT 'dq_invalid_price' AS helper, product_id AS offender FROM bad_price ORDER BY product_id LIMIT 5)
UNION ALL (SELECT 'dq_orphans_products', {_ORDER_TEXT} FROM orphans_products
  ORDER BY user_id, product_id, event_ts LIMIT 5)
UNION ALL (SELECT 'dq_orphans_customers', {_ORDER_TEXT} FROM orphans_customers
  ORDER BY user_id, product_id, event_ts LIMIT 5)"""


def _doubles(sql: str, *columns: str) -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({sql})"


_SHARES = ["orders", "revenue", "revenue_share_pct"]
_SIDE_BY_SIDE = ", ".join(
    f"coalesce(max(CAST({what}_share_pct AS DOUBLE)) FILTER (customer_order_type = '{kind}'), 0.0::DOUBLE) AS {what}_{kind}"
    for what in ("orders", "revenue")
    for kind in ("new", "repeat")
)

_ANSWERS = {
    "kpi_headline": f"({_HEADLINE})",
    "top_customers_ltv": f"({_top(50)})",
    "sales_by_category": f"({_CATEGORY})",
    "sales_by_region": f"({_REGION})",
    "seasonality_monthly": f"({_MONTHS})",
    "payment_mix": f"({_PAYMENT})",
    "new_vs_repeat": f"({_SPLIT})",
}

_ON_STAGING = {
    "clean_customers": "FROM stg_customers",
    "clean_products": "FROM stg_products",
    "clean_orders": "FROM stg_orders",
    "scan_customers_csv": "FROM stg_customers",
    "scan_products_csv": "FROM stg_products",
    "scan_orders_csv": "FROM stg_orders",
    "orders_in_2024": "FROM orders_2024",
    "dq_invalid_price": "FROM bad_price",
    "dq_orphans_products": "FROM orphans_products",
    "dq_orphans_customers": "FROM orphans_customers",
    "customer_regions": "SELECT customer_id, location, region FROM dim_customer",
    "dim_calendar": "FROM dim_calendar",
    "dim_product": "FROM dim_product",
    "dim_customer": "FROM dim_customer",
    "fact_sales": "FROM fact_sales",
    "stage_losses": _losses(),
    "stage_counts": _counts(_STAGES, "name", "rows"),
    "dq_row_counts": _counts({label: t for label, t in _COUNTED.items()}, "t", "n"),
    "dq_uniqueness": _counts(_UNIQUE, "check_name", "offenders"),
    "dq_referential": _counts(_REFERENCES, "check_name", "offenders"),
    "dq_domain": _counts(_DOMAIN, "check_name", "offenders"),
    "dq_temporal": _counts(_TEMPORAL, "check_name", "offenders"),
    "dq_summary": _SUMMARY,
    "build_summary": _SUMMARY,
    "dq_offender_samples": _SAMPLES,
}

_ON_SALES = {
    "duplicate_keys": "SELECT order_id, count(*) AS n FROM fact_sales GROUP BY 1 HAVING count(*) > 1",
    "kpi_headline": _HEADLINE,
    "top_customers_ltv": _LTV,
    "sales_by_category": _CATEGORY,
    "sales_by_region": _REGION,
    "seasonality_monthly": _MONTHS,
    "payment_mix": _PAYMENT,
    "customer_first_purchase": "SELECT customer_id, min(order_date) AS first_purchase_date FROM fact_sales GROUP BY 1",
    "order_new_repeat": _NEW_REPEAT,
    "customer_repeat_windows": _WINDOWS,
    "top_customers_10": _top(10),
    "top_customers_50": _top(50),
    "new_vs_repeat": _SPLIT,
    "catalog_top_customers": _LTV,
    "season_by_day": f"""SELECT order_date, count(*) AS orders, {_SUM} AS revenue FROM fact_sales
WHERE year(order_date) = 1995 AND month(order_date) IN (3, 4, 5) GROUP BY 1""",
    "published_rows": _counts(_ANSWERS, "name", "rows"),
    "fact_profile": _PROFILE,
    "export_roundtrip": _CATEGORY,
    "feed_headline": f"""SELECT * REPLACE (CAST(net_revenue AS DOUBLE) AS net_revenue, CAST(aov AS DOUBLE) AS aov,
  CAST(min_date AS VARCHAR) AS min_date, CAST(max_date AS VARCHAR) AS max_date) FROM ({_HEADLINE})""",
    "feed_top_customers": f"""SELECT CAST(customer_id AS VARCHAR) AS customer_id, * EXCLUDE (customer_id)
FROM ({_doubles(_top(10), "orders_count", "ltv", "ltv_rank")})""",
    "feed_sales_by_category": _doubles(_CATEGORY, *_SHARES),
    "feed_sales_by_region": _doubles(_REGION, *_SHARES),
    "feed_payment_mix": _doubles(_PAYMENT, "aov", *_SHARES),
    "feed_monthly": f"""SELECT *, make_date(year, month, 1) AS date
FROM ({_doubles(_MONTHS, "orders", "revenue", "avg_order_value")})""",
    "feed_new_vs_repeat": f"SELECT {_SIDE_BY_SIDE} FROM ({_SPLIT})",
}


def oracle_sql() -> dict[str, str]:
    return {
        **{name: _STAGING + sql for name, sql in _ON_STAGING.items()},
        **{name: _SALES + sql for name, sql in _ON_SALES.items()},
    }
