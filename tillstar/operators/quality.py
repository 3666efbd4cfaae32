"""Row counts and data-quality checks.

A check is a one-row frame whose columns are named numbers; reports turn those into
rows. The fact is read once for all checks of a report, and grouped before it meets a dimension.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions import domains, money
from tillstar.operators.distinct import count_distinct, with_distinct

# Tables of the row-count report and metric names of the summary.
COUNTED_TABLES = {
    "raw.customers_raw": "rows_raw_customers",
    "raw.products_raw": "rows_raw_products",
    "raw.orders_raw": "rows_raw_orders",
    "stg.stg_customers": "rows_stg_customers",
    "stg.stg_products": "rows_stg_products",
    "stg.stg_orders": "rows_stg_orders",
    "core.dim_customer": "rows_dim_customer",
    "core.dim_product": "rows_dim_product",
    "core.dim_calendar": "rows_dim_calendar",
    "core.fact_sales": "rows_fact_sales",
}
DUPLICATES = {
    "core.dim_customer": ("customer_id", "dupe_dim_customer"),
    "core.dim_product": ("product_id", "dupe_dim_product"),
    "core.fact_sales": ("order_id", "dupe_fact_sales_order_id"),
}
ORPHAN_CUSTOMERS = "fact→dim_customer_orphans"
ORPHAN_PRODUCTS = "fact→dim_product_orphans"
ORPHAN_DAYS = "fact→dim_calendar_orphans"
BAD_INTERACTIONS = "invalid_interaction_type"
BAD_PRICES = "invalid_or_missing_price"
NEGATIVE_REVENUE = "negative_net_revenue"
DATES_OUTSIDE = "fact_dates_outside_calendar"

Tables = dict[str, DataFrame]


def _count() -> Column:
    return F.count(F.lit(1))


def _sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def _sum_if(test: Column, n: Column) -> Column:
    return _sum(F.when(test, n))


def _as_rows(checks: list[DataFrame], name: str, value: str) -> DataFrame:
    parts = [c.unpivot([], [f"`{n}`" for n in c.columns], name, value) for c in checks]
    return reduce(DataFrame.unionAll, parts)


def _rows(tables: Tables, names) -> list[DataFrame]:
    return [tables[t].agg(_count().alias(names[t])) for t in names]


def _key_check(tables: Tables, table: str, with_rows: bool = False) -> DataFrame:
    """Number of repeated keys, and on demand of rows, from one grouping by key."""
    key, name = DUPLICATES[table]
    counts = tables[table].groupBy(key).agg(_count().alias("n"))
    numbers = [F.count_if(F.col("n") > 1).alias(name)]
    if with_rows:
        numbers.append(_sum(F.col("n")).alias(COUNTED_TABLES[table]))
    return counts.agg(*numbers)


def _fact_checks(tables: Tables, *wanted: str) -> DataFrame:
    """All that is asked about the fact, from one read and one shuffle of it.

    A row becomes a key per kind of check, so keys of all kinds are grouped together: a hot
    customer, product or day sends one row per map task. What the dimensions know then meets
    one row per key.
    """
    fact, calendar = tables["core.fact_sales"], tables["core.dim_calendar"]
    known = {
        "customer": tables["core.dim_customer"].select(F.col("customer_id").alias("key")),
        "product": tables["core.dim_product"].select(F.col("product_id").alias("key")),
        "day": calendar.select(F.col("date").alias("key")),
    }
    keys = {
        "order": ("order_id", [DUPLICATES["core.fact_sales"][1]]),
        "customer": ("customer_id", [ORPHAN_CUSTOMERS]),
        "product": ("product_id", [ORPHAN_PRODUCTS]),
        "day": (
            "order_date",
            [ORPHAN_DAYS, DATES_OUTSIDE, NEGATIVE_REVENUE, COUNTED_TABLES["core.fact_sales"]],
        ),
    }
    kinds = {kind: key for kind, (key, names) in keys.items() if set(names) & set(wanted)}
    negative = (F.col("net_revenue") < 0).cast("int")
    per_row = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.col(key).cast("string").alias("key"),
            (negative if kind == "day" else F.lit(0)).alias("negative"),
        )
        for kind, key in kinds.items()
    ]
    per_key = (
        fact.select(F.inline(F.array(*per_row)))
        .groupBy("kind", "key")
        .agg(_count().alias("n"), F.sum("negative").alias("negative"))
    )
    lists = [
        keys_of.where(F.col("key").isNotNull())
        .select(F.lit(kind).alias("kind"), F.col("key").cast("string").alias("key"))
        .distinct()
        for kind, keys_of in known.items()
        if kind in kinds and {ORPHAN_CUSTOMERS, ORPHAN_PRODUCTS, ORPHAN_DAYS} & set(keys[kind][1]) & set(wanted)
    ]
    if lists:
        listed = reduce(DataFrame.unionAll, lists).withColumn("listed", F.lit(True))
        per_key = per_key.join(listed, ["kind", "key"], "left")
    else:
        per_key = per_key.withColumn("listed", F.lit(True))
    span = calendar.agg(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    day = F.col("key").try_cast("date")

    def of(kind: str, test: Column | None = None) -> Column:
        asked = F.col("kind") == kind
        return asked if test is None else asked & test

    unlisted, n = F.col("listed").isNull(), F.col("n")
    numbers = {
        DUPLICATES["core.fact_sales"][1]: F.count_if(of("order", n > 1)),
        ORPHAN_CUSTOMERS: _sum_if(of("customer", unlisted), n),
        ORPHAN_PRODUCTS: _sum_if(of("product", unlisted), n),
        ORPHAN_DAYS: _sum_if(of("day", unlisted), n),
        DATES_OUTSIDE: _sum_if(of("day", (day < span["lo"]) | (day > span["hi"])), n),
        NEGATIVE_REVENUE: _sum_if(of("day"), F.col("negative")),
        COUNTED_TABLES["core.fact_sales"]: _sum_if(of("day"), n),
    }
    return per_key.agg(*[numbers[name].alias(name) for name in wanted])


def _order_checks(tables: Tables, with_rows: bool = False) -> DataFrame:
    bad = F.count_if(domains.not_an_interaction(F.col("interaction_type")))
    numbers = [bad.alias(BAD_INTERACTIONS)]
    if with_rows:
        numbers.append(_count().alias(COUNTED_TABLES["stg.stg_orders"]))
    return tables["stg.stg_orders"].agg(*numbers)


def _price_checks(tables: Tables, with_rows: bool = False) -> DataFrame:
    numbers = [F.count_if(money.is_bad_price(F.col("selling_price"))).alias(BAD_PRICES)]
    if with_rows:
        numbers.append(_count().alias(COUNTED_TABLES["stg.stg_products"]))
    return tables["stg.stg_products"].agg(*numbers)


def stage_counts(tables: Tables) -> DataFrame:
    """Rows of each given table: name, rows."""
    return _as_rows(_rows(tables, {t: t for t in tables}), "name", "rows")


def row_counts(tables: Tables) -> DataFrame:
    counts = _as_rows(_rows(tables, {t: t for t in COUNTED_TABLES}), "t", "n")
    return counts.orderBy("t")


def uniqueness(tables: Tables) -> DataFrame:
    return _as_rows([_key_check(tables, t) for t in DUPLICATES], "check_name", "offenders")


def referential(tables: Tables) -> DataFrame:
    checks = _fact_checks(tables, ORPHAN_CUSTOMERS, ORPHAN_PRODUCTS, ORPHAN_DAYS)
    return _as_rows([checks], "check_name", "offenders")


def domain(tables: Tables) -> DataFrame:
    checks = [
        _order_checks(tables),
        _price_checks(tables),
        _fact_checks(tables, NEGATIVE_REVENUE),
    ]
    return _as_rows(checks, "check_name", "offenders")


def temporal(tables: Tables) -> DataFrame:
    return _as_rows([_fact_checks(tables, DATES_OUTSIDE)], "check_name", "offenders")


def dq_summary(tables: Tables) -> DataFrame:
    """All 20 metrics with a pass flag: counts must be above zero, offenders zero."""
    plain = ["raw.customers_raw", "raw.products_raw", "raw.orders_raw"]
    plain += ["stg.stg_customers", "core.dim_calendar"]
    checks = _rows(tables, {t: COUNTED_TABLES[t] for t in plain}) + [
        _order_checks(tables, with_rows=True),
        _price_checks(tables, with_rows=True),
        _key_check(tables, "core.dim_customer", with_rows=True),
        _key_check(tables, "core.dim_product", with_rows=True),
        _fact_checks(
            tables,
            DUPLICATES["core.fact_sales"][1],
            ORPHAN_CUSTOMERS,
            ORPHAN_PRODUCTS,
            ORPHAN_DAYS,
            DATES_OUTSIDE,
            NEGATIVE_REVENUE,
            COUNTED_TABLES["core.fact_sales"],
        ),
    ]
    numbers = _as_rows(checks, "metric", "number")
    passed = F.when(F.col("metric").startswith("rows_"), F.col("number") > 0).otherwise(
        F.col("number") == 0
    )
    return numbers.select(
        "metric", F.col("number").cast("string").alias("value"), passed.alias("pass")
    ).orderBy("metric")


def offender_sample(helper: DataFrame, *order: str, n: int = 5) -> DataFrame:
    """A few rows of a helper table to look at, the first ones in the given order."""
    return helper.orderBy(*order).limit(n) if order else helper.limit(n)


def fact_profile(fact: DataFrame) -> DataFrame:
    """Five figures of the fact as (metric, value as text)."""
    sums = with_distinct(
        fact,
        "customer_id",
        "customers",
        {
            "n": (_count(), _sum(F.col("n"))),
            "lo": (F.min("order_date"), F.min("lo")),
            "hi": (F.max("order_date"), F.max("hi")),
        },
    )
    one_row = sums.select(
        F.col("n").cast("string").alias("fact_sales"),
        F.col("customers").cast("string").alias("distinct_customers"),
        count_distinct(fact, "product_id").cast("string").alias("distinct_products"),
        F.col("lo").cast("string").alias("min_date"),
        F.col("hi").cast("string").alias("max_date"),
    )
    return _as_rows([one_row], "metric", "value")
