"""Staging to star schema: dimensions, purchase-line fact, key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions import clock, domains, money
from tillstar.operators import rejects
from tillstar.operators.clean import purchases


class DuplicateKeyError(ValueError):
    """A table has NULL or repeated keys."""


def dim_calendar(stg_orders: DataFrame) -> DataFrame:
    """Every day of every year from the first event to the last; 2020-2025 without events.

    One row per day, so four-digit years bound it to 3.7 million rows.
    """
    span = stg_orders.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    first = F.coalesce(F.trunc("lo", "year"), F.to_date(F.lit("2020-01-01")))
    last = F.coalesce(
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)), F.to_date(F.lit("2025-12-31"))
    )
    days = span.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date"))
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "MMM").alias("month_name"),
        F.quarter("date").alias("quarter"),
        F.weekofyear("date").alias("week_of_year"),
        domains.season_uk(F.month("date")).alias("season_uk"),
    )


def dim_product(stg_products: DataFrame) -> DataFrame:
    return stg_products.where(F.col("product_id").isNotNull() & (F.col("selling_price") > 0)).select(
        "product_id", "product_name", "product_category", "selling_price"
    )


def customer_regions(stg_customers: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Customers with the region of their state; a lookup miss is Unknown.

    Spark sees the exact size of the 51-row lookup and joins without a shuffle.
    """
    lookup = dim_region.select(
        F.col("state_name").alias("location"), F.col("region").alias("known_region")
    )
    return stg_customers.join(lookup, "location", "left").withColumn(
        "region", F.coalesce("known_region", F.lit("Unknown"))
    ).drop("known_region")


def dim_customer(
    stg_customers: DataFrame, dim_region: DataFrame, stg_orders: DataFrame
) -> DataFrame:
    """Customers with region and the date of their first purchase, priced or not."""
    first_seen = (
        purchases(stg_orders)
        .groupBy(F.col("user_id").alias("customer_id"))
        .agg(F.min("event_date").alias("first_seen_date"))
    )
    return (
        customer_regions(stg_customers, dim_region)
        .where(F.col("customer_id").isNotNull())
        .join(first_seen, "customer_id", "left")
        .select(
            "customer_id",
            "gender",
            "location",
            "region",
            "payment_method",
            "subscription_status",
            "first_seen_date",
        )
    )


def _lines(stg_orders: DataFrame, tz: str) -> DataFrame:
    return purchases(stg_orders).select(
        F.col("user_id").alias("customer_id"),
        "product_id",
        "event_ts",
        F.from_utc_timestamp("event_ts", tz).alias("local_ts"),
        F.col("event_date").alias("order_date"),
    )


def _prices(dim_product: DataFrame) -> DataFrame:
    return dim_product.where(F.col("selling_price") > 0).select(
        "product_id", F.col("selling_price").cast(money.PRICE).alias("unit_price")
    )


def _sale_columns() -> list[Column]:
    stamp = clock.stamp_text(F.col("event_ts"), F.col("local_ts"))
    key = F.concat_ws("::", F.col("customer_id").cast("string"), "product_id", stamp)
    value = (F.col("quantity") * F.col("unit_price")).cast(money.LINE_VALUE)
    nothing = F.lit(0).cast(money.PRICE)
    return [
        F.md5(key).alias("order_id"),
        F.col("order_date"),
        F.col("customer_id"),
        F.col("product_id"),
        F.col("quantity"),
        F.col("unit_price"),
        value.alias("gross_item_value"),
        nothing.alias("discount_amount"),
        nothing.alias("tax_amount"),
        nothing.alias("shipping_fee"),
        value.alias("net_revenue"),
        F.col("region"),
        F.col("payment_method"),
        F.current_timestamp().alias("created_at"),
    ]


def fact_sales(
    stg_orders: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    dim_calendar: DataFrame,
    tz: str = clock.LONDON,
) -> DataFrame:
    """One row per purchase of a priced product by a known customer.

    Pass dimensions that are read from their tables: then each join has plain
    shuffles under both sides and AQE splits a hot product or customer, and Spark
    knows each table's real size when it decides on a broadcast.
    """
    buyers = dim_customer.select("customer_id", "region", "payment_method")
    days = dim_calendar.select(F.col("date").alias("order_date"))
    return (
        _lines(stg_orders, tz)
        .join(days, "order_date", "left_semi")
        .join(_prices(dim_product), "product_id")
        .join(buyers, "customer_id")
        .withColumn("quantity", F.lit(1))
        .select(_sale_columns())
    )


def judge_sales(
    stg_orders: DataFrame,
    stg_products: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    dim_calendar: DataFrame,
    tz: str = clock.LONDON,
) -> DataFrame:
    """Every purchase as a fact row, with the reason why it can't be one and so has no order_id.

    The rows without a reason are those of fact_sales, from the same joins as outer ones. Whether
    an unpriced product is known at all, and whether a day is, comes from existence joins:
    they never multiply a purchase.
    """
    buyers = dim_customer.select(
        "customer_id", "region", "payment_method", F.lit(True).alias("_buyer")
    )
    joined = (
        _lines(stg_orders, tz)
        .join(_prices(dim_product), "product_id", "left")
        .join(buyers, "customer_id", "left")
        .withColumn("quantity", F.lit(1))
    )
    # spark.sql, as only SQL has IN over a query as a column
    known = joined.sparkSession.sql(
        """SELECT *, product_id IN (SELECT product_id FROM {products}) AS _listed,
             order_date IN (SELECT date FROM {days}) AS _day FROM {joined}""",
        joined=joined,
        products=stg_products.select("product_id"),
        days=dim_calendar.select("date"),
    )
    unpriced, product = F.col("unit_price").isNull(), F.col("product_id")
    customer = F.col("customer_id").cast("string")
    listed = F.coalesce(F.col("_listed"), F.lit(False))
    reasons = rejects.first_reason(
        (unpriced & ~listed, "unknown_product", product),
        (unpriced, "no_price", product),
        (F.col("_buyer").isNull(), "unknown_customer", customer),
        (
            ~F.coalesce(F.col("_day"), F.lit(False)),
            "no_calendar_day",
            F.col("order_date").cast("string"),
        ),
    )
    judged = known.select(*_sale_columns(), *reasons)
    # only a fact row has an id
    return judged.withColumn("order_id", F.when(F.col(rejects.REASON).isNull(), F.col("order_id")))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_key(df: DataFrame, *keys: str, on_duplicate: str = "raise") -> DataFrame:
    """Stop if a key is NULL or repeated; with on_duplicate="report" just say so.

    Returns the offending keys with their counts. Only five of them reach the driver.
    """
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    offenders = counts.where((F.col("n") > 1) | missing)
    if on_duplicate == "raise":
        shown = offenders.limit(5).collect()
        if shown:
            raise DuplicateKeyError(f"bad key {keys}: {[tuple(r) for r in shown]}")
    elif on_duplicate != "report":
        raise ValueError(f"on_duplicate must be raise or report, not {on_duplicate!r}")
    return offenders
