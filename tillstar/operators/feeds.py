"""Small frames that a chart or a report page can show as they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.text import text_to_number


def ensure_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of the columns that exist as DOUBLE, bad values as NULL."""
    return df.withColumns({c: text_to_number(F.col(c)) for c in columns if c in df.columns})


def feed_headline(headline: DataFrame) -> DataFrame:
    def whole(name: str) -> Column:
        return F.coalesce(F.col(name).cast("long"), F.lit(0)).alias(name)

    def amount(name: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    return headline.select(
        whole("orders"),
        whole("customers"),
        whole("products"),
        amount("net_revenue"),
        amount("aov"),
        text("min_date"),
        text("max_date"),
    )


def feed_top_customers(top: DataFrame, n: int = 10) -> DataFrame:
    """The n best customers, the best last, ids as labels."""
    best = ensure_numeric(top, ["ltv", "orders_count", "ltv_rank"])
    best = best.orderBy(F.desc("ltv"), "customer_id").limit(n)
    return best.orderBy("ltv", F.desc("customer_id")).withColumn(
        "customer_id", F.col("customer_id").cast("string")
    )


def feed_sorted(breakdown: DataFrame, by: str = "revenue") -> DataFrame:
    """A breakdown as numbers, the largest first."""
    measures = ["orders", "revenue", "aov", "revenue_share_pct"]
    return ensure_numeric(breakdown, measures).orderBy(F.desc(by))


def feed_monthly(months: DataFrame) -> DataFrame:
    """The monthly series in order, each month with the date of its first day."""
    numbers = ensure_numeric(months, ["orders", "revenue", "avg_order_value"])
    year, month = F.col("year").cast("int"), F.col("month").cast("int")
    return numbers.withColumns(
        {"year": year, "month": month, "date": F.make_date(year, month, F.lit(1))}
    ).orderBy("date")


def feed_new_vs_repeat(split: DataFrame) -> DataFrame:
    """Both shares of both order types side by side; a missing type is 0."""

    def share(order_type: str, column: str) -> Column:
        picked = F.when(F.col("customer_order_type") == order_type, F.col(column).cast("double"))
        return F.coalesce(F.max(picked), F.lit(0.0))

    return split.agg(
        *[
            share(order_type, f"{what}_share_pct").alias(f"{what}_{order_type}")
            for what in ("orders", "revenue")
            for order_type in ("new", "repeat")
        ]
    )
