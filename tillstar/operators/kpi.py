"""KPI views over the fact.

Each one shrinks the fact first, by the key it needs, inside the map tasks, and joins
dimensions or compares customers after that. So a customer or product that
holds a third of all rows sends one row per map task, not its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions import money
from tillstar.operators.distinct import count_distinct, with_distinct
from tillstar.operators.ranking import with_dense_rank
from tillstar.operators.skew import with_minimum_per_key


def _n_rows() -> Column:
    return F.count(F.lit(1)).alias("orders")


def _revenue() -> Column:
    return money.total(F.col("net_revenue")).alias("revenue")


def _with_shares(groups: DataFrame, **shares: str) -> DataFrame:
    """Add share-of-total columns: new name = column it is the share of.

    The totals are a scalar subquery over the same grouped rows. It asks for both
    columns, so both uses have one plan and Spark runs the grouping's shuffle once;
    a window over everything would move all groups into one task.
    """
    totals = groups.agg(
        F.struct(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    ).scalar()
    return groups.withColumns(
        {new: money.share_pct(F.col(old), totals[old]) for new, old in shares.items()}
    )


def kpi_headline(fact: DataFrame) -> DataFrame:
    """Totals in one row, which is there and zero even for an empty fact.

    The fact is read once for the customers and all sums, and once for the products.
    """
    sums = with_distinct(
        fact,
        "customer_id",
        "customers",
        {
            "orders": (F.count(F.lit(1)), F.coalesce(F.sum("orders"), F.lit(0))),
            "net_revenue": (
                money.total(F.col("net_revenue")),
                F.coalesce(money.total(F.col("net_revenue")), F.lit(0).cast(money.TOTAL)),
            ),
            "min_date": (F.min("order_date"), F.min("min_date")),
            "max_date": (F.max("order_date"), F.max("max_date")),
        },
    )
    return sums.select(
        "orders",
        "customers",
        count_distinct(fact, "product_id").alias("products"),
        "net_revenue",
        money.ratio_or_zero(F.col("net_revenue"), F.col("orders")).alias("aov"),
        "min_date",
        "max_date",
    )


def customer_totals(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count(F.lit(1)).alias("orders_count"),
        money.total(F.col("net_revenue")).alias("ltv"),
    )


def _with_customer(totals: DataFrame, dim_customer: DataFrame) -> DataFrame:
    who = dim_customer.select("customer_id", "region", "payment_method")
    return totals.join(who, "customer_id", "left")


_LTV_COLUMNS = [
    "customer_id",
    "region",
    "payment_method",
    "first_order_date",
    "last_order_date",
    "orders_count",
    "ltv",
    "ltv_rank",
]


def top_customers_ltv(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Every customer with first and last date, count, lifetime value and dense rank."""
    totals = customer_totals(fact)
    # Always true. It keeps all columns in use, so that the ranking shares the shuffle
    # of the totals instead of grouping the fact a second time.
    all_columns = (F.col("orders_count") > 0) | (
        F.col("first_order_date") <= F.col("last_order_date")
    )
    ranked = with_dense_rank(
        _with_customer(totals, dim_customer),
        totals.where(all_columns),
        "ltv",
        "ltv_rank",
        spread_by=["customer_id"],
    )
    return ranked.select(_LTV_COLUMNS)


def top_customers(fact: DataFrame, dim_customer: DataFrame, n: int = 10) -> DataFrame:
    """The n best customers, ties by id.

    Everyone with a higher value is among the n, so their dense rank within the n
    is their rank among all, and nothing is sorted but n rows per task.
    """
    best = (
        customer_totals(fact)
        .select("customer_id", "orders_count", "ltv")
        .orderBy(F.desc("ltv"), "customer_id")
        .limit(n)
        .withColumn("ltv_rank", F.dense_rank().over(Window.orderBy(F.desc("ltv"))).cast("long"))
    )
    return (
        _with_customer(best, dim_customer)
        .select("customer_id", "region", "payment_method", "orders_count", "ltv", "ltv_rank")
        .orderBy("ltv_rank", "customer_id")
    )


def sales_by_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Orders, revenue and share per category; the fact meets the products after it
    has one row per product."""
    per_product = fact.groupBy("product_id").agg(_n_rows(), _revenue())
    categories = (
        per_product.join(dim_product.select("product_id", "product_category"), "product_id")
        .groupBy("product_category")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("revenue").cast(money.TOTAL).alias("revenue"),
        )
    )
    return _with_shares(categories, revenue_share_pct="revenue")


def sales_by_region(fact: DataFrame) -> DataFrame:
    region = F.coalesce("region", F.lit("Unknown")).alias("region")
    return _with_shares(
        fact.groupBy(region).agg(_n_rows(), _revenue()), revenue_share_pct="revenue"
    )


def seasonality_monthly(fact: DataFrame, dim_calendar: DataFrame) -> DataFrame:
    """Months that have sales; the fact meets the calendar after it has one row per day."""
    # a line with an order_id is an order; one without still brings revenue
    per_day = fact.groupBy(F.col("order_date").alias("date")).agg(
        F.count("order_id").alias("orders"),
        F.count("net_revenue").alias("valued"),
        _revenue(),
    )
    months = (
        per_day.join(dim_calendar, "date")
        .groupBy("year", "month", "month_name", "quarter", "season_uk")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("revenue").cast(money.TOTAL).alias("revenue"),
            F.sum("valued").alias("valued"),
        )
    )
    average = money.ratio(F.col("revenue"), F.col("valued"))
    return months.withColumn("avg_order_value", average).drop("valued")


def sales_by_day(
    fact: DataFrame, dim_calendar: DataFrame, year: int, season: str | None = None
) -> DataFrame:
    """Orders and revenue of each day with sales in a year, or in one season of it.

    The calendar is filtered and the fact is joined on its date. On a fact stored by date, Spark
    prunes folders by that join at run time.
    """
    days = dim_calendar.where(F.col("year") == year)
    if season is not None:
        days = days.where(F.col("season_uk") == season)
    lines = fact.join(days.select(F.col("date").alias("order_date")), "order_date", "left_semi")
    return lines.groupBy("order_date").agg(_n_rows(), _revenue())


def payment_mix(fact: DataFrame) -> DataFrame:
    method = F.coalesce("payment_method", F.lit("other")).alias("payment_method")
    mix = fact.groupBy(method).agg(_n_rows(), _revenue())
    aov = money.ratio_or_zero(F.col("revenue"), F.col("orders"))
    return _with_shares(mix, revenue_share_pct="revenue").select(
        "payment_method", "orders", "revenue", aov.alias("aov"), "revenue_share_pct"
    )


def customer_first_purchase(fact: DataFrame) -> DataFrame:
    return fact.groupBy("customer_id").agg(F.min("order_date").alias("first_purchase_date"))


def _order_type(first_date: str) -> Column:
    is_new = F.col("order_date") == F.col(first_date)
    return F.when(is_new, "new").otherwise("repeat").alias("customer_order_type")


def order_new_repeat(fact: DataFrame) -> DataFrame:
    """Fact rows marked new on the customer's first day, else repeat.

    A window per customer would put all rows of a hot customer into one task, and a join with
    the first dates would work the fact out twice.
    """
    dated = with_minimum_per_key(
        fact,
        "customer_id",
        "order_date",
        "first_purchase_date",
        ["order_id", "product_id", "order_date"],
    )
    return dated.select(*fact.columns, _order_type("first_purchase_date"))


def customer_repeat_windows(fact: DataFrame) -> DataFrame:
    """First and second order of each customer and whether it came within 30/60/90 days.

    The limit on row_number also runs before the shuffle, so at most two rows per
    customer leave each map task.
    """
    by_date = Window.partitionBy("customer_id").orderBy(F.col("order_date").asc_nulls_last())
    first_two = (
        fact.select("customer_id", "order_date")
        .withColumn("place", F.row_number().over(by_date))
        .where(F.col("place") <= 2)
    )
    pairs = first_two.groupBy("customer_id").agg(
        F.min(F.when(F.col("place") == 1, F.col("order_date"))).alias("first_order_date"),
        F.min(F.when(F.col("place") == 2, F.col("order_date"))).alias("second_order_date"),
    )
    days = F.date_diff("second_order_date", "first_order_date")
    return pairs.withColumn("days_to_second", days).withColumns(
        {f"repeat_{d}d": F.col("days_to_second") <= d for d in (30, 60, 90)}
    )


def new_vs_repeat(fact: DataFrame) -> DataFrame:
    """Orders and revenue of first days and later days with their shares.

    Only one row per customer and day is compared, never the lines themselves.
    """
    per_day = (
        fact.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "order_date")
        .agg(_n_rows(), _revenue())
    )
    first = F.min("order_date").over(Window.partitionBy("customer_id"))
    split = (
        per_day.withColumn("first_date", first)
        .groupBy(_order_type("first_date"))
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("revenue").cast(money.TOTAL).alias("revenue"),
        )
    )
    return _with_shares(split, orders_share_pct="orders", revenue_share_pct="revenue")
