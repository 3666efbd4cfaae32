"""Raw text to typed, normalised staging rows. No operator here shuffles by itself,
apart from the two orphan checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar import schemas
from tillstar.functions import clock, domains, money, text
from tillstar.operators import rejects


def _canonical(raw: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename raw headers; a frame that already has the short names passes through."""
    return raw.withColumnsRenamed(names)


def judge_customers(raw: DataFrame) -> DataFrame:
    """Every customer row, typed, with the reason why it goes or a value of it does."""
    c = _canonical(raw, schemas.CUSTOMER_COLUMNS)
    location = text.title_case(text.blank_to_null(F.col("location")))
    number = {
        name: text.blank_to_null(F.col(name))
        for name in ("customer_id", "age", "previous_purchases")
    }
    typed = {name: text.digits_to_int(column) for name, column in number.items()}
    too_large = [
        (text.too_large_for_int(column), f"{name}_too_large", column)
        for name, column in number.items()
    ]
    missing = typed["customer_id"].isNull() & ~F.coalesce(too_large[0][0], F.lit(False))
    return c.select(
        typed["customer_id"].alias("customer_id"),
        domains.plausible_age(typed["age"]).alias("age"),
        domains.gender(text.lower_token(F.col("gender"))).alias("gender"),
        F.coalesce(location, F.lit("Unknown")).alias("location"),
        domains.payment_method(text.lower_token(F.col("payment_method"))).alias("payment_method"),
        domains.subscription(text.lower_token(F.col("subscription_status"))).alias(
            "subscription_status"
        ),
        typed["previous_purchases"].alias("previous_purchases"),
        *rejects.first_reason((missing, "no_customer_id", F.col("customer_id")), *too_large),
    )


def clean_customers(raw: DataFrame) -> DataFrame:
    return rejects.passing(judge_customers(raw), "stg.stg_customers")


def judge_products(raw: DataFrame) -> DataFrame:
    """Every product row, typed, with the reason why it goes or its price does."""
    p = _canonical(raw, schemas.PRODUCT_COLUMNS)

    def plain(name):
        return text.blank_to_null(F.col(name)).alias(name)

    price_text = text.blank_to_null(F.col("selling_price"))
    return p.select(
        plain("product_id"),
        plain("product_name"),
        text.leftmost_label(F.col("product_category"), "Other").alias("product_category"),
        money.first_price(price_text).alias("selling_price"),
        plain("brand_name"),
        plain("model_number"),
        plain("image_url"),
        plain("product_url"),
        domains.seller_flag(text.upper_token(F.col("is_amazon_seller"))).alias("is_amazon_seller"),
        *rejects.first_reason(
            (text.blank_to_null(F.col("product_id")).isNull(), "no_product_id", F.col("product_id")),
            (money.too_large_price(price_text), "price_too_large", price_text),
        ),
    )


def clean_products(raw: DataFrame) -> DataFrame:
    return rejects.passing(judge_products(raw), "stg.stg_products")


def _order_parts(raw: DataFrame) -> DataFrame:
    o = _canonical(raw, schemas.ORDER_COLUMNS)
    user = text.blank_to_null(F.col("user_id"))
    return o.select(
        user.alias("_user"),
        text.digits_to_int(user).alias("user_id"),
        text.blank_to_null(F.col("product_id")).alias("product_id"),
        text.lower_token(F.col("interaction_type")).alias("_said"),
        text.blank_to_null(F.col("event_ts")).alias("_when"),
    )


def _is_whole() -> Column:
    """What a log row needs besides a time, which is dearer to look at."""
    return (
        domains.is_interaction(F.col("_said"))
        & F.col("product_id").isNotNull()
        & F.col("user_id").isNotNull()
    )


def _with_times(walls: DataFrame, tz: str) -> DataFrame:
    dated = walls.withColumn("event_date", clock.utc_date(F.col("_wall")))
    return clock.with_instant(dated, "_wall", "event_ts", tz)


def _order_columns() -> list[Column]:
    return [
        F.col("user_id"),
        F.col("product_id"),
        domains.interaction(F.col("_said")).alias("interaction_type"),
        F.col("event_ts"),
        F.col("event_date"),
        (F.year("event_date") == 2024).cast("int").alias("in_2024"),
    ]


def judge_orders(raw: DataFrame, tz: str = clock.LONDON) -> DataFrame:
    """Every log row, typed, with the reason why it goes. Event text is wall time in tz."""
    wall = F.when(_is_whole(), clock.read_wall(F.col("_when")))
    return _with_times(_order_parts(raw).withColumn("_wall", wall), tz).select(
        *_order_columns(),
        *rejects.first_reason(
            (text.too_large_for_int(F.col("_user")), "user_id_too_large", F.col("_user")),
            (F.col("user_id").isNull(), "no_user_id", F.col("_user")),
            (F.col("product_id").isNull(), "no_product_id", F.col("product_id")),
            (domains.not_an_interaction(F.col("_said")), "no_interaction", F.col("_said")),
            (F.col("_when").isNull(), "no_event_time", F.col("_when")),
            (F.col("_wall").isNull(), "bad_event_time", F.col("_when")),
        ),
    )


def clean_orders(raw: DataFrame, tz: str = clock.LONDON) -> DataFrame:
    """Log rows with a user, a product, a known interaction and a real date."""
    walls = _order_parts(raw).where(_is_whole()).withColumn("_wall", clock.read_wall(F.col("_when")))
    return _with_times(walls.where(F.col("_wall").isNotNull()), tz).select(_order_columns())


def orders_in_2024(stg_orders: DataFrame) -> DataFrame:
    return stg_orders.where(F.col("in_2024") == 1)


def purchases(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("interaction_type") == "purchase")


def dq_invalid_price(stg_products: DataFrame) -> DataFrame:
    return stg_products.where(money.is_bad_price(F.col("selling_price")))


def dq_orphans_products(orders: DataFrame, stg_products: DataFrame) -> DataFrame:
    """Purchases of a product that staging does not know. Pass the 2024 orders for the
    standard helper table, or all orders to look at every year."""
    return purchases(orders).join(stg_products.select("product_id"), "product_id", "left_anti")[
        orders.columns
    ]


def dq_orphans_customers(orders: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Purchases by a customer that staging does not know."""
    known = stg_customers.select(F.col("customer_id").alias("user_id"))
    return purchases(orders).join(known, "user_id", "left_anti")[orders.columns]
