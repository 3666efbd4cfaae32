"""The views of the catalog: the same rows and plans as the operators, in any session."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.helpers import final_plan, initial_plan, tuples
from tillstar.operators import quality
from tillstar.plans import jobs, views
from tillstar.sinks.warehouse import MissingTableError, Warehouse


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A star in the catalog: a hot customer, ties in value, unknown regions, NULLs."""
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("views")), catalog=True)
    n = F.col("id")
    fact = spark.range(3000).select(
        F.concat(F.lit("o"), n).alias("order_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), (n * 7 % 700).cast("int")).alias("order_date"),
        F.when(n % 3 == 0, 1).when(n % 100 == 1, None).otherwise(n % 97 + 2).cast("int").alias("customer_id"),
        F.concat(F.lit("p"), n % 50).alias("product_id"),
        F.lit(1).alias("quantity"),
        *[F.lit(0).cast("decimal(10,2)").alias(c) for c in ("unit_price", "discount_amount", "tax_amount", "shipping_fee")],
        *[((n % 5) * 25 + 1).cast("decimal(12,2)").alias(c) for c in ("gross_item_value", "net_revenue")],
        F.when(n % 7 > 0, F.concat(F.lit("r"), n % 3)).alias("region"),
        F.when(n % 11 > 0, F.concat(F.lit("m"), n % 4)).alias("payment_method"),
        F.lit("2024-01-01").cast("timestamp").alias("created_at"),
    )
    people = spark.range(1, 80).select(
        n.cast("int").alias("customer_id"), F.lit("West").alias("region"), F.lit("cash").alias("payment_method")
    )
    goods = spark.range(50).select(
        F.concat(F.lit("p"), n).alias("product_id"), F.concat(F.lit("c"), n % 4).alias("product_category"),
        F.lit(1).cast("decimal(10,2)").alias("selling_price"),
    )
    orders = fact.select(
        F.col("customer_id").alias("user_id"), "product_id", F.lit("purchase").alias("interaction_type"),
        F.col("created_at").alias("event_ts"), F.col("order_date").alias("event_date"),
        (F.year("order_date") == 2024).cast("int").alias("in_2024"),
    )
    from tillstar.operators import model

    found = wh.write_all(
        {
            "core.fact_sales": fact,
            "core.dim_customer": people,
            "core.dim_product": goods,
            "core.dim_calendar": model.dim_calendar(orders),
            "stg.stg_orders": orders,
            "stg.stg_products": goods.union(spark.sql("SELECT 'x', 'c', CAST(NULL AS DECIMAL(10,2))")),
            "stg.stg_customers": people,
            "raw.customers_raw": people,
            "raw.products_raw": goods,
            "raw.orders_raw": orders.limit(0),
        }
    )
    views.create_views(spark)
    return found


def shape(df) -> Counter:
    """How often each costly step occurs in a plan."""
    steps = r"(HashAggregate|SortAggregate|ObjectHashAggregate|Exchange|BroadcastExchange|SortMergeJoin|BroadcastHashJoin|Window|WindowGroupLimit|FileScan|Generate|Expand) "
    return Counter(re.findall(steps, initial_plan(df)))


KPI = [name for name in views.VIEWS if name.startswith("core.") and name != "core.v_dq_summary"]


def test_quality_summary(spark, tables):
    frame, view = quality.dq_summary(tables), spark.table("core.v_dq_summary")
    assert tuples(view) == tuples(frame) and view.dtypes == frame.dtypes
    failed = {r.metric for r in view.where("NOT pass").collect()}
    assert failed == {"rows_raw_orders", "invalid_or_missing_price", "fact→dim_customer_orphans"}
    plan = final_plan(view)
    assert len(re.findall(r"FileScan parquet \S*core.fact_sales", plan)) == 1


@pytest.mark.parametrize("name", KPI)
def test_rows_equal_the_operator(spark, tables, name):
    frame = jobs.kpi_views(tables)[name.split(".")[1]]
    view = spark.table(name)
    assert view.columns == frame.columns
    assert view.dtypes == frame.dtypes
    assert sorted(map(str, tuples(view))) == sorted(map(str, tuples(frame)))
    assert view.count() > 0


@pytest.mark.parametrize("name", KPI)
def test_plan_has_the_steps_of_the_operator(spark, tables, no_broadcast, name):
    frame = jobs.kpi_views(tables)[name.split(".")[1]]
    assert shape(spark.table(name)) == shape(frame)


def test_orders_of_2024(spark, tables):
    view = spark.table("stg.v_stg_orders_2024")
    assert view.count() == tables["stg.stg_orders"].where("in_2024 = 1").count() > 0


def test_another_session_reads_them(spark, tables):
    other = spark.newSession()
    for name in views.VIEWS:
        assert other.sql(f"SELECT * FROM {name}").count() > 0
    # a view follows its tables
    before = other.table("core.v_sales_by_region").count()
    assert before == spark.table("core.v_sales_by_region").count()


def test_views_need_their_tables(spark, tables, monkeypatch):
    monkeypatch.setattr(views, "_CORE", ["core.nowhere"])
    with pytest.raises(MissingTableError, match="core.nowhere"):
        views.create_views(spark)
