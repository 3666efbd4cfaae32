from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import day, make_fact, tuples
from tillstar.operators import model, quality


@pytest.fixture(scope="module")
def tables(spark):
    """A small star with planted defects."""
    fact = make_fact(
        spark,
        [
            (1, "p", "2023-01-01", 5),
            (1, "p", "2023-01-02", 5),
            (8, "p", "2023-01-03", 5),  # unknown customer
            (9, "q", "2023-01-04", 5),  # unknown customer and product
            (2, "q", "2024-02-01", -5),  # after the calendar, unknown product, negative
            (2, "p", "2022-12-31", 5),  # before the calendar
        ],
    )
    repeated = fact.where("order_id = 'o0'")
    calendar = model.dim_calendar(
        spark.createDataFrame([(day("2023-06-01"),)], "event_date date")
    ).where(F.col("date") != day("2023-01-02"))  # a missing day inside the calendar
    stg_orders = spark.createDataFrame(
        [("view",), ("purchase",), ("click",), (None,)], "interaction_type string"
    )
    stg_products = spark.createDataFrame(
        [("p", Decimal("5.00")), ("q", None), ("r", Decimal("0.00"))],
        "product_id string, selling_price decimal(10,2)",
    )
    return {
        "raw.customers_raw": spark.range(5).toDF("x"),
        "raw.products_raw": spark.range(3).toDF("x"),
        "raw.orders_raw": spark.range(0).toDF("x"),
        "stg.stg_customers": spark.range(4).toDF("customer_id"),
        "stg.stg_products": stg_products,
        "stg.stg_orders": stg_orders,
        "core.dim_customer": spark.createDataFrame([(1,), (2,), (2,)], "customer_id int"),
        "core.dim_product": spark.createDataFrame([("p",)], "product_id string"),
        "core.dim_calendar": calendar,
        "core.fact_sales": fact.unionAll(repeated),
    }


def test_row_counts(tables):
    assert tuples(quality.row_counts(tables)) == [
        ("core.dim_calendar", 364),
        ("core.dim_customer", 3),
        ("core.dim_product", 1),
        ("core.fact_sales", 7),
        ("raw.customers_raw", 5),
        ("raw.orders_raw", 0),
        ("raw.products_raw", 3),
        ("stg.stg_customers", 4),
        ("stg.stg_orders", 4),
        ("stg.stg_products", 3),
    ]
    some = {"a": tables["core.fact_sales"], "b": tables["raw.orders_raw"]}
    assert tuples(quality.stage_counts(some)) == [("a", 7), ("b", 0)]


OFFENDERS = {
    "dupe_dim_customer": 1,
    "dupe_dim_product": 0,
    "dupe_fact_sales_order_id": 1,
    "fact→dim_customer_orphans": 2,
    "fact→dim_product_orphans": 2,
    "fact→dim_calendar_orphans": 3,
    "invalid_interaction_type": 2,
    "invalid_or_missing_price": 2,
    "negative_net_revenue": 1,
    "fact_dates_outside_calendar": 2,
}


@pytest.mark.parametrize("check", ["uniqueness", "referential", "domain", "temporal"])
def test_offenders(tables, check):
    got = dict(tuples(getattr(quality, check)(tables)))
    assert got == {name: OFFENDERS[name] for name in got}
    sizes = {"uniqueness": 3, "referential": 3, "domain": 3, "temporal": 1}
    assert len(got) == sizes[check]


def test_summary(tables):
    rows = tuples(quality.dq_summary(tables))
    assert len(rows) == 20
    assert [r[0] for r in rows] == sorted(r[0] for r in rows)
    values = {name: (value, passed) for name, value, passed in rows}
    for name, n in OFFENDERS.items():
        assert values[name] == (str(n), n == 0)
    assert values["rows_raw_orders"] == ("0", False)
    assert values["rows_fact_sales"] == ("7", True)
    assert values["rows_dim_customer"] == ("3", True)
    assert values["rows_stg_products"] == ("3", True)


def test_summary_of_nothing(tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    rows = tuples(quality.dq_summary(empty))
    assert len(rows) == 20
    assert {value for _, value, _ in rows} == {"0"}
    assert all(passed != name.startswith("rows_") for name, _, passed in rows)


def test_offender_sample(tables):
    sample = quality.offender_sample(tables["core.fact_sales"], "order_id", n=2)
    assert [r.order_id for r in sample.collect()] == ["o0", "o0"]
    assert quality.offender_sample(tables["core.fact_sales"]).count() == 5


def test_fact_profile(tables):
    assert tuples(quality.fact_profile(tables["core.fact_sales"])) == [
        ("fact_sales", "7"),
        ("distinct_customers", "4"),
        ("distinct_products", "2"),
        ("min_date", "2022-12-31"),
        ("max_date", "2024-02-01"),
    ]
