"""Rows that do not pass: their reasons, their counts, and what stops a build."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest

from tests.helpers import tuples
from tests.test_jobs import CUSTOMERS, ORDERS, PRODUCTS, write_csv
from tillstar import schemas
from tillstar.operators import clean, model, rejects
from tillstar.plans import jobs
from tillstar.sinks.warehouse import scratch
from tillstar.sources import extracts
from tillstar.sources.regions import dim_region

ORDER = "user_id string, product_id string, interaction_type string, event_ts string"
LOG = [
    ("1", "p1", "purchase", "1/1/2024 8:00:59 PM", None),
    ("1", "p1", "view", "1/1/2024", None),
    (" ", "p1", "view", "1/1/2024 8:00", "no_user_id"),
    ("x1", "p1", "view", "1/1/2024 8:00", "no_user_id"),
    ("4000000000", "p1", "view", "1/1/2024 8:00", "user_id_too_large"),
    ("1", " ", "view", "1/1/2024 8:00", "no_product_id"),
    ("1", "p1", "click", "1/1/2024 8:00", "no_interaction"),
    ("1", "p1", None, "1/1/2024 8:00", "no_interaction"),
    ("1", "p1", "like", "", "no_event_time"),
    ("1", "p1", "like", "31/2/2024 8:00", "bad_event_time"),
    # the first reason counts
    ("", "", "click", "never", "no_user_id"),
]


def reasons(judged) -> dict:
    counts = Counter(r.reason for r in rejects.rejected(judged).collect())
    return dict(counts)


def test_reasons_of_log_rows(spark):
    raw = spark.createDataFrame([r[:4] for r in LOG], ORDER)
    judged = clean.judge_orders(raw)
    assert reasons(judged) == Counter(r[4] for r in LOG if r[4])
    assert judged.count() == len(LOG)
    passed = rejects.passing(judged, "stg.stg_orders")
    assert passed.count() == 2
    assert sorted(map(str, tuples(passed))) == sorted(map(str, tuples(clean.clean_orders(raw))))
    assert passed.columns == clean.clean_orders(raw).columns
    said = {r.reason: r.culprit for r in rejects.rejected(judged).collect()}
    assert said["bad_event_time"] == "31/2/2024 8:00" and said["user_id_too_large"] == "4000000000"


def test_reasons_of_customers_and_products(spark):
    rows = [("1", "30", "2"), ("", "1", "1"), ("9" * 11, "1", "1"), ("2", "9" * 11, "1"), ("3", "1", "9" * 11), ("4", "x", "y")]
    raw = spark.createDataFrame(rows, "customer_id string, age string, previous_purchases string")
    for name in ("gender", "location", "payment_method", "subscription_status"):
        raw = raw.withColumn(name, raw.age)
    judged = clean.judge_customers(raw)
    expected = ["no_customer_id", "customer_id_too_large", "age_too_large", "previous_purchases_too_large"]
    assert reasons(judged) == dict.fromkeys(expected, 1)
    # a value that is lost does not take its row along
    assert [r.customer_id for r in clean.clean_customers(raw).orderBy("customer_id").collect()] == [1, 2, 3, 4]

    rows = [("p1", "$99,999,999.99"), ("p2", "100000000.00"), (" ", "100000000"), ("p3", "free"), ("p4", None)]
    raw = spark.createDataFrame(rows, "product_id string, selling_price string")
    others = ["product_name", "product_category", "brand_name", "model_number", "image_url", "product_url", "is_amazon_seller"]
    for name in others:
        raw = raw.withColumn(name, raw.product_id)
    assert reasons(clean.judge_products(raw)) == {"price_too_large": 1, "no_product_id": 1}
    assert clean.clean_products(raw).count() == 4


@pytest.fixture
def star(spark):
    """Purchases of an unlisted, an unpriced and a twice listed product, and by a stranger."""
    rows = [
        ("1", "p1", "purchase", "1/1/2024 8:00"),
        ("1", "p1", "view", "1/1/2024 9:00"),
        ("1", "p2", "purchase", "1/1/2024 8:00"),
        ("1", "p3", "purchase", "1/1/2024 8:00"),
        ("9", "p1", "purchase", "1/1/2024 8:00"),
        ("9", "p3", "purchase", "1/1/2024 8:00"),
    ]
    orders = clean.clean_orders(spark.createDataFrame(rows, ORDER))
    listed = [("p1", "5"), ("p1", None), ("p2", "0.00"), ("p2", None)]
    products = spark.createDataFrame(listed, "product_id string, selling_price string").selectExpr(
        "product_id", "CAST(NULL AS STRING) AS product_name", "'Toys' AS product_category", "CAST(selling_price AS DECIMAL(10,2)) AS selling_price"
    )
    customers = spark.createDataFrame([(1, None, "male", "Ohio", "cash", "yes", None)], schemas.STG_CUSTOMERS)
    dims = model.dim_product(products), model.dim_customer(customers, dim_region(spark), orders), model.dim_calendar(orders)
    return orders, products, *dims


def test_reasons_of_lost_purchases(spark, star):
    orders, products, *dims = star
    judged = model.judge_sales(orders, products, *dims)
    assert reasons(judged) == {"unknown_product": 2, "no_price": 1, "unknown_customer": 1}
    # every purchase once, however often its product is listed
    assert judged.count() == 5
    passed = rejects.passing(judged, "core.fact_sales").drop("created_at")
    assert tuples(passed) == tuples(model.fact_sales(orders, *dims).drop("created_at"))


def test_a_day_outside_the_calendar(spark, star):
    orders, products, product, customer, calendar = star
    judged = model.judge_sales(orders, products, product, customer, calendar.where("date > '2024-01-01'"))
    assert reasons(judged)["no_calendar_day"] == 1


def test_counted_while_written(spark):
    raw = spark.createDataFrame([r[:4] for r in LOG], ORDER)
    judged, counts = rejects.observed(clean.judge_orders(raw), "stg.stg_orders")
    stored = scratch(spark).write(rejects.passing(judged, "stg.stg_orders"), "stg.stg_orders")
    assert stored.count() == 2
    seen = rejects.losses_of(spark, {"stg.stg_orders": counts})
    assert tuples(seen) == tuples(rejects.losses({"stg.stg_orders": clean.judge_orders(raw)}))
    assert sum(r.rows for r in seen.collect()) == len(LOG) - 2


def test_no_rows_no_losses(spark):
    judged = clean.judge_orders(spark.createDataFrame([], ORDER))
    assert {r.rows for r in rejects.losses({"stg.stg_orders": judged}).collect()} == {0}


def source(folder: Path, **extra) -> str:
    """The extracts of test_jobs with some more rows."""
    folder.mkdir()
    more = {"customers": [], "products": [], "orders": []} | extra
    write_csv(folder / extracts.CUSTOMERS_FILE, schemas.CUSTOMER_COLUMNS, CUSTOMERS + more["customers"])
    write_csv(folder / extracts.PRODUCTS_FILE, schemas.PRODUCT_COLUMNS, PRODUCTS + more["products"])
    write_csv(folder / extracts.ORDERS_FILE, schemas.ORDER_COLUMNS, ORDERS + more["orders"])
    return str(folder)


def log_row(user="1", product="p1", kind="purchase", when="1/2/2024 8:00"):
    return {"user id": user, "product id": product, "Interaction type": kind, "Time stamp": when}


@pytest.mark.parametrize(
    "extra, said",
    [
        ({"orders": [log_row(when="31/2/2024 8:00")]}, "bad_event_time 31/2/2024 8:00"),
        ({"orders": [log_row(user="4000000000")]}, "user_id_too_large 4000000000"),
        ({"customers": [{"Customer ID": "5", "Age": "30000000000"}]}, "age_too_large 30000000000"),
        ({"products": [{"Uniqe Id": "p9", "Selling Price": "$100000000.00"}]}, "price_too_large"),
    ],
)
def test_an_unreadable_value_stops_a_build(spark, tmp_path, extra, said):
    src = source(tmp_path / "in", **extra)
    with pytest.raises(Exception, match=f"bad row: {said}".replace("$", r"\$")):
        jobs.build(spark, src, str(tmp_path / "out"))
    built = jobs.build(spark, src, str(tmp_path / "out"), on_bad_row="report")
    lost = {r.reason: r.rows for r in built.losses.collect()}
    assert lost[said.split()[0]] == 1
    assert lost["no_price"] == lost["unknown_customer"] == 1 and lost["no_user_id"] == 1
    assert spark.table("core.fact_sales").count() == 3


def test_on_bad_row_has_two_values(spark):
    with pytest.raises(ValueError, match="raise or report"):
        rejects.stopping(spark.range(1), "ignore")
