from __future__ import annotations

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import FACT, day, make_fact, money, tuples
from tillstar.operators.distinct import count_distinct, with_distinct
from tillstar.operators import feeds, kpi, model, ranking

PEOPLE = "customer_id int, region string, payment_method string"


@pytest.fixture(scope="module")
def sales(spark):
    """A random fact in which one customer and one product hold a third of all lines."""
    rng = random.Random(7)
    lines = []
    for _ in range(900):
        hot = rng.random() < 1 / 3
        customer = 1 if hot else rng.randint(2, 60)
        product = "p1" if rng.random() < 1 / 3 else f"p{rng.randint(2, 40)}"
        when = f"{rng.choice([2022, 2023])}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
        lines.append((customer, product, when, f"{rng.randint(1, 40)}.{rng.choice(['00', '50'])}"))
    return lines, make_fact(spark, lines)


def by_customer(lines):
    groups = defaultdict(list)
    for customer, _, when, revenue in lines:
        groups[customer].append((day(when), money(revenue)))
    return {c: sorted(v) for c, v in groups.items()}


def dense_ranks(values):
    order = {v: i + 1 for i, v in enumerate(sorted(set(values), reverse=True))}
    return [order[v] for v in values]


def test_headline_of_nothing(spark):
    empty = spark.createDataFrame([], FACT)
    zero = Decimal("0.00")
    assert tuples(kpi.kpi_headline(empty)) == [(0, 0, 0, zero, zero, None, None)]
    assert tuples(feeds.feed_headline(kpi.kpi_headline(empty))) == [(0, 0, 0, 0.0, 0.0, "", "")]


def test_headline(sales):
    lines, fact = sales
    (row,) = tuples(kpi.kpi_headline(fact))
    total = sum(money(x[3]) for x in lines)
    assert row[0] == len(lines)
    assert row[1:3] == (len({x[0] for x in lines}), len({x[1] for x in lines}))
    assert row[3] == total
    assert row[5:] == (min(day(x[2]) for x in lines), max(day(x[2]) for x in lines))


def test_top_customers_ltv(spark, sales):
    lines, fact = sales
    groups = by_customer(lines)
    people = spark.createDataFrame([(c, "West", "cash") for c in groups if c != 5], PEOPLE)
    got = {r.customer_id: r for r in kpi.top_customers_ltv(fact, people).collect()}
    ltv = {c: sum(x[1] for x in v) for c, v in groups.items()}
    ranks = dict(zip(ltv, dense_ranks(list(ltv.values()))))
    assert {c: (r.ltv, r.ltv_rank) for c, r in got.items()} == {c: (ltv[c], ranks[c]) for c in ltv}
    assert all(
        (r.first_order_date, r.last_order_date, r.orders_count)
        == (groups[c][0][0], groups[c][-1][0], len(groups[c]))
        for c, r in got.items()
    )
    assert got[5].region is None and got[6].region == "West"

    top = kpi.top_customers(fact, people, 10)
    best = sorted(ltv, key=lambda c: (-ltv[c], c))[:10]
    assert [(r.customer_id, r.ltv, r.ltv_rank) for r in top.collect()] == [
        (c, ltv[c], ranks[c]) for c in best
    ]


def test_published_ranks(spark):
    values = ["199.95", "182.00", "179.99", "179.99", "179.00", "99.99", "99.99", "99.99", "99.65"]
    fact = make_fact(spark, [(i, "p", "2023-01-01", v) for i, v in enumerate(values)])
    people = spark.createDataFrame([], PEOPLE)
    ranked = kpi.top_customers_ltv(fact, people).orderBy("customer_id")
    assert [r.ltv_rank for r in ranked.collect()] == [1, 2, 3, 3, 4, 5, 5, 5, 6]


def test_dense_rank_across_bands_and_zones(spark):
    rng = random.Random(3)
    values = [Decimal(rng.randint(-(10**6), 10 ** rng.randint(2, 16))) / 100 for _ in range(400)]
    values += values[:50] + [Decimal("0.00"), Decimal("-0.01"), Decimal("10000.00")]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v decimal(22,2)")
    ranked = ranking.with_dense_rank(df, df, "v", "r", spread_by=["i"])
    got = {r.i: r.r for r in ranked.collect()}
    assert [got[i] for i in range(len(values))] == dense_ranks(values)


def test_a_null_value_keeps_its_row(spark):
    df = spark.createDataFrame([(1, Decimal("1.00")), (2, None)], "i int, v decimal(22,2)")
    ranked = ranking.with_dense_rank(df, df, "v", "r", spread_by=["i"]).orderBy("i")
    assert [(r.i, r.r) for r in ranked.collect()] == [(1, 1), (2, None)]


def test_breakdowns_add_up(spark, sales):
    lines, fact = sales
    total, n = sum(money(x[3]) for x in lines), len(lines)
    items = spark.createDataFrame(
        [(f"p{i}", f"c{i % 7}") for i in range(1, 41)], "product_id string, product_category string"
    )
    days = model.dim_calendar(fact.select(F.col("order_date").alias("event_date")))
    for view in (
        kpi.sales_by_category(fact, items),
        kpi.sales_by_region(fact),
        kpi.payment_mix(fact),
        kpi.seasonality_monthly(fact, days),
        kpi.new_vs_repeat(fact),
    ):
        rows = view.collect()
        assert sum(r.orders for r in rows) == n
        assert sum(r.revenue for r in rows) == total
        for share in [c for c in view.columns if c.endswith("share_pct")]:
            assert abs(sum(r[share] for r in rows) - 100) <= Decimal("0.01") * len(rows)


def test_missing_labels(spark):
    fact = make_fact(spark, [(1, "p", "2023-01-01", 5, None, None), (2, "p", "2023-01-01", 15)])
    by_region = {r.region: r for r in kpi.sales_by_region(fact).collect()}
    assert by_region["Unknown"].revenue_share_pct == Decimal("25.00")
    mix = {r.payment_method: r for r in kpi.payment_mix(fact).collect()}
    assert mix["other"].aov == Decimal("5.00") and mix["cash"].orders == 1


def test_share_of_nothing_is_null(spark):
    fact = make_fact(spark, [(1, "p", "2023-01-01", 0)])
    (row,) = kpi.sales_by_region(fact).collect()
    assert row.revenue_share_pct is None


def test_category_needs_a_product(spark):
    fact = make_fact(spark, [(1, "p", "2023-01-01", 5), (1, "gone", "2023-01-01", 15)])
    items = spark.createDataFrame([("p", "Toys")], "product_id string, product_category string")
    assert tuples(kpi.sales_by_category(fact, items)) == [("Toys", 1, money(5), money(100))]


def test_seasonality(spark):
    fact = make_fact(
        spark,
        [(1, "p", "2022-12-28", "10.00"), (2, "p", "2022-12-30", "10.01"), (1, "p", "2023-06-01", 7)],
    )
    days = model.dim_calendar(fact.select(F.col("order_date").alias("event_date")))
    months = kpi.seasonality_monthly(fact, days)
    assert tuples(months.orderBy("year", "month")) == [
        (2022, 12, "Dec", 4, "Winter", 2, money("20.01"), money("10.01")),
        (2023, 6, "Jun", 2, "Summer", 1, money(7), money(7)),
    ]
    feed = feeds.feed_monthly(months).collect()
    assert [r.date for r in feed] == [day("2022-12-01"), day("2023-06-01")]
    assert feed[0].revenue == 20.01


def test_new_and_repeat(spark):
    fact = make_fact(
        spark,
        [
            (1, "a", "2023-01-01", 10),
            (1, "b", "2023-01-01", 20),
            (1, "a", "2023-02-01", 30),
            (2, "a", "2023-03-01", 40),
        ],
    )
    marked = kpi.order_new_repeat(fact).orderBy("order_id")
    assert [r.customer_order_type for r in marked.collect()] == ["new", "new", "repeat", "new"]
    assert marked.columns == fact.columns + ["customer_order_type"]
    split = kpi.new_vs_repeat(fact)
    assert tuples(split.orderBy("customer_order_type")) == [
        ("new", 3, money(70), money(75), money(70)),
        ("repeat", 1, money(30), money(25), money(30)),
    ]
    assert tuples(feeds.feed_new_vs_repeat(split)) == [(75.0, 25.0, 70.0, 30.0)]


def test_new_vs_repeat_without_repeats(spark):
    fact = make_fact(spark, [(1, "a", "2023-01-01", 10), (2, "a", "2023-01-02", 10)])
    split = kpi.new_vs_repeat(fact)
    assert tuples(split) == [("new", 2, money(20), money(100), money(100))]
    assert tuples(feeds.feed_new_vs_repeat(split)) == [(100.0, 0.0, 100.0, 0.0)]


def test_order_types_of_a_hot_customer(sales):
    lines, fact = sales
    firsts = {c: v[0][0] for c, v in by_customer(lines).items()}
    got = kpi.order_new_repeat(fact).collect()
    assert len(got) == len(lines)
    assert all(
        r.customer_order_type == ("new" if r.order_date == firsts[r.customer_id] else "repeat")
        for r in got
    )
    first = {r.customer_id: r.first_purchase_date for r in kpi.customer_first_purchase(fact).collect()}
    assert first == firsts


def test_repeat_windows(spark):
    fact = make_fact(
        spark,
        [
            (1, "a", "2023-01-01", 1),
            (1, "a", "2023-01-31", 1),
            (1, "a", "2023-12-31", 1),
            (2, "a", "2023-01-01", 1),
            (2, "a", "2023-02-01", 1),
            (3, "a", "2023-01-01", 1),
            (4, "a", "2023-01-01", 1),
            (4, "b", "2023-01-01", 1),
        ],
    )
    first = day("2023-01-01")
    assert tuples(kpi.customer_repeat_windows(fact).orderBy("customer_id")) == [
        (1, first, day("2023-01-31"), 30, True, True, True),
        (2, first, day("2023-02-01"), 31, False, True, True),
        (3, first, None, None, None, None, None),
        (4, first, first, 0, True, True, True),
    ]


def test_feeds(spark):
    top = spark.createDataFrame(
        [(i, money(10 - i // 2), i) for i in range(14)], "customer_id int, ltv decimal(22,2), ltv_rank int"
    )
    feed = feeds.feed_top_customers(top).collect()
    assert [r.customer_id for r in feed] == [str(i) for i in range(9, -1, -1)]
    assert feed[-1].ltv == 10.0

    messy = spark.createDataFrame([("1.5", "a"), ("x", "b")], "revenue string, region string")
    numbers = feeds.ensure_numeric(messy, ["revenue", "missing"])
    assert tuples(numbers) == [(1.5, "a"), (None, "b")]
    assert [r.region for r in feeds.feed_sorted(messy).collect()] == ["a", "b"]


@pytest.mark.parametrize("kind", ["int", "long", "string"])
def test_distinct_counts(spark, kind):
    ids = [None, -5, 0, 1, 1, 32767, 32768, 32769, 2_000_000_000, 2_000_000_000]
    df = spark.createDataFrame([(i,) for i in ids], "k long").select(F.col("k").cast(kind))
    one = spark.range(1)
    assert one.select(count_distinct(df, "k")).first()[0] == 7
    assert one.select(count_distinct(df.limit(0), "k")).first()[0] == 0
    totals = with_distinct(df, "k", "keys", {"n": (F.count(F.lit(1)), F.sum("n"))}).first()
    assert (totals.keys, totals.n) == (7, 10)
