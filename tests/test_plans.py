"""Plans that must hold when tables no longer fit a broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.helpers import final_plan, initial_plan
from tillstar.operators import clean, kpi, model, quality, skew
from tillstar.plans import registry
from tillstar.session import SETTINGS
from tillstar.sinks.warehouse import scratch
from tillstar.sources.regions import dim_region


@pytest.fixture(scope="module")
def stored(spark):
    """A stored star in which customer 1 and product p1 hold a third of 30 000 lines."""
    n = 30_000
    wh = scratch(spark)
    third = F.col("id") % 3 == 0
    orders = spark.range(n).select(
        F.when(third, 1).otherwise(F.col("id") % 997).cast("int").alias("user_id"),
        F.concat(F.lit("p"), F.when(third, 1).otherwise(F.col("id") % 499)).alias("product_id"),
        F.lit("purchase").alias("interaction_type"),
        F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 3600).alias("event_ts"),
        F.date_add(F.lit("2020-09-13").cast("date"), (F.col("id") / 24).cast("int")).alias(
            "event_date"
        ),
        F.lit(0).alias("in_2024"),
    )
    customers = spark.range(997).select(
        F.col("id").cast("int").alias("customer_id"),
        F.lit("West").alias("region"),
        F.lit("cash").alias("payment_method"),
    )
    products = spark.range(499).select(
        F.concat(F.lit("p"), F.col("id")).alias("product_id"),
        F.lit("Toys").alias("product_category"),
        (F.col("id") + 1).cast("decimal(10,2)").alias("selling_price"),
    )
    t = wh.write_all(
        {
            "stg.stg_orders": orders.repartition(8),
            "core.dim_customer": customers,
            "core.dim_product": products,
            "core.dim_calendar": model.dim_calendar(orders),
        }
    )
    fact = model.fact_sales(
        t["stg.stg_orders"], t["core.dim_product"], t["core.dim_customer"], t["core.dim_calendar"]
    )
    t["core.fact_sales"] = wh.write(fact.repartition(8), "core.fact_sales")
    return t


@pytest.fixture
def small_skew(spark):
    """Thresholds at which the test's hot keys count as hot."""
    new = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_fact_joins_split_hot_keys(stored, no_broadcast, small_skew):
    fact = model.fact_sales(
        stored["stg.stg_orders"],
        stored["core.dim_product"],
        stored["core.dim_customer"],
        stored["core.dim_calendar"],
    )
    assert final_plan(fact).count("SortMergeJoin(skew=true)") >= 2
    assert fact.count() == 30_000


def test_hash_joins_split_hot_keys_too(spark, stored, no_broadcast, small_skew):
    """With the recommended settings the thin sides are hashed, not sorted."""
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    spark.conf.set(key, SETTINGS[key])
    try:
        fact = model.fact_sales(
            stored["stg.stg_orders"],
            stored["core.dim_product"],
            stored["core.dim_customer"],
            stored["core.dim_calendar"],
        )
        assert final_plan(fact).count("ShuffledHashJoin(skew=true)") >= 2
    finally:
        spark.conf.unset(key)


def test_fact_reads_only_purchases_and_needed_columns(stored):
    fact = model.fact_sales(
        stored["stg.stg_orders"],
        stored["core.dim_product"],
        stored["core.dim_customer"],
        stored["core.dim_calendar"],
    )
    plan = initial_plan(fact)
    assert "EqualTo(interaction_type,purchase)" in plan
    assert "GreaterThan(selling_price,0.00)" in plan
    assert "product_category" not in plan
    assert "LeftSemi" in plan and "CartesianProduct" not in plan


def test_first_dates_meet_orders_over_salted_keys(stored, no_broadcast, small_skew):
    plan = final_plan(kpi.order_new_repeat(stored["core.fact_sales"]))
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    joined = [x for x in shuffles if re.search(r"Exchange hashpartitioning\(customer_id#\w+, _salt#\w+,", x)]
    # the lines and the first dates; the minima are worked out on the lines' own shuffle
    assert sum("Reused" not in x for x in joined) == 2
    assert sum("Reused" in x for x in joined) == 1
    assert "Window" not in plan


def test_new_or_repeat_works_the_fact_out_once(stored, no_broadcast):
    fact = model.fact_sales(
        stored["stg.stg_orders"],
        stored["core.dim_product"],
        stored["core.dim_customer"],
        stored["core.dim_calendar"],
    )
    plan = final_plan(kpi.order_new_repeat(fact))
    assert len(re.findall(r"FileScan parquet \[user_id", plan)) == 1
    # salts go back to the customers that have them; nothing is copied for every salt
    assert "explode(_salts" in plan and "sequence(" not in plan


def test_a_hot_customer_is_spread(spark, stored, no_broadcast):
    fact = stored["core.fact_sales"]
    marked = kpi.order_new_repeat(fact)
    assert marked.count() == 30_000
    places = skew.salt(["order_id", "product_id", "order_date"])
    spread = fact.where("customer_id = 1").groupBy(places).count().collect()
    assert len(spread) == skew.SALTS and max(r["count"] for r in spread) < 2 * 10_000 / skew.SALTS


def test_distinct_counts_expand_nothing(stored, no_broadcast):
    for view in (kpi.kpi_headline, quality.fact_profile):
        plan = final_plan(view(stored["core.fact_sales"]))
        # but for the one row of figures, which becomes five
        assert not re.search(r"Expand \[\[(?!fact_sales,)", plan)
        assert "bitmap_construct_agg" in plan
        # a row per range of ids, not per customer
        assert not re.search(r"Exchange hashpartitioning\(customer_id#", plan)


def test_only_hot_values_are_broadcast(spark, no_broadcast):
    """A third of all customers have one value; the ranks of no other one are copied."""
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("decimal(22,2)").alias("v"))
    counted = rows.groupBy("v").agg(F.count(F.lit(1)).alias("n")).withColumn("twice", F.col("v") * 2)
    joined = skew.split_join(rows, counted, "v", "n", F.lit(9000), ["id"])
    plan = final_plan(joined)
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in plan
    got = joined.where("twice = 2 * v").count()
    assert got == 9000 and joined.columns == ["id", "v", "twice"]
    assert counted.where("n * 1000 > 9000").count() == 1


def test_split_join_keeps_rows_without_a_match(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "id int, k string")
    per_key = spark.createDataFrame([("a", 2, 1.5), ("c", 1, 2.5)], "k string, n long, x double")
    for total in (2, 10**9):  # all keys hot, none
        joined = skew.split_join(rows, per_key, "k", "n", F.lit(total), ["id"])
        assert sorted((r.id, r.x) for r in joined.collect()) == [(1, 1.5), (2, None), (3, None), (4, 1.5)]


def test_at_most_two_rows_per_customer_leave_a_map_task(stored, no_broadcast):
    plan = final_plan(kpi.customer_repeat_windows(stored["core.fact_sales"]))
    assert "row_number(), 2, Partial" in plan
    assert plan.count("Exchange ") == 1


def test_ranking_reads_the_fact_once(stored, no_broadcast):
    ranked = kpi.top_customers_ltv(stored["core.fact_sales"], stored["core.dim_customer"])
    plan = final_plan(ranked)
    assert len(re.findall(r"FileScan parquet \[.*net_revenue", plan)) == 1
    assert plan.count("ReusedExchange") >= 3


@pytest.mark.parametrize("view", ["sales_by_category", "sales_by_region", "new_vs_repeat"])
def test_shares_reuse_the_grouping(stored, no_broadcast, view):
    dims = [stored["core.dim_product"]] if view == "sales_by_category" else []
    plan = final_plan(getattr(kpi, view)(stored["core.fact_sales"], *dims))
    scans = re.findall(r"FileScan parquet \[.*net_revenue", plan)
    assert len(scans) == 1 and "ReusedExchange" in plan
    # the grand total is no window over everything
    assert not re.search(r"Window \[sum\(", plan)


def test_category_groups_before_it_joins(stored, no_broadcast):
    plan = final_plan(kpi.sales_by_category(stored["core.fact_sales"], stored["core.dim_product"]))
    join = plan.index("SortMergeJoin")
    assert "keys=[product_id" in plan[join:]


def test_top_n_sorts_n_rows_per_task(stored, no_broadcast):
    plan = final_plan(kpi.top_customers(stored["core.fact_sales"], stored["core.dim_customer"], 10))
    assert "TakeOrderedAndProject(limit=10" in plan


def test_orphan_checks_group_before_they_join(stored, no_broadcast):
    plan = initial_plan(quality.referential(stored))
    assert plan.count("LeftOuter") == 1
    for text in re.findall(r"LeftOuter\n(?:.*\n){12}", plan):
        assert "HashAggregate(keys=[" in text


def test_all_checks_read_the_fact_once(spark, stored, no_broadcast):
    names = [t for t in quality.COUNTED_TABLES if t not in stored]
    tables = stored | {t: spark.range(1).select("id", F.lit(1).alias("selling_price")) for t in names}
    plan = final_plan(quality.dq_summary(tables))
    # only the fact has an order_id
    assert len(re.findall(r"FileScan parquet \[[^\]]*order_id", plan)) == 1
    assert len(re.findall(r"FileScan parquet \[[^\]]*net_revenue", plan)) == 1


def test_bounds_come_from_a_subquery(stored):
    plan = initial_plan(quality.temporal(stored))
    assert "Subquery" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_region_lookup_joins_without_a_shuffle(spark, stored):
    customers = stored["core.dim_customer"].select("customer_id", F.col("region").alias("location"))
    plan = initial_plan(model.customer_regions(customers, dim_region(spark)))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_cleaning_stays_in_generated_code(spark):
    raw = spark.createDataFrame([], "user_id string, product_id string, interaction_type string, event_ts string")
    plan = final_plan(clean.clean_orders(raw))
    assert "Exchange" not in plan and "Python" not in plan


def test_no_python_workers_anywhere(spark):
    from pathlib import Path

    data = "/root/testdata/sf0.001"
    if not Path(data).exists():
        pytest.skip("no driver tables")
    lazy = [n for n in registry.queries() if n.startswith(("clean", "dim", "kpi", "top", "sales"))]
    for name in lazy:
        plan = initial_plan(registry.queries()[name](spark, data))
        assert "Python" not in plan and "ArrowEval" not in plan, name
