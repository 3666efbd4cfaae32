"""Tables in folders by date: what is read of them, and what a rebuild touches."""

from __future__ import annotations

import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.helpers import final_plan, make_fact, tuples
from tillstar.operators import clean, kpi, model
from tillstar.plans import jobs
from tillstar.sinks.warehouse import BY_DATE, Warehouse, scratch

LINES = [(c, "p1", f"2023-{m:02d}-{d:02d}", 5) for c, m, d in [(1, 1, 5), (1, 2, 1), (2, 2, 28), (3, 3, 1), (3, 3, 1)]]


@pytest.fixture
def stored(spark):
    wh = Warehouse(spark, scratch(spark).root, layout=BY_DATE)
    days = spark.sql("SELECT explode(sequence(date'2023-01-01', date'2023-12-31')) AS event_date")
    return wh, wh.write(make_fact(spark, LINES), "core.fact_sales"), model.dim_calendar(days)


def test_same_rows_and_columns(spark, stored):
    _, sales, _ = stored
    fact = make_fact(spark, LINES)
    assert sales.columns == fact.columns
    assert sorted(map(str, tuples(sales))) == sorted(map(str, tuples(fact)))


def test_a_date_range_reads_its_folders(stored):
    _, sales, _ = stored
    some = sales.where(F.col("order_date").between("2023-02-01", "2023-02-28"))
    plan = final_plan(some)
    assert re.search(r"PartitionFilters: \[[^\]]*order_date#\d+ >= 2023-02-01", plan)
    assert some.count() == 2 and len(some.inputFiles()) == 4  # input files know no filters


def test_a_filtered_calendar_prunes_at_run_time(stored):
    _, sales, calendar = stored
    spring = kpi.sales_by_day(sales, calendar, 2023, "Spring")
    assert "dynamicpruning" in final_plan(spring)
    assert [(r.order_date, r.orders) for r in spring.collect()] == [(date(2023, 3, 1), 2)]
    assert kpi.sales_by_day(sales, calendar, 2023).count() == 4


def test_orders_of_2024_read_their_folder(spark):
    wh = Warehouse(spark, scratch(spark).root, layout=BY_DATE)
    raw = [("1", "p1", "view", f"1/1/{y} 8:00") for y in (2023, 2024, 2024)]
    raw = spark.createDataFrame(raw, "user_id string, product_id string, interaction_type string, event_ts string")
    orders = wh.write(clean.clean_orders(raw), "stg.stg_orders")
    in_2024 = clean.orders_in_2024(orders)
    assert re.search(r"PartitionFilters: \[[^\]]*in_2024#\d+ = 1", final_plan(in_2024))
    assert in_2024.count() == 2 and orders.columns[-1] == "in_2024"


def files_of(wh) -> dict[str, set[str]]:
    folders = Path(wh.path("core.fact_sales").removeprefix("file:")).glob("order_date=*")
    return {f.name: {p.name for p in f.glob("part-*")} for f in folders}


def test_a_month_is_replaced_alone(spark, stored):
    wh, _, _ = stored
    before = files_of(wh)
    anew = make_fact(spark, [(9, "p9", "2023-02-14", 7), (9, "p9", "2023-03-01", 7), (2, "p1", "2023-02-28", 6)])
    touched = wh.replace(anew, "core.fact_sales", date(2023, 2, 1), date(2023, 2, 28))
    assert touched == ["2023-02-01", "2023-02-14", "2023-02-28"]
    after = files_of(wh)
    # days of other months are the same files; a day without rows is gone
    assert {d: f for d, f in after.items() if "-02-" not in d} == {d: f for d, f in before.items() if "-02-" not in d}
    assert sorted(d for d in after if "-02-" in d) == ["order_date=2023-02-14", "order_date=2023-02-28"]
    rows = wh.read("core.fact_sales").where("month(order_date) = 2").select("customer_id", "net_revenue")
    assert sorted((c, int(x)) for c, x in tuples(rows)) == [(2, 6), (9, 7)]


def test_a_failing_rebuild_replaces_nothing(spark, stored):
    wh, _, _ = stored
    before = files_of(wh)
    broken = make_fact(spark, [(1, "p1", "2023-02-01", 1)]).withColumn("region", F.raise_error(F.lit("stop here")).cast("string"))
    with pytest.raises(Exception, match="stop here"):
        wh.replace(broken, "core.fact_sales", "2023-02-01", "2023-02-28")
    assert files_of(wh) == before


def test_a_table_may_be_replaced_from_itself(spark, stored):
    wh, sales, _ = stored
    wh.replace(sales.withColumn("region", F.lit("West")), "core.fact_sales", "2023-03-01", "2023-03-31")
    regions = wh.read("core.fact_sales").groupBy("region").count()
    assert dict(tuples(regions)) == {"South": 3, "West": 2}


def test_days_of_a_build_are_worked_out_anew(spark, tmp_path):
    from tests.test_jobs import write_source

    built = jobs.build(spark, write_source(tmp_path / "in"), str(tmp_path / "out"))
    wh = Warehouse(spark, str(tmp_path / "out"), catalog=True, layout=BY_DATE)
    lines = "SELECT order_id, order_date, net_revenue FROM core.fact_sales ORDER BY 1"
    before = tuples(spark.sql(lines))
    touched = jobs.rebuild_days(wh, built.tables, date(2023, 10, 1), date(2023, 10, 31))
    assert touched == ["2023-10-10", "2023-10-11"]
    assert tuples(spark.sql(lines)) == before and len(before) == 3
