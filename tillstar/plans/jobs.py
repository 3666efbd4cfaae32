"""Raw extracts to star schema, views, answers and quality report, in order.

Each layer is stored before the next one reads it. So text is parsed once, Spark
plans joins with real table sizes, and a lost executor costs one step, not the chain.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillstar.functions import clock
from tillstar.operators import clean, kpi, model, quality, rejects
from tillstar.plans.views import create_views
from tillstar.session import sized_shuffles
from tillstar.sinks.snapshots import export_all, publish
from tillstar.sinks.warehouse import BY_DATE, Warehouse
from tillstar.sources import extracts
from tillstar.sources.regions import dim_region

Tables = dict[str, DataFrame]
Counted = dict[str, Observation]

RAW = ("raw.customers_raw", "raw.products_raw", "raw.orders_raw")
STAGING = ("stg.stg_customers", "stg.stg_products", "stg.stg_orders")
HELPERS = (
    "stg.stg_dq_invalid_price",
    "stg.stg_dq_orphans_products",
    "stg.stg_dq_orphans_customers",
)
CORE = (
    "core.dim_region",
    "core.dim_calendar",
    "core.dim_product",
    "core.dim_customer",
    "core.fact_sales",
)


def judged_staging(raw: Tables, tz: str = clock.LONDON) -> Tables:
    """Every raw row, typed, with the reason why it does not pass."""
    return {
        "stg.stg_customers": clean.judge_customers(raw["raw.customers_raw"]),
        "stg.stg_products": clean.judge_products(raw["raw.products_raw"]),
        "stg.stg_orders": clean.judge_orders(raw["raw.orders_raw"], tz),
    }


def stage(
    raw: Tables,
    wh: Warehouse,
    tz: str = clock.LONDON,
    on_bad_row: str = "report",
    counted: Counted | None = None,
) -> Tables:
    """Clean and store the three staging tables. `counted` gets what the same jobs count of the
    rows that do not pass."""
    frames = {}
    for name, judged in judged_staging(raw, tz).items():
        if counted is not None:
            judged, counted[name] = rejects.observed(judged, name)
        frames[name] = rejects.passing(rejects.stopping(judged, on_bad_row), name)
    return wh.write_all(frames)


def helpers(stg: Tables, wh: Warehouse) -> Tables:
    """Store the rows that the quality helper tables collect."""
    in_2024 = clean.orders_in_2024(stg["stg.stg_orders"])
    products, customers = stg["stg.stg_products"], stg["stg.stg_customers"]
    return wh.write_all(
        {
            "stg.stg_dq_invalid_price": clean.dq_invalid_price(products),
            "stg.stg_dq_orphans_products": clean.dq_orphans_products(in_2024, products),
            "stg.stg_dq_orphans_customers": clean.dq_orphans_customers(in_2024, customers),
        }
    )


def dimensions(stg: Tables, wh: Warehouse) -> Tables:
    """Build and store the four dimensions."""
    customers, orders = stg["stg.stg_customers"], stg["stg.stg_orders"]
    region = dim_region(wh.spark)
    return wh.write_all(
        {
            "core.dim_region": region,
            "core.dim_calendar": model.dim_calendar(orders),
            "core.dim_product": model.dim_product(stg["stg.stg_products"]),
            "core.dim_customer": model.dim_customer(customers, region, orders),
        }
    )


def fact(tables: Tables, tz: str = clock.LONDON) -> DataFrame:
    return model.fact_sales(
        tables["stg.stg_orders"],
        tables["core.dim_product"],
        tables["core.dim_customer"],
        tables["core.dim_calendar"],
        tz,
    )


def judged_fact(tables: Tables, tz: str = clock.LONDON) -> DataFrame:
    """Every purchase as a fact row, with the reason why it can't be one."""
    return model.judge_sales(
        tables["stg.stg_orders"],
        tables["stg.stg_products"],
        tables["core.dim_product"],
        tables["core.dim_customer"],
        tables["core.dim_calendar"],
        tz,
    )


def kpi_views(tables: Tables) -> Tables:
    """The KPI views and the quality summary as lazy frames."""
    sales = tables["core.fact_sales"]
    customers, products = tables["core.dim_customer"], tables["core.dim_product"]
    return {
        "v_kpi_headline": kpi.kpi_headline(sales),
        "v_top_customers_ltv": kpi.top_customers_ltv(sales, customers),
        "v_sales_by_category": kpi.sales_by_category(sales, products),
        "v_sales_by_region": kpi.sales_by_region(sales),
        "v_seasonality_monthly": kpi.seasonality_monthly(sales, tables["core.dim_calendar"]),
        "v_payment_mix": kpi.payment_mix(sales),
        "v_customer_first_purchase": kpi.customer_first_purchase(sales),
        "v_order_new_repeat": kpi.order_new_repeat(sales),
        "v_customer_repeat_windows": kpi.customer_repeat_windows(sales),
    }


def register_views(tables: Tables) -> list[str]:
    """Make the views, and the 2024 orders and quality summary, known to spark.sql."""
    views = kpi_views(tables)
    if "stg.stg_orders" in tables:
        views["v_stg_orders_2024"] = clean.orders_in_2024(tables["stg.stg_orders"])
    if set(quality.COUNTED_TABLES) <= set(tables):
        views["v_dq_summary"] = quality.dq_summary(tables)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)


def snapshots(tables: Tables, top_n: int) -> Tables:
    """The seven business answers in their reporting order."""
    sales = tables["core.fact_sales"]
    customers, products = tables["core.dim_customer"], tables["core.dim_product"]
    return {
        "kpi_headline": kpi.kpi_headline(sales),
        "top_customers_ltv": kpi.top_customers(sales, customers, top_n),
        "sales_by_category": kpi.sales_by_category(sales, products).orderBy(F.desc("revenue")),
        "sales_by_region": kpi.sales_by_region(sales).orderBy(F.desc("revenue")),
        "seasonality_monthly": kpi.seasonality_monthly(sales, tables["core.dim_calendar"]).orderBy(
            "year", "month"
        ),
        "payment_mix": kpi.payment_mix(sales).orderBy(F.desc("revenue")),
        "new_vs_repeat": kpi.new_vs_repeat(sales).orderBy("customer_order_type"),
    }


def analysis(tables: Tables) -> Tables:
    return snapshots(tables, top_n=10)


def export_snapshots(spark: SparkSession, tables: Tables, out: str) -> list[str]:
    with sized_shuffles(spark, *files_of(tables)):
        return export_all(spark, snapshots(tables, top_n=50), out)


def publish_snapshots(spark: SparkSession, tables: Tables, out: str) -> str:
    """The seven answers as one publication; see snapshots.publish."""
    with sized_shuffles(spark, *files_of(tables)):
        return publish(spark, snapshots(tables, top_n=50), out)


def files_of(tables: Tables) -> list[str]:
    """The fact's files: by far the most of what the answers shuffle."""
    return list(tables["core.fact_sales"].inputFiles())


def rebuild_days(wh: Warehouse, tables: Tables, first, last, tz: str = clock.LONDON) -> list[str]:
    """Work out the fact of some days anew, from the stored tables, and rewrite only these days."""
    return wh.replace(fact(tables, tz), "core.fact_sales", first, last)


def stored_tables(wh: Warehouse) -> Tables:
    """The tables of an earlier build, read from their folders."""
    return {name: wh.read(name) for name in RAW + STAGING + HELPERS + CORE}


@dataclass
class Build:
    """What a build leaves: stored tables, lazy answers, the quality report, and how many rows
    each step lost for which reason."""

    tables: Tables
    analysis: Tables
    quality: DataFrame
    losses: DataFrame


_EXTRACTS = {
    "raw.customers_raw": (extracts.CUSTOMERS_FILE, extracts.read_customers_raw),
    "raw.products_raw": (extracts.PRODUCTS_FILE, extracts.read_products_raw),
    "raw.orders_raw": (extracts.ORDERS_FILE, extracts.read_orders_raw),
}


def land(spark: SparkSession, src: str, wh: Warehouse, split: Collection[str] = ()) -> Tables:
    """Store the extracts under `src` as text tables.

    `split` names the raw tables whose extract has no line breaks in its fields: their files are
    read by many tasks each. It suits the orders, which are the largest by far.
    """
    unknown = set(split) - set(_EXTRACTS)
    if unknown:
        raise ValueError(f"no such extract: {', '.join(sorted(unknown))}")
    frames = {
        table: read(spark, f"{src.rstrip('/')}/{file}", line_breaks_in_fields=table not in split)
        for table, (file, read) in _EXTRACTS.items()
    }
    return wh.write_all(frames)


def build(
    spark: SparkSession,
    src: str,
    root: str,
    tz: str = clock.LONDON,
    on_duplicate: str = "raise",
    on_bad_row: str = "raise",
    catalog: bool = True,
    split: Collection[str] = (),
) -> Build:
    """Run the whole chain from the extracts in `src` to tables under `root`.

    The first failing step stops it. A table whose key is NULL or repeated is a
    failure too, unless on_duplicate="report" leaves that to the quality report. So is a value
    that can't be read (rejects.STOPPING), unless on_bad_row="report" leaves that to `losses`.
    Without the catalog the tables are folders only, and there are no views. See land for split.
    """
    wh = Warehouse(spark, root, catalog, BY_DATE)
    tables = land(spark, src, wh, split)
    with sized_shuffles(spark, wh.path("raw")):
        return _build(tables, wh, tz, on_duplicate, on_bad_row)


def _build(tables: Tables, wh: Warehouse, tz: str, on_duplicate: str, on_bad_row: str) -> Build:
    spark = wh.spark
    counted: Counted = {}
    tables |= stage(tables, wh, tz, on_bad_row, counted)
    tables |= helpers(tables, wh) | dimensions(tables, wh)
    keys = {
        "core.dim_region": "state_name",
        "core.dim_calendar": "date",
        "core.dim_product": "product_id",
        "core.dim_customer": "customer_id",
    }
    for name, key in keys.items():
        model.assert_key(tables[name], key, on_duplicate=on_duplicate)
    name = "core.fact_sales"
    judged, counted[name] = rejects.observed(judged_fact(tables, tz), name)
    tables[name] = wh.write(rejects.passing(judged, name), name)
    try:
        model.assert_key(tables[name], "order_id", on_duplicate=on_duplicate)
    except model.DuplicateKeyError:
        wh.drop(name)  # a fact without a key is not to be read
        raise
    wh.require(*CORE)
    if wh.catalog:
        register_views(tables)
        create_views(spark)
    losses = rejects.losses_of(spark, counted)
    return Build(tables, analysis(tables), quality.dq_summary(tables), losses)
