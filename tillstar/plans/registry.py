"""Every operator as a named query over the given tables.

Cleaning and quality queries run on the messy raw tables, KPI queries on the large
fact. Queries over stored layers write those to the shared scratch folder first,
as a build does.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions import clock
from tillstar.operators import clean, feeds, kpi, model, quality, rejects
from tillstar.plans import jobs
from tillstar.plans.views import create_views
from tillstar.sinks.snapshots import export_csv, read_published
from tillstar.sinks.warehouse import BY_DATE, Warehouse, scratch
from tillstar.sources import driver_tables, extracts
from tillstar.sources.regions import dim_region

Query = Callable[[SparkSession, str], DataFrame]
Tables = dict[str, DataFrame]


def _utc(df: DataFrame) -> DataFrame:
    """event_ts as its UTC reading, which compares the same under every session zone."""
    return df.withColumn("event_ts", clock.utc_clock(F.col("event_ts")))


def _of(query: Query, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(query(spark, sf_dir))


def _cleaned(table: str, cleaner: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: cleaner(driver_tables.raw_table(spark, sf_dir, table))


_customers = _cleaned("raw.customers_raw", clean.clean_customers)
_products = _cleaned("raw.products_raw", clean.clean_products)
_orders = _cleaned("raw.orders_raw", clean.clean_orders)
_orders_2024 = _of(_orders, clean.orders_in_2024)


def _orphans_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, products = _orders_2024(spark, sf_dir), _products(spark, sf_dir)
    return _utc(clean.dq_orphans_products(orders, products))


def _orphans_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = _orders_2024(spark, sf_dir), _customers(spark, sf_dir)
    return _utc(clean.dq_orphans_customers(orders, customers))


def _customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = model.customer_regions(_customers(spark, sf_dir), dim_region(spark))
    return matched.select("customer_id", "location", "region")


def _dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = _customers(spark, sf_dir), _orders(spark, sf_dir)
    return model.dim_customer(customers, dim_region(spark), orders)


def _raw(spark: SparkSession, sf_dir: str) -> Tables:
    return {name: driver_tables.raw_table(spark, sf_dir, name) for name in jobs.RAW}


def _fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = scratch(spark)
    stg = jobs.stage(_raw(spark, sf_dir), wh)
    return jobs.fact(stg | jobs.dimensions(stg, wh)).drop("created_at")


def _stage_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each step loses, and why. Staging is counted while it is written, as in a
    build; the purchases that make no fact row are counted when the result is read."""
    wh, counted = scratch(spark), {}
    stg = jobs.stage(_raw(spark, sf_dir), wh, counted=counted)
    tables = stg | jobs.dimensions(stg, wh)
    sales = rejects.losses({"core.fact_sales": jobs.judged_fact(tables)})
    return rejects.losses_of(spark, counted).unionAll(sales)


def _on_star(build: Callable[[Tables], DataFrame], helpers: bool = False) -> Query:
    """A query over stored staging and dimensions, on demand with helper tables. The fact is read
    once by each of them, so it is not stored."""

    def query(spark, sf_dir):
        wh = scratch(spark)
        tables = _raw(spark, sf_dir)
        tables |= jobs.stage(tables, wh)
        tables |= jobs.dimensions(tables, wh)
        tables["core.fact_sales"] = jobs.fact(tables)
        return build(tables | jobs.helpers(tables, wh) if helpers else tables)

    return query


# Labels of the row counts that follow each step.
_STAGE_LABELS = {
    "customers_raw": "raw.customers_raw",
    "products_raw": "raw.products_raw",
    "orders_raw": "raw.orders_raw",
    "stg_customers": "stg.stg_customers",
    "stg_products": "stg.stg_products",
    "stg_orders": "stg.stg_orders",
    "dq_invalid_price": "stg.stg_dq_invalid_price",
    "dq_orphans_products": "stg.stg_dq_orphans_products",
    "dq_orphans_customers": "stg.stg_dq_orphans_customers",
    "dim_region": "core.dim_region",
    "dim_calendar": "core.dim_calendar",
    "dim_product": "core.dim_product",
    "dim_customer": "core.dim_customer",
    "fact_sales": "core.fact_sales",
}


def _stage_counts(tables: Tables) -> DataFrame:
    return quality.stage_counts({label: tables[t] for label, t in _STAGE_LABELS.items()})


def _offender_samples(tables: Tables) -> DataFrame:
    local = F.from_utc_timestamp("event_ts", clock.LONDON)
    stamp = clock.stamp_text(F.col("event_ts"), local)
    order_text = F.concat_ws("/", "user_id", "product_id", stamp)
    order_keys = ("user_id", "product_id", "event_ts")
    samples = {
        "dq_invalid_price": (F.col("product_id"), ("product_id",)),
        "dq_orphans_products": (order_text, order_keys),
        "dq_orphans_customers": (order_text, order_keys),
    }
    parts = [
        quality.offender_sample(tables[f"stg.stg_{name}"], *keys).select(
            F.lit(name).alias("helper"), text.alias("offender")
        )
        for name, (text, keys) in samples.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def _through_csv(
    table: str, file: str, reader: Callable, cleaner: Callable[[DataFrame], DataFrame]
) -> Query:
    """Write a raw table as a CSV extract, scan that, clean the rows."""

    def query(spark, sf_dir):
        path = f"{scratch(spark).root}/{file}"
        export_csv(driver_tables.raw_extract(spark, sf_dir, table), path)
        return cleaner(reader(spark, path))

    return query


def _sales(view: Callable[..., DataFrame], *dims: str) -> Query:
    """A query over the large fact and the dimensions it names."""
    names = ["core.fact_sales"] + [f"core.{d}" for d in dims]
    return lambda spark, sf_dir: view(
        *[driver_tables.sales_table(spark, sf_dir, name) for name in names]
    )


def _top(n: int) -> Query:
    return _sales(lambda fact, customers: kpi.top_customers(fact, customers, n), "dim_customer")


def _export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export the category report as CSV and read that back."""
    report = _sales(kpi.sales_by_category, "dim_product")(spark, sf_dir)
    path = f"{scratch(spark).root}/sales_by_category.csv"
    export_csv(report.orderBy(F.desc("revenue")), path)
    reader = spark.read.schema(report.schema).option("header", True).option("escape", '"')
    return reader.csv(path)


def _build_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: extracts written as CSV, landed, staged, modelled, checked."""
    wh = scratch(spark)
    for table, file in _EXTRACT_FILES.items():
        export_csv(driver_tables.raw_extract(spark, sf_dir, table), f"{wh.root}/in/{file}")
    built = jobs.build(
        spark, f"{wh.root}/in", f"{wh.root}/out", on_duplicate="report", on_bad_row="report", catalog=False
    )
    return built.quality


_EXTRACT_FILES = {
    "raw.customers_raw": extracts.CUSTOMERS_FILE,
    "raw.products_raw": extracts.PRODUCTS_FILE,
    "raw.orders_raw": extracts.ORDERS_FILE,
}
_SALES_TABLES = ("core.fact_sales", "core.dim_customer", "core.dim_product", "core.dim_calendar")


def _sales_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return {name: driver_tables.sales_table(spark, sf_dir, name) for name in _SALES_TABLES}


def _published_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the seven answers over the large fact, and count what is read back of each."""
    tables = _sales_tables(spark, sf_dir)
    out = scratch(spark).root
    jobs.publish_snapshots(spark, tables, out)
    parts = []
    for name, answer in jobs.snapshots(tables, top_n=50).items():
        back = read_published(spark, out, name, answer.schema)
        parts.append(back.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows")))
    return reduce(DataFrame.unionAll, parts)


def _catalog_view(name: str) -> Query:
    """A view of the catalog over the large fact."""

    def query(spark, sf_dir):
        wh = Warehouse(spark, scratch(spark).root, catalog=True)
        wh.write_all(_sales_tables(spark, sf_dir))
        create_views(spark, [name])
        return spark.table(name)

    return query


def _season_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales per day of one season and year, from a fact stored by date: the calendar's filter
    decides at run time which folders are read."""
    wh = Warehouse(spark, scratch(spark).root, layout=BY_DATE)
    tables = wh.write_all({n: t for n, t in _sales_tables(spark, sf_dir).items() if n in _DATED})
    return kpi.sales_by_day(*[tables[n] for n in _DATED], year=1995, season="Spring")


_DATED = ("core.fact_sales", "core.dim_calendar")


def queries() -> dict[str, Query]:
    headline = _sales(kpi.kpi_headline)
    by_category = _sales(kpi.sales_by_category, "dim_product")
    by_region = _sales(kpi.sales_by_region)
    by_month = _sales(kpi.seasonality_monthly, "dim_calendar")
    by_payment = _sales(kpi.payment_mix)
    new_vs_repeat = _sales(kpi.new_vs_repeat)
    return {
        # cleaning
        "clean_customers": _customers,
        "clean_products": _products,
        "clean_orders": _of(_orders, _utc),
        "orders_in_2024": _of(_orders_2024, _utc),
        "dq_invalid_price": _of(_products, clean.dq_invalid_price),
        "dq_orphans_products": _orphans_products,
        "dq_orphans_customers": _orphans_customers,
        # CSV extracts
        "scan_customers_csv": _through_csv(
            "raw.customers_raw",
            extracts.CUSTOMERS_FILE,
            extracts.read_customers_raw,
            clean.clean_customers,
        ),
        "scan_products_csv": _through_csv(
            "raw.products_raw",
            extracts.PRODUCTS_FILE,
            extracts.read_products_raw,
            clean.clean_products,
        ),
        "scan_orders_csv": _of(
            _through_csv(
                "raw.orders_raw",
                extracts.ORDERS_FILE,
                partial(extracts.read_orders_raw, line_breaks_in_fields=False),
                clean.clean_orders,
            ),
            _utc,
        ),
        # model
        "customer_regions": _customer_regions,
        "dim_calendar": _of(_orders, model.dim_calendar),
        "dim_product": _of(_products, model.dim_product),
        "dim_customer": _dim_customer,
        "fact_sales": _fact_sales,
        "duplicate_keys": _sales(lambda fact: model.duplicate_keys(fact, "order_id")),
        # KPI views and answers
        "kpi_headline": headline,
        "top_customers_ltv": _sales(kpi.top_customers_ltv, "dim_customer"),
        "sales_by_category": by_category,
        "sales_by_region": by_region,
        "seasonality_monthly": by_month,
        "payment_mix": by_payment,
        "customer_first_purchase": _sales(kpi.customer_first_purchase),
        "order_new_repeat": _sales(kpi.order_new_repeat),
        "customer_repeat_windows": _sales(kpi.customer_repeat_windows),
        "top_customers_10": _top(10),
        "top_customers_50": _top(50),
        "new_vs_repeat": new_vs_repeat,
        "season_by_day": _season_by_day,
        "catalog_top_customers": _catalog_view("core.v_top_customers_ltv"),
        "fact_profile": _sales(quality.fact_profile),
        # quality
        "stage_losses": _stage_losses,
        "stage_counts": _on_star(_stage_counts, helpers=True),
        "dq_row_counts": _on_star(quality.row_counts),
        "dq_uniqueness": _on_star(quality.uniqueness),
        "dq_referential": _on_star(quality.referential),
        "dq_domain": _on_star(quality.domain),
        "dq_temporal": _on_star(quality.temporal),
        "dq_summary": _on_star(quality.dq_summary),
        "dq_offender_samples": _on_star(_offender_samples, helpers=True),
        "build_summary": _build_summary,
        # export and report feeds
        "export_roundtrip": _export_roundtrip,
        "published_rows": _published_rows,
        "feed_headline": _of(headline, feeds.feed_headline),
        "feed_top_customers": _of(_top(50), feeds.feed_top_customers),
        "feed_sales_by_category": _of(by_category, feeds.feed_sorted),
        "feed_sales_by_region": _of(by_region, feeds.feed_sorted),
        "feed_payment_mix": _of(by_payment, feeds.feed_sorted),
        "feed_monthly": _of(by_month, feeds.feed_monthly),
        "feed_new_vs_repeat": _of(new_vs_repeat, feeds.feed_new_vs_repeat),
    }
