from __future__ import annotations

import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import pytest

from tests.helpers import day, tuples
from tillstar import schemas
from tillstar.operators import model
from tillstar.plans import jobs
from tillstar.sinks import snapshots, warehouse
from tillstar.sources import extracts


def write_csv(path, columns, rows):
    """Rows as dicts by header; a value is written as it is, quotes included."""
    lines = [",".join(columns)] + [",".join(row.get(c, "") for c in columns) for row in rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


CUSTOMERS = [
    {"Customer ID": str(i), "Age": "30", "Gender": "Male", "Location": state, "Payment Method": pay}
    for i, state, pay in [(1, "Kentucky", "Venmo"), (2, "Oregon", "Cash"), (3, "Ontario", "PayPal")]
]
PRODUCTS = [
    {"Uniqe Id": "p1", "Product Name": '"Kite ""XL"", red"', "Category": '"Clothing, Shoes | Hats"', "Selling Price": "$10.00"},
    {"Uniqe Id": "p2", "Product Name": '"two\nlines"', "Category": "Toys > Cars", "Selling Price": '"$1,234.50"'},
    {"Uniqe Id": "p3", "Product Name": "back\\slash", "Category": "Toys", "Selling Price": "n/a"},
]
ORDERS = [
    {"user id": u, "product id": p, "Interaction type": i, "Time stamp": t}
    for u, p, i, t in [
        ("1", "p1", "purchase", "10/10/2023 8:00"),
        ("1", "p2", "Purchase", "11/10/2023 8:00"),
        ("2", "p1", "purchase", "28/12/2022 8:00"),
        ("2", "p3", "purchase", "28/12/2022 9:00"),
        ("9", "p1", "purchase", "1/2/2024 9:00"),
        ("3", "p1", "view", "1/2/2024 9:00"),
        ("", "", "", ""),
    ]
]


def write_source(folder: Path) -> str:
    folder.mkdir(exist_ok=True)
    write_csv(folder / extracts.CUSTOMERS_FILE, schemas.CUSTOMER_COLUMNS, CUSTOMERS)
    write_csv(folder / extracts.PRODUCTS_FILE, schemas.PRODUCT_COLUMNS, PRODUCTS)
    write_csv(folder / extracts.ORDERS_FILE, schemas.ORDER_COLUMNS, ORDERS)
    return str(folder)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    src, root = write_source(folder / "in"), str(folder / "out")
    first = jobs.build(spark, src, root)
    before = {t: sorted(map(str, stable(df))) for t, df in first.tables.items()}
    return before, jobs.build(spark, src, root), folder


def stable(df):
    return tuples(df.drop("created_at"))


def test_build_again_gives_the_same(built):
    before, second, _ = built
    assert {t: sorted(map(str, stable(df))) for t, df in second.tables.items()} == before
    assert len(before) == 14


def test_built_tables(spark, built):
    products = {r.product_id: r for r in spark.table("stg.stg_products").collect()}
    assert products["p1"].product_name == 'Kite "XL", red'
    assert products["p1"].product_category == "Clothing, Shoes"
    assert products["p2"].product_name == "two\nlines"
    assert products["p2"].selling_price == Decimal("1234.50")
    assert products["p3"].product_name == "back\\slash"
    sales = spark.table("core.fact_sales")
    lines = sales.select("customer_id", "product_id", "order_date", "net_revenue", "region")
    assert sorted(tuples(lines)) == [
        (1, "p1", day("2023-10-10"), Decimal("10.00"), "South"),
        (1, "p2", day("2023-10-11"), Decimal("1234.50"), "South"),
        (2, "p1", day("2022-12-28"), Decimal("10.00"), "West"),
    ]
    assert spark.table("raw.orders_raw").columns == list(schemas.ORDER_COLUMNS)
    assert spark.table("stg.stg_dq_orphans_customers").count() == 1
    assert spark.table("core.dim_calendar").count() == 3 * 365 + 1


def test_views(spark, built):
    (headline,) = spark.sql("SELECT * FROM v_kpi_headline").collect()
    assert (headline.orders, headline.net_revenue) == (3, Decimal("1254.50"))
    assert spark.sql("SELECT * FROM v_stg_orders_2024").count() == 2
    failed = spark.sql("SELECT metric FROM v_dq_summary WHERE NOT pass")
    assert tuples(failed) == [("invalid_or_missing_price",)]
    names = ["v_top_customers_ltv", "v_sales_by_category", "v_sales_by_region"]
    names += ["v_seasonality_monthly", "v_payment_mix", "v_customer_first_purchase"]
    names += ["v_order_new_repeat", "v_customer_repeat_windows"]
    assert all(spark.table(name).count() > 0 for name in names)


def test_answers_and_quality(built):
    _, build, _ = built
    assert len(build.analysis) == 7
    assert [r.customer_id for r in build.analysis["top_customers_ltv"].collect()] == [1, 2]
    assert build.quality.count() == 20


def read_lines(folder: str) -> list[str]:
    parts = sorted(Path(folder).glob("part-*"))
    return [line for p in parts for line in p.read_text(encoding="utf-8").splitlines()]


def test_export(spark, built):
    _, build, folder = built
    out = str(folder / "exports")
    for _ in range(2):  # replaces what is there
        paths = jobs.export_snapshots(spark, build.tables, out)
    assert sorted(p.name for p in Path(out).iterdir()) == sorted(Path(p).name for p in paths)
    assert read_lines(f"{out}/kpi_headline.csv") == [
        "orders,customers,products,net_revenue,aov,min_date,max_date",
        "3,2,2,1254.50,418.17,2022-12-28,2023-10-11",
    ]
    assert read_lines(f"{out}/sales_by_category.csv") == [
        "product_category,orders,revenue,revenue_share_pct",
        "Toys,1,1234.50,98.41",
        '"Clothing, Shoes",2,20.00,1.59',
    ]
    assert read_lines(f"{out}/new_vs_repeat.csv")[1:] == [
        "new,2,20.00,66.67,1.59",
        "repeat,1,1234.50,33.33,98.41",
    ]
    assert read_lines(f"{out}/top_customers_ltv.csv")[0].endswith("orders_count,ltv,ltv_rank")


def test_export_text_form(spark, tmp_path):
    rows = [('say "hi"', None), (" padded ", "")]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    snapshots.export_csv(df, str(tmp_path / "x.csv"))
    assert read_lines(str(tmp_path / "x.csv")) == ["a,b", '"say ""hi""",', ' padded ,""']


def test_a_failing_export_replaces_nothing(spark, tmp_path):
    good = {"a": spark.range(1).coalesce(1), "b": spark.range(2)}
    snapshots.export_all(spark, good, str(tmp_path))
    broken = spark.range(1).selectExpr("CAST(raise_error('stop here') AS INT) AS id")
    with pytest.raises(Exception, match="stop here"):
        snapshots.export_all(spark, {"a": spark.range(9), "b": broken}, str(tmp_path))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a.csv", "b.csv"]
    assert read_lines(str(tmp_path / "a.csv")) == ["id", "0"]


def test_a_publication_is_seen_all_at_once(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    schema = spark.range(1).schema
    with pytest.raises(LookupError):
        snapshots.published(spark, out)
    names = [f"f{i}" for i in range(7)]
    first = snapshots.publish(spark, {n: spark.range(1) for n in names}, out)

    def rows():
        return [snapshots.read_published(spark, out, n, schema).count() for n in names]

    assert snapshots.published(spark, out) == first and rows() == [1] * 7
    write = snapshots.export_csv
    for failing in range(7):  # before each of the seven files
        written = []

        def export(df, path, failing=failing, written=written):
            if len(written) == failing:
                raise OSError("no space")
            written.append(path)
            write(df, path)

        monkeypatch.setattr(snapshots, "export_csv", export)
        with pytest.raises(OSError, match="no space"):
            snapshots.publish(spark, {n: spark.range(5) for n in names}, out)
    monkeypatch.setattr(snapshots, "export_csv", write)
    assert snapshots.published(spark, out) == first and rows() == [1] * 7
    # a pointer that was never finished doesn't count, and keeps its number
    (tmp_path / "published" / f"{2:012d}").write_text("")
    assert rows() == [1] * 7
    second = snapshots.publish(spark, {n: spark.range(3) for n in names}, out)
    assert snapshots.published(spark, out) == second and rows() == [3] * 7
    assert sorted(p.name for p in (tmp_path / "published").glob("0*")) == [f"{i:012d}" for i in (1, 2, 3)]


def test_published_answers(spark, built):
    _, build, folder = built
    out = str(folder / "published")
    jobs.publish_snapshots(spark, build.tables, out)
    for name, answer in jobs.snapshots(build.tables, top_n=50).items():
        back = snapshots.read_published(spark, out, name, answer.schema)
        assert sorted(map(str, tuples(back))) == sorted(map(str, tuples(answer)))


def test_a_repeated_order_leaves_no_fact(spark, tmp_path):
    src, root = write_source(tmp_path / "in"), str(tmp_path / "out")
    write_csv(Path(src) / extracts.ORDERS_FILE, schemas.ORDER_COLUMNS, ORDERS + ORDERS[:1])
    with pytest.raises(model.DuplicateKeyError, match="order_id"):
        jobs.build(spark, src, root)
    assert not (tmp_path / "out" / "core" / "fact_sales").exists()
    assert not spark.catalog.tableExists("core.fact_sales")
    values = {r.metric: r.value for r in jobs.build(spark, src, root, on_duplicate="report").quality.collect()}
    assert values["dupe_fact_sales_order_id"] == "1" and values["rows_fact_sales"] == "4"


def test_a_build_without_a_catalog(spark, tmp_path):
    src, root = write_source(tmp_path / "in"), str(tmp_path / "out")
    built = jobs.build(spark, src, root, catalog=False)
    assert built.tables["core.fact_sales"].count() == 3
    wh = warehouse.Warehouse(spark, root)
    wh.require("core.fact_sales", "core.dim_region")
    with pytest.raises(warehouse.MissingTableError, match="core.nowhere"):
        wh.require("core.fact_sales", "core.nowhere")


def test_blank_extract_has_no_rows(spark, tmp_path):
    (tmp_path / "blank.csv").write_text("\n")
    blank = extracts.read_products_raw(spark, str(tmp_path / "blank.csv"))
    assert blank.count() == 0 and len(blank.columns) == 28


def test_header_is_skipped_not_matched(spark, tmp_path):
    (tmp_path / "o.csv").write_text("a,b,c,d,e\n1,p,view,1/1/2024 8:00,\n")
    (row,) = extracts.read_orders_raw(spark, str(tmp_path / "o.csv")).collect()
    assert tuple(row) == ("1", "p", "view", "1/1/2024 8:00", None)


@pytest.mark.parametrize("split", [True, False])
@pytest.mark.parametrize("torn", ["2,p", "2,p,view,1/1/2024 8:00,,extra"])
def test_a_torn_row_stops_the_load(spark, tmp_path, split, torn):
    (tmp_path / "o.csv").write_text(f"a,b,c,d,e\n1,p,view,1/1/2024 8:00,\n{torn}\n")
    path = str(tmp_path / "o.csv")
    rows = extracts.read_orders_raw(spark, path, line_breaks_in_fields=not split)
    for read in (rows, rows.select(rows.columns[0]), rows.groupBy().count()):
        with pytest.raises(Exception, match="MALFORMED"):
            read.collect()


def test_many_tasks_share_a_large_file(spark, tmp_path):
    rows = [{"user id": str(i), "product id": "p1", "Interaction type": "view", "Time stamp": "1/1/2024 8:00"} for i in range(20_000)]
    src = write_source(tmp_path / "in")
    write_csv(Path(src) / extracts.ORDERS_FILE, schemas.ORDER_COLUMNS, rows)
    path = f"{src}/{extracts.ORDERS_FILE}"
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        whole = extracts.read_orders_raw(spark, path)
        shared = extracts.read_orders_raw(spark, path, line_breaks_in_fields=False)
        assert whole.rdd.getNumPartitions() == 1 and shared.rdd.getNumPartitions() > 4
        assert shared.count() == whole.count() == 20_000
        wh = warehouse.scratch(spark)
        raw = jobs.land(spark, src, wh, split=["raw.orders_raw"])
        assert raw["raw.orders_raw"].count() == 20_000 and raw["raw.products_raw"].count() == 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with pytest.raises(ValueError, match="no such extract"):
        jobs.land(spark, src, wh, split=["orders"])


def test_build_over_tables_of_another_session(spark, tmp_path):
    src, root = write_source(tmp_path / "in"), str(tmp_path / "out")
    jobs.build(spark, src, root)
    for table in jobs.RAW + jobs.STAGING + jobs.HELPERS + jobs.CORE:
        spark.sql(f"DROP TABLE {table}")  # the catalog forgets, the files stay
    again = jobs.build(spark, src, root)
    assert again.tables["core.fact_sales"].count() == 3


def test_repeated_customer_stops_the_build(spark, tmp_path):
    src = write_source(tmp_path / "in")
    write_csv(Path(src) / extracts.CUSTOMERS_FILE, schemas.CUSTOMER_COLUMNS, CUSTOMERS + CUSTOMERS[:1])
    with pytest.raises(model.DuplicateKeyError, match="customer_id"):
        jobs.build(spark, src, str(tmp_path / "out"))
    report = jobs.build(spark, src, str(tmp_path / "out"), on_duplicate="report").quality
    values = {r.metric: r.value for r in report.collect()}
    assert values["dupe_dim_customer"] == "1" and values["rows_fact_sales"] == "5"


def test_missing_tables(spark):
    with pytest.raises(warehouse.MissingTableError, match="core.nowhere"):
        warehouse.require_tables(spark, ["core.nowhere"])


def test_scratch_is_in_the_shared_folder(spark):
    first, second = warehouse.scratch(spark), warehouse.scratch(spark)
    assert first.root != second.root
    assert first.root.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_goes_with_its_application(tmp_path):
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "{tmp_path}").getOrCreate()
from tillstar.sinks.warehouse import scratch
kept = scratch(spark)
kept.write(spark.range(3), "a")
import os
print("ROWS", kept.read("a").count(), sum(n.startswith("tillstar-") for n in os.listdir("{tmp_path}")))
spark.stop()
"""
    at = Path(__file__).resolve().parent.parent
    run = subprocess.run([sys.executable, "-c", code], cwd=at, capture_output=True, text=True, timeout=120)
    assert "ROWS 3 1" in run.stdout
    assert not list(tmp_path.glob("tillstar-*"))


def test_every_row_is_shown(spark, capsys):
    from tillstar.__main__ import _show

    _show({"months": spark.range(80)}, spark.sql("SELECT 'm' AS metric, null AS value"))
    lines = capsys.readouterr().out.splitlines()
    assert lines == ["months", "id", *map(str, range(80)), "dq_summary", "metric\tvalue", "m\t"]


def test_command_line(spark, restored_settings, tmp_path, capsys):
    from tillstar.__main__ import main

    src, root, out = write_source(tmp_path / "in"), str(tmp_path / "dw"), str(tmp_path / "out")
    main(["build", src, root])
    assert "1254.50" in capsys.readouterr().out
    main(["report", root])
    assert "fact→dim_customer_orphans" in capsys.readouterr().out
    main(["export", root, out])
    assert len(list(Path(out).iterdir())) == 7
