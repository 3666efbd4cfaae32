from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

FACT = (
    "order_id string, order_date date, customer_id int, product_id string, "
    "net_revenue decimal(12,2), region string, payment_method string"
)


def day(text: str) -> date:
    return date.fromisoformat(text)


def money(text) -> Decimal:
    return Decimal(str(text)).quantize(Decimal("0.01"))


def make_fact(spark, lines):
    """lines of (customer, product, date, revenue[, region[, payment]]); ids are o0, o1..."""
    rows = []
    for i, (customer, product, when, revenue, *rest) in enumerate(lines):
        region, payment = (rest + ["South", "cash"][len(rest) :])[:2]
        rows.append((f"o{i}", day(when), customer, product, money(revenue), region, payment))
    return spark.createDataFrame(rows, FACT)


def tuples(df):
    return [tuple(row) for row in df.collect()]


def apply_rule(spark, cases, rule, schema="string"):
    """Check a column rule against a table of (input, expected)."""
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], f"i int, x {schema}")
    got = [r[1] for r in df.select("i", rule(F.col("x"))).orderBy("i").collect()]
    assert list(zip([c[0] for c in cases], got)) == list(cases)


def final_plan(df) -> str:
    """The plan that adaptive execution ended with, subqueries included."""
    df.collect()
    kept, skip_from = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        indent = len(line) - len(line.lstrip(" :"))
        if skip_from is not None and indent > skip_from:
            continue
        skip_from = indent if "== Initial Plan ==" in line else None
        if skip_from is None:
            kept.append(line)
    return "\n".join(kept)


def initial_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
