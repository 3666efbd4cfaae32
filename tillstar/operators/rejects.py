"""Rows that do not pass: why, how many, and which of them stop a build.

A judging operator types every raw row and gives the rows that fail a reason. The rows that pass
are a filter over that, and the reasons are counted while the passing rows are written. A
reason may also tell of a value that is lost while its row stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REASON = "_reason"
#: The text that a reason is about.
CULPRIT = "_culprit"

# Reasons of each step, in the order in which they are looked for.
REASONS = {
    "stg.stg_customers": [
        "no_customer_id",
        "customer_id_too_large",
        "age_too_large",
        "previous_purchases_too_large",
    ],
    "stg.stg_products": ["no_product_id", "price_too_large"],
    "stg.stg_orders": [
        "no_user_id",
        "user_id_too_large",
        "no_product_id",
        "no_interaction",
        "no_event_time",
        "bad_event_time",
    ],
    "core.fact_sales": ["unknown_product", "no_price", "unknown_customer", "no_calendar_day"],
}
#: Values that are there but can't be read: they stop a build, unless it is to report them.
STOPPING = [
    "customer_id_too_large",
    "age_too_large",
    "previous_purchases_too_large",
    "price_too_large",
    "user_id_too_large",
    "bad_event_time",
]
#: Columns that a row of a step needs to stay.
NEEDED = {
    "stg.stg_customers": ["customer_id"],
    "stg.stg_products": ["product_id"],
    "stg.stg_orders": ["user_id", "product_id", "interaction_type", "event_date"],
    "core.fact_sales": ["order_id"],
}


def first_reason(*cases: tuple[Column, str, Column]) -> list[Column]:
    """(test, reason, culprit) in order as the two columns of a judged frame; NULL where all is well."""
    (test, reason, culprit), *rest = cases
    name, text = F.when(test, F.lit(reason)), F.when(test, culprit)
    for test, reason, culprit in rest:
        name, text = name.when(test, F.lit(reason)), text.when(test, culprit)
    return [name.alias(REASON), text.alias(CULPRIT)]


def passing(judged: DataFrame, step: str) -> DataFrame:
    """The judged rows that stay: those with all that is NEEDED. It asks for the values and not for
    the reason, which the optimizer would work out once more under every projection."""
    rows = judged.drop(REASON, CULPRIT)
    return reduce(DataFrame.where, [F.col(name).isNotNull() for name in NEEDED[step]], rows)


def stopping(judged: DataFrame, on_bad_row: str) -> DataFrame:
    """With on_bad_row="raise" a job over these rows stops at the first one whose reason is in
    STOPPING, and names it; with "report" they are as they were."""
    if on_bad_row == "report":
        return judged
    if on_bad_row != "raise":
        raise ValueError(f"on_bad_row must be raise or report, not {on_bad_row!r}")
    said = F.concat_ws(" ", F.lit("bad row:"), REASON, F.col(CULPRIT))
    stop = F.raise_error(said).cast("boolean")
    return judged.where(F.when(F.col(REASON).isin(STOPPING), stop).otherwise(True))


def _counts(step: str) -> list[Column]:
    return [F.count_if(F.col(REASON) == reason).alias(reason) for reason in REASONS[step]]


def observed(judged: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """The judged rows, counted by reason in whatever job they are written by."""
    counts = Observation(step)
    return judged.observe(counts, *_counts(step)), counts


def losses_of(spark, counted: dict[str, Observation]) -> DataFrame:
    """What the observations of finished jobs have counted: step, reason, rows."""
    rows = [(s, r, o.get[r]) for s, o in counted.items() for r in REASONS[s]]
    return spark.createDataFrame(rows, "step string, reason string, rows long")


def losses(judged: dict[str, DataFrame]) -> DataFrame:
    """The same from judged frames, each read once; a reason without rows counts zero."""
    parts = []
    for step, df in judged.items():
        one = df.agg(*_counts(step)).unpivot([], REASONS[step], "reason", "rows")
        parts.append(one.select(F.lit(step).alias("step"), "reason", "rows"))
    return reduce(DataFrame.unionAll, parts)


def rejected(judged: DataFrame) -> DataFrame:
    """The rows with a reason, typed as far as they could be, with reason and culprit."""
    return judged.where(F.col(REASON).isNotNull()).withColumnsRenamed(
        {REASON: "reason", CULPRIT: "culprit"}
    )
