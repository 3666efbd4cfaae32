"""Exact distinct counts without a row per key in the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _has_bits(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, T.IntegralType)


def count_distinct(df: DataFrame, key: str) -> Column:
    """The number of distinct non-NULL values of a column, as a subquery of one value."""
    return with_distinct(df, key, "n", {}).select("n").scalar()


def with_distinct(
    df: DataFrame, key: str, name: str, totals: dict[str, tuple[Column, Column]]
) -> DataFrame:
    """One row with the number of distinct non-NULL values of a column, and totals of all rows.

    `totals` names each total by its aggregate over rows and the one over parts of rows. Whole
    numbers become bits: a map task sends one bitmap of 4 kB for every range of 32,768 ids that
    it has seen, which is less than a row per id where ids are dense. Other types are grouped. Unlike
    several distinct counts in one aggregation, rows are not expanded.
    """
    if _has_bits(df, key):
        part = F.bitmap_bucket_number(F.col(key))
        found = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))))
    else:
        part, found = F.col(key), F.any_value(F.col(key).isNotNull().cast("int"))
    parts = df.groupBy(part.alias("_part")).agg(
        found.alias(name), *[of_rows.alias(total) for total, (of_rows, _) in totals.items()]
    )
    return parts.agg(
        F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name),
        *[of_parts.alias(total) for total, (_, of_parts) in totals.items()],
    )
