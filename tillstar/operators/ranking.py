"""Dense rank over a whole table without one task that sees it all."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.skew import split_join

BAND = Decimal("0.0001")  # 10 000 wide: at most 10^6 distinct values with two decimals
ZONE = 10_000  # bands per zone


def _sum_above(n: Column, window) -> Column:
    above = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(above), F.lit(0))


def dense_rank_positions(values: DataFrame, value: str, rank: str, ties: str) -> DataFrame:
    """Distinct two-decimal values of a frame with their dense rank, highest first, and their
    number of rows.

    Values fall into bands by size, bands into zones. A value's rank is its place in
    its band plus the values in higher bands of its zone plus those in higher zones.
    The value range bounds what any one task sorts: 10^6 values of a band, 10^4
    bands of a zone, one row per 10^8 of value range for the zones.
    """
    # Never-NULL bands and zones: no join below pushes a filter of its own under the
    # shuffles, so all three uses of the distinct values share one shuffle.
    distinct = (
        values.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias(ties))
    )
    band = F.coalesce(F.floor(F.col(value) * F.lit(BAND)).cast("long"), F.lit(0))
    banded = distinct.withColumn("_band", band)
    zone = F.col("_band") - F.coalesce(F.pmod(F.col("_band"), F.lit(ZONE)), F.lit(0))
    bands = (
        banded.groupBy("_band").agg(F.count(F.lit(1)).alias("_n")).withColumn("_zone", zone)
    )
    zones = bands.groupBy("_zone").agg(F.sum("_n").alias("_n"))
    over_zones = zones.select(
        "_zone", _sum_above(F.col("_n"), Window.orderBy(F.desc("_zone"))).alias("_zones_above")
    )
    in_zone = Window.partitionBy("_zone").orderBy(F.desc("_band"))
    offsets = (
        bands.withColumn("_bands_above", _sum_above(F.col("_n"), in_zone))
        .join(over_zones, "_zone")
        .select("_band", (F.col("_bands_above") + F.col("_zones_above")).alias("_above"))
    )
    in_band = Window.partitionBy("_band").orderBy(F.desc(value))
    return (
        banded.withColumn("_place", F.row_number().over(in_band))
        .join(offsets, "_band")
        .select(value, ties, (F.col("_place") + F.col("_above")).cast("long").alias(rank))
    )


def with_dense_rank(
    rows: DataFrame, values: DataFrame, value: str, rank: str, spread_by: list[str]
) -> DataFrame:
    """rows with the dense rank of their value among `values`; many rows may tie.

    A NULL value has no rank.
    """
    positions = dense_rank_positions(values, value, rank, "_ties")
    total = values.agg(F.count(value)).scalar()
    return split_join(rows, positions, value, "_ties", total, spread_by)
