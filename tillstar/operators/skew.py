"""Joins in which one key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places that the rows of one key are spread over.
SALTS = 16
#: A key with more than this part of all rows is hot, so fewer keys than this can be hot.
HOT_SHARE = 1000


def salt(spread_by: list[str], salts: int = SALTS) -> Column:
    """A number below `salts` from the row's own values: a retried task gives the same. It is
    marked as never NULL, which spares a filter on it at the scan."""
    return F.coalesce(F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"), F.lit(0))


def with_minimum_per_key(
    rows: DataFrame, key: str, value: str, name: str, spread_by: list[str]
) -> DataFrame:
    """Rows with a non-NULL key, and the smallest value among the rows of their key.

    The rows are shuffled once, by key and salt, so a hot key lies in SALTS tasks. That shuffle
    serves the join and the minimum per key and salt. Minima meet per key, and go back to the
    salts that the key has, so a key that is rare is not copied.
    """
    rows = rows.where(F.col(key).isNotNull())
    salted = rows.withColumn("_salt", salt(spread_by)).repartition(key, "_salt")
    # Always true. It keeps all columns in use, so that both uses have one plan and one shuffle.
    all_columns = F.xxhash64(*rows.columns) >= F.lit(-(2**63))
    per_salt = salted.groupBy(key, "_salt").agg(
        F.min(F.when(all_columns, F.col(value))).alias("_least")
    )
    per_key = per_salt.groupBy(key).agg(
        F.min("_least").alias(name), F.collect_list("_salt").alias("_salts")
    )
    back = per_key.select(key, name, F.explode("_salts").alias("_salt"))
    return salted.join(back, [key, "_salt"]).drop("_salt")


def split_join(
    rows: DataFrame, per_key: DataFrame, key: str, weight: str, total: Column, spread_by: list[str]
) -> DataFrame:
    """rows LEFT JOIN per_key, which has one row per key and how many of all `total` rows have it.

    Hot keys are fewer than HOT_SHARE, whatever the size of the tables: they are broadcast. The
    other keys are shuffled plainly. Rows with a hot key have found their match by then; a salt
    that no key has spreads them over all tasks.
    """
    given = [c for c in per_key.columns if c not in (key, weight)]
    hot = F.col(weight) * F.lit(HOT_SHARE) > total
    found = F.struct(*given)
    heavy = F.broadcast(per_key.where(hot).select(key, found.alias("_heavy")))
    light = per_key.where(~hot).select(key, found.alias("_light"), F.lit(0).alias("_salt"))
    is_heavy = F.col("_heavy").isNotNull() | F.col(key).isNull()
    apart = F.coalesce(F.when(is_heavy, F.xxhash64(*spread_by).bitwiseOR(F.lit(1))), F.lit(0))
    joined = (
        rows.join(heavy, key, "left")
        .withColumn("_salt", apart)
        .join(light.withColumn("_salt", F.col("_salt").cast("long")), [key, "_salt"], "left")
    )
    either = F.coalesce("_heavy", "_light")
    return joined.select(*rows.columns, *[either[c].alias(c) for c in given])
