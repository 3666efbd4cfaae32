"""Prices out of free text, and ratios that round exactly."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: shape of the first price in a text. Thousands commas count only
# when decimals follow, so "$1,234" reads as 1.
PRICE_PATTERN = (
    r"\$?\s*([0-9]{1,3}(?:,[0-9]{3})*(?:\.[0-9]{1,2})|[0-9]+(?:\.[0-9]{1,2})?)"
)

PRICE = "decimal(10,2)"
LINE_VALUE = "decimal(12,2)"
# A sum of decimal(12,2) is decimal(22,2): 10^20 dollars, beyond any 100 TB fact.
TOTAL = "decimal(22,2)"
RATIO = "decimal(18,2)"


def _price_token(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, PRICE_PATTERN, 1), F.lit(""))


def first_price(c: Column) -> Column:
    """First price-like token as a decimal; no token or one too large is NULL."""
    return F.replace(_price_token(c), F.lit(","), F.lit("")).try_cast(PRICE)


def too_large_price(c: Column) -> Column:
    """Whether the first price-like token is beyond what PRICE holds."""
    return _price_token(c).isNotNull() & first_price(c).isNull()


def is_bad_price(c: Column) -> Column:
    return c.isNull() | (c <= 0)


def total(c: Column) -> Column:
    return F.sum(c).cast(TOTAL)


def ratio(num: Column, den: Column, times: int = 1) -> Column:
    """times * num / den to two places, half away from zero; NULL if den is 0 or NULL.

    A decimal division would round once at Spark's result scale and again at two
    places. Dividing whole hundredths gives the one rounding that is wanted.
    """
    n, d = num.cast(TOTAL), F.nullif(den.cast(TOTAL), F.lit(0).cast(TOTAL))
    twice = F.abs(n) * F.lit(200 * times) + F.abs(d)
    hundredths = F.call_function("div", twice, F.abs(d) * F.lit(2))
    sign = F.when((n < 0) != (d < 0), F.lit(-1)).otherwise(F.lit(1))
    return ((hundredths * sign).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(RATIO)


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0).cast(RATIO))


def share_pct(part: Column, whole: Column) -> Column:
    return ratio(part, whole, times=100)
