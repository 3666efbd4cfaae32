"""Text rules. All stay inside whole-stage codegen (no lambdas over arrays)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MARK = "\u0001 "


def blank_to_null(c: Column) -> Column:
    """Trim spaces; an empty rest becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def lower_token(c: Column) -> Column:
    return F.lower(blank_to_null(c))


def upper_token(c: Column) -> Column:
    return F.upper(blank_to_null(c))


def digits_to_int(c: Column) -> Column:
    """Digits-only text as INT; anything else, and overflow, is NULL."""
    # \z and not $: in Java, $ also matches before a final line break
    return F.when(c.rlike(r"^[0-9]+\z"), c.try_cast("int"))


def too_large_for_int(c: Column) -> Column:
    """Digits-only text that INT can't hold."""
    return c.rlike(r"^[0-9]+\z") & c.try_cast("int").isNull()


def title_case(c: Column) -> Column:
    """Upper-case the first letter after every character that is no letter or digit.

    Spark's initcap starts a word after a space only, so each other boundary gets
    a marker that ends in a space, and the markers come out again afterwards.
    """
    spaced = F.regexp_replace(c, r"([^\p{L}\p{N}])", "$1" + _MARK)
    return F.replace(F.initcap(spaced), F.lit(_MARK), F.lit(""))


def leftmost_label(c: Column, default: str) -> Column:
    """The part before the first '|' or '>', trimmed, or the default if blank."""
    head = F.substring_index(F.replace(c, F.lit(">"), F.lit("|")), "|", 1)
    return F.coalesce(blank_to_null(head), F.lit(default))


def text_to_number(c: Column) -> Column:
    """Text as DOUBLE with bad values as NULL (Java's 1.5d / 1.5f forms are bad too)."""
    text = c.cast("string")
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*\z"), text.try_cast("double"))
