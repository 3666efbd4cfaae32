"""Closed value domains: free text in, one of a few labels out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words and labels of each domain; the first hit in order wins.
GENDER_PREFIXES = {"m": "male", "f": "female"}
GENDER_UNKNOWN = ["", "na", "n/a", "unknown"]
PAYMENT_WORDS = {
    "credit": "credit_card",
    "debit": "debit_card",
    "paypal": "paypal",
    "bank": "bank_transfer",
    "venmo": "venmo",
    "cash": "cash",
}
SUBSCRIPTION_LABELS = {
    "yes": ["yes", "y", "true", "1"],
    "no": ["no", "n", "false", "0"],
}
SELLER_LABELS = {
    "Y": ["Y", "YES", "TRUE", "1"],
    "N": ["N", "NO", "FALSE", "0"],
}
INTERACTIONS = ["purchase", "view", "like"]
AGE_LOW, AGE_HIGH = 13, 100
SEASON_MONTHS = {
    "Winter": [12, 1, 2],
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Autumn": [9, 10, 11],
}


def _first_hit(cases: list[tuple[Column, Column]]) -> Column:
    (test, label), *rest = cases
    chain = F.when(test, label)
    for test, label in rest:
        chain = chain.when(test, label)
    return chain


def _label_of(c: Column, labels: dict) -> Column:
    return _first_hit([(c.isin(words), F.lit(label)) for label, words in labels.items()])


def gender(c: Column) -> Column:
    cases = [(c.startswith(p), F.lit(label)) for p, label in GENDER_PREFIXES.items()]
    cases.append((c.isNull() | c.isin(GENDER_UNKNOWN), F.lit("unknown")))
    return _first_hit(cases).otherwise("other")


def payment_method(c: Column) -> Column:
    cases = [(c.contains(w), F.lit(label)) for w, label in PAYMENT_WORDS.items()]
    return _first_hit(cases).otherwise("other")


def subscription(c: Column) -> Column:
    return _label_of(c, SUBSCRIPTION_LABELS)


def seller_flag(c: Column) -> Column:
    return _label_of(c, SELLER_LABELS)


def is_interaction(c: Column) -> Column:
    return c.isin(INTERACTIONS)


def interaction(c: Column) -> Column:
    return F.when(is_interaction(c), c)


def not_an_interaction(c: Column) -> Column:
    return c.isNull() | ~is_interaction(c)


def plausible_age(c: Column) -> Column:
    return F.when(c.between(AGE_LOW, AGE_HIGH), c)


def season_uk(month: Column) -> Column:
    return _label_of(month, SEASON_MONTHS)
