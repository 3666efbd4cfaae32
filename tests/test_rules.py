from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import apply_rule, money, tuples
from tillstar.functions import clock, domains, text
from tillstar.functions import money as prices


def test_blank_to_null(spark):
    apply_rule(
        spark,
        [(" a b ", "a b"), ("", None), ("   ", None), (None, None), ("\t", "\t")],
        text.blank_to_null,
    )


def test_digits_to_int(spark):
    cases = [("7", 7), ("007", 7), ("7.0", None), ("x", None), ("", None), (None, None)]
    cases += [("-1", None), ("99999999999", None), ("2147483647", 2147483647), ("12\n", None)]
    apply_rule(spark, cases, text.digits_to_int)


def test_age_window(spark):
    cases = [(12, None), (13, 13), (100, 100), (101, None), (None, None)]
    apply_rule(spark, cases, domains.plausible_age, "int")


def test_gender(spark):
    cases = [("Male", "male"), ("m", "male"), ("misc", "male"), (" F ", "female")]
    cases += [("n/a", "unknown"), ("NA", "unknown"), ("Unknown", "unknown"), ("", "unknown")]
    cases += [(None, "unknown"), ("Nonbinary", "other")]
    apply_rule(spark, cases, lambda c: domains.gender(text.lower_token(c)))


def test_title_case(spark):
    cases = [("new york", "New York"), ("stratford-on-avon", "Stratford-On-Avon")]
    cases += [("o'brien", "O'Brien"), ("WINSTON-SALEM", "Winston-Salem"), ("3rd st", "3rd St")]
    cases += [("a\u0001 b", "A\u0001 B"), ("école", "École"), (None, None)]
    cases += [("district of columbia", "District Of Columbia")]
    apply_rule(spark, cases, text.title_case)


def test_payment_method(spark):
    cases = [("Credit Card", "credit_card"), ("debit card", "debit_card"), ("PayPal", "paypal")]
    cases += [("Bank Transfer", "bank_transfer"), ("VENMO", "venmo"), ("cash", "cash")]
    cases += [("Gift", "other"), (None, "other"), ("", "other")]
    cases += [("debit or credit", "credit_card"), ("cash via bank", "bank_transfer")]
    apply_rule(spark, cases, lambda c: domains.payment_method(text.lower_token(c)))


def test_subscription_and_seller(spark):
    cases = [("Yes", "yes"), ("y", "yes"), ("TRUE", "yes"), ("1", "yes"), ("No", "no")]
    cases += [("n", "no"), ("false", "no"), ("0", "no"), ("maybe", None), (None, None)]
    apply_rule(spark, cases, lambda c: domains.subscription(text.lower_token(c)))
    cases = [("y", "Y"), ("YES", "Y"), ("true", "Y"), ("1", "Y"), ("n", "N"), ("No", "N")]
    cases += [("FALSE", "N"), ("0", "N"), ("?", None), ("", None)]
    apply_rule(spark, cases, lambda c: domains.seller_flag(text.upper_token(c)))


def test_first_price(spark):
    cases = [("$237.68", "237.68"), ("$1,234.56", "1234.56"), ("$1,234", "1.00")]
    cases += [("1234.56", "1234.56"), ("74.99249.99", "74.99"), ("$10.99 - $25.99", "10.99")]
    cases += [("Total price: $ 12.5", "12.50"), ("-5.00", "5.00"), ("$12.999", "12.99")]
    cases += [("$12,345,678.90", "12345678.90"), ("99999999", "99999999.00")]
    expected = [(x, Decimal(y)) for x, y in cases]
    expected += [("N/A", None), ("", None), (None, None), ("100000000", None)]
    apply_rule(spark, expected, prices.first_price)


def test_leftmost_label(spark):
    cases = [("A | B", "A"), ("A > B", "A"), ("| B", "Other"), ("", "Other"), ("A", "A")]
    cases += [(None, "Other"), (" A>B|C ", "A"), ("> A", "Other")]
    apply_rule(spark, cases, lambda c: text.leftmost_label(c, "Other"))


def test_interaction(spark):
    cases = [("PURCHASE", "purchase"), (" view", "view"), ("like", "like")]
    cases += [("click", None), ("", None), (None, None)]
    apply_rule(spark, cases, lambda c: domains.interaction(text.lower_token(c)))


def test_season(spark):
    names = ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]
    apply_rule(spark, list(zip(range(1, 13), names)), domains.season_uk, "int")


def test_text_to_number(spark):
    cases = [("1.5", 1.5), (" 2 ", 2.0), ("1e3", 1000.0), ("x", None), ("", None)]
    cases += [("1.5d", None), ("1f", None), (None, None)]
    apply_rule(spark, cases, text.text_to_number)


# text, UTC reading, local date, local text
EVENTS = [
    ("10/10/2023 8:00", "2023-10-10 07:00:00", "2023-10-10", "2023-10-10 08:00:00+01"),
    ("01/01/2023 08:00", "2023-01-01 08:00:00", "2023-01-01", "2023-01-01 08:00:00+00"),
    ("15/07/2023 0:30", "2023-07-14 23:30:00", "2023-07-15", "2023-07-15 00:30:00+01"),
    # the hour that occurs twice is standard time
    ("29/10/2023 1:30", "2023-10-29 01:30:00", "2023-10-29", "2023-10-29 01:30:00+00"),
    ("29/10/2023 0:59", "2023-10-28 23:59:00", "2023-10-29", "2023-10-29 00:59:00+01"),
    # the hour that does not exist moves on
    ("26/03/2023 1:30", "2023-03-26 01:30:00", "2023-03-26", "2023-03-26 02:30:00+01"),
    # a gap of the session zone has no effect
    ("12/03/2023 2:30", "2023-03-12 02:30:00", "2023-03-12", "2023-03-12 02:30:00+00"),
    ("31/12/1969 23:00", "1969-12-31 22:00:00", "1969-12-31", "1969-12-31 23:00:00+01"),
    # what follows the minute is ignored; time and minute may be missing
    ("1/1/2023 8:00:30", "2023-01-01 08:00:00", "2023-01-01", "2023-01-01 08:00:00+00"),
    ("1/1/2023 8:05 (till\n9)", "2023-01-01 08:05:00", "2023-01-01", "2023-01-01 08:05:00+00"),
    ("15/7/2023", "2023-07-14 23:00:00", "2023-07-15", "2023-07-15 00:00:00+01"),
    ("15-7-2023  8", "2023-07-15 07:00:00", "2023-07-15", "2023-07-15 08:00:00+01"),
    ("15.7.2023 8:", "2023-07-15 07:00:00", "2023-07-15", "2023-07-15 08:00:00+01"),
]
NOT_EVENTS = ["31/02/2023 8:00", "", None, "1/13/2023 8:00", "1/1/23 8:00", "1/1/2023 24:00"]
NOT_EVENTS += ["1/1/2023 at noon", "1/1/2023x", "1/1/2023 8:60", "1/1/2023 8pm", "on 1/1/2023", "1/1/20233"]


def test_event_times(spark):
    df = spark.createDataFrame([(e[0],) for e in EVENTS], "x string").coalesce(1)
    timed = df.withColumn("wall", clock.read_wall(F.col("x")))
    timed = clock.with_instant(timed, "wall", "ts")
    local = F.from_utc_timestamp("ts", clock.LONDON)
    got = timed.select(
        "x",
        clock.utc_clock(F.col("ts")).cast("string"),
        clock.utc_date(F.col("wall")).cast("string"),
        clock.stamp_text(F.col("ts"), local),
    )
    assert tuples(got) == EVENTS


def test_impossible_times(spark):
    apply_rule(spark, [(x, None) for x in NOT_EVENTS], clock.read_wall)


def test_stamp_text_in_half_hour_zones(spark):
    df = spark.sql("SELECT timestamp_seconds(0) AS ts")
    for zone, expected in [
        ("Asia/Kolkata", "1970-01-01 05:30:00+05:30"),
        ("America/St_Johns", "1969-12-31 20:30:00-03:30"),
    ]:
        local = F.from_utc_timestamp("ts", zone)
        assert tuples(df.select(clock.stamp_text(F.col("ts"), local))) == [(expected,)]


def test_ratio_rounds_once(spark):
    rows = [("1.00", "3"), ("-1.00", "3"), ("0.01", "2"), ("-0.01", "2"), ("5", "0")]
    rows += [(None, "1"), ("1", None), ("0", "7")]
    # just below a tie: rounding at a finite scale first would give 0.01
    rows += [("49999999999999999.99", "10000000000000000000")]
    df = spark.createDataFrame(rows, "n string, d string").coalesce(1)
    n, d = F.col("n").cast("decimal(22,2)"), F.col("d").cast("decimal(22,2)")
    got = [r[0] for r in df.select(prices.ratio(n, d)).collect()]
    expected = ["0.33", "-0.33", "0.01", "-0.01", None, None, None, "0.00", "0.00"]
    assert got == [x and Decimal(x) for x in expected]


# Published figures: orders, revenue and what they gave.
PAYMENTS = [(153, 5061.08, 33.08, 19.38), (147, 5026.89, 34.20, 19.25), (146, 4324.35, 29.62, 16.56)]
PAYMENTS += [(152, 4315.57, 28.39, 16.53), (121, 3869.81, 31.98, 14.82), (128, 3517.69, 27.48, 13.47)]
MONTHS = [(25, 700.37, 28.01), (122, 3479.34, 28.52), (37, 1264.57, 34.18), (34, 1101.86, 32.41)]
MONTHS += [(35, 2221.68, 63.48), (36, 982.01, 27.28), (37, 801.35, 21.66), (28, 627.11, 22.40)]
MONTHS += [(26, 775.56, 29.83), (31, 1211.44, 39.08), (119, 3140.90, 26.39), (167, 5273.60, 31.58)]
MONTHS += [(150, 4535.60, 30.24)]
SHARES = [(8949.34, 34.27), (6798.51, 26.03), (6455.74, 24.72), (3911.80, 14.98)]
SHARES += [(17583.61, 67.33), (2827.61, 10.83), (1887.81, 7.23), (1693.35, 6.48), (968.55, 3.71)]
SHARES += [(292.98, 1.12), (226.57, 0.87), (213.86, 0.82), (147.07, 0.56), (102.31, 0.39)]
SHARES += [(50.39, 0.19), (44.83, 0.17), (38.88, 0.15), (18.80, 0.07), (18.77, 0.07)]
TOTAL = 26115.39


@pytest.mark.parametrize(
    "rows",
    [
        [(rev, n, aov, 1) for n, rev, aov, _ in PAYMENTS] + [(TOTAL, 847, 30.83, 1)],
        [(rev, n, aov, 1) for n, rev, aov in MONTHS],
        [(rev, TOTAL, pct, 100) for _, rev, _, pct in PAYMENTS]
        + [(rev, TOTAL, pct, 100) for rev, pct in SHARES],
    ],
)
def test_published_ratios(spark, rows):
    df = spark.createDataFrame(
        [(money(a), money(b), money(c)) for a, b, c, _ in rows],
        "a decimal(12,2), b decimal(12,2), expected decimal(12,2)",
    )
    rule = prices.ratio if rows[0][3] == 1 else prices.share_pct
    wrong = df.where(rule(F.col("a"), F.col("b")) != F.col("expected"))
    assert tuples(wrong) == []


def test_published_figures_agree():
    assert sum(p[0] for p in PAYMENTS) == sum(m[0] for m in MONTHS) == 847
    assert sum(money(p[1]) for p in PAYMENTS) == sum(money(m[1]) for m in MONTHS) == money(TOTAL)


