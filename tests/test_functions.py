from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from posloom.functions import calendar as cal
from posloom.functions import conditions as cond
from posloom.functions import numbers as num
from posloom.functions import text


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    "function, value, expected",
    [
        (text.strip, "\t a b \n", "a b"),
        (text.blank_to_null, "  ", None),
        (lambda c: text.part(c, ".", 2), "a.b.c", "c"),
        (lambda c: text.part(c, ".", 2), "1.2", None),
        (lambda c: text.part(c, ".", 2), None, None),
        (lambda c: text.after_first(c, " "), "123 Car Seat", "Car Seat"),
        (lambda c: text.after_first(c, " "), "777", ""),
        (lambda c: text.after_first(c, " "), None, None),
        (lambda c: text.with_prefix("00", c), None, None),
        (lambda c: text.from_offset(c, 2), "0012345", "12345"),
        (lambda c: text.from_offset(c, 2), "0", ""),
        (lambda c: text.without(c, "-"), "030-01-0001", "030010001"),
        (lambda c: text.lstrip_chars(c, "0"), "000120", "120"),
        (text.pad_upc, "190000000001 ", "0190000000001"),
        (text.pad_upc, "884392000001", "884392000001"),
        (text.pad_upc, None, None),
        (text.normalise_name, "BBB-Mainline (été).xlsx", "bbbmainline étéxlsx"),
        (text.joined_digits, "bbb-2020-01-05", "20200105"),
        (lambda c: text.name_has_token(c, "bbb-maxi"), "BBBMaxi TL.xlsx", True),
    ],
)
def test_text(spark, function, value, expected):
    assert one(spark, function, value) == expected


def test_line_record(spark):
    record = one(spark, lambda c: text.line_record(c, ["a", "b", "c"]), " 1 ,2")
    assert record == {"a": "1", "b": "2"}


@pytest.mark.parametrize(
    "value, nonzero, known, positive",
    [("0", False, False, False), ("-5", True, True, False), ("3", True, True, True), (None, True, False, None)],
)
def test_amount_conditions(spark, value, nonzero, known, positive):
    amount = None if value is None else Decimal(value)
    assert one(spark, cond.nonzero, amount, "decimal(18,4)") is nonzero
    assert one(spark, cond.known_nonzero, amount, "decimal(18,4)") is known
    assert one(spark, cond.positive, amount, "decimal(18,4)") is positive


def test_sentinel_and_tags(spark):
    assert one(spark, lambda c: cond.not_sentinel(c, "Total"), None) is True
    assert one(spark, lambda c: cond.not_sentinel(c, "Total"), "Total") is False
    assert one(spark, cond.brand_tier, "QUINNY") == "Premium"
    assert one(spark, cond.brand_tier, "Quinny") == "Mainline"
    assert one(spark, cond.brand_tier, None) == "Mainline"
    assert one(spark, lambda c: cond.clicks_when(c, "ONLINE"), None) == "Bricks"
    assert one(spark, lambda c: cond.bricks_when(c, "STORE"), None) == "Clicks"


@pytest.mark.parametrize(
    "value, expected",
    [("12.5", Decimal("12.5000")), (" 7 ", Decimal("7")), ("n/a", None), (None, None), ("1e2", Decimal("100"))],
)
def test_money_from_text(spark, value, expected):
    assert one(spark, num.money, value) == expected


def test_numbers(spark):
    nan = one(spark, lambda c: num.money(c, is_text=False), float("nan"), "double")
    assert nan is None
    assert one(spark, num.dash_to_zero, "--") == "0"
    for raw, cents in [("0.125", "0.12"), ("0.135", "0.14"), ("-0.125", "-0.12")]:
        assert one(spark, num.round_cents, Decimal(raw), "decimal(18,4)") == Decimal(cents)
    assert one(spark, num.whole, Decimal("-2.9"), "decimal(18,4)") == -2


# run date, previous week's Saturday, rolled forward, year and quarter of the former
CALENDAR = [
    (dt.date(2020, 1, 5), dt.date(2019, 12, 28), dt.date(2020, 1, 11), 2019, 4),
    (dt.date(2020, 3, 1), dt.date(2020, 2, 22), dt.date(2020, 3, 7), 2020, 1),
    (dt.date(2020, 3, 2), dt.date(2020, 2, 29), dt.date(2020, 3, 7), 2020, 1),
    (dt.date(2020, 3, 7), dt.date(2020, 2, 29), dt.date(2020, 3, 7), 2020, 1),
]


@pytest.mark.parametrize("day, previous, rolled, year, quarter", CALENDAR)
def test_calendar(spark, day, previous, rolled, year, quarter):
    assert one(spark, cal.previous_week_saturday, day, "date") == previous
    assert one(spark, cal.roll_to_saturday, day, "date") == rolled
    assert cal.week_values(day) == (previous, year, quarter)
    assert one(spark, lambda d: cal.year_of(cal.previous_week_saturday(d)), day, "date") == year
    assert one(spark, lambda d: cal.quarter_of(cal.previous_week_saturday(d)), day, "date") == quarter


def test_week_values_agree_with_the_column_for_a_year(spark):
    days = [(dt.date(2019, 12, 1) + dt.timedelta(days=i),) for i in range(400)]
    df = spark.createDataFrame(days, "d date").select(
        "d", cal.previous_week_saturday(F.col("d")).alias("w"),
        cal.previous_week_start(F.col("d")).alias("s"), cal.previous_week_end(F.col("d")).alias("e"),
    )
    for d, w, s, e in df.collect():
        assert cal.week_values(d)[0] == w
        assert s.weekday() == 0 and e.weekday() == 6 and s + dt.timedelta(days=5) == w and (e - s).days == 6
