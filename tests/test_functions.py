import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (blank_to_null, inclusive_days, is_blank, parse_dirty_date,
                                parse_dirty_decimal, round2, safe_daily_rate, strip_ws, days_as_int)
from tidemark.functions.dates import OPEN_END_CLAMP


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("", None), ("  ", None), ("00.00.0000", None), (None, None),
    (" 01.02.2024 ", dt.date(2024, 2, 1)), ("1.2.2024", dt.date(2024, 2, 1)),
    ("31.12.9999", dt.date(9999, 12, 31)),
])
def test_dirty_date(spark, text, expected):
    assert _one(spark, parse_dirty_date("v"), text) == expected


def test_dirty_date_invalid_fails_or_nulls(spark):
    with pytest.raises(Exception):
        _one(spark, parse_dirty_date("v"), "30.02.2024")
    assert _one(spark, parse_dirty_date("v", on_error="null"), "30.02.2024") is None


def test_open_end_clamp(spark):
    assert _one(spark, parse_dirty_date("v", open_end=OPEN_END_CLAMP), "31.12.9999") == dt.date(2099, 12, 31)
    assert _one(spark, parse_dirty_date("v", open_end=OPEN_END_CLAMP), "30.12.9999") == dt.date(9999, 12, 30)


@pytest.mark.parametrize("text,expected", [
    ("", None), ("   ", None), ("1,234,567.89", Decimal("1234567.89")), ("-12.345", Decimal("-12.35")),
    (" 7 ", Decimal("7.00")),
])
def test_dirty_decimal(spark, text, expected):
    assert _one(spark, parse_dirty_decimal("v"), text) == expected


def test_trailing_minus_is_an_error(spark):
    with pytest.raises(Exception):
        _one(spark, parse_dirty_decimal("v"), "100.00-")
    assert _one(spark, parse_dirty_decimal("v", on_error="null"), "100.00-") is None


def test_strip_is_python_strip(spark):
    for s in ["  x y \t", "\r\nabc ", "   ", "a"]:
        assert _one(spark, strip_ws("v"), s) == s.strip()


def test_blank_helpers(spark):
    assert _one(spark, blank_to_null("v"), "  ") is None
    assert _one(spark, blank_to_null("v"), " a ") == "a"
    assert _one(spark, is_blank("v"), None) is True
    assert _one(spark, is_blank("v"), " ") is True
    assert _one(spark, is_blank("v"), "x") is False


def test_round2_is_scale_round_divide(spark):
    # 1.005 * 100 = 100.49999999999999 -> 100 -> 1.0 (Spark's round(x, 2) gives 1.01)
    assert _one(spark, round2("v"), 1.005, "v double") == 1.0
    assert _one(spark, round2("v"), 2.5, "v double") == 2.5
    assert _one(spark, round2("v"), -0.125, "v double") == -0.13
    assert _one(spark, round2("v"), 0.125, "v double") == 0.13


def test_days_and_rates(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 31), "31", Decimal("310.00"))],
                               "s date, e date, d string, a decimal(18,2)")
    r = df.select(inclusive_days("s", "e").alias("n"), safe_daily_rate("a", days_as_int("d")).alias("r"),
                  safe_daily_rate("a", F.lit(0)).alias("z"), days_as_int(F.lit("31.5")).alias("h")).first()
    assert r["n"] == 31 and r["r"] == 10.0 and r["z"] is None and r["h"] == 32
