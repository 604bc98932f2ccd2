"""Scalar Column builders.  Everything here is a built-in Spark expression (codegen'd, JVM-side)."""

from tidemark.functions.text import strip_ws, blank_to_null, is_blank, trimmed
from tidemark.functions.dates import (
    parse_dirty_date, inclusive_days, day_bucket, to_date_col, OPEN_END_TEXT, OPEN_END_CLAMP,
)
from tidemark.functions.numbers import (
    parse_dirty_decimal, days_as_int, safe_daily_rate, round2, strip_thousands,
)

__all__ = [
    "strip_ws", "blank_to_null", "is_blank", "trimmed",
    "parse_dirty_date", "inclusive_days", "day_bucket", "to_date_col", "OPEN_END_TEXT", "OPEN_END_CLAMP",
    "parse_dirty_decimal", "days_as_int", "safe_daily_rate", "round2", "strip_thousands",
]
