"""Dirty-amount parsing and proration arithmetic (FN3, FN6, FN9, FN10, FN13, SEG3, SEG4, SEG7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidemark.functions._col import as_col


def strip_thousands(c) -> Column:
    """Remove the thousands separator (EXT12, FN6)."""
    return F.replace(as_col(c).cast("string"), F.lit(","), F.lit(""))


def parse_dirty_decimal(c, precision: int = 18, scale: int = 2, on_error: str = "fail") -> Column:
    """FN3: ``CAST(REPLACE(NULLIF(TRIM(x), ''), ',', '') AS DECIMAL(18,2))`` (half-up to scale).

    Text such as ``100.00-`` is an error under ANSI casts; ``on_error='null'`` uses ``try_cast``.
    """
    t = F.replace(F.nullif(F.trim(as_col(c).cast("string")), F.lit("")), F.lit(","), F.lit(""))
    dt = DecimalType(precision, scale)
    if on_error == "null":
        return t.try_cast(dt)
    if on_error != "fail":
        raise ValueError("on_error must be 'fail' or 'null'")
    return t.cast(dt)


def days_as_int(c) -> Column:
    """FN13: text -> INTEGER the way the source SQL casts it (``'31.5'`` rounds to 32).

    Spark's ANSI cast refuses ``'31.5'`` as INT, so go through DOUBLE and round half away
    from zero; integral input is unchanged.  Blank text stays an error, as in the source.
    """
    return F.round(as_col(c).cast("double")).cast("int")


def safe_daily_rate(amount, days) -> Column:
    """SEG3: ``amount / NULLIF(days, 0)`` as DOUBLE (zero days -> NULL).

    The amount is cast to DOUBLE first: DECIMAL / INT is DOUBLE in the source engine but
    ``decimal(29,13)`` in Spark (S3).
    """
    return as_col(amount).cast("double") / F.nullif(as_col(days), F.lit(0))


def round2(x) -> Column:
    """FN10: ``ROUND(x, 2)`` on DOUBLE as ``round(x*100)/100``, half away from zero.

    This is the double rounding of the source engine (scale by 100, round, divide);
    Spark's ``round(x, 2)`` differs on values like 1.005 (S4).
    """
    return F.round(as_col(x) * F.lit(100.0)) / F.lit(100.0)
