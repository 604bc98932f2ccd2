"""Dirty-date parsing and interval arithmetic (FN1, FN2, FN11, FN15, FN17, SEG2)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._col import as_col

# Fixed values of the source exports: the day.month.year text format, the two texts that
# mean "no date", and the open-end marker with the date the prototype clamps it to.
DATE_FORMAT = "d.M.y"
NO_DATE_TEXTS = ("", "00.00.0000")
OPEN_END_TEXT = "31.12.9999"
OPEN_END_CLAMP = _dt.date(2099, 12, 31)

_EPOCH = _dt.date(1970, 1, 1)


def parse_dirty_date(c, fmt: str = DATE_FORMAT, no_date=NO_DATE_TEXTS,
                     open_end: _dt.date | None = None, on_error: str = "fail") -> Column:
    """FN1: ``TRIM`` in (``''``, ``00.00.0000``) -> NULL, else parse ``dd.mm.yyyy``.

    ``d.M.y`` accepts one- or two-digit day/month like ``strptime``.  Unparseable text is an
    error (ANSI ``to_date``) unless ``on_error='null'`` (``try_to_date``).  ``open_end`` (FN2)
    maps the ``31.12.9999`` marker to the given date; by default year 9999 is kept as is.
    """
    t = F.trim(as_col(c))
    parse = F.try_to_date if on_error == "null" else F.to_date
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    out = F.when(t.isin(*no_date), F.lit(None).cast("date"))
    if open_end is not None:
        out = out.when(t == F.lit(OPEN_END_TEXT), F.lit(open_end))
    return out.otherwise(parse(t, fmt))


def to_date_col(c) -> Column:
    """DATE of a DATE / TIMESTAMP / TIMESTAMP_NTZ column (S9: test parquet holds timestamp_ntz)."""
    return F.to_date(as_col(c))


def inclusive_days(start, end) -> Column:
    """SEG2: closed-interval day count ``date_diff('day', s, e) + 1`` as BIGINT."""
    return (F.datediff(as_col(end), as_col(start)) + F.lit(1)).cast("bigint")


def day_number(c) -> Column:
    """Days since 1970-01-01 as BIGINT."""
    return F.datediff(as_col(c), F.lit(_EPOCH)).cast("bigint")


def day_bucket(c, width_days: int) -> Column:
    """Index of the ``width_days``-wide time bucket holding a date (bucketed overlap joins)."""
    return F.floor(F.datediff(as_col(c), F.lit(_EPOCH)) / F.lit(width_days)).cast("bigint")
