"""Calendar periods: segments cut at month bounds, cents dealt out so that they add up, fiscal years.

AGG4 and SEG7 with exact sums.  A segment over several months is cut into one part a month.  Its
amount is dealt out to the parts in whole cents by the largest remainder: each part gets the cents
that its share of the days has in full, and the cents left over go, one each, to the parts with the
largest remainders (the earlier part on a tie).  The parts of a segment stay in its own row until
they are final, so cutting needs no shuffle, and the sum of the parts is the segment's amount.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions._col import as_col

CENTS = "decimal(20,0)"


def fiscal_year(date, start_month: int = 1) -> Column:
    """The year in which the fiscal year of a date began; it begins on the first of ``start_month``."""
    d = as_col(date)
    return F.year(d) - F.when(F.month(d) < start_month, 1).otherwise(0)


def fiscal_period(date, start_month: int = 1) -> Column:
    """1 for the first month of the fiscal year up to 12."""
    return F.pmod(F.month(as_col(date)) - F.lit(start_month), F.lit(12)) + 1


def fiscal_window(year: int, start_month: int = 1) -> tuple[_dt.date, _dt.date]:
    """FLT8: first and last day of the fiscal year that begins in ``year``, for ``analysis_window``."""
    if not 1 <= start_month <= 12:
        raise ValueError("start_month must be 1 to 12")
    return _dt.date(year, start_month, 1), _dt.date(year + 1, start_month, 1) - _dt.timedelta(days=1)


def allocate(cents: Column, weights: Column) -> Column:
    """Whole ``cents`` dealt out by an array of positive weights: an array that sums to ``cents``.

    Largest remainder; a negative amount is dealt out like its absolute value.  NULL cents give
    NULLs, an empty array of weights an empty one.
    """
    size, positive = F.abs(cents), F.signum(cents).cast(CENTS)

    def share(weights: Column, total: Column) -> Column:
        return F.transform(weights, lambda w, i: F.struct(((size * w) % total).cast("bigint").alias("rest"), (-i).alias("place"),
                                                          ((size * w - (size * w) % total) / total).cast(CENTS).alias("full")))

    def cut(shares: Column) -> Column:
        """The last of those that get one of the cents left over; NULL if none is."""
        left = (size - F.aggregate(shares, F.lit(0).cast(CENTS), lambda a, s: (a + s["full"]).cast(CENTS))).cast("int")
        ranked = F.sort_array(F.transform(shares, lambda s: F.struct(s["rest"], s["place"])), asc=False)
        return F.when(F.size(shares) > 0, F.try_element_at(ranked, F.nullif(left, F.lit(0))))

    def dealt(shares: Column, last: Column) -> Column:
        return F.transform(shares, lambda s: (positive * (s["full"] + F.when(F.struct(s["rest"], s["place"]) >= last, 1).otherwise(0))).cast(CENTS))

    total = F.aggregate(weights, F.lit(0).cast("bigint"), lambda a, w: a + w)
    return _let(total, lambda t: _let(share(weights, t), lambda shares: _let(cut(shares), lambda last: dealt(shares, last))))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often, and inside whatever lambda, the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_by_month(segments: DataFrame, start: str, end: str, amounts: list[str], part_start: str = "part_start", part_end: str = "part_end",
                   part_days: str = "part_days") -> DataFrame:
    """One row per month that a segment touches, amounts dealt out by days (DECIMAL(18,2)).

    All other columns are repeated; ``part_start`` / ``part_end`` / ``part_days`` are added.  An
    amount is rounded to cents first; the parts of a segment sum to that exactly.  A segment
    without both dates, or that ends before it starts, is one part as it is, with no days and its
    whole amount.
    """
    s, e = as_col(start), as_col(end)
    whole = F.coalesce(s <= e, F.lit(False))
    months = F.sequence(F.trunc(s, "MM"), F.trunc(e, "MM"), F.expr("interval 1 month"))
    parts = F.transform(months, lambda m: F.struct(F.greatest(s, m).alias("s"), F.least(e, F.last_day(m)).alias("e")))
    parts = F.transform(parts, lambda p: F.struct(p["s"], p["e"], (F.datediff(p["e"], p["s"]) + 1).cast("bigint").alias("n")))
    alone = F.array(F.struct(s.alias("s"), e.alias("e"), F.lit(0).cast("bigint").alias("n")))
    held = segments.withColumn("_parts", F.when(whole, parts).otherwise(alone))
    days = F.when(whole, F.transform("_parts", lambda p: p["n"])).otherwise(F.array(F.lit(1).cast("bigint")))
    held = held.withColumn("_days", days)
    for i, a in enumerate(amounts):
        cents = (as_col(a).cast("decimal(18,2)") * 100).cast(CENTS)
        held = held.withColumn(f"_cents{i}", allocate(cents, F.col("_days")))
    dealt = [F.col(f"_cents{i}") for i in range(len(amounts))]
    held = held.withColumn("_p", F.explode(F.arrays_zip(F.col("_parts"), *dealt))).drop("_parts", "_days", *(f"_cents{i}" for i in range(len(amounts))))
    money = {a: (F.col(f"_p._cents{i}") / 100).cast("decimal(18,2)") for i, a in enumerate(amounts)}
    return held.withColumns({part_start: F.col("_p._parts.s"), part_end: F.col("_p._parts.e"), part_days: F.col("_p._parts.n"), **money}).drop("_p")


def period_rollup(segments: DataFrame, start: str, end: str, unit: str, amount: str, start_month: int = 1) -> DataFrame:
    """Days and cost per (fiscal year, fiscal period, unit), each day and cent in the month to which it belongs.

    ``segments`` counts the parts.  Amounts are summed as DECIMAL; only partial sums are shuffled.
    """
    narrow = segments.select(as_col(start).alias("start"), as_col(end).alias("end"), as_col(unit).alias("org_unit"), as_col(amount).alias("cost"))
    parts = split_by_month(narrow, "start", "end", ["cost"])
    return (parts.groupBy(fiscal_year("part_start", start_month).alias("fiscal_year"), fiscal_period("part_start", start_month).alias("period"), "org_unit")
                 .agg(F.count(F.lit(1)).alias("segments"), F.sum("part_days").cast("bigint").alias("days"), F.sum("cost").cast("decimal(38,2)").alias("total_cost")))
