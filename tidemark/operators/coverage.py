"""Coverage balance: what the overlap joins lose and double, by a sweep over interval end points.

A Gold segment exists for the days on which every matched dimension has a row.  So days of a fact
that a matched dimension leaves uncovered are lost, days covered twice are doubled, and a fact
whose dimensions never meet on a day vanishes.  ``coverage_balance`` counts these days without
making the segments.

Every dimension row is +1 on its first day and -1 after its last; every fact asks at its first day
and after its last.  Equal (key, day) fall together before any shuffle, so a key has at most as
many points as there are days, however many rows it has.  Points are swept in windows of one key
and ``bucket_days`` days; what a window must know of earlier ones, how many rows are open and how
many days were covered so far, is carried over from one summary row per window.  The days between
two points of a fact are then the difference of two running sums, and no fact meets a dimension row.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions._col import as_col, quote
from tidemark.functions.dates import day_number
from tidemark.functions.numbers import round2
from tidemark.operators.temporal import DimSpec

BUCKET_DAYS = 512


def _events(dims: Mapping[str, DimSpec]) -> DataFrame:
    """(key, day, open_<i>): how many rows of dimension i begin minus how many ended the day before."""
    out = None
    for i, d in enumerate(dims.values()):
        key = F.trim(as_col(d.key)) if d.trim_key else as_col(d.key)
        first, last = day_number(d.valid_from), day_number(d.valid_to)
        rows = d.df.select(key.alias("key"), first.alias("first"), last.alias("last")).where("key <> '' and first <= last")
        ends = F.explode(F.array(F.struct(F.col("first").alias("day"), F.lit(1).alias("open")), F.struct((F.col("last") + 1).alias("day"), F.lit(-1).alias("open"))))
        rows = rows.select("key", ends.alias("e")).select("key", "e.day", *[(F.col("e.open") if j == i else F.lit(0)).cast("bigint").alias(f"open_{j}") for j in range(len(dims))])
        out = rows if out is None else out.unionAll(rows)
    return out


def _subsets(n: int) -> list[tuple[int, ...]]:
    return [s for size in range(1, n + 1) for s in combinations(range(n), size)]


def _together(subset: tuple[int, ...]) -> str:
    return "both_" + "_".join(map(str, subset))


def swept(points: DataFrame, dims: Mapping[str, DimSpec], bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """At each asked (key, day) the sums over the key's earlier days.

    ``once_<i>`` and ``more_<i>`` are days on which one, or two and more, rows of dimension i are
    valid; ``both_<i>_<j>...`` sums the number of combinations of rows of several dimensions
    (``both_<i>`` the number of rows of one).
    """
    n = len(dims)
    opens = [f"open_{i}" for i in range(n)]
    asked = points.select("key", "day", *[F.lit(0).cast("bigint").alias(c) for c in opens], F.lit(True).alias("asked"))
    events = _events(dims).withColumn("asked", F.lit(False)).unionAll(asked)
    events = events.groupBy("key", "day").agg(*[F.sum(c).alias(c) for c in opens], F.bool_or("asked").alias("asked"))
    events = events.withColumn("bucket", F.floor(F.col("day") / bucket_days).cast("bigint"))

    earlier = Window.partitionBy("key").orderBy("bucket")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    opened = events.groupBy("key", "bucket").agg(*[F.sum(c).alias(c) for c in opens], F.min("day").alias("first"))
    opened = opened.select("key", "bucket", F.lead("first").over(earlier).alias("next_first"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"was_{c}") for c in opens])

    inside = Window.partitionBy("key", "bucket").orderBy("day")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    steps = events.join(opened, ["key", "bucket"]).select(
        "key", "bucket", "day", "asked", (F.coalesce(F.lead("day").over(inside), "next_first", "day") - F.col("day")).alias("days"),
        *[(F.col(f"was_{c}") + F.sum(c).over(upto)).alias(c) for c in opens])
    counted: dict[str, Column] = {}
    for i in range(n):
        counted[f"once_{i}"] = F.when(F.col(opens[i]) == 1, F.col("days")).otherwise(F.lit(0))
        counted[f"more_{i}"] = F.when(F.col(opens[i]) > 1, F.col("days")).otherwise(F.lit(0))
    for subset in _subsets(n):
        product = F.col("days")
        for i in subset:
            product = product * F.col(opens[i])
        counted[_together(subset)] = product
    steps = steps.select("key", "bucket", "day", "asked", *[c.cast("bigint").alias(name) for name, c in counted.items()])
    sums = steps.groupBy("key", "bucket").agg(*[F.sum(c).alias(c) for c in counted])
    sums = sums.select("key", "bucket", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"was_{c}") for c in counted])
    running = inside.rowsBetween(Window.unboundedPreceding, -1)
    return steps.join(sums, ["key", "bucket"]).select(
        "key", "day", "asked", *[(F.col(f"was_{c}") + F.coalesce(F.sum(c).over(running), F.lit(0))).alias(c) for c in counted]).where("asked").drop("asked")


def coverage_balance(fact: DataFrame, key: str, valid_from: str, valid_to: str, dims: Mapping[str, DimSpec], rate: str | None = None,
                     bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """The fact's columns, its days, and for each named dimension the days covered 0, 1 and more times.

    Per dimension ``d``: ``d_days_0``, ``d_days_1``, ``d_days_2`` (two rows or more) and
    ``d_days_extra`` (rows beyond the first, summed over days).  ``days_out`` are the days that the
    Gold segments of the fact have together: a dimension of which no row overlaps the fact leaves
    its days alone, others multiply them.  ``vanishes`` marks facts with days of which none is
    left.  With a daily ``rate``: ``d_cost_lost`` (uncovered days of a matched dimension) and
    ``d_cost_doubled``, rounded like segments.

    A blank or NULL key matches nothing (keys are compared as they are, like in the overlap join); a fact without both dates, or whose last day is before the
    first, has no days.  A dimension row with a NULL date or key, or that ends before it begins, covers
    no day and matches nothing.  Rows that repeat count each; an empty dimension covers nothing, an
    empty fact table gives no rows.
    """
    taken = {c.lower() for c in fact.columns}
    made = ["days", "days_out", "vanishes", *(f"{d}_{x}" for d in dims for x in ("days_0", "days_1", "days_2", "days_extra", "cost_lost", "cost_doubled"))]
    if clash := [c for c in made if c.lower() in taken]:
        raise ValueError(f"output columns {clash} already exist")
    k = as_col(key)
    first, last = day_number(valid_from), day_number(valid_to)
    held = fact.select("*", F.when((k != "") & (first <= last), k).alias("_key"), first.alias("_first"), (last + 1).alias("_after"))
    points = held.where("_key is not null").select(F.col("_key").alias("key"), F.explode(F.array("_first", "_after")).alias("day")).distinct()
    sums = swept(points, dims, bucket_days)
    names = [c for c in sums.columns if c not in ("key", "day")]
    for side, day in (("a", "_first"), ("b", "_after")):
        at = sums.select(F.col("key").alias(f"_{side}_key"), F.col("day").alias(f"_{side}_day"), *[F.col(c).alias(f"_{side}_{c}") for c in names])
        held = held.join(at, (F.col("_key") == F.col(f"_{side}_key")) & (F.col(day) == F.col(f"_{side}_day")), "left")

    between = lambda c: F.coalesce(F.col(f"_b_{c}") - F.col(f"_a_{c}"), F.lit(0)).cast("bigint")
    days = F.greatest(F.coalesce(F.col("_after") - F.col("_first"), F.lit(0)), F.lit(0)).cast("bigint")
    own, matched = [], []
    for i, d in enumerate(dims):
        once, more = between(f"once_{i}"), between(f"more_{i}")
        extra = between(_together((i,))) - once - more
        matched.append(once + more > 0)
        own += [(days - once - more).alias(f"{d}_days_0"), once.alias(f"{d}_days_1"), more.alias(f"{d}_days_2"), extra.alias(f"{d}_days_extra")]
        if rate is not None:
            lost = F.when(matched[i], days - once - more).otherwise(F.lit(0))
            own += [round2(as_col(rate) * lost).alias(f"{d}_cost_lost"), round2(as_col(rate) * extra).alias(f"{d}_cost_doubled")]
    out = F.lit(None).cast("bigint")
    for subset in _subsets(len(dims)):
        exactly = F.lit(True)
        for i, m in enumerate(matched):
            exactly = exactly & (m if i in subset else ~m)
        out = F.coalesce(out, F.when(exactly, between(_together(subset))))
    out = F.coalesce(out, days)
    return held.select(*[F.col(quote(c)) for c in fact.columns], days.alias("days"), *own, out.alias("days_out"), ((days > 0) & (out == 0)).alias("vanishes"))
