"""Interval-overlap joins, segment clipping and day-weighted proration.

IDs: JN1 (fact x one effective-dated dimension), JN2 (two), JN3 (N), FLT3, FLT4, FLT7,
SEG1-SEG7, SRT1.

Semantics (closed intervals, left outer):  a fact row ``f`` matches a dimension row ``d`` iff
``f.key`` is neither NULL nor ``''``, ``f.key = TRIM(d.key)``, ``f.from <= d.to`` and
``f.to >= d.from``.  Unmatched facts survive with NULL dimension columns.  Each dimension is
matched against the *fact's* interval, so two dimensions give the per-fact product of their
matches, later cut by the segment filter ``seg_start <= seg_end``.

Physical plan.  A plain ``key = key AND overlap`` join compares every fact row of a key with
every dimension row of that key; with one key holding a third of the rows that is quadratic
in one task.  Instead both sides also carry a time bucket, and the join is an equi-join on
``(key, bucket)`` with the overlap as a residual:

* facts fall into length classes: class ``c`` holds facts of length <= L_c (L_0 ~ p99 of the
  fact lengths, L_c = L_0 * 2^c for the rare longer ones; only classes that hold facts exist),
  with buckets B_c = max(4 L_c, span / 256, 28) days wide.  A fact lives in exactly one bucket:
  that of its start date, in its own class;
* each dimension row is copied, per class, into every bucket ``b`` with
  ``bucket_c(d.from - L_c) <= b <= bucket_c(d.to)`` (clamped to the buckets facts start in).
  If ``d`` overlaps a fact ``f`` of class ``c`` then ``d.from <= f.to <= f.from + L_c`` and
  ``d.to >= f.from``, so a copy of ``d`` sits in ``f``'s bucket: every match is found, once.
  The candidates a fact meets are the dimension rows of its key within about 5 L_c + D days of
  it -- a bound that holds for long facts too (no key-only fallback);
* facts that can never match (blank key, NULL date) get a NULL join key and a salt hashed from
  their dates and the ``salt_by`` columns as bucket, so they spread over partitions instead of
  piling into one and still come out of the *same* left join with NULL dimension columns -- one
  scan of the fact, no union.  No other fact column is read for it, so later pruning works.

All dimensions join on the same ``(key, bucket)`` columns of the fact, so the fact side is
shuffled once for the whole chain.  A bucketed dimension is broadcast only when an exact
measurement of it (one aggregate) is under the broadcast threshold, else the join is a
sort-merge join.  AQE splits a (key, bucket) partition that is still skewed; in a chain it does so
only with ``spark.sql.adaptive.forceOptimizeSkewedJoin`` (a session default here), since the next
join reuses the partitioning.  With ``clip_early`` a chain carries no rows whose segment is empty.
"""

from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StructType, VariantType

from tidemark.functions._col import as_col, quote
from tidemark.functions.dates import day_bucket, inclusive_days
from tidemark.functions.numbers import round2, safe_daily_rate

_CLASS_SHIFT = 1 << 40         # bucket id = class * 2^40 + bucket index
_MAX_LOG2 = 24                 # length classes up to 2^24 days (beyond any date range)
_SALT_BUCKETS = 1 << 16        # spread of never-matching facts (their key is NULL, so they never match)
_MIN_WIDTH = 28                # days
_MAX_COPIES = 256              # target bound on bucket copies of one dimension row


@dataclass(frozen=True)
class DimSpec:
    """One effective-dated dimension of an overlap join.

    ``attributes`` maps output column -> dimension column.  ``from_as`` / ``to_as`` name the
    dimension's validity dates in the output (used by segment clipping).
    """

    df: DataFrame
    key: str
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    attributes: dict[str, str] = field(default_factory=dict)
    from_as: str = "dim_valid_from"
    to_as: str = "dim_valid_to"
    trim_key: bool = True


@dataclass(frozen=True)
class LengthClass:
    short: int                  # L: facts of this class have to - from <= L
    width: int                  # B: bucket width in days
    lo: int                     # first / last bucket (of this width) a fact starts in
    hi: int


@dataclass(frozen=True)
class BucketPlan:
    classes: tuple[LengthClass, ...]     # ascending L; empty when no fact can match

    @property
    def max_copies(self) -> int:
        """Upper bound of bucket copies of one dimension row."""
        return sum(c.hi - c.lo + 1 for c in self.classes)


def _width(short: int, span: int) -> int:
    return max(4 * short, math.ceil(span / _MAX_COPIES), _MIN_WIDTH)


def plan_buckets(fact: DataFrame, key: str, valid_from: str, valid_to: str,
                 bucket_days: int | str = "auto") -> BucketPlan:
    """Choose the bucket geometry from one small aggregate over the fact's two date columns.

    The aggregate (start-day range and a count per power-of-two length) reads only the two date
    columns and returns one row.  ``auto``: L_0 = the smallest power of two covering 99 % of the
    fact lengths; a given ``bucket_days`` sets L_0 = B_0 = ``bucket_days``.  Longer facts get the
    classes L = 2^j that hold any of them.
    """
    k, f0, f1 = as_col(key), as_col(valid_from), as_col(valid_to)
    length = F.datediff(f1, f0)
    epoch_days = F.datediff(f0, F.lit(_dt.date(1970, 1, 1)))
    log2 = F.ceil(F.log2(F.greatest(length, F.lit(1)).cast("double")))
    aggs = [F.min(epoch_days).alias("lo"), F.max(epoch_days).alias("hi")]
    aggs += [F.count_if(log2 == F.lit(j)).alias(f"n{j}") for j in range(_MAX_LOG2 + 1)]
    row = fact.where(_matchable(k, f0, f1)).agg(*aggs).first()      # fixed-width hash aggregate
    if row is None or row["lo"] is None:
        return BucketPlan(())
    lo, hi = row["lo"], row["hi"]
    span = hi - lo + 1
    counts = [int(row[f"n{j}"]) for j in range(_MAX_LOG2 + 1)]
    if bucket_days == "auto":
        # p99 at power-of-two resolution, read off the histogram: the smallest 2^j that covers
        # at least 99 % of the facts
        total, acc, j99 = sum(counts), 0, 0
        for j, n in enumerate(counts):
            acc += n
            if acc >= 0.99 * total:
                j99 = j
                break
        base = 1 << j99
        classes = [(base, _width(base, span))]
    else:
        base = int(bucket_days)
        if base < 1:
            raise ValueError("bucket_days must be >= 1")
        classes = [(base, base)]
    for j in range(_MAX_LOG2 + 1):
        if (1 << j) > base and counts[j]:
            classes.append((1 << j, _width(1 << j, span)))
    return BucketPlan(tuple(LengthClass(L, B, lo // B, hi // B) for L, B in classes))


def _matchable(k: Column, f0: Column, f1: Column) -> Column:
    return k.isNotNull() & (k != F.lit("")) & f0.isNotNull() & f1.isNotNull()


def overlap_left_join(fact: DataFrame, key: str, valid_from: str, valid_to: str,
                      dims: Sequence[DimSpec], bucket_days: int | str = "auto",
                      plan: BucketPlan | None = None, broadcast: str | bool = "auto",
                      salt_by: Sequence[str] = (), clip_early: bool = False) -> DataFrame:
    """JN1 / JN2 / JN3: left outer overlap join of ``fact`` with each of ``dims``.

    Output: all fact columns, then per dimension ``from_as``, ``to_as`` and its attributes.

    ``broadcast``: ``"auto"`` measures each bucketed dimension exactly (rows and bytes, one
    aggregate over the dimension's join columns) and broadcasts it only when that size is under
    ``spark.sql.autoBroadcastJoinThreshold``; otherwise the join is a shuffle sort-merge join
    (the explode makes Catalyst's file-size estimate an under-estimate, so it is not trusted).
    ``True`` / ``False`` force either way.  A dimension attribute whose size cannot be measured
    (anything but text and fixed-width types) keeps ``"auto"`` from broadcasting.

    ``salt_by`` names fact columns (a row id, say) that spread the facts that match nothing.
    ``clip_early`` drops, after each dimension, the rows whose common interval is empty; use it
    where segments are clipped afterwards (FLT4), which would drop them in the end.  A ``plan`` that
    does not cover a fact's length makes the query fail instead of losing its matches.
    """
    if not dims:
        return fact
    k, f0, f1 = as_col(key), as_col(valid_from), as_col(valid_to)
    taken = {c.lower() for c in fact.columns}
    for d in dims:
        for out in (d.from_as, d.to_as, *d.attributes):
            if out.lower() in taken:
                raise ValueError(f"output column {out!r} already exists")
            taken.add(out.lower())

    if plan is None:
        plan = plan_buckets(fact, key, valid_from, valid_to, bucket_days)
    matchable = _matchable(k, f0, f1)
    length = F.datediff(f1, f0)
    salt = -1 - F.pmod(F.xxhash64(f0, f1, *[F.col(quote(c)) for c in salt_by]), F.lit(_SALT_BUCKETS))
    bucket = F.when(~matchable, salt)
    for c, cls in enumerate(plan.classes):          # the first class whose L covers the fact
        bucket = bucket.when(length <= F.lit(cls.short), F.lit(c * _CLASS_SHIFT) + day_bucket(f0, cls.width))
    bucket = bucket.otherwise(F.raise_error(F.lit("the bucket plan does not cover a fact's length")).cast("bigint"))
    left = fact.select("*", F.when(matchable, k).alias("_tm_k"), bucket.alias("_tm_b"))

    if broadcast == "auto":
        limit = broadcast_threshold(fact.sparkSession)
        sizes = measure_bucketed(dims, plan) if limit >= 0 else [limit + 1] * len(dims)
        small = [0 <= sz <= limit and _measurable(d) for sz, d in zip(sizes, dims)]
    else:
        small = [bool(broadcast)] * len(dims)
    out = left
    for i, d in enumerate(dims):
        out = _join_one(out, d, i, plan, valid_from, valid_to, small[i])
        if clip_early and i + 1 < len(dims):
            start, end = segment_bounds(f0, f1, [quote(x.from_as) for x in dims[:i + 1]], [quote(x.to_as) for x in dims[:i + 1]])
            out = out.where(start.isNull() | end.isNull() | (start <= end))
    return out.drop("_tm_k", "_tm_b")


def _bucket_array(d: DimSpec, i: int, plan: BucketPlan) -> tuple[DataFrame, Column]:
    p = f"_tm{i}_"
    dk = F.trim(as_col(d.key)) if d.trim_key else as_col(d.key)
    dim = d.df.select(
        dk.alias(p + "k"), as_col(d.valid_from).alias(p + "from"), as_col(d.valid_to).alias(p + "to"),
        *[as_col(src).alias(p + "a_" + str(j)) for j, src in enumerate(d.attributes.values())],
    ).where(F.col(p + "k").isNotNull() & F.col(p + "from").isNotNull() & F.col(p + "to").isNotNull())
    empty = F.array().cast("array<bigint>")
    parts = []
    for c, cls in enumerate(plan.classes):
        off = F.lit(c * _CLASS_SHIFT)
        first = F.greatest(day_bucket(F.date_sub(F.col(p + "from"), cls.short), cls.width), F.lit(cls.lo))
        last = F.least(day_bucket(F.col(p + "to"), cls.width), F.lit(cls.hi))
        parts.append(F.when(first <= last, F.sequence(first + off, last + off)).otherwise(empty))
    buckets = empty if not parts else parts[0] if len(parts) == 1 else F.concat(*parts)
    return dim, buckets


def bucketed_dim(d: DimSpec, i: int, plan: BucketPlan) -> DataFrame:
    """The dimension's join columns, one row per (dimension row, bucket it must be found in)."""
    dim, buckets = _bucket_array(d, i, plan)
    return dim.select("*", F.explode(buckets).alias(f"_tm{i}_b"))


def measure_bucketed(dims: Sequence[DimSpec], plan: BucketPlan) -> list[int]:
    """Exact in-memory size bound of every bucketed dimension, all in one job.

    Per dimension one aggregate of (copies, copies x text bytes) over the un-exploded rows
    (the copy count is ``size`` of the bucket array); each row of the exploded frame costs 8
    bytes per field plus its text.  The aggregates of all dimensions run as one union job.
    """
    parts = []
    for i, d in enumerate(dims):
        dim, buckets = _bucket_array(d, i, plan)
        n = F.size(buckets).cast("bigint")
        strings = [F.coalesce(F.octet_length(F.col(quote(f.name))), F.lit(0)) for f in dim.schema.fields
                   if f.dataType.simpleString() == "string"]
        text = sum(strings[1:], strings[0]) if strings else F.lit(0)
        width = 8 * (len(dim.columns) + 2)
        parts.append(dim.agg(F.lit(i).alias("i"), F.coalesce(F.sum(n * (F.lit(width) + text)), F.lit(0)).alias("bytes")))
    union = parts[0]
    for q in parts[1:]:
        union = union.unionByName(q)
    got = {r["i"]: int(r["bytes"]) for r in union.collect()}
    return [got[i] for i in range(len(dims))]


def _measurable(d: DimSpec) -> bool:
    """Whether every attribute is text or of a fixed width."""
    kinds = [d.df.schema[c].dataType for c in d.attributes.values()]
    return not any(isinstance(k, (ArrayType, BinaryType, MapType, StructType, VariantType)) for k in kinds)


def conf_bytes(value: str) -> int:
    """Parse a Spark size setting (``10485760``, ``10485760b``, ``10m``, ``1g``, ``-1``)."""
    v = str(value).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30,
             "t": 1 << 40, "tb": 1 << 40}
    for suffix in sorted(units, key=len, reverse=True):
        if v.endswith(suffix) and v[: -len(suffix)].lstrip("-").isdigit():
            return int(v[: -len(suffix)]) * units[suffix]
    return int(v)


def broadcast_threshold(spark) -> int:
    return conf_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


def _join_one(left: DataFrame, d: DimSpec, i: int, plan: BucketPlan,
              valid_from: str, valid_to: str, small: bool) -> DataFrame:
    p = f"_tm{i}_"
    dim = bucketed_dim(d, i, plan)
    dim = F.broadcast(dim) if small else dim.hint("shuffle_merge")
    cond = ((F.col("_tm_k") == F.col(p + "k")) & (F.col("_tm_b") == F.col(p + "b"))
            & (as_col(valid_from) <= F.col(p + "to")) & (as_col(valid_to) >= F.col(p + "from")))
    joined = left.join(dim, cond, "left")
    renames = [F.col(p + "from").alias(d.from_as), F.col(p + "to").alias(d.to_as)]
    renames += [F.col(p + "a_" + str(j)).alias(out) for j, out in enumerate(d.attributes)]
    keep = [F.col(quote(c)) for c in left.columns]
    return joined.select(*keep, *renames)


# ---------------------------------------------------------------------------------------
# Segment operators

def segment_bounds(fact_from, fact_to, dim_froms: Sequence, dim_tos: Sequence) -> tuple[Column, Column]:
    """SEG1: ``GREATEST(f.from, COALESCE(d_i.from, f.from)...)`` and the LEAST of the ends."""
    f0, f1 = as_col(fact_from), as_col(fact_to)
    start = F.greatest(f0, *[F.coalesce(as_col(c), f0) for c in dim_froms]) if dim_froms else f0
    end = F.least(f1, *[F.coalesce(as_col(c), f1) for c in dim_tos]) if dim_tos else f1
    return start, end


def actual_attribute(key, attr, unknown: str = "Unknown") -> Column:
    """SEG5: NULL without a fact key, ``'Unknown'`` without a match (or a NULL value), else the value."""
    k = as_col(key)
    return F.when(k.isNull() | (k == F.lit("")), F.lit(None).cast("string")) \
            .otherwise(F.coalesce(as_col(attr).cast("string"), F.lit(unknown)))


def keyed_value(key, value) -> Column:
    """SEG5 for dimension dates: NULL without a fact key, else the value as joined."""
    k = as_col(key)
    return F.when(k.isNull() | (k == F.lit("")), F.lit(None)).otherwise(as_col(value))


def prorate(rate, days) -> Column:
    """SEG4: ``ROUND(rate * days, 2)``; rate first, then times days (keep that order)."""
    return round2(as_col(rate) * as_col(days))


def period_divisor(kind: str | int, date_col=None) -> Column:
    """SEG7 divisor: a fixed number of days (e.g. 30), ``'day'`` = day of month of ``date_col``
    (``EXTRACT(DAY FROM ...)``), or ``'month_days'`` = days in that month."""
    if isinstance(kind, int):
        return F.lit(kind)
    if kind == "day":
        return F.dayofmonth(as_col(date_col))
    if kind == "month_days":
        return F.dayofmonth(F.last_day(as_col(date_col)))
    raise ValueError(f"unknown period divisor {kind!r}")


def clip_and_weigh(df: DataFrame, fact_from: str, fact_to: str, dim_froms: Sequence[str],
                   dim_tos: Sequence[str], start_as: str = "seg_start", end_as: str = "seg_end",
                   days_as: str = "seg_days") -> DataFrame:
    """SEG1 + FLT4 + SEG2: add the segment bounds, keep non-empty segments, add the day count."""
    s, e = segment_bounds(fact_from, fact_to, dim_froms, dim_tos)
    return (df.withColumns({start_as: s, end_as: e})
              .where(F.col(quote(start_as)) <= F.col(quote(end_as)))
              .withColumn(days_as, inclusive_days(quote(start_as), quote(end_as))))


def daily_rates(amounts: Sequence[str], days, prefix: str = "d_") -> list[Column]:
    """SEG3 for several measures against one day count (CSE shares the divisor)."""
    return [safe_daily_rate(F.col(quote(a)).cast("decimal(18,2)"), days).alias(prefix + a) for a in amounts]


def complete_interval(df: DataFrame, valid_from: str, valid_to: str) -> DataFrame:
    """FLT3: both fact dates present (IS NOT NULL is pushed into the Parquet scan)."""
    return df.where(as_col(valid_from).isNotNull() & as_col(valid_to).isNotNull())


def analysis_window(df: DataFrame, valid_from: str, valid_to: str,
                    start: _dt.date | str, end: _dt.date | str) -> DataFrame:
    """FLT7 / FLT8: ``from >= start AND to <= end`` (pushed down as Parquet range filters)."""
    s = F.lit(start).cast("date")
    e = F.lit(end).cast("date")
    return df.where((as_col(valid_from) >= s) & (as_col(valid_to) <= e))


def sort_nulls_last(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SRT1: global ``ORDER BY ... ASC`` with the source engine's NULLS LAST (range exchange)."""
    return df.orderBy(*[as_col(c).asc_nulls_last() for c in cols])
