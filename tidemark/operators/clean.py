"""Silver cleaning: typed dates / decimals, trims, blank-to-NULL, pass-through (CFG5, PRJ1, FLT1, FLT2).

A template is a ``CleanSpec``; ``clean`` turns a Bronze (all-text) frame into the Silver frame:
``<dates>, <decimals>, <trims>, <nullifs>, * EXCEPT (<their sources>)``.  One narrow
projection (+ optional filter) -- whole-stage codegen, no shuffle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions._col import as_col, quote
from tidemark.functions.dates import parse_dirty_date
from tidemark.functions.numbers import parse_dirty_decimal
from tidemark.functions.text import blank_to_null
from tidemark.operators.projection import resolve, star_except


@dataclass(frozen=True)
class CleanSpec:
    """Output name -> source column, per kind.  ``decimals`` keep their names."""

    dates: dict[str, str] = field(default_factory=dict)
    decimals: Sequence[str] = ()
    trims: dict[str, str] = field(default_factory=dict)
    nullifs: dict[str, str] = field(default_factory=dict)
    exclude: Sequence[str] = ()       # further source columns dropped from the pass-through


def source_filter(df: DataFrame, predicate: str | Column | Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """FLT2: optional config filter on the *source* columns (``''`` / None = no filter).

    A condition as text (a leading ``WHERE`` is accepted) or Column, or a function of the frame.  It
    is applied to the frame before the projection, never spliced into SQL text.
    """
    if predicate is None:
        return df
    if callable(predicate) and not isinstance(predicate, Column):
        return predicate(df)
    if isinstance(predicate, Column):
        return df.where(predicate)
    text = predicate.strip()
    if not text:
        return df
    if text[:6].upper() == "WHERE ":
        text = text[6:]
    return df.where(F.expr(text))


def clean(df: DataFrame, spec: CleanSpec, *, open_end: _dt.date | None = None,
          on_error: str = "fail", where: str | Column | Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Apply a cleaning template (optionally after the config filter ``where``)."""
    df = source_filter(df, where)
    lead: list[Column] = []
    used: list[str] = []
    for out, src in spec.dates.items():
        lead.append(parse_dirty_date(resolve(df, src), open_end=open_end, on_error=on_error).alias(out))
        used.append(src)
    for name in spec.decimals:
        lead.append(parse_dirty_decimal(resolve(df, name), on_error=on_error).alias(name))
        used.append(name)
    for out, src in spec.trims.items():
        lead.append(F.trim(as_col(resolve(df, src))).alias(out))
        used.append(src)
    for out, src in spec.nullifs.items():
        lead.append(blank_to_null(resolve(df, src)).alias(out))
        used.append(src)
    return star_except(df, [*used, *spec.exclude], leading=lead)


# The four Silver templates -- column names of the source layouts.
PA0001 = CleanSpec(
    dates={"valid_from": "Start Date", "valid_to": "End Date"},
    trims={"cost_center": "Cost Ctr"},
    nullifs={"org_unit": "Org.unit"},
)
PA0008 = CleanSpec(dates={"valid_from": "Start Date", "valid_to": "End Date"})
ZPOST = CleanSpec(
    dates={"valid_from": "Start date", "valid_to": "End Date",
           "adj_valid_from": "Adjusted Start Date", "adj_valid_to": "Adjusted End Date"},
    decimals=(
        "Standard Cost", "Transfer to Ashi Reserves", "Transfer to Separation Fund",
        "Transfer to MIP Reserve", "Total Post Cost", "Central Cost Attribution",
        "GSSC Chargeback", "Local Hosting Office Cost", "Local Service Cost1",
        "Local Service Cost2 (Optional)", "Total Non Post Cost", "Total",
    ),
)
# The layout of the shipped position-cost export: two dates, twelve amounts.  (Its published SQL also
# excludes the two adjusted dates, which that layout does not have; that would be a bind
# error, so the example template here leaves them out.)
ZPOST_EXAMPLE = CleanSpec(
    dates={"valid_from": "Start date", "valid_to": "End Date"},
    decimals=(
        "Standard Cost", "Transfer to Reserves", "Transfer to Fund", "Transfer Reserve",
        "Total Post Cost", "Other Costs", "Other Charges", "Local Cost", "Local Cost1",
        "Local Cost2 (Optional)", "Total Non Post Cost", "Total",
    ),
)

def zpost_layout(df: DataFrame) -> CleanSpec:
    """The template of a position-cost table by its columns: only one layout has adjusted dates."""
    return ZPOST if ZPOST.dates["adj_valid_from"] in df.columns else ZPOST_EXAMPLE


# What marks an org assignment that is none (FLT1).
NO_POSITION = "99999999"
DUMMY_COST_CENTRE = "DUMMY"


def is_org_assignment(df: DataFrame) -> Column:
    """FLT1 as a condition: key not blank, real position, not the dummy cost centre."""
    key, position, centre = (blank_to_null(resolve(df, c)) for c in ("Pers.No.", "Position", "Cost Ctr"))
    dummy = F.trim(as_col(resolve(df, "Cost Ctr"))) == F.lit(DUMMY_COST_CENTRE)
    return key.isNotNull() & position.isNotNull() & (position != F.lit(NO_POSITION)) & ~dummy


def org_assignment_filter(df: DataFrame) -> DataFrame:
    """FLT1: the filter of the PA0001 Silver job (a NULL condition drops the row)."""
    return df.where(is_org_assignment(df))


def active_only(df: DataFrame, status: str | None = None, active: Sequence[str] = (), deleted: str | None = None) -> DataFrame:
    """FLT8: rows whose trimmed ``status`` is one of ``active`` and whose ``deleted`` flag is blank or NULL.

    Either column may be left out; a NULL status drops the row, as in the other filters.
    """
    if status is None and deleted is None:
        raise ValueError("name a status or a deletion-flag column")
    keep = F.lit(True)
    if status is not None:
        if not active:
            raise ValueError("name the status values that count as active")
        keep = keep & F.trim(F.col(quote(status))).isin(*active)
    if deleted is not None:
        keep = keep & (F.coalesce(F.trim(F.col(quote(deleted))), F.lit("")) == "")
    return df.where(keep)
