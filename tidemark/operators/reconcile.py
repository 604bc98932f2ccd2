"""Planned-versus-actual mismatch reports (FLT5, FLT6) with the schema-driven projection (PRJ4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions._col import quote
from tidemark.operators.projection import date_columns, resolve

# The post types the mismatch reports look at, and the report's key / filter column.
POST_TYPES = ("01", "07", "12", "13", "15", "16", "22", "35")
REPORT_KEY = "Personnel Number"
POST_TYPE_COL = "Post Type"


def mismatches(gold: DataFrame, actual: str, planned: str, actual_as: str, planned_as: str, *,
               key: str = REPORT_KEY, post_type: str = POST_TYPE_COL,
               post_types: Sequence[str] = POST_TYPES) -> DataFrame:
    """Rows whose actual and planned attribute differ.

    Filter: key present and not blank, ``actual != planned`` (a NULL on either side drops the
    row; ``'Unknown'`` counts as a difference), post type in the list.  Projection: key, every
    DATE column as text, the two compared columns renamed, then every other column in order.
    Works with zero DATE columns too.  All predicates are plain column filters, pushed into the
    scan when ``gold`` is read from Parquet.
    """
    key, actual, planned, post_type = (resolve(gold, c) for c in (key, actual, planned, post_type))
    dates = [c for c in date_columns(gold) if c not in (key, actual, planned)]
    k, a, p = F.col(quote(key)), F.col(quote(actual)), F.col(quote(planned))
    handled = {key, actual, planned, *dates}
    rest = [F.col(quote(c)) for c in gold.columns if c not in handled]
    return (gold.where(k.isNotNull() & (F.trim(k) != F.lit("")) & (a != p)
                       & F.col(quote(post_type)).isin(*post_types))
                .select(k, *[F.col(quote(c)).cast("string").alias(c) for c in dates],
                        a.alias(actual_as), p.alias(planned_as), *rest))


def area_mismatches(gold: DataFrame) -> DataFrame:
    """FLT5: personnel area of the org assignment vs the planned area on the cost report."""
    return mismatches(gold, "Actual Personnel Area", "Personnel area",
                      "PA0001_Personnel_Area", "ZPOST_Personnel_Area")


def group_mismatches(gold: DataFrame) -> DataFrame:
    """FLT6: pay-scale group of basic pay vs the planned group.  The public label of the
    actual column says PA0001 although the value comes from PA0008 (kept as published)."""
    return mismatches(gold, "Actual PS Group", "Planned PS Group", "PA0001_PS_Group", "ZPOST_PS_Group")
