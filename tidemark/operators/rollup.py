"""AGG4: monthly roll-up of Gold segments by organisational unit (Gold-on-Gold job)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions._col import as_col


def monthly_rollup(gold: DataFrame, date_col: str, unit_col: str, days_col: str, amount_col: str,
                   month_as: str = "month", unit_as: str = "org_unit") -> DataFrame:
    """Segments, days and cost per (month of segment start, unit).

    Amounts are summed as DECIMAL so the result does not depend on summation order (partial
    aggregation runs map-side; only one row per group and partition is shuffled).
    """
    return (gold.groupBy(F.trunc(as_col(date_col), "MM").alias(month_as), as_col(unit_col).alias(unit_as))
                .agg(F.count(F.lit(1)).alias("segments"),
                     F.sum(as_col(days_col)).cast("bigint").alias("days"),
                     F.sum(as_col(amount_col).cast("decimal(18,2)")).cast("decimal(38,2)").alias("total_cost")))
