"""Queries over the profiling operators (AGG2, AGG3) and the run balance (AUD5)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import clean as C
from tidemark.operators.profile import blank_profile, blank_profile_rows, state_rows
from tidemark.plans import fixtures as fx
from tidemark.plans.catalog import register
from tidemark.plans.profiles import merged_profile, update_profile
from tidemark.session import checkpoint_dir
from tidemark.sources.snapshots import write_snapshot

_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_PA1_BRONZE_COLS = ["Pers.No.", "Start Date", "End Date", "Position", "Cost Ctr", "Org.unit", "PA"]


def _profile_sql(cols, src: str) -> str:
    parts = ["COUNT(*) AS total_rows"] + [
        f'CAST(SUM(CASE WHEN TRIM(CAST("{c}" AS VARCHAR)) = \'\' OR "{c}" IS NULL THEN 1 ELSE 0 END) AS BIGINT) '
        f'AS "{c}_blanks"' for c in cols]
    return "SELECT " + ",\n       ".join(parts) + f"\nFROM {src}"


@register("blank_profile", "AGG1 AGG2 PRJ5", _profile_sql(_LINEITEM_COLS, "lineitem"))
def blank_profile_query(spark: SparkSession, sf: str) -> DataFrame:
    return blank_profile(fx.table(spark, sf, "lineitem"))


@register("blank_profile_bronze", "AGG2",
          fx.with_fixtures(_profile_sql(_PA1_BRONZE_COLS, "b"), b=fx.PA0001_BRONZE_SQL))
def blank_profile_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Blank profile of a text (Bronze) table with injected blanks and space-only values."""
    return blank_profile(fx.pa0001_bronze(spark, sf))


@register("blank_profile_rows", "AGG3",
          fx.with_fixtures("SELECT metric, value FROM (UNPIVOT p ON COLUMNS(*) INTO NAME metric VALUE value)",
                           s=fx.PA0001_SQL, p=_profile_sql(
                               ["valid_from", "valid_to", "cost_center", "org_unit", "Pers.No.", "Position", "PA"], "s")))
def blank_profile_rows_query(spark: SparkSession, sf: str) -> DataFrame:
    """Transposed profile of a Silver table (DATE columns included)."""
    return blank_profile_rows(fx.pa0001(spark, sf))


_TOTALS_SQL = _profile_sql(_LINEITEM_COLS, "lineitem")


@register("profile_incremental", "AGG2 AGG3 SNK2", f"""
WITH p AS ({_TOTALS_SQL}) SELECT metric, value FROM (UNPIVOT p ON COLUMNS(*) INTO NAME metric VALUE value)""")
def profile_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as three snapshots, profiled as they arrive; the states merged are the profile of all rows."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex[:12]}"
    t = fx.table(spark, sf, "lineitem")
    for k in range(3):
        write_snapshot(t.where(F.col("l_orderkey") % 3 == k), root, "silver", "lineitem", f"2024010{k + 1}_000000_000000")
        update_profile(spark, root, "silver", "lineitem")
    return state_rows(merged_profile(spark, root, "silver", "lineitem"))


@register("run_balance", "AUD5 AGG1 FLT1", fx.with_fixtures("""
SELECT 'pa0001' AS table_name, 'silver' AS layer, COUNT(*) AS input_row_count,
       COUNT(*) FILTER (WHERE TRIM("Pers.No.") <> '' AND TRIM("Position") NOT IN ('', '99999999')
                        AND TRIM("Cost Ctr") <> 'DUMMY') AS output_row_count,
       COUNT(*) - COUNT(*) FILTER (WHERE TRIM("Pers.No.") <> '' AND TRIM("Position") NOT IN ('', '99999999')
                        AND TRIM("Cost Ctr") <> 'DUMMY') AS rows_filtered
FROM b""", b=fx.PA0001_BRONZE_SQL))
def run_balance(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in / out / filtered of the PA0001 Silver job in one pass over its input."""
    b = fx.pa0001_bronze(spark, sf)
    # the job's filter predicate, evaluated as a counter instead of a filter (NULL = dropped)
    pred = F.coalesce(C.is_org_assignment(b), F.lit(False))
    out = b.agg(F.count(F.lit(1)).alias("input_row_count"), F.count_if(pred).alias("output_row_count"))
    return out.select(F.lit("pa0001").alias("table_name"), F.lit("silver").alias("layer"),
                      "input_row_count", "output_row_count",
                      (F.col("input_row_count") - F.col("output_row_count")).alias("rows_filtered"))
