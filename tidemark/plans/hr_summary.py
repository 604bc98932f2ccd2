"""CFG6: the HR financial summary -- position cost facts x org assignment x basic pay.

Pipeline: FLT3 -> SEG3 (daily rates) -> JN2 (two overlap joins) -> SEG5 / SEG1 -> FLT4 ->
SEG2 -> SEG4 -> PRJ1/PRJ3 -> SRT1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions._col import quote
from tidemark.functions.numbers import days_as_int
from tidemark.operators.clean import ZPOST
from tidemark.operators.projection import rest_columns
from tidemark.operators.temporal import (
    DimSpec, actual_attribute, clip_and_weigh, complete_interval, daily_rates, keyed_value,
    overlap_left_join, prorate, sort_nulls_last,
)

# The amount columns of the position-cost layout, in report order, and (fixed values) the output
# names of their prorated values: one loses its suffix.
MEASURES = list(ZPOST.decimals)
MEASURE_OUTPUT = {m: m for m in MEASURES} | {"Local Service Cost2 (Optional)": "Local Service Cost2"}

# Source column names of the three inputs and the output names of the report.
FACT_KEY, FACT_POSITION, FACT_GROUP, FACT_DAYS = "Personnel Number", "Position", "Position Pay Scale Group", "Number of Days"
DIM_KEY, PA_AREA, PS_GROUP = "Pers.No.", "PA", "PS group"
OUT_KEY, OUT_POSITION = "Personnel Number", "Position"
OUT_PLANNED, OUT_ACTUAL_GROUP, OUT_ACTUAL_AREA = "Planned PS Group", "Actual PS Group", "Actual Personnel Area"
OUT_PA1_FROM, OUT_PA1_TO = "PA0001 Valid From", "PA0001 Valid To"
OUT_START, OUT_END, OUT_DAYS = "Adj_Start_Date", "Adj_End_Date", "Days in Segment"


def hr_summary(zpost: DataFrame, pa0001: DataFrame, pa0008: DataFrame, *,
               measures: Sequence[str] = MEASURES, sort: bool = True,
               bucket_days: int | str = "auto", flat: dict[str, str] | None = None,
               broadcast_dims: str | bool = "auto") -> DataFrame:
    """Gold segments: one row per (fact, PA0001 match, PA0008 match) with a non-empty overlap.

    ``zpost`` is the Silver position-cost table (``adj_valid_from/to`` DATE, amounts
    DECIMAL(18,2), ``Number of Days`` text); ``pa0001`` / ``pa0008`` are Silver
    effective-dated tables with ``valid_from`` / ``valid_to``.  ``flat`` (SEG6) keeps measures
    un-prorated for snapshot reporting: output name -> measure, as DECIMAL(18,2), placed after
    the prorated amounts.
    """
    flat = dict(flat or {})
    # zpost_clean: complete facts, trimmed key, daily rates; every other column passes through
    z = complete_interval(zpost, "adj_valid_from", "adj_valid_to")
    days = days_as_int(quote(FACT_DAYS))
    handled = [FACT_KEY, FACT_POSITION, FACT_GROUP, *measures, "adj_valid_from", "adj_valid_to"]
    rest = rest_columns(z, handled)
    z = z.select(
        F.trim(F.col(quote(FACT_KEY))).alias("employee_id"),
        F.col(quote(FACT_POSITION)).alias("position_id"),
        F.col(quote(FACT_GROUP)).alias("zpost_ps_group"),
        "adj_valid_from", "adj_valid_to",
        *daily_rates(measures, days),
        *[F.col(quote(m)).cast("decimal(18,2)").alias(out) for out, m in flat.items()],
        *[F.col(quote(c)) for c in rest],
    )

    joined = overlap_left_join(
        z, "employee_id", "adj_valid_from", "adj_valid_to",
        [DimSpec(pa0001, DIM_KEY, attributes={"_pa_area": PA_AREA}, from_as="_pa1_from", to_as="_pa1_to"),
         DimSpec(pa0008, DIM_KEY, attributes={"_ps_group": PS_GROUP}, from_as="_pa8_from", to_as="_pa8_to")],
        bucket_days=bucket_days, broadcast=broadcast_dims, salt_by=["position_id"], clip_early=True,
    )
    seg = clip_and_weigh(joined, "adj_valid_from", "adj_valid_to",
                         ["_pa1_from", "_pa8_from"], ["_pa1_to", "_pa8_to"])

    out = seg.select(
        F.col("employee_id").alias(OUT_KEY),
        F.col("position_id").alias(OUT_POSITION),
        F.col("zpost_ps_group").alias(OUT_PLANNED),
        actual_attribute("employee_id", "_ps_group").alias(OUT_ACTUAL_GROUP),
        actual_attribute("employee_id", "_pa_area").alias(OUT_ACTUAL_AREA),
        keyed_value("employee_id", "_pa1_from").alias(OUT_PA1_FROM),
        keyed_value("employee_id", "_pa1_to").alias(OUT_PA1_TO),
        F.col("seg_start").alias(OUT_START),
        F.col("seg_end").alias(OUT_END),
        F.col("seg_days").alias(OUT_DAYS),
        *[prorate(F.col(quote("d_" + m)), F.col("seg_days")).alias(MEASURE_OUTPUT.get(m, m)) for m in measures],
        *[F.col(quote(out)) for out in flat],
        *[F.col(quote(c)) for c in rest],
    )
    if sort:
        out = sort_nulls_last(out, [OUT_POSITION, OUT_KEY, OUT_START])
    return out
