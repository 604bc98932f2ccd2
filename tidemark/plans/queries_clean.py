"""Queries over the Silver cleaning operators (FN1-FN5, PRJ1, FLT1, FLT2, CFG5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions._col import quote
from tidemark.functions.dates import OPEN_END_CLAMP, parse_dirty_date
from tidemark.functions.numbers import parse_dirty_decimal
from tidemark.functions.text import blank_to_null
from tidemark.operators import clean as C
from tidemark.plans import fixtures as fx
from tidemark.plans.catalog import register


# The oracles do not parse the dirty text: they state, from ``orders`` and the rules by which the
# fixtures inject dirt, the typed value that cleaning must give back.
_K, _C, _D = "o_orderkey", "CAST(o_custkey AS VARCHAR)", "CAST(o_orderdate AS DATE)"
_FAR = "DATE '9999-12-31'"
_CLAMP = f"DATE '{OPEN_END_CLAMP.isoformat()}'"


def _day(later: int, shift: int) -> str:
    """The order's day, so much later, where the order key plus ``shift`` does not blank it."""
    return f"CASE WHEN 0 IN (({_K} + {shift}) % 29, ({_K} + {shift}) % 31) THEN NULL ELSE {_D} + {later} END"


def _end(open_every: int, later: int, shift: int, far: str = _FAR) -> str:
    return f"CASE WHEN {_K} % {open_every} = 0 THEN {far} ELSE {_day(later, shift)} END"


def _amounts(names) -> str:
    return ", ".join(f'CASE WHEN ({_K} + {i}) % 41 <> 0 THEN CAST(round(o_totalprice - {i}, 2) AS DECIMAL(18,2)) END AS "{m}"'
                     for i, m in enumerate(names))


_POSITION = f"CASE WHEN {_K} % 9 = 0 THEN '99999999' WHEN {_K} % 43 = 0 THEN ' ' ELSE CAST({_K} AS VARCHAR) END AS \"Position\""
_CENTRE = f"CASE {_K} % 8 WHEN 0 THEN 'DUMMY' ELSE concat('CC', o_custkey % 50) END AS cost_center"
_UNIT = f"CASE WHEN {_K} % 6 <> 0 THEN concat('OU', o_custkey % 7) END AS org_unit"
_PA1_SILVER = f"""SELECT {_day(0, 0)} AS valid_from, {_end(4, 179, 1)} AS valid_to, {_CENTRE}, {_UNIT},
       CASE {_K} % 47 WHEN 0 THEN '  ' ELSE {_C} END AS "Pers.No.", {_POSITION}, o_orderstatus AS "PA"
FROM orders"""
_ZPOST_REST = f"""CAST({_K} AS VARCHAR) AS "Position", {_C} AS "Personnel Number", '90' AS "Number of Days",
       o_orderstatus AS "Personnel area", lpad(CAST({_K} % 40 AS VARCHAR), 2, '0') AS "Post Type\""""


@register("clean_dates", "FN1 FN4 FN15", f"SELECT {_POSITION}, {_day(0, 0)} AS valid_from, {_end(4, 179, 1)} AS valid_to FROM orders")
def clean_dates(spark: SparkSession, sf: str) -> DataFrame:
    b = fx.pa0001_bronze(spark, sf)
    return b.select("Position", parse_dirty_date("Start Date").alias("valid_from"),
                    parse_dirty_date("End Date").alias("valid_to"))


@register("clean_dates_open_end", "FN2", f"""SELECT {_C} AS "Pers.No.", {_day(0, 6)} AS valid_from, {_end(3, 364, 5, _CLAMP)} AS valid_to FROM orders""")
def clean_dates_open_end(spark: SparkSession, sf: str) -> DataFrame:
    b = fx.pa0008_bronze(spark, sf)
    return b.select(F.col(quote("Pers.No.")), parse_dirty_date("Start Date", open_end=OPEN_END_CLAMP).alias("valid_from"),
                    parse_dirty_date("End Date", open_end=OPEN_END_CLAMP).alias("valid_to"))


@register("clean_decimals", "FN3 FN5 FN6", f"""SELECT CAST({_K} AS VARCHAR) AS "Position", {_amounts(C.ZPOST.decimals)} FROM orders""")
def clean_decimals(spark: SparkSession, sf: str) -> DataFrame:
    b = fx.zpost_bronze(spark, sf)
    return b.select("Position", *[parse_dirty_decimal(m).alias(m) for m in C.ZPOST.decimals])


@register("blank_to_null", "FN4 FN5", f"SELECT {_POSITION}, {_CENTRE}, {_UNIT} FROM orders")
def blank_to_null_query(spark: SparkSession, sf: str) -> DataFrame:
    b = fx.pa0001_bronze(spark, sf)
    return b.select("Position", F.trim(F.col("`Cost Ctr`")).alias("cost_center"),
                    blank_to_null("Org.unit").alias("org_unit"))


@register("star_except", "PRJ1 CFG5", _PA1_SILVER)
def star_except_query(spark: SparkSession, sf: str) -> DataFrame:
    """PA0001 Silver template without its filter: typed columns first, the rest passes through."""
    return C.clean(fx.pa0001_bronze(spark, sf), C.PA0001)


@register("org_filter", "FLT1 FLT2 CFG2 CFG5", _PA1_SILVER + f" WHERE 0 NOT IN ({_K} % 47, {_K} % 9, {_K} % 43, {_K} % 8)")
def org_filter(spark: SparkSession, sf: str) -> DataFrame:
    """The PA0001 Silver job: config filter on the source, then the template."""
    return C.clean(fx.pa0001_bronze(spark, sf), C.PA0001, where=C.org_assignment_filter)


@register("silver_pa0008", "CFG5 FN1", f"""SELECT {_day(0, 6)} AS valid_from, {_end(3, 364, 5)} AS valid_to,
       {_C} AS "Pers.No.", substr(o_orderpriority, 1, 1) AS "PS group" FROM orders""")
def silver_pa0008(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean(fx.pa0008_bronze(spark, sf), C.PA0008)


@register("silver_zpost", "CFG5 FN1 FN3 PRJ1", f"""SELECT {_day(0, 0)} AS valid_from, {_day(89, 2)} AS valid_to,
       {_day(0, 3)} AS adj_valid_from, {_day(89, 4)} AS adj_valid_to, {_amounts(C.ZPOST.decimals)}, {_ZPOST_REST} FROM orders""")
def silver_zpost(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean(fx.zpost_bronze(spark, sf), C.ZPOST)


@register("silver_zpost_example", "CFG5 FN1 FN3 PRJ1", f"""SELECT {_day(0, 0)} AS valid_from, {_day(89, 2)} AS valid_to,
       {_amounts(C.ZPOST_EXAMPLE.decimals)}, {_ZPOST_REST} FROM orders""")
def silver_zpost_example(spark: SparkSession, sf: str) -> DataFrame:
    """The Silver job on the layout of the shipped export: no adjusted dates, other amount names."""
    b = fx.zpost_bronze(spark, sf).drop("Adjusted Start Date", "Adjusted End Date")
    b = b.withColumnsRenamed(dict(zip(C.ZPOST.decimals, C.ZPOST_EXAMPLE.decimals)))
    return C.clean(b, C.zpost_layout(b))
