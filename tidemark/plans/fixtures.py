"""Inputs in the shape of the source exports, derived by Spark from the given tables.

Each frame is built from the *whole* ``orders`` table (one output row per order); the modulo
rules below only inject dirty values (blank keys, NULL dates, zero days, orphan keys) into
some rows, they never drop rows.  The same derivations are given as DuckDB SQL (``*_SQL``)
so the oracle reads exactly the same inputs.

* ``zpost``   Silver position-cost facts: key = customer, 90-day window from the order date.
* ``pa0001``  Silver org assignment, 180-day windows; 2/3 of the rows carry keys of people
              without cost facts (``X<cust>``), some keys are padded, some ends are NULL.
* ``pa0008``  Silver basic pay, 365-day windows; 4/5 orphan keys (``Y<cust>``).
* ``pa_extra`` a third dimension (JN3), 60-day windows; 1/2 orphan keys (``Z<cust>``).
* ``*_bronze`` text versions (``dd.mm.yyyy`` dates with blanks, ``00.00.0000`` and
  ``31.12.9999``; amounts with thousands separators) for the Silver cleaning templates.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.hr_summary import MEASURES
from tidemark.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", spread)


def _ocols():
    k = F.col("o_orderkey")
    c = F.col("o_custkey").cast("string")
    d = F.to_date("o_orderdate")
    return k, c, d


def _m(k: Column, n: int) -> Column:
    return (k % F.lit(n)) == F.lit(0)


def _dec(x) -> Column:
    return x.cast("decimal(18,2)")


def zpost(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c, d = _ocols()
    total = _dec(F.col("o_totalprice"))
    key = (F.when(_m(k, 11), F.lit("")).when(_m(k, 13), F.lit(None).cast("string"))
            .when(_m(k, 7), F.concat(F.lit(" "), c)).otherwise(c))
    amounts = []
    for i, m in enumerate(MEASURES):
        v = _dec(total - F.lit(Decimal(i)))
        if m == "GSSC Chargeback":
            v = F.when(_m(k, 23), F.lit(None).cast("decimal(18,2)")).otherwise(v)
        amounts.append(v.alias(m))
    return table(spark, sf_dir, "orders").select(
        d.alias("valid_from"),
        F.date_add(d, 89).alias("valid_to"),
        F.when(_m(k, 17), F.lit(None).cast("date")).otherwise(d).alias("adj_valid_from"),
        F.date_add(d, 89).alias("adj_valid_to"),
        *amounts,
        k.cast("string").alias("Position"),
        key.alias("Personnel Number"),
        F.substring("o_orderpriority", 1, 1).alias("Position Pay Scale Group"),
        F.when(_m(k, 19), F.lit("0")).otherwise(F.lit("90")).alias("Number of Days"),
        F.col("o_orderstatus").alias("Personnel area"),
        F.lpad((k % 40).cast("string"), 2, "0").alias("Post Type"),
    )


def pa0001(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c, d = _ocols()
    key = F.when(_m(k, 3), F.when(_m(k, 2), F.concat(F.lit(" "), c, F.lit(" "))).otherwise(c)) \
           .otherwise(F.concat(F.lit("X"), c))
    return table(spark, sf_dir, "orders").select(
        d.alias("valid_from"),
        F.when(_m(k, 21), F.lit(None).cast("date")).otherwise(F.date_add(d, 179)).alias("valid_to"),
        F.concat(F.lit("CC"), (F.col("o_custkey") % 50).cast("string")).alias("cost_center"),
        F.concat(F.lit("OU"), (F.col("o_custkey") % 7).cast("string")).alias("org_unit"),
        key.alias("Pers.No."),
        k.cast("string").alias("Position"),
        F.col("o_orderstatus").alias("PA"),
    )


def pa0008(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c, d = _ocols()
    key = F.when(_m(k, 5), c).otherwise(F.concat(F.lit("Y"), c))
    return table(spark, sf_dir, "orders").select(
        d.alias("valid_from"),
        F.date_add(d, 364).alias("valid_to"),
        key.alias("Pers.No."),
        F.substring("o_orderpriority", 1, 1).alias("PS group"),
    )


def pa_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c, d = _ocols()
    key = F.when(_m(k, 2), c).otherwise(F.concat(F.lit("Z"), c))
    return table(spark, sf_dir, "orders").select(
        d.alias("valid_from"),
        F.date_add(d, 59).alias("valid_to"),
        key.alias("Pers.No."),
        F.col("o_orderpriority").alias("Priority"),
    )


def _date_text(d: Column, k: Column) -> Column:
    """dd.mm.yyyy with dirt: blank (k%29), '00.00.0000' (k%31), spaces (k%37)."""
    txt = F.date_format(d, "dd.MM.yyyy")
    return (F.when(_m(k, 29), F.lit("")).when(_m(k, 31), F.lit("00.00.0000"))
             .when(_m(k, 37), F.concat(F.lit("  "), txt, F.lit(" "))).otherwise(txt))


def _amount_text(x: Column, k: Column) -> Column:
    """Amount text with thousands separators; blank for k%41."""
    return F.when(_m(k, 41), F.lit(" ")).otherwise(F.format_number(x, 2))


def pa0001_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze org assignment: every column text, as extracted from the report."""
    k, c, d = _ocols()
    end = F.when(_m(k, 4), F.lit("31.12.9999")).otherwise(_date_text(F.date_add(d, 179), k + 1))
    pos = F.when(_m(k, 9), F.lit("99999999")).when(_m(k, 43), F.lit(" ")).otherwise(k.cast("string"))
    return table(spark, sf_dir, "orders", spread=True).select(
        F.when(_m(k, 47), F.lit("  ")).otherwise(c).alias("Pers.No."),
        _date_text(d, k).alias("Start Date"),
        end.alias("End Date"),
        pos.alias("Position"),
        F.when(_m(k, 8), F.lit("DUMMY")).otherwise(F.concat(F.lit(" CC"), (F.col("o_custkey") % 50).cast("string")))
         .alias("Cost Ctr"),
        F.when(_m(k, 6), F.lit("  ")).otherwise(F.concat(F.lit("OU"), (F.col("o_custkey") % 7).cast("string")))
         .alias("Org.unit"),
        F.col("o_orderstatus").alias("PA"),
    )


def pa0008_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze basic pay: dates as text, open ends as 31.12.9999."""
    k, c, d = _ocols()
    end = F.when(_m(k, 3), F.lit("31.12.9999")).otherwise(_date_text(F.date_add(d, 364), k + 5))
    return table(spark, sf_dir, "orders", spread=True).select(
        c.alias("Pers.No."),
        _date_text(d, k + 6).alias("Start Date"),
        end.alias("End Date"),
        F.substring("o_orderpriority", 1, 1).alias("PS group"),
    )


def zpost_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze position-cost report: dates and amounts as text."""
    k, c, d = _ocols()
    cols = [
        k.cast("string").alias("Position"),
        c.alias("Personnel Number"),
        _date_text(d, k).alias("Start date"),
        _date_text(F.date_add(d, 89), k + 2).alias("End Date"),
        _date_text(d, k + 3).alias("Adjusted Start Date"),
        _date_text(F.date_add(d, 89), k + 4).alias("Adjusted End Date"),
    ]
    for i, m in enumerate(MEASURES):
        cols.append(_amount_text(F.col("o_totalprice") - F.lit(float(i)), k + i).alias(m))
    cols += [
        F.lit("90").alias("Number of Days"),
        F.col("o_orderstatus").alias("Personnel area"),
        F.lpad((k % 40).cast("string"), 2, "0").alias("Post Type"),
    ]
    return table(spark, sf_dir, "orders", spread=True).select(*cols)


# ---------------------------------------------------------------------------------------
# The same derivations for DuckDB (oracle side).  ``orders`` is a pre-registered view.

_K = "o_orderkey"
_C = "CAST(o_custkey AS VARCHAR)"
_D = "CAST(o_orderdate AS DATE)"


def _measures_sql() -> str:
    parts = []
    for i, m in enumerate(MEASURES):
        v = f"CAST(CAST(o_totalprice AS DECIMAL(18,2)) - {i} AS DECIMAL(18,2))"
        if m == "GSSC Chargeback":
            v = f"CASE WHEN {_K} % 23 = 0 THEN NULL ELSE {v} END"
        parts.append(f'{v} AS "{m}"')
    return ",\n    ".join(parts)


ZPOST_SQL = f"""SELECT
    {_D} AS valid_from,
    {_D} + 89 AS valid_to,
    CASE WHEN {_K} % 17 = 0 THEN NULL ELSE {_D} END AS adj_valid_from,
    {_D} + 89 AS adj_valid_to,
    {_measures_sql()},
    CAST({_K} AS VARCHAR) AS "Position",
    CASE WHEN {_K} % 11 = 0 THEN '' WHEN {_K} % 13 = 0 THEN NULL
         WHEN {_K} % 7 = 0 THEN ' ' || {_C} ELSE {_C} END AS "Personnel Number",
    substr(o_orderpriority, 1, 1) AS "Position Pay Scale Group",
    CASE WHEN {_K} % 19 = 0 THEN '0' ELSE '90' END AS "Number of Days",
    o_orderstatus AS "Personnel area",
    lpad(CAST({_K} % 40 AS VARCHAR), 2, '0') AS "Post Type"
FROM orders"""

PA0001_SQL = f"""SELECT
    {_D} AS valid_from,
    CASE WHEN {_K} % 21 = 0 THEN NULL ELSE {_D} + 179 END AS valid_to,
    'CC' || CAST(o_custkey % 50 AS VARCHAR) AS cost_center,
    'OU' || CAST(o_custkey % 7 AS VARCHAR) AS org_unit,
    CASE WHEN {_K} % 3 = 0 THEN (CASE WHEN {_K} % 2 = 0 THEN ' ' || {_C} || ' ' ELSE {_C} END)
         ELSE 'X' || {_C} END AS "Pers.No.",
    CAST({_K} AS VARCHAR) AS "Position",
    o_orderstatus AS "PA"
FROM orders"""

PA0008_SQL = f"""SELECT
    {_D} AS valid_from,
    {_D} + 364 AS valid_to,
    CASE WHEN {_K} % 5 = 0 THEN {_C} ELSE 'Y' || {_C} END AS "Pers.No.",
    substr(o_orderpriority, 1, 1) AS "PS group"
FROM orders"""

PA_EXTRA_SQL = f"""SELECT
    {_D} AS valid_from,
    {_D} + 59 AS valid_to,
    CASE WHEN {_K} % 2 = 0 THEN {_C} ELSE 'Z' || {_C} END AS "Pers.No.",
    o_orderpriority AS "Priority"
FROM orders"""


def _date_text_sql(d: str, k: str) -> str:
    txt = f"strftime({d}, '%d.%m.%Y')"
    return (f"CASE WHEN ({k}) % 29 = 0 THEN '' WHEN ({k}) % 31 = 0 THEN '00.00.0000' "
            f"WHEN ({k}) % 37 = 0 THEN '  ' || {txt} || ' ' ELSE {txt} END")


PA0001_BRONZE_SQL = f"""SELECT
    CASE WHEN {_K} % 47 = 0 THEN '  ' ELSE {_C} END AS "Pers.No.",
    {_date_text_sql(_D, _K)} AS "Start Date",
    CASE WHEN {_K} % 4 = 0 THEN '31.12.9999' ELSE {_date_text_sql(_D + ' + 179', _K + ' + 1')} END AS "End Date",
    CASE WHEN {_K} % 9 = 0 THEN '99999999' WHEN {_K} % 43 = 0 THEN ' ' ELSE CAST({_K} AS VARCHAR) END AS "Position",
    CASE WHEN {_K} % 8 = 0 THEN 'DUMMY' ELSE ' CC' || CAST(o_custkey % 50 AS VARCHAR) END AS "Cost Ctr",
    CASE WHEN {_K} % 6 = 0 THEN '  ' ELSE 'OU' || CAST(o_custkey % 7 AS VARCHAR) END AS "Org.unit",
    o_orderstatus AS "PA"
FROM orders"""


PA0008_BRONZE_SQL = f"""SELECT
    {_C} AS "Pers.No.",
    {_date_text_sql(_D, _K + ' + 6')} AS "Start Date",
    CASE WHEN {_K} % 3 = 0 THEN '31.12.9999' ELSE {_date_text_sql(_D + ' + 364', _K + ' + 5')} END AS "End Date",
    substr(o_orderpriority, 1, 1) AS "PS group"
FROM orders"""


def _amount_text_sql(i: int) -> str:
    return (f"CASE WHEN ({_K} + {i}) % 41 = 0 THEN ' ' "
            f"ELSE format('{{:,.2f}}', o_totalprice - {float(i)}) END")


def _zpost_bronze_sql() -> str:
    cols = [
        f'CAST({_K} AS VARCHAR) AS "Position"',
        f'{_C} AS "Personnel Number"',
        f'{_date_text_sql(_D, _K)} AS "Start date"',
        f'{_date_text_sql(_D + " + 89", _K + " + 2")} AS "End Date"',
        f'{_date_text_sql(_D, _K + " + 3")} AS "Adjusted Start Date"',
        f'{_date_text_sql(_D + " + 89", _K + " + 4")} AS "Adjusted End Date"',
    ]
    cols += [f'{_amount_text_sql(i)} AS "{m}"' for i, m in enumerate(MEASURES)]
    cols += ["'90' AS \"Number of Days\"", 'o_orderstatus AS "Personnel area"',
             f"lpad(CAST({_K} % 40 AS VARCHAR), 2, '0') AS \"Post Type\""]
    return "SELECT\n    " + ",\n    ".join(cols) + "\nFROM orders"


ZPOST_BRONZE_SQL = _zpost_bronze_sql()


def with_fixtures(body: str, **ctes: str) -> str:
    """Prefix a DuckDB query with the named fixture CTEs."""
    if not ctes:
        return body
    parts = [f'{name} AS (\n{sql}\n)' for name, sql in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body
