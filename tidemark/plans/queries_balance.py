"""Queries over coverage balance, calendar periods, fiscal years and active rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions._col import quote
from tidemark.functions.numbers import days_as_int, safe_daily_rate
from tidemark.operators.calendar import fiscal_window, period_rollup
from tidemark.operators.clean import active_only
from tidemark.operators.coverage import coverage_balance
from tidemark.operators.temporal import DimSpec, analysis_window
from tidemark.plans import fixtures as fx
from tidemark.plans.audit import TRANSFORMS, AuditStore
from tidemark.plans.catalog import register
from tidemark.plans.hr_summary import hr_summary
from tidemark.plans.jobs import GOLD_JOBS, Job, run_jobs
from tidemark.plans.queries_temporal import _gold, _gold_with
from tidemark.session import checkpoint_dir
from tidemark.sources.snapshots import read_latest, write_snapshot

FISCAL_START = 7


def _covered_sql(name: str, n: str) -> str:
    lost = f"CASE WHEN max({n}) > 0 THEN count(*) FILTER ({n} = 0) ELSE 0 END"
    extra = f"CAST(sum(greatest({n} - 1, 0)) AS BIGINT)"
    return f"""count(*) FILTER ({n} = 0) AS {name}_0, count(*) FILTER ({n} = 1) AS {name}_1, count(*) FILTER ({n} > 1) AS {name}_2, {extra} AS {name}_x, {lost} AS {name}_lost"""


def _shown_sql(name: str) -> str:
    days = ", ".join(f"coalesce({name}_{i}, 0) AS {name}_days_{s}" for i, s in (("0", "0"), ("1", "1"), ("2", "2"), ("x", "extra")))
    return f"{days}, round(rate * coalesce({name}_lost, 0), 2) AS {name}_cost_lost, round(rate * coalesce({name}_x, 0), 2) AS {name}_cost_doubled"


@register("coverage_balance", "JN2 SEG1-SEG4 FLT4", fx.with_fixtures("", zpost=fx.ZPOST_SQL, pa1=fx.PA0001_SQL, pa8=fx.PA0008_SQL).rstrip("\n") + f""",
f AS (SELECT "Position" AS position_id, trim("Personnel Number") AS employee_id, adj_valid_from, adj_valid_to,
    CAST("Total" AS DOUBLE) / nullif(CAST("Number of Days" AS INTEGER), 0) AS rate FROM zpost),
fact_days AS (SELECT position_id, nullif(employee_id, '') AS person,
    CAST(unnest(range(CAST(adj_valid_from AS TIMESTAMP), CAST(adj_valid_to + 1 AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM f),
n1 AS (SELECT position_id, day, count(*) AS n1 FROM fact_days JOIN pa1 ON trim("Pers.No.") = person AND day BETWEEN valid_from AND valid_to GROUP BY ALL),
n8 AS (SELECT position_id, day, count(*) AS n8 FROM fact_days JOIN pa8 ON trim("Pers.No.") = person AND day BETWEEN valid_from AND valid_to GROUP BY ALL),
g AS (SELECT position_id, day, coalesce(n1, 0) AS n1, coalesce(n8, 0) AS n8, max(coalesce(n1, 0)) OVER w AS m1, max(coalesce(n8, 0)) OVER w AS m8
    FROM fact_days LEFT JOIN n1 USING (position_id, day) LEFT JOIN n8 USING (position_id, day) WINDOW w AS (PARTITION BY position_id)),
s AS (SELECT position_id, count(*) AS n, {_covered_sql("pa1", "n1")}, {_covered_sql("pa8", "n8")},
    CAST(sum(CASE WHEN m1 > 0 THEN n1 ELSE 1 END * CASE WHEN m8 > 0 THEN n8 ELSE 1 END) AS BIGINT) AS out FROM g GROUP BY position_id)
SELECT f.*, coalesce(n, 0) AS days, {_shown_sql("pa1")}, {_shown_sql("pa8")}, coalesce(out, 0) AS days_out, coalesce(n > 0 AND out = 0, false) AS vanishes
FROM f LEFT JOIN s USING (position_id)""")
def coverage_balance_query(spark: SparkSession, sf: str) -> DataFrame:
    """What the Gold join loses and doubles of every fact, per dimension and altogether."""
    z = fx.zpost(spark, sf)
    rate = safe_daily_rate(F.col("Total").cast("decimal(18,2)"), days_as_int(quote("Number of Days")))
    fact = z.select(F.col("Position").alias("position_id"), F.trim(F.col(quote("Personnel Number"))).alias("employee_id"), "adj_valid_from", "adj_valid_to", rate.alias("rate"))
    dims = {"pa1": DimSpec(fx.pa0001(spark, sf), "Pers.No."), "pa8": DimSpec(fx.pa0008(spark, sf), "Pers.No.")}
    return coverage_balance(fact, "employee_id", "adj_valid_from", "adj_valid_to", dims, rate="rate")


@register("calendar_rollup", "AGG4 SEG7 FLT8", _gold_with(f""", segs AS (
    SELECT row_number() OVER () AS id, "Adj_Start_Date" AS s, "Adj_End_Date" AS e, "Actual Personnel Area" AS org_unit, CAST(CAST("Total" AS DECIMAL(18,2)) * 100 AS HUGEINT) AS c FROM gold),
months AS (SELECT *, CAST(unnest(range(date_trunc('month', s), CAST(e + 1 AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS m FROM segs),
parts AS (SELECT id, org_unit, c, m, date_diff('day', s, e) + 1 AS whole, date_diff('day', greatest(s, m), least(e, last_day(m))) + 1 AS n FROM months),
dealt AS (SELECT *, abs(c) * n // whole AS full_cents, row_number() OVER (PARTITION BY id ORDER BY abs(c) * n % whole DESC, m) AS place FROM parts),
cents AS (SELECT *, sign(c) * (full_cents + CASE WHEN place <= abs(c) - sum(full_cents) OVER (PARTITION BY id) THEN 1 ELSE 0 END) AS cents FROM dealt)
SELECT year(m) - CASE WHEN month(m) < {FISCAL_START} THEN 1 ELSE 0 END AS fiscal_year, (month(m) - {FISCAL_START} + 12) % 12 + 1 AS period, org_unit,
    count(*) AS segments, CAST(sum(n) AS BIGINT) AS days, CAST(CAST(sum(cents) AS DECIMAL(38,2)) / 100 AS DECIMAL(38,2)) AS total_cost
FROM cents GROUP BY ALL"""))
def calendar_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Gold cost by fiscal month and unit, segments cut at month bounds, cents dealt out without loss."""
    return period_rollup(_gold(spark, sf), "Adj_Start_Date", "Adj_End_Date", quote("Actual Personnel Area"), "Total", FISCAL_START)


@register("fiscal_year_window", "FLT8 FLT7 CFG6",
          _gold_with("SELECT * FROM gold", fact_where="adj_valid_from >= DATE '1996-07-01' AND adj_valid_to < DATE '1997-07-01'"))
def fiscal_year_window(spark: SparkSession, sf: str) -> DataFrame:
    """Gold of the facts that lie within the fiscal year that begins in July 1996."""
    z = analysis_window(fx.zpost(spark, sf), "adj_valid_from", "adj_valid_to", *fiscal_window(1996, FISCAL_START))
    return hr_summary(z, fx.pa0001(spark, sf), fx.pa0008(spark, sf), sort=False)


@register("active_rows", "FLT8", """
SELECT o_orderkey, o_orderstatus || CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE '' END AS status, CASE WHEN o_orderkey % 5 = 0 THEN ' ' END AS deletion_flag
FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_orderkey % 7 <> 0""")
def active_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a status that counts as active and no deletion flag; some flags are blanks, some statuses padded."""
    k = F.col("o_orderkey")
    flag = F.when(k % 7 == 0, F.lit("X")).when(k % 5 == 0, F.lit(" "))
    t = fx.table(spark, sf, "orders").select("o_orderkey", F.concat("o_orderstatus", F.when(k % 3 == 0, " ").otherwise("")).alias("status"), flag.alias("deletion_flag"))
    return active_only(t, "status", ("O", "P"), "deletion_flag")


@register("gold_jobs", "CFG3 CFG4 SRC6 SRC7 AGG4 AUD5 SNK3", _gold_with("""SELECT CAST(date_trunc('month', "Adj_Start_Date") AS DATE) AS month, "Actual Personnel Area" AS org_unit,
    COUNT(*) AS segments, CAST(SUM("Days in Segment") AS BIGINT) AS days, CAST(SUM(CAST("Total" AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_cost,
    (SELECT count(*) FROM zpost) AS gold_in, (SELECT count(*) FROM gold) AS gold_out
FROM gold GROUP BY 1, 2"""))
def gold_jobs(spark: SparkSession, sf: str) -> DataFrame:
    """The configured Gold jobs over Silver snapshots: the monthly summary reads the Gold summary that ran before it.

    With the rows in and out that the transform log has of the Gold summary."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex[:12]}"
    for name, df in (("zpost", fx.zpost(spark, sf)), ("pa0001", fx.pa0001(spark, sf)), ("pa0008", fx.pa0008(spark, sf))):
        write_snapshot(df, root, "silver", name, "20240101_000000_000000")
    audit = AuditStore(spark, f"{root}/_audit")
    run_jobs(spark, GOLD_JOBS[::-1], root, audit)
    logged = audit.read(TRANSFORMS).where("table_name = 'hr_summary'")
    summary, _ = read_latest(spark, root, "monthly_cost_summary", ("gold",))
    return summary.withColumns({"gold_in": logged.select("input_row_count").scalar(), "gold_out": logged.select("output_row_count").scalar()})


@register("sql_template_job", "SRC4 SRC5 CFG2 FLT2 SNK2", fx.with_fixtures("""
SELECT "Post Type" AS post_type, count(*) AS posts, CAST(sum("Total") AS DECIMAL(38,2)) AS total, count(DISTINCT "Personnel area") AS areas
FROM z WHERE "Personnel area" <> 'P' GROUP BY 1""", z=fx.ZPOST_SQL))
def sql_template_job(spark: SparkSession, sf: str) -> DataFrame:
    """A job given as a SQL template over a Silver snapshot, its filter from the configuration."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex[:12]}"
    write_snapshot(fx.zpost(spark, sf), root, "silver", "zpost", "20240101_000000_000000")
    job = Job("by_post_type", "gold", {"z": "zpost"}, source_layers=("silver",), filters="`Personnel area` <> 'P'", sql="""
SELECT `Post Type` AS post_type, count(*) AS posts, CAST(sum(`Total`) AS DECIMAL(38,2)) AS total, count(DISTINCT `Personnel area`) AS areas
FROM {z} {filters} GROUP BY 1""")
    run_jobs(spark, [job], root, AuditStore(spark, f"{root}/_audit"))
    return read_latest(spark, root, "by_post_type", ("gold",))[0]
