"""Queries through real files: rendered reports, ingestion, audit tables, snapshots, Silver jobs, export."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions._col import quote
from tidemark.plans import fixtures as fx
from tidemark.plans.audit import MANIFEST, RUNS, TRANSFORMS, AuditStore
from tidemark.plans.catalog import register
from tidemark.plans.ingest import ingest_bronze
from tidemark.plans.jobs import SILVER_JOBS, run_jobs
from tidemark.session import checkpoint_dir
from tidemark.sources.reports import extract_grid, read_report_lines
from tidemark.sources.snapshots import export_report, latest_snapshot, read_latest, write_snapshot

PEOPLE = 400                # a report file holds the rows of so many people, so files grow with the table
GLOB = "part=*/*.txt"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def _write_reports(df: DataFrame, title: str, number: Column, raw_dir: str, charset: str = "UTF-8") -> None:
    """Write report files, a folder each: a title, the header and a row per line; ``number`` says which file a row is in."""
    def line(cells: list[Column]) -> Column:
        return F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(c, F.lit("")) for c in cells]), F.lit(" |"))

    rows = df.select(number.cast("int").alias("file"), F.lit(2).alias("at"), line([F.col(quote(c)) for c in df.columns]).alias("line"))
    heads = rows.select("file").distinct().select(
        "file",
        F.explode(F.array(F.struct(F.lit(0).alias("at"), F.concat(F.lit(title + " "), F.col("file").cast("string")).alias("line")),
                          F.struct(F.lit(1).alias("at"), line([F.lit(c) for c in df.columns]).alias("line")))).alias("h"))
    lines = rows.union(heads.select("file", "h.at", "h.line")).repartition("file").sortWithinPartitions("file", "at")
    # the text writer writes a string's bytes as they are
    encoded = lines.select(F.col("file").alias("part"), F.encode("line", charset).cast("string").alias("line"))
    encoded.write.mode("append").partitionBy("part").text(raw_dir)


def _number(key: str) -> Column:
    """File of a row by its person's number; blank numbers are in the first."""
    return F.floor(F.coalesce(F.expr(f"try_cast(trim({quote(key)}) AS int)"), F.lit(0)) / PEOPLE)


_ALL = f"""b1 AS (SELECT CASE WHEN o_orderkey % 47 = 0 THEN 0 ELSE o_custkey // {PEOPLE} END AS f,
       0 NOT IN (o_orderkey % 47, o_orderkey % 9, o_orderkey % 43, o_orderkey % 8) AS kept FROM orders),
b2 AS (SELECT o_custkey // {PEOPLE} AS f FROM orders),
n AS (SELECT 'pa0001' AS name, f, count(*) AS n, count(*) FILTER (kept) AS kept FROM b1 GROUP BY f
      UNION ALL SELECT t, f, count(*), count(*) FROM b2 CROSS JOIN (VALUES ('pa0008'), ('zpost')) v(t) GROUP BY t, f)"""


@register("bronze_to_silver", "SRC1 SRC2 SRC6 EXT5 EXT9 AUD1 AUD2 AUD3 AUD4 AUD5 SNK1 SNK2 CFG2 CFG4 FN14 FN16", f"""
WITH {_ALL}
SELECT 'manifest' AS step, name, count(*) AS a, CAST(sum(n) AS BIGINT) AS b FROM n GROUP BY name
UNION ALL SELECT 'run', '1 success', count(*), CAST(sum(n) AS BIGINT) FROM n
UNION ALL SELECT 'run', '2 success', 0, 0
UNION ALL SELECT 'silver', name, n, kept FROM n WHERE CAST(f AS VARCHAR) = (SELECT max(CAST(f AS VARCHAR)) FROM n)""")
def bronze_to_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Report files of three tables ingested twice (the second run finds nothing new), then the Silver jobs.

    One row for each table of the manifest (files, rows), each run (files, rows) and each Silver job
    (rows in and out of the latest snapshot, that of the last file)."""
    root, raw = _folder(spark, "lake"), _folder(spark, "raw")
    for name, df, key in (("PA0001", fx.pa0001_bronze(spark, sf), "Pers.No."), ("PA0008", fx.pa0008_bronze(spark, sf), "Pers.No."),
                          ("ZPOST", fx.zpost_bronze(spark, sf), "Personnel Number")):
        _write_reports(df, f"Table To Be Searched {name}", _number(key), raw)
    audit = AuditStore(spark, f"{root}/_audit")
    ingest_bronze(spark, raw, root, audit, glob=GLOB)
    ingest_bronze(spark, raw, root, audit, glob=GLOB)
    run_jobs(spark, SILVER_JOBS, root, audit)
    table = F.regexp_extract("output_file", "/bronze/([^/]+)/", 1)
    parts = [
        audit.read(MANIFEST).groupBy(table.alias("name")).agg(F.count("*").alias("a"), F.sum("row_count").alias("b"))
             .select(F.lit("manifest").alias("step"), "name", "a", "b"),
        audit.read(RUNS).where("script_name = 'bronze_ingestion'")
             .select(F.lit("run").alias("step"), F.concat_ws(" ", "run_id", "status").alias("name"), F.col("files_processed").alias("a"), F.col("total_rows").alias("b")),
        audit.read(TRANSFORMS).select(F.lit("silver").alias("step"), F.col("table_name").alias("name"), F.col("input_row_count").alias("a"), F.col("output_row_count").alias("b")),
    ]
    return reduce(DataFrame.unionByName, parts)


@register("latin1_extract", "SRC1 SRC3 EXT1 EXT2 EXT4 EXT5", f"""
SELECT c_name AS name, 'é' || c_mktsegment || 'ü' AS segment, c_custkey // {PEOPLE} AS file FROM customer""")
def latin1_extract(spark: SparkSession, sf: str) -> DataFrame:
    """The customers written as Latin-1 report files and read back by the splittable source."""
    raw = _folder(spark, "latin1")
    c = fx.table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.concat(F.lit("é"), "c_mktsegment", F.lit("ü")).alias("segment"),
                                               F.col("c_custkey").cast("string").alias("key"))
    _write_reports(c, "Customers", F.floor(F.col("key").cast("int") / PEOPLE), raw, "ISO-8859-1")
    rows, files = extract_grid(read_report_lines(spark, raw, GLOB, encoding="latin-1"))
    titles = files.select("file", F.element_at(F.split("first_line", " "), -1).cast("int").alias("number"))
    return rows.join(titles, "file").select(F.col("cells")[0].alias("name"), F.col("cells")[1].alias("segment"), F.col("number").cast("bigint").alias("file"))


@register("report_export", "SRC6 SRC7 SRC8 SNK3 SNK4", """
SELECT o_orderstatus AS status, count(*) AS orders FROM orders GROUP BY 1""")
def report_export(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots in two layers, the latest of which is exported as CSV and read back.

    The older Gold snapshot, a newer Silver one and a newer Gold folder without a commit marker
    (a write under way) must all lose against the newest committed Gold snapshot."""
    root = _folder(spark, "lake")
    counts = fx.table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("orders"))
    write_snapshot(counts.limit(0), root, "gold", "status", "20240101_000000_000000")
    newest = write_snapshot(counts, root, "gold", "status", "20240102_000000_000000")
    write_snapshot(counts.limit(0), root, "silver", "status", "20240103_000000_000000")
    counts.limit(0).write.parquet(f"{root}/gold/status/snapshot=20240104_000000_000000")
    latest, path = read_latest(spark, root, "status", ("silver", "gold"))
    assert path == newest == latest_snapshot(spark, root, "status", ("silver", "gold"))
    out = export_report(latest, f"{root}/report")
    return spark.read.schema("status string, orders bigint").option("header", True).csv(out)


@register("ingest_isolation", "AUD4 AUD6 EXT7 EXT14 SNK1", f"""
WITH f AS (SELECT c_custkey // {PEOPLE} AS f, count(*) AS n, count(*) FILTER (c_custkey % {7 * PEOPLE} = {PEOPLE}) AS wide FROM customer GROUP BY 1)
SELECT f AS file, CASE WHEN wide > 0 THEN 'error' ELSE 'ingested' END AS status, CASE WHEN wide > 0 THEN 0 ELSE n END AS n_rows FROM f
UNION ALL SELECT -1, 'skipped_empty', 0
UNION ALL SELECT NULL, CASE WHEN sum(wide) > 0 THEN 'partial' ELSE 'success' END, CAST(sum(CASE WHEN wide > 0 THEN 0 ELSE n END) AS BIGINT) FROM f""")
def ingest_isolation(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as report files, some with a row that is too wide and one with a header alone: these fail or are skipped, the others are ingested.

    A row per file, and one (no file) for the run log's entry."""
    root, raw = _folder(spark, "lake"), _folder(spark, "raw")
    c = fx.table(spark, sf, "customer")
    key = F.col("c_custkey")
    wide = F.when(key % (7 * PEOPLE) == PEOPLE, F.lit("a | b")).otherwise(F.col("c_mktsegment"))     # one cell too many
    rows = c.select(key.cast("string").alias("key"), "c_name", wide.alias("segment"))
    _write_reports(rows, "Customers", F.floor(F.col("key").cast("int") / PEOPLE), raw)
    spark.createDataFrame([("Customers -1", 0), ("| key | c_name | segment |", 1)], "line string, at int").coalesce(1).sortWithinPartitions("at").select("line").write.text(f"{raw}/part=-1")
    audit = AuditStore(spark, f"{root}/_audit")
    found = ingest_bronze(spark, raw, root, audit, glob=GLOB)
    number = F.regexp_extract("path", r"/part=(-?\d+)/", 1).cast("long")
    files = spark.createDataFrame([(f["path"], f["status"], f.get("rows", 0)) for f in found.files], "path string, status string, n_rows long")     # a row per file
    files = files.select(number.alias("file"), "status", "n_rows")
    return files.union(audit.read(RUNS).select(F.lit(None).cast("long"), "status", "total_rows"))
