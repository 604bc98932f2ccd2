"""Queries over report extraction, layouts and content-hash dedup (EXT1-EXT16, AUD1-AUD2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import clean as C
from tidemark.plans import report_fixtures as rf
from tidemark.plans.catalog import register
from tidemark.plans.fixtures import table
from tidemark.sources import layouts as L
from tidemark.sources.reports import extract_grid, file_name, file_stats
from tidemark.plans.audit import content_hash_dedup


def _extract_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = extract_grid(rf.orders_report(spark, sf))
    return L.to_table(rows, rf.ORDERS_HEADERS, layout=L.TABLE_DUMP)


@register("report_extract", "EXT1-EXT6 EXT13 EXT16 SRC2", rf.ORDERS_TEXT_SQL)
def report_extract(spark: SparkSession, sf: str) -> DataFrame:
    """orders rendered as page-broken report text, extracted back to an all-text table."""
    return _extract_orders(spark, sf)


ORDERS_SPEC = C.CleanSpec(dates={"o_orderdate": "o_orderdate"}, decimals=("o_totalprice",))


@register("report_roundtrip", "EXT1-EXT6 CFG5 FN1 FN3",
          """SELECT CAST(o_orderdate AS DATE) AS o_orderdate, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
       o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders""")
def report_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """table -> report text -> extraction -> Silver cleaning gives the typed table back."""
    t = C.clean(_extract_orders(spark, sf), ORDERS_SPEC)
    return t.select("o_orderdate", "o_totalprice", F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
                    F.col("o_custkey").cast("bigint").alias("o_custkey"), "o_orderstatus", "o_orderpriority")


def _all_reports(spark: SparkSession, sf: str) -> DataFrame:
    return (rf.orders_report(spark, sf).unionByName(rf.nation_report(spark, sf))
              .unionByName(rf.poscost_report(spark, sf)))


@register("layout_match", "EXT7 EXT8 EXT9 EXT10 EXT13 CFG1", f"""
SELECT 'orders_' || CAST(o_orderkey // 5000 AS VARCHAR) || '.txt' AS file, 'table_dump' AS layout,
       'ORDERS' AS table_name, COUNT(*) AS n_rows, {len(rf.ORDERS_HEADERS)} AS n_headers
FROM orders GROUP BY 1
UNION ALL
SELECT 'nation_report.txt', 'generic', 'nation_report', COUNT(*), {len(rf.NATION_HEADERS)} FROM nation
UNION ALL
SELECT 'poscost_' || CAST(o_orderkey // 5000 AS VARCHAR) || '.txt', 'position_cost', 'ZPOST', COUNT(*), 35
FROM orders GROUP BY 1""")
def layout_match(spark: SparkSession, sf: str) -> DataFrame:
    """Per file: first matching layout (position cost before table dump), table name, size."""
    rows, files = extract_grid(_all_reports(spark, sf))
    st = L.match_layouts(file_stats(rows, files))
    return st.select(file_name(F.col("file")).alias("file"), "layout", "table_name", "n_rows",
                     F.size("headers").alias("n_headers"))


def _strip_sql(name: str, expr: str) -> str:
    if any(k in name for k in L.AMOUNT_KEYWORDS):
        return f"REPLACE({expr}, ',', '')"
    return expr


@register("layout_rename_strip_commas", "EXT10 EXT11 EXT12",
          "SELECT " + ",\n       ".join(
              f'{_strip_sql(L.POSITION_COST_HEADERS[i], q)} AS "{L.POSITION_COST_HEADERS[i]}"'
              for i, (_, q) in enumerate(rf.poscost_sql_cells())) + "\nFROM orders")
def layout_rename_strip_commas(spark: SparkSession, sf: str) -> DataFrame:
    """Position-cost export: positional rename to the canonical 35 headers, commas removed
    from the amount-like columns (any whose name contains a keyword, Fund Code included)."""
    rows, files = extract_grid(rf.poscost_report(spark, sf))
    headers = [h for h, _ in rf.poscost_sql_cells()]
    return L.to_table(rows, headers, layout=L.POSITION_COST)


@register("ragged_files", "EXT14 EXT7", f"""
SELECT 'nation_short.txt' AS file, COUNT(*) AS n_rows, max(CASE WHEN n_nationkey % 4 = 0 THEN 2 ELSE 3 END) AS max_width,
       3 AS n_headers, false AS ragged, CAST(SUM(CASE WHEN n_nationkey % 4 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS padded_cells
FROM nation
UNION ALL
SELECT 'nation_wide.txt', COUNT(*), max(CASE WHEN n_nationkey % 5 = 0 THEN 4 ELSE 3 END), 3,
       max(n_nationkey % 5 = 0), 0
FROM nation""")
def ragged_files(spark: SparkSession, sf: str) -> DataFrame:
    """Short rows are padded (file ok); a row wider than the header fails its file."""
    lines = (rf.nation_report(spark, sf, "nation_short", drop_last_when=F.col("n_nationkey") % 4 == 0)
               .unionByName(rf.nation_report(spark, sf, "nation_wide", extra_cell_when=F.col("n_nationkey") % 5 == 0)))
    rows, files = extract_grid(lines)
    st = file_stats(rows, files)
    padded = (L.to_table(rows, rf.NATION_HEADERS, keep=["file"])
                .groupBy("file").agg(F.sum(F.col("n_regionkey").isNull().cast("int")).alias("padded_cells")))
    return (st.join(padded, "file", "left")
              .select(file_name(F.col("file")).alias("file"), "n_rows", "max_width",
                      F.size("headers").alias("n_headers"), "ragged",
                      F.when(F.col("ragged"), F.lit(0)).otherwise(F.col("padded_cells")).cast("bigint")
                       .alias("padded_cells")))


@register("content_hash_dedup", "AUD1 AUD2",
          "SELECT min(doc_id) AS doc_id, md5(text) AS content_hash, COUNT(*) AS copies FROM documents GROUP BY md5(text)")
def content_hash_dedup_query(spark: SparkSession, sf: str) -> DataFrame:
    """Keep the first (lowest id) document per MD5 of the whole text; count the copies."""
    return content_hash_dedup(table(spark, sf, "documents"), "text", "doc_id")


_LINEITEM_SQL = f"""SELECT {rf.LINEITEM_FILE_SQL} AS file, {", ".join(f"{q} AS {h}" for h, _, q in rf.LINEITEM_CELLS)} FROM lineitem"""


@register("skewed_report_extract", "EXT1-EXT6 EXT16", _LINEITEM_SQL)
def skewed_report_extract(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as reports, one file of which holds nine tenths of the lines, extracted in one scan of the text."""
    rows, _ = extract_grid(rf.lineitem_report(spark, sf))
    return (L.to_table(rows, [h for h, _, _ in rf.LINEITEM_CELLS], keep=["file"])
             .withColumn("file", file_name(F.col("file"))))


# A nation list whose header row repeats a name in another case and leaves one name blank.
_CLASHING_HEADERS = ["Key", "key", " "]


@register("duplicate_headers", "EXT15 EXT16 EXT13", """
SELECT CAST(n_nationkey AS VARCHAR) AS "Key", n_name AS "key_1", CAST(n_regionkey AS VARCHAR) AS "C2" FROM nation""")
def duplicate_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Header names made unique: case-insensitive repeats get ``_1``, blank names ``C<i>``."""
    n = table(spark, sf, "nation")
    key = F.col("n_nationkey")
    lines = rf.render(n, F.lit("reports/clash.txt"), F.floor(key / 10), key % 10, "Nation list",
                      _CLASHING_HEADERS, [key.cast("string"), F.col("n_name"), F.col("n_regionkey").cast("string")])
    rows, files = extract_grid(lines)
    headers = [r["headers"] for r in files.select("headers").distinct().collect()]
    return L.to_table(rows, list(headers[0]))
