"""Render given tables as page-broken report text (a lines frame), for the extraction queries.

Each table row becomes one grid line ``| a | b | ... |``; every page (a fixed number of rows by
key) starts with a title, a page number, a divider, the header row and another divider, and
ends with a footer.  The first line of a file is its first page's title.  All of it is computed
by Spark from the whole table; nothing is written to disk.  Oracles re-derive the cell texts in
DuckDB from the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.fixtures import table
from tidemark.sources.tables import ensure_parallelism
from tidemark.sources.layouts import POSITION_COST_HEADERS, POSITION_COST_SIGNATURE

DIVIDER = "|" + "-" * 72 + "|"
NBSP = "\u00a0"


def render(df: DataFrame, file: Column, page: Column, slot: Column, title: str,
           headers: Sequence[str], cells: Sequence[Column] | Column) -> DataFrame:
    """Lines ``(file, pos, value)`` of a report with the given headers and cell texts
    (a list of text columns, or one array column whose width may vary per row)."""
    df = ensure_parallelism(df)
    arr = cells if isinstance(cells, Column) else F.array(*cells)
    row = F.concat(F.lit("| "), F.array_join(arr, " | "), F.lit(" |"))
    data = df.select(file.alias("file"), (page * 1000 + 100 + slot).cast("bigint").alias("pos"), row.alias("value"))
    header_row = "|" + "|".join(f" {h} " for h in headers) + "|"
    pages = df.groupBy(file.alias("file"), page.alias("page")).agg(F.count(F.lit(1)).alias("n"))
    page_lines = F.array(
        F.struct(F.lit(0).alias("k"), F.lit(title).alias("v")),
        F.struct(F.lit(1).alias("k"), F.concat(F.lit("Page "), (F.col("page") + 1).cast("string")).alias("v")),
        F.struct(F.lit(2).alias("k"), F.lit(DIVIDER).alias("v")),
        F.struct(F.lit(3).alias("k"), F.lit(header_row).alias("v")),
        F.struct(F.lit(4).alias("k"), F.lit(DIVIDER).alias("v")),
        F.struct(F.lit(999).alias("k"), F.lit("").alias("v")),
    )
    frame = (pages.select("file", "page", F.explode(page_lines).alias("l"))
                  .select("file", (F.col("page") * 1000 + F.col("l.k")).cast("bigint").alias("pos"),
                          F.col("l.v").alias("value")))
    return data.unionByName(frame)


# ---------------------------------------------------------------------------------------
# orders as a table-dump report, split into files of 5,000 keys, 50 rows per page

ORDERS_TITLE = "Table To Be Searched   ORDERS"
ORDERS_HEADERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders_cells() -> list[Column]:
    k = F.col("o_orderkey")
    status = F.when(k % 10 == 0, F.concat(F.lit(NBSP), F.col("o_orderstatus"), F.lit(NBSP))).otherwise(
        F.col("o_orderstatus"))
    return [k.cast("string"), F.col("o_custkey").cast("string"), status,
            F.format_number(F.col("o_totalprice"), 2), F.date_format(F.to_date("o_orderdate"), "dd.MM.yyyy"),
            F.col("o_orderpriority")]


ORDERS_TEXT_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, format('{:,.2f}', o_totalprice) AS o_totalprice,
       strftime(CAST(o_orderdate AS DATE), '%d.%m.%Y') AS o_orderdate, o_orderpriority
FROM orders"""


def orders_report(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    file = F.concat(F.lit("reports/orders_"), F.floor(k / 5000).cast("string"), F.lit(".txt"))
    return render(table(spark, sf, "orders"), file, F.floor(k / 50), k % 50, ORDERS_TITLE,
                  ORDERS_HEADERS, orders_cells())


# ---------------------------------------------------------------------------------------
# nation as a plain list (no table-dump marker -> generic layout, table name = file stem)

NATION_HEADERS = ["n_nationkey", "n_name", "n_regionkey"]


def nation_report(spark: SparkSession, sf: str, name: str = "nation_report", drop_last_when: Column | None = None,
                  extra_cell_when: Column | None = None) -> DataFrame:
    """nation as a list; optionally ragged: some rows lose their last cell, some gain one."""
    key = F.col("n_nationkey")
    cells = F.array(key.cast("string"), F.col("n_name"), F.col("n_regionkey").cast("string"))
    if drop_last_when is not None:
        cells = F.when(drop_last_when, F.slice(cells, 1, 2)).otherwise(cells)
    if extra_cell_when is not None:
        cells = F.when(extra_cell_when, F.concat(cells, F.array(F.lit("x")))).otherwise(cells)
    return render(table(spark, sf, "nation"), F.lit(f"reports/{name}.txt"), F.floor(key / 10), key % 10,
                  "Nation list", NATION_HEADERS, cells)


# ---------------------------------------------------------------------------------------
# a position-cost export rendered from orders: the 10-column signature, 35 columns in all

def _poscost_columns() -> list[tuple[str, object, str]]:
    """(source header, Spark cell-text builder, DuckDB cell text) for the 35 columns.

    The Spark side is a zero-argument builder so that nothing touches a SparkContext until a
    frame is actually rendered (the DuckDB texts are needed without one).
    """
    k = lambda: F.col("o_orderkey")           # noqa: E731
    c = lambda: F.col("o_custkey")            # noqa: E731
    d = lambda: F.to_date("o_orderdate")      # noqa: E731
    ks, cs, ds = "o_orderkey", "o_custkey", "CAST(o_orderdate AS DATE)"

    def tag(prefix, col, n, sql_col):
        return (lambda: F.concat(F.lit(prefix), (col() % n).cast("string")),
                f"'{prefix}' || CAST({sql_col} % {n} AS VARCHAR)")

    spec = [
        (lambda: k().cast("string"), f"CAST({ks} AS VARCHAR)"),
        tag("Post ", k, 97, ks),
        (lambda: F.substring("o_orderpriority", 1, 1), "substr(o_orderpriority, 1, 1)"),
        (lambda: F.lpad((k() % 40).cast("string"), 2, "0"), f"lpad(CAST({ks} % 40 AS VARCHAR), 2, '0')"),
        (lambda: F.col("o_orderstatus"), "o_orderstatus"),
        (lambda: F.format_number(c() * 1000, 0), f"format('{{:,}}', {cs} * 1000)"),
        tag("FT", k, 3, ks),
        tag("EE", k, 5, ks),
        (lambda: F.concat(F.lit("Desc, item "), k().cast("string")), f"'Desc, item ' || CAST({ks} AS VARCHAR)"),
        tag("FA", k, 11, ks),
        (lambda: c().cast("string"), f"CAST({cs} AS VARCHAR)"),
        (lambda: F.date_format(d(), "dd.MM.yyyy"), f"strftime({ds}, '%d.%m.%Y')"),
        (lambda: F.date_format(F.date_add(d(), 89), "dd.MM.yyyy"), f"strftime({ds} + 89, '%d.%m.%Y')"),
        (lambda: F.lit("90"), "'90'"),
        (lambda: F.year(d()).cast("string"), f"CAST(year({ds}) AS VARCHAR)"),
        tag("OU", c, 7, cs),
        tag("Unit, ", c, 7, cs),
        tag("BA", k, 4, ks),
        tag("Area ", k, 4, ks),
        (lambda: F.col("o_orderstatus"), "o_orderstatus"),
        tag("Loc, ", k, 9, ks),
        tag("S", k, 2, ks),
        (lambda: F.format_number(c() * 10, 0), f"format('{{:,}}', {cs} * 10)"),
    ]
    for j in range(12):
        spec.append(((lambda j=j: F.format_number(F.col("o_totalprice") - F.lit(float(j)), 2)),
                     f"format('{{:,.2f}}', o_totalprice - {float(j)})"))
    headers = POSITION_COST_SIGNATURE + POSITION_COST_HEADERS[len(POSITION_COST_SIGNATURE):]
    return [(h, s, q) for h, (s, q) in zip(headers, spec)]


POSCOST_TITLE = "Position cost report"


def poscost_report(spark: SparkSession, sf: str) -> DataFrame:
    cols = _poscost_columns()
    k = F.col("o_orderkey")
    file = F.concat(F.lit("reports/poscost_"), F.floor(k / 5000).cast("string"), F.lit(".txt"))
    return render(table(spark, sf, "orders"), file, F.floor(k / 50), k % 50, POSCOST_TITLE,
                  [h for h, _, _ in cols], [s() for _, s, _ in cols])


def poscost_sql_cells() -> list[tuple[str, str]]:
    return [(h, q) for h, _, q in _poscost_columns()]


# ---------------------------------------------------------------------------------------
# lineitem as reports of very unequal size: one file with nine tenths of the lines, 20 others

_amount = lambda name: (lambda: F.format_number(F.col(name), 2))
#: (header, Spark cell-text builder, DuckDB cell text)
LINEITEM_CELLS = [
    *((c, (lambda c=c: F.col(c).cast("string")), f"CAST({c} AS VARCHAR)") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")),
    *((c, _amount(c), f"format('{{:,.2f}}', {c})") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    *((c, (lambda c=c: F.col(c)), c) for c in ("l_returnflag", "l_linestatus")),
    ("l_shipdate", lambda: F.date_format(F.to_date("l_shipdate"), "dd.MM.yyyy"), "strftime(CAST(l_shipdate AS DATE), '%d.%m.%Y')"),
]
LINEITEM_FILE_SQL = "CASE WHEN l_orderkey % 10 < 9 THEN 'lineitem_main.txt' ELSE 'lineitem_' || CAST(l_orderkey // 10 % 20 AS VARCHAR) || '.txt' END"


def lineitem_report(spark: SparkSession, sf: str) -> DataFrame:
    """Lines in the order in which the table's rows are scanned; every 50th brings the header again."""
    k = F.col("l_orderkey")
    name = F.when(k % 10 < 9, F.lit("main")).otherwise((F.floor(k / 10) % 20).cast("string"))
    t = ensure_parallelism(table(spark, sf, "lineitem")).withColumn("id", F.monotonically_increasing_id() + 10)
    t = t.withColumn("file", F.concat(F.lit("reports/lineitem_"), name, F.lit(".txt")))
    header = "| " + " |  ".join(h for h, _, _ in LINEITEM_CELLS) + " |"
    page = [F.lit("Page"), F.lit(DIVIDER), F.lit(header), F.lit(DIVIDER)]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *(s() for _, s, _ in LINEITEM_CELLS)), F.lit(" |"))
    lines = t.select("file", "id", F.posexplode(F.when(F.col("id") % 50 == 0, F.array(*page, row)).otherwise(F.array(row))).alias("at", "value"))
    titles = t.select("file").distinct().select("file", F.posexplode(F.array(F.lit("Lines"), *page)).alias("pos", "value"))
    return titles.select("file", F.col("pos").cast("bigint").alias("pos"), "value").unionByName(
        lines.select("file", (F.col("id") * 10 + F.col("at")).alias("pos"), "value"))
