"""Layout registry: which export a file is, its table name, renames and amount clean-up.

CFG1, EXT8-EXT13, EXT15, EXT16.  A layout is pure Column logic over the one-row-per-file frame
``(file, first_line, headers)``; matching is ``coalesce(when(match_1, 1), when(match_2, 2), ...)``
so the *first* registered layout that matches wins.  No Python runs per row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import strip_thousands
from tidemark.sources.reports import file_stem

MatchFn = Callable[[Column, Column], Column]              # (first_line, headers) -> bool
NameFn = Callable[[Column, Column, Column], Column]        # (first_line, headers, stem) -> table name


@dataclass(frozen=True)
class Layout:
    name: str
    match: MatchFn
    table_name: NameFn
    rename: Sequence[str] | None = None          # positional, applied only when widths agree
    strip_comma_keywords: Sequence[str] = ()     # columns whose name contains one lose ','
    extra: dict = field(default_factory=dict)


# Fixed values of the table-dump layout: the marker of its first line and the name pattern.
TABLE_DUMP_MARKER = "Table To Be Searched"
TABLE_DUMP_NAME = r"(?U)Table To Be Searched\s+([A-Z0-9_]+)"

TABLE_DUMP = Layout(
    name="table_dump",
    match=lambda first, headers: first.contains(TABLE_DUMP_MARKER),
    table_name=lambda first, headers, stem: F.coalesce(
        F.nullif(F.regexp_extract(first, TABLE_DUMP_NAME, 1), F.lit("")), stem),
)

# Fixed values of the position-cost layout: its ten-column signature, the 35 canonical
# headers it is renamed to, and the name keywords of the amount columns.
POSITION_COST_SIGNATURE = [
    "Position", "Post Title", "PS Group", "Post Type", "Position Type",
    "Fund Code", "Funding Type", "EE group", "Description", "Functional Area",
]
POSITION_COST_HEADERS = [
    "Position", "Post Title", "Position Pay Group", "Post Type", "Post Type Description",
    "Fund Code", "Description of Fund Code", "Functional Area", "Description of Functional Area", "Reporting number", "Personnel Number",
    "Start date", "End Date", "Number of Days", "Year", "Organizational unit", "Org Unit Desc", "Business Area", "Business Area Description",
    "Personnel Area", "Location Text", "Location subarea",
    "Cost Center", "Standard Cost", "Transfer to Reserves", "Transfer to Fund",
    "Transfer Reserve", "Total Post Cost", "Other Costs", "Other Charges",
    "Local Cost", "Local Cost1", "Local Cost2 (Optional)",
    "Total Non Post Cost", "Total",
]
AMOUNT_KEYWORDS = ["Amount", "Cost", "Total", "Reserves", "Fund", "Standard Cost"]
POSITION_COST_TABLE = "ZPOST"

POSITION_COST = Layout(
    name="position_cost",
    match=lambda first, headers: F.coalesce(
        F.slice(headers, 1, len(POSITION_COST_SIGNATURE))
        == F.array(*[F.lit(h) for h in POSITION_COST_SIGNATURE]), F.lit(False)),
    table_name=lambda first, headers, stem: F.lit(POSITION_COST_TABLE),
    rename=POSITION_COST_HEADERS,
    strip_comma_keywords=AMOUNT_KEYWORDS,
)

GENERIC = "generic"
DEFAULT_LAYOUTS: list[Layout] = [POSITION_COST, TABLE_DUMP]   # first match wins


def match_layouts(files: DataFrame, layouts: Sequence[Layout] = DEFAULT_LAYOUTS) -> DataFrame:
    """EXT8 / EXT13: add ``layout`` (first match, else ``generic``) and ``table_name``
    (the layout's, else the file stem) to the per-file frame."""
    first, headers, stem = F.col("first_line"), F.col("headers"), file_stem(F.col("file"))
    layout = F.coalesce(*[F.when(l.match(first, headers), F.lit(l.name)) for l in layouts], F.lit(GENERIC))
    name = F.coalesce(*[F.when(F.col("layout") == l.name, l.table_name(first, headers, stem)) for l in layouts],
                      stem)
    return files.withColumn("layout", layout).withColumn("table_name", name)


def unique_headers(headers: Sequence[str]) -> list[str]:
    """EXT15: blank names become ``C<i>``; case-insensitive repeats get ``_1``, ``_2``...

    Spark refuses to write two columns whose names differ only in case, so uniqueness is
    case-insensitive.
    """
    out: list[str] = []
    seen: set[str] = set()
    for i, h in enumerate(headers):
        base = h if h.strip() else f"C{i}"
        name, n = base, 0
        while name.lower() in seen:
            n += 1
            name = f"{base}_{n}"
        seen.add(name.lower())
        out.append(name)
    return out


def layout_by_name(name: str, layouts: Sequence[Layout] = DEFAULT_LAYOUTS) -> Layout | None:
    for l in layouts:
        if l.name == name:
            return l
    return None


def final_headers(headers: Sequence[str], layout: Layout | None) -> list[str]:
    """EXT11: the layout's positional rename when the widths agree, else the file's headers."""
    if layout is not None and layout.rename is not None and len(layout.rename) == len(headers):
        return list(layout.rename)
    return list(headers)


def to_table(rows: DataFrame, headers: Sequence[str], layout: Layout | None = None,
             keep: Sequence[str] = ()) -> DataFrame:
    """Build the Bronze table of one header signature from ``rows`` (``cells`` arrays).

    Every column is text (EXT16).  Short rows are padded with NULL (EXT14; the source pads
    with the text ``'None'``); widths are checked per file beforehand by ``file_stats``.
    ``keep`` passes row columns (``file``, ``pos``...) through in front.
    """
    names = unique_headers(final_headers(headers, layout))
    cols = [F.try_element_at(F.col("cells"), F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
    if layout is not None and layout.strip_comma_keywords:
        kws = layout.strip_comma_keywords
        cols = [strip_thousands(c).alias(n) if any(k in n for k in kws) else c
                for c, n in zip(cols, names)]
    return rows.select(*[F.col(k) for k in keep], *cols)
