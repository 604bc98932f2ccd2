"""Page-broken, pipe-delimited report text -> rows of cells (SRC1-SRC3, EXT1-EXT7, EXT14).

The extractor is one Spark job over a *lines* frame ``(file, pos, value)`` covering any number
of files; ``pos`` is any orderable column giving the line order inside a file.

* EXT1  first line of a file: ``min_by(strip(value), pos)`` (empty file -> no row at all)
* EXT2  grid rows: stripped line starts and ends with ``|``
* EXT3  dividers ``^|[-\\s]+|$`` are skipped (``|---|---|`` is not a divider unless
        ``multi_cell_dividers=True``)
* EXT4  cells: split on ``|``, drop the first and last piece, strip each
* EXT5  header: the first grid row of the file (``min_by(cells, pos)``)
* EXT6  later rows equal to the header are skipped
* EXT7  files without data rows report ``n_rows = 0`` (callers skip them)

The text is scanned once.  What a line must know of its file, the header, is carried over the
file's splits: each split gives a summary row, these are scanned in split order, and the header is
handed back to each split (``scan_grid``).  Lines are joined by split, never by file, so a huge
file never lands in one task.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import PY_WHITESPACE, strip_ws
from tidemark.session import checkpoint_dir

DIVIDER = r"(?U)^\|[-\s]+\|$"
_CHARSETS = {"utf-8": "utf-8", "utf8": "utf-8", "latin-1": "latin-1", "latin1": "latin-1",
             "iso-8859-1": "latin-1", "cp1252": "cp1252", "windows-1252": "cp1252"}
# cp1252 is latin-1 but for 0x80-0x9F, where the codec itself gives the characters it defines
_CP1252 = "".join(bytes([b]).decode("cp1252", "replace") for b in range(0x80, 0xA0))
_C1 = "".join(map(chr, range(0x80, 0xA0)))
DIVIDER_MULTI = r"(?U)^\|[-\s|]*-[-\s|]*\|$"


def read_report_lines(spark: SparkSession, raw_dir: str | None = None, glob: str = "*.txt",
                      encoding: str = "utf-8", paths: list[str] | None = None) -> DataFrame:
    """SRC1-SRC3: the lines of every ``glob`` file directly in ``raw_dir`` (not recursive,
    case-sensitive) -- or of the given ``paths`` -- as ``(file, pos, value)``.

    UTF-8 input is read by the splittable text source; invalid bytes become U+FFFD.  ``pos`` =
    (split start, row id) orders lines inside a file even when the file is split across tasks;
    the id is taken right above the scan, before any shuffle.  ``latin-1`` and ``cp1252`` are read
    by the same source and decoded from its bytes, so they split as well; line ends are the same
    bytes in all three.
    """
    sources = [_literal(p) for p in paths] if paths is not None else [raw_dir.rstrip("/") + "/" + glob]
    charset = _CHARSETS.get(encoding.lower().replace("_", "-"))
    if charset is None:
        raise ValueError(f"unknown encoding {encoding!r}; known: {sorted(_CHARSETS)}")
    raw = F.col("value")
    if charset == "utf-8":
        value = F.make_valid_utf8(raw)
    else:
        value = F.decode(raw.cast("binary"), "ISO-8859-1")
        if charset == "cp1252":
            value = F.translate(value, _C1, _CP1252)
    return spark.read.format("text").load(sources).select(
        unescaped(F.col("_metadata.file_path")).alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("pos"),
        value.alias("value"),
    )


def _char_class(chars: str) -> str:
    """A regex class of the characters, neighbours as ranges: a matcher tries its parts one by one."""
    runs: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "[" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in runs) + "]"


_WS_CLASS = _char_class(PY_WHITESPACE)
_LOOSE_PIPE = _WS_CLASS + r"*+\|" + _WS_CLASS + "*+"
_OTHER_WS = _char_class(PY_WHITESPACE.replace(" ", ""))
_UNPRINTED = "[^ -~]"       # one range, so a plain line is passed over quickly; all of _OTHER_WS lies outside it


def _with_tight(lines: DataFrame, is_row: Column) -> DataFrame:
    """Add ``tight``: a grid row (of ``s``) without the whitespace around its ``|``, so that its cells are stripped.

    One space on either side goes by plain replacement, once more where some are left (blank cells);
    a pattern runs only on lines that have still more of them, or other whitespace.
    """
    def plain(c: Column) -> Column:
        return F.replace(F.replace(c, F.lit(" |"), F.lit("|")), F.lit("| "), F.lit("|"))

    t = F.col("tight")
    loose = t.contains(" |") | t.contains("| ")
    other = t.rlike(_UNPRINTED) & t.rlike(_OTHER_WS)
    lines = lines.withColumn("tight", F.when(is_row, plain(F.col("s")))).withColumn("tight", F.when(loose, plain(t)).otherwise(t))
    return lines.withColumn("tight", F.when(other, F.regexp_replace(t, _LOOSE_PIPE, "|")).when(loose, F.regexp_replace(t, r" *+\| *+", "|")).otherwise(t))


def cells(tight: Column, width: Column) -> Column:
    """EXT4: ``[c.strip() for c in line.split('|')[1:-1]]`` of a grid line, from its tight form."""
    return F.slice(F.split(tight, r"\|", -1), F.lit(2), width)


#: Lines whose ``pos`` is a plain number are cut into splits of so many positions.
SPLIT_BITS = 20


@dataclass(frozen=True)
class Grid:
    """The grid lines of report files, scanned once, and what every split of them was handed back.

    ``lines``:  ``file, block, pos, tight, width, hash_1, hash_2`` -- every grid row, headers included.
    ``splits``: ``file, block, hash_1, hash_2`` -- one row per split, with the hashes of its file's header.
    ``files``:  ``file, first_line, headers`` -- one row per non-empty file.
    ``state_bytes``: size of ``splits``, measured while it was written.
    """

    lines: DataFrame
    splits: DataFrame
    files: DataFrame
    state_bytes: int

    def rows(self, per_file: DataFrame | None = None) -> DataFrame:
        """Data rows ``file, block, pos, cells, width``: no headers, dividers or repeats (EXT6)."""
        found = self.texts(per_file)
        return found.select(*[cells(F.col("tight"), F.col("width")).alias("cells") if c == "tight" else c for c in found.columns])

    def texts(self, per_file: DataFrame | None = None) -> DataFrame:
        """Data rows as ``rows`` gives them, but with the line's text ``tight``, of which ``cells`` makes them.

        ``per_file`` (one row per file) adds its columns, and only its files are left.  Both go
        to the rows by split, so no join key stands for more rows than one split has.
        """
        state, size = self.splits, self.state_bytes
        if per_file is not None:
            state = state.join(per_file, "file")
            size = state.agg(_size(state)).collect()[0][0]
        state = state.withColumnsRenamed({"hash_1": "_h1", "hash_2": "_h2"})
        state = F.broadcast(state) if size <= _broadcast_limit(state) else state.hint("shuffle_merge")
        header = (F.col("hash_1") == F.col("_h1")) & (F.col("hash_2") == F.col("_h2"))
        return self.lines.join(state, ["file", "block"]).where(~header).drop("hash_1", "hash_2", "_h1", "_h2")


def _size(state: DataFrame) -> Column:
    """Bytes of a table of splits: its text and 16 a field."""
    text = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c, t in state.dtypes if t == "string"), F.lit(0))
    return F.coalesce(F.sum(text + 16 * len(state.columns)), F.lit(0)).alias("size")


def _broadcast_limit(df: DataFrame) -> int:
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _staged(df: DataFrame, name: str, seen: Observation | None = None) -> DataFrame:
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    (df if seen is None else df.observe(seen, _size(df))).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_grid(lines: DataFrame, multi_cell_dividers: bool = False) -> Grid:
    """Scan ``lines`` (file, pos, value) once and carry each file's header over its splits (EXT1-EXT6).

    A split is what one task reads of a file (``pos.block``), or 2^20 positions where ``pos`` is a
    number.  The scan writes grid rows without whitespace around their cells, their width and a
    128-bit hash to the shared checkpoint folder.  From the narrow columns alone each split gives one summary row, the places
    of its first line and first grid row.  A running minimum over a file's summaries is its first
    line and header; the header's hashes are handed back to each split.  No line meets a row of
    another split, and a file that holds most of the lines is as many tasks as it has splits.
    """
    numbered = not isinstance(lines.schema["pos"].dataType, T.StructType)
    block = F.shiftright("pos", SPLIT_BITS).cast("bigint") if numbered else F.col("pos.block")
    at = F.col("pos").cast("bigint") if numbered else F.col("pos.row")
    scanned = lines.select("file", block.alias("block"), at.alias("at"), "pos", strip_ws(F.col("value")).alias("s"))
    is_row = F.col("s").startswith("|") & F.col("s").endswith("|") & ~F.col("s").rlike(DIVIDER_MULTI if multi_cell_dividers else DIVIDER)
    scanned = _with_tight(scanned, is_row)
    # a line's text is read again only where it is a file's first line, which may be a grid row
    keep = F.lit(True) if numbered else F.col("tight").isNull() | (F.col("block") == 0)
    width = F.octet_length("tight") - F.octet_length(F.replace("tight", F.lit("|"), F.lit(""))) - 1
    staged = _staged(scanned.select("file", "block", "at", "pos", F.when(keep, F.col("s")).alias("s"), "tight", width.alias("width"),
                                    F.xxhash64("tight").alias("hash_1"), F.xxhash64(F.lit(1), F.col("tight")).alias("hash_2")), "grid-lines")
    is_grid = F.col("width") >= 0
    summary = staged.groupBy("file", "block").agg(F.min("at").alias("first"), F.min(F.when(is_grid, F.col("at"))).alias("head"))
    in_order = Window.partitionBy("file").orderBy("block")
    first = F.row_number().over(in_order) == 1
    carried = F.first(F.when(F.col("head").isNotNull(), F.struct("block", "head")), ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    summary = _staged(summary.select("file", "block", F.when(first, F.col("first")).alias("first"), carried.alias("header")), "grid-splits")

    # the two lines of each file that matter, looked up by split and place (AQE broadcasts them if they are small)
    asked = summary.where("first is not null").select("file", "block", F.col("first").alias("at")).union(
        summary.where("first is not null and header is not null").select("file", "header.block", "header.head")).distinct()
    found = _staged(staged.join(asked, ["file", "block", "at"]).select("file", "block", "at", "s", cells(F.col("tight"), F.col("width")).alias("cells"), "hash_1", "hash_2"), "grid-heads")
    firsts = summary.where("first is not null").select("file", "block", F.col("first").alias("at"), "header")
    files = (firsts.join(found.select("file", "block", "at", F.col("s").alias("first_line")), ["file", "block", "at"])
                   .join(found.select("file", F.struct("block", F.col("at").alias("head")).alias("header"), F.col("cells").alias("headers")), ["file", "header"], "left")
                   .select("file", "first_line", "headers"))
    heads = found.select(F.col("file").alias("f"), F.struct("block", F.col("at").alias("head")).alias("h"), "hash_1", "hash_2")
    splits = summary.join(heads, (F.col("file") == F.col("f")) & (F.col("header") == F.col("h"))).select("file", "block", "hash_1", "hash_2")
    grid = staged.where(is_grid).select("file", "block", "pos", "tight", "width", "hash_1", "hash_2")
    seen = Observation()
    state = _staged(splits, "grid-state", seen)
    return Grid(grid, state, files, seen.get["size"])


def extract_grid(lines: DataFrame, multi_cell_dividers: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(rows, files)`` of ``scan_grid``: the data rows and one row per non-empty file."""
    grid = scan_grid(lines, multi_cell_dividers)
    return grid.rows(), grid.files


def file_stats(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Per file: ``first_line, headers, n_rows, max_width, ragged`` (EXT7, EXT14).

    ``ragged``: the widest row differs from the header width -- the source cannot build a
    frame from such a file (the file fails, the run is partial).  Shorter rows alone are fine;
    they are padded with NULL.  Reads the rows' widths, not their cells.
    """
    counts = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.max("width").alias("max_width"))
    return (files.join(counts, "file", "left")
                 .select("file", "first_line", "headers",
                         F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
                         "max_width",
                         ((F.coalesce(F.col("n_rows"), F.lit(0)) > 0)
                          & (F.col("max_width") != F.size("headers"))).alias("ragged")))


def unescaped(path: Column) -> Column:
    """A path as the file system has it: ``_metadata`` gives it with URL escapes, other sources do not."""
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def _literal(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def file_stem(path: Column) -> Column:
    """``Path(p).stem``: the file name without its last suffix."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 1)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)
