"""Bronze ingestion: raw report files -> one Bronze snapshot per file (lifecycle A).

SRC1-SRC3, AUD1-AUD4, AUD6, EXT1-EXT16, SNK1.  One Spark job extracts all new files at once:

1. MD5 of every ``*.txt`` file -- read only for files that are new or changed since they were
   last hashed (path, size, modification time), in pieces and whatever their size; files whose
   content is in the manifest are skipped, and of identical files in this run only the first by
   path is taken (AUD1, AUD2).  A file that cannot be read fails alone (AUD6).
2. The lines of the new files are scanned once (``scan_grid``), which stages their cells; the
   per-file facts (first line, headers, row count, widest row) are collected -- one small row per file.
3. Files without data rows are skipped and not recorded (EXT7); files whose widest row does not
   match the header width fail alone and make the run ``partial`` (EXT14, AUD6).
4. Data rows of the good files are dealt out by header signature in the shared checkpoint folder;
   each (table, header) signature is then written from its own partition there, several at once,
   one ``snapshot=<id>`` per file with a commit marker of its own (SNK1).  The raw text is read once.
5. Manifest rows are appended after the data (AUD3), the run row last (AUD4).
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.audit import FILE_INDEX, MANIFEST, AuditStore, file_hashes, filesystem, list_files, remember_hashes, unhashed, unseen_files
from tidemark.session import checkpoint_dir
from tidemark.sources.layouts import DEFAULT_LAYOUTS, Layout, layout_by_name, match_layouts, to_table
from tidemark.sources.reports import _staged, cells, file_stats, read_report_lines, scan_grid
from tidemark.sources.snapshots import COMMITTED, SNAPSHOT, commit_snapshot, dataset_path, marker, snapshot_id, write_snapshots_by_column


def hash_files(spark: SparkSession, raw_dir: str, glob: str, audit: AuditStore):
    """AUD1 with an index: hash only new or changed files (their bytes are read once, by the
    job that appends them to the shared file index), then resolve every listed file's hash from
    the index.  The files are listed once, without their contents, and the listing is staged: with
    many small files a listing costs more than their hashes."""
    listing = _staged(list_files(spark, raw_dir, glob), "file-listing")
    fresh = file_hashes(spark, raw_dir, glob, known=audit.read(FILE_INDEX), listing=listing)
    remember_hashes(audit, fresh.where(F.col("file_hash").isNotNull()))
    index = audit.read(FILE_INDEX).dropDuplicates(["file", "size", "modified"])
    return listing.join(index, ["file", "size", "modified"], "left").select("file", "file_hash", "size", "modified")


def _mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Write the commit markers of snapshots; give back those that Arrow cannot reach."""
    for outputs in batches:
        done = []
        for path, rows in zip(outputs["path"], outputs["rows"]):
            try:
                system, local = filesystem(f"{path}/{COMMITTED}")
                with system.open_output_stream(local) as out:
                    out.write(marker(rows))
                done.append(True)
            except (OSError, pa.ArrowException):
                done.append(False)
        yield outputs[[not d for d in done]]


def commit_snapshots(spark: SparkSession, outputs: Sequence[tuple[str, int]]) -> None:
    """Commit many snapshots (path, rows) after the write has ended: tasks write the markers, each a file of its own."""
    if len(outputs) > DRIVER_MARKS:
        table = spark.createDataFrame(list(outputs), "path string, rows long").repartition(spark.sparkContext.defaultParallelism)
        outputs = [(r["path"], r["rows"]) for r in table.mapInPandas(_mark, table.schema).collect()]
    for path, rows in outputs:
        commit_snapshot(spark, path, rows)


DRIVER_MARKS = 64       # so many markers are written faster than a job starts


def _output(root: str, g: dict) -> str:
    return f"{dataset_path(root, 'bronze', g['table'])}/{SNAPSHOT}={g['sid']}"


@dataclass
class IngestResult:
    status: str = "success"
    files_processed: int = 0
    total_rows: int = 0
    files: list[dict] = field(default_factory=list)


def ingest_bronze(spark: SparkSession, raw_dir: str, root: str, audit: AuditStore, *,
                  layouts: Sequence[Layout] = DEFAULT_LAYOUTS, glob: str = "*.txt",
                  encoding: str = "utf-8", multi_cell_dividers: bool = False,
                  run_ts: _dt.datetime | None = None, writers: int = 8) -> IngestResult:
    """Ingest the new files of ``raw_dir``; up to ``writers`` tables are written at once."""
    run_ts = run_ts or _dt.datetime.now()
    res = IngestResult()
    try:
        hashes = hash_files(spark, raw_dir, glob, audit)
        for r in unhashed(hashes).collect():    # AUD6: a file that cannot be read fails alone
            res.status = "partial"
            res.files.append(dict(file=os.path.basename(r["file"]), path=r["file"], status="error", error="the file could not be read"))
        todo = sorted(unseen_files(hashes, audit.seen_hashes()).select("file", "file_hash").collect())
        if not todo:
            return res
        hash_of = {r["file"]: r["file_hash"] for r in todo}
        lines = read_report_lines(spark, encoding=encoding, paths=sorted(hash_of))   # only the new files
        grid = scan_grid(lines, multi_cell_dividers)
        meta = match_layouts(file_stats(grid.rows(), grid.files), layouts).collect()

        good = []
        for seq, m in enumerate(sorted(meta, key=lambda r: r["file"])):
            name = os.path.basename(m["file"])
            if m["n_rows"] == 0:
                res.files.append(dict(file=name, path=m["file"], status="skipped_empty"))
                continue
            if m["ragged"]:
                res.status = "partial"
                res.files.append(dict(file=name, path=m["file"], status="error",
                                      error=f"{m['max_width']} cells in a row, {len(m['headers'])} headers"))
                continue
            sig = hashlib.md5(("\x1f".join([m["table_name"], m["layout"], *m["headers"]])).encode()).hexdigest()[:16]
            sid = snapshot_id(run_ts, seq, hash_of[m["file"]])
            good.append(dict(file=m["file"], name=name, sid=sid, sig=sig, table=m["table_name"],
                             layout=m["layout"], headers=list(m["headers"]), rows=int(m["n_rows"])))
        if not good:
            return res

        info = spark.createDataFrame([(g["file"], g["sid"], g["sig"]) for g in good],
                                     T.StructType([T.StructField("file", T.StringType()),
                                                   T.StructField("_sid", T.StringType()),
                                                   T.StructField("_sig", T.StringType())]))
        stage = f"{checkpoint_dir(spark).rstrip('/')}/bronze-stage-{run_ts:%Y%m%d%H%M%S%f}"
        (grid.texts(info).select("_sig", "_sid", "file", "tight", "width")
             .write.mode("errorifexists").partitionBy("_sig").parquet(stage))

        by_sig: dict[str, list[dict]] = {}
        for g in good:
            by_sig.setdefault(g["sig"], []).append(g)

        def write(group: list[dict]) -> Exception | None:
            """One job for all files of a signature, then a commit marker for each (SNK1)."""
            g0 = group[0]
            try:
                staged = spark.read.schema("_sid string, file string, tight string, width int").parquet(f"{stage}/_sig={g0['sig']}")
                staged = staged.withColumn("cells", cells(F.col("tight"), F.col("width")))
                table = to_table(staged, g0["headers"], layout_by_name(g0["layout"], layouts), keep=["_sid"])
                write_snapshots_by_column(table, root, "bronze", g0["table"], "_sid")
                commit_snapshots(spark, [(_output(root, g), g["rows"]) for g in group])
            except Exception as e:  # noqa: BLE001 -- AUD6: one failing table does not stop the others
                return e
            return None

        manifest = []
        with ThreadPoolExecutor(max_workers=max(1, writers)) as threads:
            errors = list(threads.map(write, by_sig.values()))
        for group, error in zip(by_sig.values(), errors):
            if error is not None:
                res.status = "partial"
                for g in group:
                    res.files.append(dict(file=g["name"], path=g["file"], status="error", error=f"{type(error).__name__}: {error}"))
                continue
            for g in group:
                out = _output(root, g)
                manifest.append(dict(filename=g["name"], file_hash=hash_of[g["file"]], row_count=g["rows"],
                                     output_file=out))
                res.files.append(dict(file=g["name"], path=g["file"], status="ingested", table=g["table"], rows=g["rows"],
                                      output=out))
                res.files_processed += 1
                res.total_rows += g["rows"]
        audit.append(MANIFEST, manifest)
        return res
    except Exception:
        res.status = "failed"
        raise
    finally:
        audit.log_run("bronze_ingestion", f"{root.rstrip('/')}/bronze", res.total_rows, res.files_processed,
                      res.status)
