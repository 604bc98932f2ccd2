"""Audit trail: content hashes, manifest of processed files, run log, transform log (AUD1-AUD7).

The audit tables are append-only logs (``sources.commitlog``) under one folder with fixed schemas.
Appends are small (one row per run / job / file) and written *after* the data they describe
(a crash in between leaves an unreferenced snapshot that the next run simply repeats under a
new id).  Several runs may append at once: a run's id is the number of its log entry.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions._col import as_col
from tidemark.sources.commitlog import CommitLog

MANIFEST = "processed_files"
RUNS = "pipeline_runs"
TRANSFORMS = "transform_log"
FILE_INDEX = "file_index"       # (path, size, modified) -> hash, so unchanged files are not re-read

SCHEMAS = {
    MANIFEST: T.StructType([
        T.StructField("filename", T.StringType()),
        T.StructField("file_hash", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("output_file", T.StringType()),
    ]),
    RUNS: T.StructType([
        T.StructField("run_id", T.IntegerType()),
        T.StructField("script_name", T.StringType()),
        T.StructField("output_dir", T.StringType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("files_processed", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("run_at", T.TimestampType()),
    ]),
    FILE_INDEX: T.StructType([
        T.StructField("file", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("modified", T.TimestampType()),
        T.StructField("file_hash", T.StringType()),
    ]),
    TRANSFORMS: T.StructType([
        T.StructField("table_name", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("output_file", T.StringType()),
        T.StructField("input_row_count", T.LongType()),
        T.StructField("output_row_count", T.LongType()),
        T.StructField("rows_filtered", T.LongType()),
        T.StructField("processed_at", T.TimestampType()),
    ]),
}


# ---------------------------------------------------------------------------------------
# AUD1 / AUD2: content hashes and dedup

def list_files(spark: SparkSession, raw_dir: str, glob: str = "*.txt") -> DataFrame:
    """``(file, size, modified)`` of each ``glob`` file directly in ``raw_dir``, without file contents."""
    return (spark.read.format("binaryFile").load(raw_dir.rstrip("/") + "/" + glob)
                 .select(F.col("path").alias("file"), F.col("length").alias("size"),
                         F.col("modificationTime").alias("modified")))


def file_hashes(spark: SparkSession, raw_dir: str, glob: str = "*.txt",
                known: DataFrame | None = None, listing: DataFrame | None = None) -> DataFrame:
    """AUD1: MD5 of all bytes of each ``glob`` file directly in ``raw_dir``
    -> ``(file, file_hash, size, modified)``.

    The listing (path, length, modification time) is read without file contents.  Files found
    in ``known`` with the same size and time keep their recorded hash; only the others are read,
    so a run reads the bytes of new or changed files only.  Each is streamed by one task in
    pieces of ``PIECE`` bytes, so its size does not matter; the files are spread over all tasks.
    A caller that has listed the files (``list_files``) passes the listing.
    A file that cannot be opened or read has a NULL hash.
    """
    if listing is None:
        listing = list_files(spark, raw_dir, glob)
    keys = ["file", "size", "modified"]
    if known is not None:
        seen = listing.join(known.select(*keys, "file_hash"), keys)
        todo = listing.join(known.select(*keys), keys, "left_anti")
    else:
        seen, todo = None, listing
    # a row is a whole file of work: give every task slot its share
    spread = todo.repartition(spark.sparkContext.defaultParallelism)
    fresh = spread.mapInPandas(_hash_pieces, "file string, file_hash string, size long, modified timestamp")
    return fresh if seen is None else seen.select(*fresh.columns).unionByName(fresh)


PIECE = 1 << 20


def _hash_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """MD5 of files, read in pieces; a file system that Arrow cannot reach counts as unreadable."""
    for files in batches:
        hashes = []
        for path in files["file"]:
            digest = hashlib.md5()
            try:
                system, local = filesystem(path)
                with system.open_input_stream(local) as source:
                    while piece := source.read(PIECE):
                        digest.update(piece)
                hashes.append(digest.hexdigest())
            except (OSError, pa.ArrowException):
                hashes.append(None)
        yield files.assign(file_hash=hashes)[["file", "file_hash", "size", "modified"]]


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a Hadoop path and the path in it; characters stay as they are."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return pafs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    host, _, inside = rest.lstrip("/").partition("/")
    system, base = pafs.FileSystem.from_uri(f"{scheme}://{host}/")
    return system, f"{base.rstrip('/')}/{inside}" if base.strip("/") else ("/" + inside if scheme == "hdfs" else inside)


def unhashed(hashes: DataFrame) -> DataFrame:
    """AUD6: files without a hash, that is those that could not be read."""
    return hashes.where(F.col("file_hash").isNull())


def content_hash_dedup(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """First row (lowest id) per MD5 of the whole text, with the number of copies.

    A grouped aggregate, so a content repeated in a third of all rows is still combined
    map-side (partial aggregation) and never gathered into one task.
    """
    return (df.groupBy(F.md5(as_col(text_col)).alias("content_hash"))
              .agg(F.min(as_col(id_col)).alias(id_col), F.count(F.lit(1)).alias("copies")))


def unseen_files(hashes: DataFrame, manifest: DataFrame) -> DataFrame:
    """AUD2: files whose content was never processed; of identical files in one run only the
    first by path is kept.  Anti-join on the hash, then one row per hash."""
    known = manifest.select("file_hash").distinct()
    fresh = hashes.where(F.col("file_hash").isNotNull()).join(known, "file_hash", "left_anti")
    return (fresh.groupBy("file_hash")
                 .agg(F.min_by(F.struct("file", "size"), F.col("file")).alias("f"))
                 .select(F.col("f.file").alias("file"), "file_hash", F.col("f.size").alias("size")))


def remember_hashes(store: "AuditStore", hashes: DataFrame) -> None:
    """Record (file, size, modified) -> hash for files not yet in the index."""
    known = store.read(FILE_INDEX).select("file", "size", "modified")
    new = hashes.join(known, ["file", "size", "modified"], "left_anti")
    store.append_df(FILE_INDEX, new)


# ---------------------------------------------------------------------------------------
# AUD3-AUD5: the audit store

class AuditStore:
    """Append-only audit tables under ``root`` (a shared folder on a cluster), a commit log each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, self.path(name), SCHEMAS[name])

    def read(self, name: str) -> DataFrame:
        return self._log(name).read()

    def append(self, name: str, rows: Iterable[dict]) -> None:
        stamped = [self._stamped(name, r) for r in rows]
        if stamped:
            self._log(name).append(stamped)

    @staticmethod
    def _stamped(name: str, row: dict) -> dict:
        """The row with the current time where a time is missing (current_timestamp default)."""
        now = _dt.datetime.now()
        times = [f.name for f in SCHEMAS[name].fields if isinstance(f.dataType, T.TimestampType)]
        return {f.name: row.get(f.name) for f in SCHEMAS[name].fields} | {t: row.get(t) or now for t in times}

    def append_df(self, name: str, df: DataFrame) -> None:
        cols = []
        for f in SCHEMAS[name].fields:
            if f.name in df.columns:
                cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
            elif isinstance(f.dataType, T.TimestampType):
                cols.append(F.current_timestamp().alias(f.name))
            else:
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        self._log(name).append_df(df.select(*cols))

    # AUD4
    def log_run(self, script_name: str, output_dir: str, total_rows: int, files_processed: int,
                status: str) -> int:
        """Run log row; ``run_id`` is the number of its entry: from 1, without gaps, also with several writers."""
        row = self._stamped(RUNS, dict(script_name=script_name, output_dir=output_dir, total_rows=int(total_rows),
                                       files_processed=int(files_processed), status=status))
        return self._log(RUNS).append(lambda n: [row | {"run_id": n}])

    # AUD5
    def log_transform(self, table_name: str, layer: str, source_files: list[str], output_file: str,
                      input_row_count: int, output_row_count: int) -> None:
        """``rows_filtered = in - out`` (negative when a join fans out); sources joined by `` + ``."""
        self.append(TRANSFORMS, [dict(
            table_name=table_name, layer=layer,
            source_file=" + ".join(os.path.basename(p.rstrip("/")) for p in source_files),
            output_file=output_file, input_row_count=int(input_row_count),
            output_row_count=int(output_row_count), rows_filtered=int(input_row_count - output_row_count))])

    # AUD2 lookup
    def seen_hashes(self) -> DataFrame:
        return self.read(MANIFEST).select("file_hash")


def latest(df: DataFrame, ts_col: str, n: int = 10, tie_break: Iterable[str] = ()) -> DataFrame:
    """AUD7 / SRT3: the ``n`` newest rows (``ORDER BY ts DESC LIMIT n``), ties broken by
    ``tie_break`` (descending) so the result is deterministic.  Planned as TakeOrderedAndProject:
    each task keeps its own top n, only those reach the final merge."""
    order = [F.col(ts_col).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]]
    return df.orderBy(*order).limit(n)
