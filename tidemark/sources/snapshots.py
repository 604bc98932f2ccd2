"""Snapshotted datasets: ``<root>/<layer>/<dataset>/snapshot=<id>/`` (SRC4, SRC6-SRC8, SNK1-SNK4).

Every run writes a new snapshot directory; readers take the lexicographically largest id.  Ids
start with the run timestamp, so "largest" is "newest"; a per-file sequence number and a hash
prefix make two outputs of one second distinct.  A snapshot counts only with a ``_COMMITTED``
marker, which is written last: what a failed or still running write leaves is never read.  The
marker holds the number of rows, counted inside the write job (AUD5).  Listing
uses the Hadoop FileSystem API (names only), so it costs one directory listing whatever the data
size.
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions._col import as_col

SNAPSHOT = "snapshot"
COMMITTED = "_COMMITTED"    # Spark's readers ignore names that start with an underscore


class MissingDependency(LookupError):
    """No snapshot of a required dataset exists in the searched layers."""


def snapshot_id(run_ts: _dt.datetime, seq: int = 0, digest: str = "") -> str:
    """``YYYYmmdd_HHMMSS_<seq>_<hash8>``: sorts by time first."""
    sid = f"{run_ts:%Y%m%d_%H%M%S}_{seq:06d}"
    return f"{sid}_{digest[:8]}" if digest else sid


def dataset_path(root: str, layer: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{dataset.lower()}"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def marker(rows: int, **more) -> bytes:
    """What a commit marker holds."""
    return json.dumps({"rows": int(rows), **more}).encode()


def commit_snapshot(spark: SparkSession, path: str, rows: int, **more) -> None:
    """Mark a snapshot as whole and keep its number of rows (and whatever else is given); the last step of every write."""
    p, fs = _fs(spark, f"{path}/{COMMITTED}")
    out = fs.create(p, True)
    out.write(bytearray(marker(rows, **more)))
    out.close()


def snapshot_rows(spark: SparkSession, path: str) -> int:
    """Rows of a committed snapshot, from its marker; no job runs."""
    return snapshot_marker(spark, path)["rows"]


def snapshot_marker(spark: SparkSession, path: str) -> dict:
    p, fs = _fs(spark, f"{path}/{COMMITTED}")
    source = fs.open(p)
    try:
        return json.loads(bytes(source.readAllBytes()))
    finally:
        source.close()


def _is_committed(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, f"{path}/{COMMITTED}")
    return fs.exists(p)


def _written_snapshots(spark: SparkSession, root: str, layer: str, dataset: str) -> list[str]:
    """Sorted ids of all snapshot folders, committed or not (empty if none)."""
    p, fs = _fs(spark, dataset_path(root, layer, dataset))
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(SNAPSHOT + "="))


def list_snapshots(spark: SparkSession, root: str, layer: str, dataset: str) -> list[str]:
    """Sorted ids of the committed snapshots of one dataset in one layer (empty if none)."""
    base = dataset_path(root, layer, dataset)
    return [i for i in _written_snapshots(spark, root, layer, dataset) if _is_committed(spark, f"{base}/{SNAPSHOT}={i}")]


def latest_snapshot(spark: SparkSession, root: str, dataset: str,
                    layers: Sequence[str] = ("silver",)) -> str | None:
    """SRC6 / SRC7 / SRC8: path of the latest snapshot.

    Layers are searched in the given order and their listings concatenated, so a snapshot in a
    later layer beats every snapshot of an earlier one (Gold beats Silver), as in the source.
    """
    chosen = None
    for layer in layers:
        for i in reversed(_written_snapshots(spark, root, layer, dataset)):
            path = f"{dataset_path(root, layer, dataset)}/{SNAPSHOT}={i}"
            if _is_committed(spark, path):
                chosen = path
                break
    return chosen


def read_latest(spark: SparkSession, root: str, dataset: str, layers: Sequence[str] = ("silver",)) -> tuple[DataFrame, str]:
    """SRC4: the latest snapshot as a DataFrame (only that directory is scanned)."""
    path = latest_snapshot(spark, root, dataset, layers)
    if path is None:
        raise MissingDependency(f"{dataset} ({'/'.join(layers)})")
    return spark.read.parquet(path), path


def pick_latest(listing: DataFrame, dataset_col: str, layer_col: str, snapshot_col: str,
                layers: Sequence[str]) -> DataFrame:
    """SRC7 as a DataFrame operator over a listing ``(dataset, layer, snapshot, ...)``: per dataset
    the largest snapshot of the last layer (in ``layers`` order) that has one.  One grouped
    aggregate (``max_by`` on (layer rank, snapshot)), partial aggregation map-side."""
    rank = F.coalesce(*[F.when(as_col(layer_col) == F.lit(l), F.lit(i)) for i, l in enumerate(layers)])
    known = listing.where(as_col(layer_col).isin(*layers))
    best = F.max_by(F.struct(as_col(layer_col).alias("layer"), as_col(snapshot_col).alias("snapshot")),
                    F.struct(rank, as_col(snapshot_col)))
    return (known.groupBy(as_col(dataset_col).alias("dataset")).agg(best.alias("b"))
                 .select("dataset", F.col("b.layer").alias("layer"), F.col("b.snapshot").alias("snapshot")))


def write_snapshot(df: DataFrame, root: str, layer: str, dataset: str, sid: str) -> str:
    """SNK1-SNK3: write one snapshot (ZSTD Parquet).  Fails instead of overwriting an existing
    snapshot.  Task output is committed atomically by Spark's commit protocol, so lost
    executors only cause task retries.  Rows are counted by an ``Observation`` in the tasks that
    write them; a retried task of that stage counts once."""
    path = f"{dataset_path(root, layer, dataset)}/{SNAPSHOT}={sid}"
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    commit_snapshot(df.sparkSession, path, seen.get["rows"])
    return path


def write_snapshots_by_column(df: DataFrame, root: str, layer: str, dataset: str, sid_col: str) -> str:
    """Several snapshots of one dataset in one write job: ``partitionBy(snapshot)``, append.

    The caller knows the rows of each and commits it (``commit_snapshot``) after the job has ended."""
    path = dataset_path(root, layer, dataset)
    (df.withColumnRenamed(sid_col, SNAPSHOT).write.mode("append").option("compression", "zstd")
       .partitionBy(SNAPSHOT).parquet(path))
    return path


def export_report(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> str | None:
    """SNK4: write report rows with a header; zero rows -> no output (returns None).

    ``single_file`` gives one file like the source's spreadsheet; use it only for reports of a
    known small size (it funnels the rows through one task).  By default the rows are written
    in parallel, one file per partition.
    """
    if df.isEmpty():
        return None
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("errorifexists")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.option("compression", "zstd").parquet(path)
    else:
        raise ValueError(f"unknown report format {fmt!r}")
    return path
