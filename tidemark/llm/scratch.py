"""Tables and files staged in the shared folder, so that lineage is cut without local checkpoints.

Everything goes below the folder that ``spark.checkpoint.dir`` names (see ``tidemark.session``):
executors can be lost at any time and every later read still finds whole Parquet tables there.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import os
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

import tidemark
from tidemark.session import checkpoint_dir


def folder(spark: SparkSession, name: str) -> str:
    """A new path (not yet created) in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


#: Lists that note the paths of tables as they are staged.
_RECORDS: list[list[str]] = []


@contextlib.contextmanager
def recorded(paths: list[str]):
    """Within the block the paths of staged tables are added to the list."""
    _RECORDS.append(paths)
    try:
        yield
    finally:
        _RECORDS.pop()


def drop_paths(spark: SparkSession, paths: list[str], read: DataFrame) -> None:
    """Delete staged tables by path, but for those that ``read`` still reads, and empty the list."""
    held = {os.path.dirname(f) for f in read.inputFiles()} if paths else set()
    for path in paths:
        if not any(h.endswith(os.path.basename(path)) for h in held):
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    paths.clear()


#: Bytes of a row group of tables with large rows; a writer holds one, a reader's batch lies within one.
GROUP_BYTES = 8 << 20


def stage(df: DataFrame, name: str, large_rows: bool = False) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    With ``large_rows`` the writer looks at its size after every row and closes row groups of
    ``GROUP_BYTES``; by default it looks after 100 rows first, whatever they weigh.
    """
    path = folder(df.sparkSession, name)
    write = df.write
    if large_rows:
        write = write.option("parquet.block.size", GROUP_BYTES).option("parquet.page.size.row.check.min", 1)
    write.parquet(path)
    if _RECORDS:
        _RECORDS[-1].append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


#: Ids (8 bytes each) up to which a table of them is broadcast.
BROADCAST_IDS = 1_000_000


def small(ids: DataFrame) -> DataFrame:
    """A staged table of ids, marked for broadcast if it has at most ``BROADCAST_IDS`` rows; else Spark joins it by a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def drop(*tables: DataFrame) -> None:
    """Delete staged tables that no later plan reads."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._staged_at)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return memory that this process no longer uses to the machine, as far as its allocators can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run):
    """A function of Arrow batches whose worker gives memory back at the end of each task."""
    @functools.wraps(run)
    def batches(held):
        try:
            yield from run(held)
        finally:
            give_back()

    return batches


def tidy_group(run):
    """A function of a group whose worker gives memory back after every ``GROUPS`` of them."""
    @functools.wraps(run)
    def group(key, rows):
        out = run(key, rows)
        _GROUPS[0] += 1
        if _GROUPS[0] % GROUPS == 0:
            give_back()
        return out

    return group


GROUPS = 500
_GROUPS = [0]

#: Bytes of an Arrow batch: whole texts go to Python, and a task holds several copies of a batch.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per context, as ``--py-files`` would, and bound the batches of texts.

    The bound is a default: a session that has set its own keeps it.
    """
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark._jsparkSession.sessionState().conf().contains(bound):
        spark.conf.set(bound, str(BATCH_BYTES))
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(tidemark.__file__)))
    sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark"), "zip", root, "tidemark"))
    sc._tidemark_shipped = True
