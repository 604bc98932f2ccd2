"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  AQE re-plans joins at runtime (broadcast only when the
# measured shuffle output is below the threshold, skew splitting for hot keys, partition
# coalescing); the session time zone is pinned so DATE <-> TIMESTAMP casts are stable.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    # bad text fails a strict cast instead of becoming NULL
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # also where the next join would reuse the partitioning: a shuffle more, but no task with a hot key
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # post-shuffle partitions are coalesced / split toward this size, so a cluster sets
    # spark.sql.shuffle.partitions generously (about shuffle bytes / 128 MB) and AQE trims it
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "tidemark",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    On a cluster pass ``master=None`` and let the launcher decide; locally pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS / object store) folder there and we use it as is.  Only a
    local-mode session without the setting (tests, laptops) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a cluster must name a shared folder")
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
