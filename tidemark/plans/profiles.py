"""Incremental profiles: a state per snapshot, kept in a log, merged on demand (AGG2, AGG3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.profile import merge_states, profile_state
from tidemark.sources.commitlog import CommitLog
from tidemark.sources.snapshots import SNAPSHOT, dataset_path, list_snapshots

SCHEMA = T.StructType([
    T.StructField("part", T.StringType()),          # the snapshot
    T.StructField("position", T.IntegerType()),
    T.StructField("metric", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("blanks", T.LongType()),
    T.StructField("shortest", T.IntegerType()),
    T.StructField("longest", T.IntegerType()),
    T.StructField("distinct", T.BinaryType()),
])


def _log(spark: SparkSession, root: str, layer: str, dataset: str) -> CommitLog:
    return CommitLog(spark, f"{root.rstrip('/')}/_profiles/{layer}/{dataset.lower()}", SCHEMA)


def update_profile(spark: SparkSession, root: str, layer: str, dataset: str) -> list[str]:
    """Profile the committed snapshots that have no state yet and return their ids; others are not read.

    Two runs at once may both profile a new snapshot; ``merged_profile`` counts it once.
    """
    log = _log(spark, root, layer, dataset)
    known = {r.part for r in log.read().select("part").distinct().collect()}    # one name a snapshot
    new = [i for i in list_snapshots(spark, root, layer, dataset) if i not in known]
    for i in new:
        df = spark.read.parquet(f"{dataset_path(root, layer, dataset)}/{SNAPSHOT}={i}")
        log.append_df(profile_state(df).withColumn("part", F.lit(i)))
    return new


def merged_profile(spark: SparkSession, root: str, layer: str, dataset: str) -> DataFrame:
    """The profile of all profiled snapshots together, from their states alone."""
    states = _log(spark, root, layer, dataset).read()
    return merge_states(states.dropDuplicates(["part", "metric"]))
