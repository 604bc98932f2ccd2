"""Reading the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has task slots.

    Use it in front of heavy per-row work (text rendering / parsing) that runs before the first
    shuffle.  A large input already has thousands of splits and is returned unchanged (no
    shuffle).  A small file with a single row group would otherwise run all that work in one
    task; it is round-robin repartitioned to the default parallelism instead.  Joins and
    aggregates do not need it: their shuffle spreads the work anyway.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def read_table(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    df = spark.read.parquet(path)
    return ensure_parallelism(df) if spread else df
