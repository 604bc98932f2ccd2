"""Bucketed snapshots: rows laid out by a key, so that later joins on it need no shuffle (JN1, JN2, SNK2).

A snapshot is written with Spark's own bucketing.  Its commit marker keeps the key, the number of
buckets and the schema beside the number of rows, so a reader, in whatever session, gets the layout
back from the folder alone.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions._col import quote
from tidemark.sources.snapshots import SNAPSHOT, commit_snapshot, dataset_path, snapshot_marker


def write_bucketed(df: DataFrame, root: str, layer: str, dataset: str, sid: str, key: str, buckets: int) -> str:
    """Write one snapshot in ``buckets`` buckets of ``key``, sorted by it within a file; fails if the snapshot exists.

    All rows of a key share a bucket.  A key with a large share of the rows should be joined on the
    way for hot keys (``colocated_left_join`` does so); storing it is one task of plain writing.
    """
    path = f"{dataset_path(root, layer, dataset)}/{SNAPSHOT}={sid}"
    spark = df.sparkSession
    name = f"tidemark_{uuid.uuid4().hex}"
    seen = Observation()
    spread = df.repartition(buckets, F.col(quote(key))).observe(seen, F.count(F.lit(1)).alias("rows"))  # a file a bucket
    spread.write.mode("errorifexists").format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")             # an external table: its files stay
    commit_snapshot(spark, path, seen.get["rows"], buckets={"key": key, "n": buckets, "schema": df.schema.json()})
    return path


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A committed bucketed snapshot with its layout; one without buckets is read as it is."""
    marker = snapshot_marker(spark, path)
    if "buckets" not in marker:
        return spark.read.parquet(path)
    held = marker["buckets"]
    name = "tidemark_" + hashlib.md5(path.encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        schema = T.StructType.fromJson(json.loads(held["schema"]))
        columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        key = quote(held["key"])
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {held['n']} BUCKETS LOCATION '{path}'")
    return spark.table(name)
