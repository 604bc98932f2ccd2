"""Queries over snapshot resolution (SRC6-SRC8) and the audit log (AUD7, SRT3)."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import fixtures as fx
from tidemark.plans.audit import MANIFEST, RUNS, AuditStore, latest
from tidemark.plans.catalog import register
from tidemark.session import checkpoint_dir
from tidemark.sources.snapshots import pick_latest

# A snapshot listing derived from orders: one snapshot per order, named by date and key, in
# dataset = priority; urgent/high orders in status P sit in the Gold layer, the rest in Silver.
_LISTING_SQL = """SELECT o_orderpriority AS dataset,
       CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'gold' ELSE 'silver' END AS layer,
       strftime(CAST(o_orderdate AS DATE), '%Y%m%d') || '_' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS snapshot
FROM orders"""


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders")
    layer = F.when((F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
                   F.lit("gold")).otherwise(F.lit("silver"))
    snap = F.concat(F.date_format(F.to_date("o_orderdate"), "yyyyMMdd"), F.lit("_"),
                    F.lpad(F.col("o_orderkey").cast("string"), 10, "0"))
    return o.select(F.col("o_orderpriority").alias("dataset"), layer.alias("layer"), snap.alias("snapshot"))


@register("latest_snapshot", "SRC6 SRC7 SRC8", fx.with_fixtures("""
SELECT dataset, layer, snapshot FROM (
    SELECT *, row_number() OVER (PARTITION BY dataset
                                 ORDER BY CASE WHEN layer = 'gold' THEN 1 ELSE 0 END DESC, snapshot DESC) AS rn
    FROM l) WHERE rn = 1""", l=_LISTING_SQL))
def latest_snapshot_query(spark: SparkSession, sf: str) -> DataFrame:
    """Per dataset the latest snapshot, any Gold snapshot beating every Silver one."""
    return pick_latest(_listing(spark, sf), "dataset", "layer", "snapshot", ["silver", "gold"])


@register("audit_topk", "AUD7 SRT3", """
SELECT event_id AS run_id, event_type AS script_name, ts AS run_at, value AS total_rows
FROM events ORDER BY run_at DESC, run_id DESC LIMIT 10""")
def audit_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The ten newest entries of a run log (events read as one); the limit is the feature."""
    log = fx.table(spark, sf, "events").select(F.col("event_id").alias("run_id"), F.col("event_type").alias("script_name"),
                                              F.col("ts").alias("run_at"), F.col("value").alias("total_rows"))
    return latest(log, "run_at", 10, tie_break=["run_id"])


WRITERS = 4


@register("audit_log", "AUD3 AUD4 AUD7 FN14", f"""
SELECT 'file' AS step, event_type || '_' || event_id AS name, user_id AS a, user_id % {WRITERS} AS b FROM events
UNION ALL SELECT 'run', event_type || ' ' || w, count(*), count(DISTINCT user_id) FROM (SELECT *, user_id % {WRITERS} AS w FROM events) GROUP BY event_type, w
UNION ALL SELECT 'ids', 'first and last', 1, count(*) FROM (SELECT DISTINCT event_type, user_id % {WRITERS} FROM events)
UNION ALL SELECT 'ids', 'distinct', count(*), count(*) FROM (SELECT DISTINCT event_type, user_id % {WRITERS} FROM events)""")
def audit_log(spark: SparkSession, sf: str) -> DataFrame:
    """Writers that append at once: each logs its share of ``events`` as manifest rows and a run for each event type.

    One row per manifest row and run, and the range and number of distinct run ids."""
    audit = AuditStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/audit-{uuid.uuid4().hex[:12]}")
    events = fx.table(spark, sf, "events").withColumn("w", F.col("user_id") % WRITERS)
    shares = events.groupBy("w", "event_type").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users")).collect()    # a row per type and writer

    def writer(w: int) -> None:
        own = events.where(F.col("w") == w)
        audit.append_df(MANIFEST, own.select(F.concat_ws("_", "event_type", "event_id").alias("filename"), F.col("user_id").alias("row_count"),
                                             F.col("ts").alias("processed_at"), F.lit(str(w)).alias("output_file")))
        for r in shares:
            if r.w == w:
                audit.log_run(f"{r.event_type} {w}", "", r.n, r.users, "success")

    with ThreadPoolExecutor(WRITERS) as threads:
        list(threads.map(writer, range(WRITERS)))
    runs = audit.read(RUNS)
    files = audit.read(MANIFEST).select(F.lit("file").alias("step"), F.col("filename").alias("name"), F.col("row_count").alias("a"), F.col("output_file").cast("bigint").alias("b"))
    logged = runs.select(F.lit("run"), "script_name", "total_rows", "files_processed")
    ids = runs.agg(F.min("run_id").cast("bigint"), F.max("run_id").cast("bigint")).select(F.lit("ids"), F.lit("first and last"), "*")
    number = runs.agg(F.countDistinct("run_id").alias("n")).select(F.lit("ids"), F.lit("distinct"), "n", "n")
    return files.union(logged).union(ids).union(number)
