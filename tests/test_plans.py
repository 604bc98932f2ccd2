"""Plan-shape checks: filters reach the Parquet scan, only used columns are read, no cross joins."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tidemark.operators.reconcile import area_mismatches
from tidemark.operators.temporal import analysis_window, complete_interval
from tidemark.plans import fixtures as fx
from tidemark.plans.hr_summary import hr_summary


def plan_text(df):
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def test_report_filters_are_pushed_into_the_gold_scan(spark, tmp_root):
    g = hr_summary(fx.zpost(spark, "/root/testdata/sf0.001"), fx.pa0001(spark, "/root/testdata/sf0.001"),
                   fx.pa0008(spark, "/root/testdata/sf0.001"), sort=False)
    path = os.path.join(tmp_root, "gold")
    g.write.parquet(path)
    rep = area_mismatches(spark.read.parquet(path))
    p = plan_text(rep)
    pushed = p.split("PushedFilters: ")[1].split("]")[0]
    assert "IsNotNull(`Personnel Number`)" in pushed and "In(`Post Type`" in pushed


def test_window_and_completeness_filters_and_pruning(spark, tmp_root):
    path = os.path.join(tmp_root, "z")
    fx.zpost(spark, "/root/testdata/sf0.001").write.parquet(path)
    z = complete_interval(spark.read.parquet(path), "adj_valid_from", "adj_valid_to")
    z = analysis_window(z, "adj_valid_from", "adj_valid_to", dt.date(1995, 1, 1), dt.date(1996, 12, 31))
    p = plan_text(z.select("Position", "Total"))
    assert "GreaterThanOrEqual(adj_valid_from,1995-01-01)" in p
    assert "LessThanOrEqual(adj_valid_to,1996-12-31)" in p
    read_schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "Standard Cost" not in read_schema and "Total" in read_schema


def test_gold_plan_has_no_cartesian_or_nested_loop(spark):
    sf = "/root/testdata/sf0.001"
    g = hr_summary(fx.zpost(spark, sf), fx.pa0001(spark, sf), fx.pa0008(spark, sf))
    p = plan_text(g)
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_overlap_join_leaves_unused_fact_columns_unread(spark, tmp_root):
    sf = "/root/testdata/sf0.001"
    path = os.path.join(tmp_root, "z")
    fx.zpost(spark, sf).write.parquet(path)
    g = hr_summary(spark.read.parquet(path), fx.pa0001(spark, sf), fx.pa0008(spark, sf), sort=False, broadcast_dims=False)
    p = plan_text(g.select("Adj_Start_Date", "Days in Segment", "Total"))
    read = next(s for s in p.split("ReadSchema: ")[1:] if "Personnel Number" in s).split("\n")[0]
    assert "Total:" in read and "adj_valid_to" in read
    assert not any(c in read for c in ("Standard Cost", "Post Type", "Local Service Cost1", "Personnel area"))


def test_a_plan_that_misses_facts_fails(spark):
    import pytest
    from tidemark.operators.temporal import BucketPlan, DimSpec, LengthClass, overlap_left_join
    fact = spark.sql("select 'a' k, date '2024-01-01' f, date '2024-12-31' t")
    dim = DimSpec(spark.sql("select 'a' k, date '2024-06-01' valid_from, date '2024-06-30' valid_to"), "k")
    assert overlap_left_join(fact, "k", "f", "t", [dim]).first()["dim_valid_from"] == dt.date(2024, 6, 1)
    short = BucketPlan((LengthClass(30, 120, 0, 10_000),))
    with pytest.raises(Exception, match="does not cover"):
        overlap_left_join(fact, "k", "f", "t", [dim], plan=short, broadcast=False).collect()


def test_hot_key_is_split_in_a_chain_of_two_dimensions(spark):
    """Half of the facts on one (key, bucket): the sort-merge joins of both dimensions are split, with the same rows."""
    from tidemark.operators.temporal import DimSpec, overlap_left_join
    facts = spark.range(40_000).selectExpr("id", "if(id % 2 = 0, 'hot', cast(id as string)) k", "date '2024-01-10' f", "date '2024-01-20' t", "repeat('x', 50) pad")
    rows = spark.range(3000).selectExpr("if(id < 3, 'hot', cast(id * 2 + 1 as string)) k", "date_add(date '2024-01-05', cast(id % 3 as int)) valid_from", "date '2024-01-12' valid_to")
    dims = [DimSpec(rows, "k", from_as=f"from{i}", to_as=f"to{i}") for i in range(2)]
    low = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        out = overlap_left_join(facts, "k", "f", "t", dims, broadcast=False)
        n = out.count()
        ids = out.select("id")
        ids.collect()
        assert "skew=true" in plan_text(ids)
        plain = facts.join(rows.withColumnsRenamed({"k": "k0"}), F.expr("k = k0 and valid_from <= t and valid_to >= f"), "left").groupBy("id").agg(F.count("k0").alias("m"))
        expected = plain.select(F.sum(F.greatest(F.col("m") * F.col("m"), F.lit(1)))).first()[0]
        assert n == expected
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
