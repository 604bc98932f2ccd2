"""Results do not depend on the number of shuffle partitions; ordering is NULLS LAST."""

from tidemark.operators.temporal import sort_nulls_last
from tidemark.plans import fixtures as fx
from tidemark.plans.hr_summary import hr_summary

SF = "/root/testdata/sf0.001"


def _bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_same_result_with_1_and_200_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    out = {}
    try:
        for n in ("1", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            g = hr_summary(fx.zpost(spark, SF), fx.pa0001(spark, SF), fx.pa0008(spark, SF), broadcast_dims=False)
            out[n] = _bag(g)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out["1"] == out["200"] and len(out["1"]) > 0


def test_sort_is_nulls_last(spark):
    df = spark.createDataFrame([(None, 1), ("b", 2), ("a", 3), (None, 0)], "k string, v int")
    got = [tuple(r) for r in sort_nulls_last(df, ["k", "v"]).collect()]
    assert got == [("a", 3), ("b", 2), (None, 0), (None, 1)]
