import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.colocated import colocated_left_join
from tidemark.operators.temporal import DimSpec, overlap_left_join
from tidemark.sources.buckets import read_bucketed, write_bucketed
from tidemark.sources.snapshots import snapshot_rows, write_snapshot
from test_temporal import D, DIM_SCHEMA, FACT_SCHEMA
import datetime as dt


def _inputs(spark, root, n=400, hot=0):
    rnd = random.Random(n + hot)
    day = lambda x: D(2020, 1, 1) + dt.timedelta(days=x)
    facts = [(i, rnd.choice(["a", "b", "c", "", None, " d"]) if i >= hot else "hot", *(lambda s: (day(s), day(s + rnd.randrange(60))))(rnd.randrange(300))) for i in range(n)]
    facts += [(n, "a", None, day(3)), (n + 1, "a", day(1), day(2)), (n + 1, "a", day(1), day(2))]
    dims = [[(rnd.choice(["a", "b", "c", "hot", "x", "", None, " d"]), *(lambda s: (day(s), rnd.choice([day(s + 50)] * 5 + [None])))(rnd.randrange(300)), f"v{i}") for i in range(60)] for _ in range(2)]
    fact = spark.createDataFrame(facts, FACT_SCHEMA)
    frames = [spark.createDataFrame(d, DIM_SCHEMA) for d in dims]
    spec = lambda df, i: DimSpec(df, "k", "d0", "d1", {f"v{i}": "val"}, from_as=f"from{i}", to_as=f"to{i}", trim_key=False)
    stored = [read_bucketed(spark, write_bucketed(df, root, "silver", name, "1", key, 5)) for name, df, key in (("f", fact, "key"), ("d0", frames[0], "k"), ("d1", frames[1], "k"))]
    plain = overlap_left_join(fact, "key", "f0", "f1", [spec(d, i) for i, d in enumerate(frames)])
    return stored[0], [spec(d, i) for i, d in enumerate(stored[1:])], plain


def _bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("hot", [0, 200])
def test_same_rows_as_the_shuffled_join(spark, tmp_root, hot):
    fact, dims, plain = _inputs(spark, tmp_root, hot=hot)
    for hot_rows in (0, 90, 10 ** 6):
        got = colocated_left_join(fact, "key", "f0", "f1", dims, hot_rows=hot_rows)
        assert got.columns == plain.columns and _bag(got) == _bag(plain), hot_rows


def test_no_exchange_without_hot_keys(spark, tmp_root):
    fact, dims, _ = _inputs(spark, tmp_root)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    cold = plan(colocated_left_join(fact, "key", "f0", "f1", dims, hot_rows=10 ** 6))
    assert "Exchange" not in cold and cold.count("SortMergeJoin") == 2 and "Bucketed: true" in cold
    assert "Exchange" in plan(colocated_left_join(fact, "key", "f0", "f1", dims, hot_rows=50))


def test_snapshots_keep_their_layout_and_rows(spark, tmp_root):
    df = spark.createDataFrame([(k, f"k{k % 7}", f"é{k}") for k in range(100)], "`a b` int, `k.k` string, c string")
    path = write_bucketed(df, tmp_root, "silver", "odd names", "1", "k.k", 3)
    assert snapshot_rows(spark, path) == 100 and _bag(read_bucketed(spark, path)) == _bag(df)
    assert spark.read.parquet(path).count() == 100
    with pytest.raises(Exception, match="(?i)exist"):
        write_bucketed(df, tmp_root, "silver", "odd names", "1", "k.k", 3)
    other = write_snapshot(df, tmp_root, "silver", "plain", "1")
    assert _bag(read_bucketed(spark, other)) == _bag(df)
    empty = write_bucketed(df.limit(0), tmp_root, "silver", "none", "1", "c", 2)
    assert snapshot_rows(spark, empty) == 0 and read_bucketed(spark, empty).collect() == []
