import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.coverage import coverage_balance
from tidemark.operators.temporal import DimSpec, clip_and_weigh, overlap_left_join

FACT = "fid int, key string, f0 date, f1 date, rate double, other string"
DIM = "k string, d0 date, d1 date"


def day(n):
    return None if n is None else dt.date(2020, 1, 1) + dt.timedelta(days=n)


def brute(fact, dims):
    """Day by day."""
    fid, key, a, b, rate, _ = fact
    days = [] if a is None or b is None else [a + dt.timedelta(days=i) for i in range((b - a).days + 1)]
    out, factors = [], [1] * len(days)
    for rows in dims:
        own = [r for r in rows if key and r[0] is not None and r[0].strip() == key and r[1] is not None and r[2] is not None]
        n = [sum(r[1] <= d <= r[2] for r in own) for d in days]
        extra = sum(max(0, x - 1) for x in n)
        lost = sum(x == 0 for x in n) if any(n) else 0
        out += [sum(x == 0 for x in n), sum(x == 1 for x in n), sum(x > 1 for x in n), extra]
        out += [None, None] if rate is None else [round(rate * lost, 2), round(rate * extra, 2)]
        if any(n):
            factors = [f * x for f, x in zip(factors, n)]
    return (fid, len(days), *out, sum(factors), bool(days) and sum(factors) == 0)


def got(spark, facts, dims, **kw):
    specs = {f"d{i}": DimSpec(spark.createDataFrame(rows, DIM), "k", "d0", "d1") for i, rows in enumerate(dims)}
    fact = spark.createDataFrame(facts, FACT)
    out = coverage_balance(fact, "key", "f0", "f1", specs, rate="rate", **kw)
    assert out.columns[:len(fact.columns)] == fact.columns
    return sorted((tuple(r[len(fact.columns):]) for r in out.select("*").collect()), key=repr), out


def _random(rnd, n_facts, n_rows, keys, span):
    facts = []
    for i in range(n_facts):
        a = rnd.choice([rnd.randrange(span)] * 9 + [None])
        b = rnd.choice([None if a is None else a + rnd.randrange(-2, 60)] * 9 + [None])
        facts.append((i, rnd.choice(keys + ["", None, "nobody"]), day(a), day(b), rnd.choice([1.5, 10.0, None]), "x"))
    dims = []
    for _ in range(2):
        rows = []
        for _ in range(n_rows):
            a = rnd.randrange(-30, span)
            rows.append((rnd.choice(keys + [f" {keys[0]} ", None, ""]), rnd.choice([day(a)] * 15 + [None]), rnd.choice([day(a + rnd.randrange(-3, 40))] * 15 + [None])))
        dims.append(rows + rows[:3])
    return facts, dims


@pytest.mark.parametrize("bucket_days", [1, 7, 512])
def test_against_counting_days(spark, bucket_days):
    facts, dims = _random(random.Random(bucket_days), 120, 60, ["a", "b", "c"], 200)
    rows, _ = got(spark, facts, dims, bucket_days=bucket_days)
    assert rows == sorted((brute(f, dims)[1:] for f in facts), key=repr)


def test_open_ends_and_one_hot_key(spark):
    """Rows that end in 9999, thousands of equal rows, all of one key."""
    end = dt.date(9999, 12, 31)
    facts = [(i, "a", day(i % 50), day(i % 50 + 30), 2.0, "x") for i in range(300)]
    dims = [[("a", day(10), end)] * 500 + [("a", day(20), day(40))] * 3, []]
    rows, _ = got(spark, facts, dims)
    assert rows == sorted((brute(f, dims)[1:] for f in facts), key=repr)


def test_days_out_are_the_days_of_the_segments(spark):
    facts, dims = _random(random.Random(5), 150, 80, ["a", "b"], 150)
    dims = [[r for r in rows if r[1] is None or r[2] is None or r[1] <= r[2]] for rows in dims]
    facts = [f for f in facts if f[2] is not None and f[3] is not None and f[2] <= f[3]]
    _, balance = got(spark, facts, dims)
    fact = spark.createDataFrame(facts, FACT)
    specs = [DimSpec(spark.createDataFrame(rows, DIM), "k", "d0", "d1", from_as=f"a{i}", to_as=f"b{i}") for i, rows in enumerate(dims)]
    joined = overlap_left_join(fact, "key", "f0", "f1", specs)
    segments = clip_and_weigh(joined, "f0", "f1", ["a0", "a1"], ["b0", "b1"]).groupBy("fid").agg(F.sum("seg_days").alias("n"))
    days = {r.fid: r.n for r in segments.collect()}
    assert {r.fid: r.days_out for r in balance.collect()} == {f[0]: days.get(f[0], 0) for f in facts}


def test_empty_tables_and_clashing_names(spark):
    assert got(spark, [], [[("a", day(1), day(2))]])[0] == []
    assert got(spark, [(1, "a", day(1), day(3), 1.0, "x")], [[]])[0] == [(3, 3, 0, 0, 0, 0.0, 0.0, 3, False)]
    fact = spark.createDataFrame([(1, "a", day(1), day(3))], "days int, key string, f0 date, f1 date")
    with pytest.raises(ValueError):
        coverage_balance(fact, "key", "f0", "f1", {"d": DimSpec(spark.createDataFrame([], DIM), "k", "d0", "d1")})


def test_facts_meet_points_not_dimension_rows(spark):
    """Both joins of the fact are on (key, day); no join or window is on the key alone but for one row a window."""
    _, out = got(spark, [(1, "a", day(1), day(3), 1.0, "x")], [[("a", day(1), day(2))], []])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and plan.count("Join LeftOuter") == 2
