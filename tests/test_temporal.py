import datetime as dt
import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators.temporal import DimSpec, clip_and_weigh, overlap_left_join, plan_buckets

D = dt.date


def brute_force(facts, dims_list):
    """Reference semantics in plain Python: left outer overlap join, dims in sequence."""
    out = []
    for f in facts:
        fid, key, f0, f1 = f
        combos = [()]
        for dims in dims_list:
            matches = []
            if key not in (None, "") and f0 is not None and f1 is not None:
                for (dk, d0, d1, val) in dims:
                    if dk is not None and dk.strip() == key and d0 is not None and d1 is not None \
                            and f0 <= d1 and f1 >= d0:
                        matches.append((d0, d1, val))
            if not matches:
                matches = [(None, None, None)]
            combos = [c + (m,) for c in combos for m in matches]
        for c in combos:
            out.append((fid,) + tuple(x for m in c for x in m))
    return sorted(out, key=repr)


FACT_SCHEMA = "fid int, key string, f0 date, f1 date"
DIM_SCHEMA = "k string, d0 date, d1 date, val string"


def run(spark, facts, dims_list, bucket_days="auto"):
    fact = spark.createDataFrame(facts, FACT_SCHEMA)
    specs = [DimSpec(spark.createDataFrame(dims, DIM_SCHEMA), "k", "d0", "d1", {f"v{i}": "val"},
                     from_as=f"from{i}", to_as=f"to{i}") for i, dims in enumerate(dims_list)]
    j = overlap_left_join(fact, "key", "f0", "f1", specs, bucket_days=bucket_days)
    cols = ["fid"] + [c for i in range(len(dims_list)) for c in (f"from{i}", f"to{i}", f"v{i}")]
    return sorted([tuple(r) for r in j.select(*cols).collect()], key=repr)


def test_edge_cases(spark):
    facts = [
        (1, "A", D(2024, 1, 1), D(2024, 1, 31)),   # touching by one day on both sides
        (2, "A", D(2024, 3, 1), D(2024, 3, 31)),   # gap of one day to dim rows
        (3, "B", D(2024, 1, 1), D(2024, 12, 31)),  # dim inside fact
        (4, "B", D(2024, 6, 1), D(2024, 6, 2)),    # fact inside dim
        (5, "", D(2024, 1, 1), D(2024, 1, 31)),    # blank key
        (6, None, D(2024, 1, 1), D(2024, 1, 31)),  # NULL key
        (7, "C", D(2024, 1, 1), D(2024, 1, 31)),   # NULL dim date -> no match
        (8, "E", D(2024, 1, 1), D(2024, 1, 31)),   # key with spaces on the dim
        (9, "F", D(2024, 1, 1), D(2024, 1, 31)),   # two overlapping dim rows (cost doubled)
        (10, "Z", D(2024, 1, 1), D(2024, 1, 31)),  # no match at all
        (11, "A", None, D(2024, 1, 31)),            # NULL fact date
        (12, "A", D(2024, 2, 10), D(2024, 2, 5)),   # inverted fact interval
    ]
    dims = [
        ("A", D(2023, 12, 1), D(2024, 1, 1), "a1"), ("A", D(2024, 1, 31), D(2024, 2, 28), "a2"),
        ("A", D(2024, 4, 1), D(2024, 4, 30), "a3"),
        ("B", D(2024, 5, 1), D(2024, 7, 1), "b1"),
        ("C", None, D(2024, 12, 31), "c1"),
        (" E  ", D(2024, 1, 15), D(2024, 1, 20), "e1"),
        ("F", D(2023, 1, 1), D(2024, 12, 31), "f1"), ("F", D(2024, 1, 10), D(2024, 1, 12), "f2"),
    ]
    assert run(spark, facts, [dims]) == brute_force(facts, [dims])
    dims2 = [("A", D(2024, 1, 20), D(9999, 12, 31), "open"), ("B", D(2024, 1, 1), D(2024, 1, 1), "day")]
    assert run(spark, facts, [dims, dims2]) == brute_force(facts, [dims, dims2])
    assert run(spark, facts, [dims, dims2], bucket_days=3) == brute_force(facts, [dims, dims2])


def test_long_facts_get_their_own_length_classes(spark):
    facts = [(i, "K", D(2020, 1, 1) + dt.timedelta(days=i), D(2020, 1, 5) + dt.timedelta(days=i * 40))
             for i in range(60)]
    dims = [("K", D(2019, 1, 1) + dt.timedelta(days=30 * j), D(2019, 1, 20) + dt.timedelta(days=30 * j), f"d{j}")
            for j in range(80)]
    fact = spark.createDataFrame(facts, FACT_SCHEMA)
    plan = plan_buckets(fact, "key", "f0", "f1", bucket_days=10)
    assert len(plan.classes) > 1 and plan.classes[0].short == 10
    assert all(a.short < b.short for a, b in zip(plan.classes, plan.classes[1:]))
    assert run(spark, facts, [dims], bucket_days=10) == brute_force(facts, [dims])
    assert run(spark, facts, [dims]) == brute_force(facts, [dims])


def test_empty_fact(spark):
    assert run(spark, [], [[("A", D(2024, 1, 1), D(2024, 1, 2), "x")]]) == []


dates = st.dates(min_value=D(2023, 1, 1), max_value=D(2024, 12, 31))
keys = st.sampled_from(["A", "B", " A", "", None])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(keys, st.one_of(st.none(), dates), dates), max_size=12),
       st.lists(st.tuples(keys, st.one_of(st.none(), dates), dates, st.sampled_from(["x", "y", None])), max_size=10),
       st.lists(st.tuples(keys, dates, dates, st.sampled_from(["p", "q"])), max_size=6),
       st.sampled_from(["auto", 1, 5, 40]))
def test_property_matches_brute_force(spark, facts, dims1, dims2, width):
    facts = [(i,) + f for i, f in enumerate(facts)]
    assert run(spark, facts, [dims1, dims2], bucket_days=width) == brute_force(facts, [dims1, dims2])


def test_tiling_dims_conserve_amount(spark):
    """Conservation: when one dim tiles the fact exactly once, prorated parts add up."""
    fact = spark.createDataFrame([(1, "A", D(2024, 1, 1), D(2024, 3, 31), 910.0)], "fid int, key string, f0 date, f1 date, amt double")
    dim = spark.createDataFrame([("A", D(2023, 12, 1), D(2024, 1, 15), "x"), ("A", D(2024, 1, 16), D(2024, 2, 29), "y"),
                                 ("A", D(2024, 3, 1), D(2025, 1, 1), "z")], DIM_SCHEMA)
    j = overlap_left_join(fact, "key", "f0", "f1", [DimSpec(dim, "k", "d0", "d1", {"v": "val"}, "df", "dt")])
    s = clip_and_weigh(j, "f0", "f1", ["df"], ["dt"])
    rows = s.select("seg_days", (F.col("amt") / 91 * F.col("seg_days")).alias("p")).collect()
    assert sum(r["seg_days"] for r in rows) == 91
    assert abs(sum(r["p"] for r in rows) - 910.0) < 0.01 * len(rows)


def test_hot_key_plan_has_no_cartesian_product(spark):
    rnd = random.Random(7)
    facts = [(i, "HOT", D(2020, 1, 1) + dt.timedelta(days=rnd.randrange(1500)), None) for i in range(300)]
    facts = [(i, k, f0, f0 + dt.timedelta(days=30)) for i, k, f0, _ in facts]
    dims = [("HOT", D(2020, 1, 1) + dt.timedelta(days=20 * j), D(2020, 1, 19) + dt.timedelta(days=20 * j), str(j))
            for j in range(80)]
    fact = spark.createDataFrame(facts, FACT_SCHEMA)
    dim = spark.createDataFrame(dims, DIM_SCHEMA)
    j = overlap_left_join(fact, "key", "f0", "f1", [DimSpec(dim, "k", "d0", "d1", {"v": "val"}, "df", "dt")])
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert run(spark, facts, [dims]) == brute_force(facts, [dims])


def test_conf_bytes():
    from tidemark.operators.temporal import conf_bytes
    assert conf_bytes("10485760") == 10485760 and conf_bytes("10485760b") == 10485760
    assert conf_bytes("10m") == 10 << 20 and conf_bytes("1g") == 1 << 30 and conf_bytes("-1") == -1


def test_broadcast_follows_the_measured_size(spark):
    from tidemark.operators.temporal import bucketed_dim, measure_bucketed
    facts = [(i, "K%d" % (i % 7), D(2024, 1, 1) + dt.timedelta(days=i), D(2024, 1, 20) + dt.timedelta(days=i))
             for i in range(50)]
    dims = [("K%d" % (j % 7), D(2023, 12, 1) + dt.timedelta(days=5 * j), D(2024, 1, 1) + dt.timedelta(days=5 * j), "v")
            for j in range(40)]
    fact = spark.createDataFrame(facts, FACT_SCHEMA)
    spec = DimSpec(spark.createDataFrame(dims, DIM_SCHEMA), "k", "d0", "d1", {"v": "val"}, "df", "dt")
    plan = plan_buckets(fact, "key", "f0", "f1")
    size = measure_bucketed([spec], plan)[0]
    exploded = bucketed_dim(spec, 0, plan).count()
    assert size >= exploded * 8 * 5            # at least 8 bytes per field of every exploded row
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(size))
        big = overlap_left_join(fact, "key", "f0", "f1", [spec])._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(size - 1))
        small = overlap_left_join(fact, "key", "f0", "f1", [spec])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in big
    assert "SortMergeJoin" in small and "BroadcastHashJoin" not in small
