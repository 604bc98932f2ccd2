import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators.profile import blank_profile_rows, merge_states, profile_state, state_rows
from tidemark.plans.audit import MANIFEST, RUNS, AuditStore
from tidemark.plans.ingest import ingest_bronze
from tidemark.plans.jobs import GOLD_JOBS, SILVER_JOBS, Job, run_jobs, run_order, upstream
from tidemark.plans.profiles import merged_profile, update_profile
from tidemark.sources.snapshots import list_snapshots, read_latest, write_snapshot


def _job(name, needs, transform=lambda **frames: next(iter(frames.values())), layer="gold", layers=("silver", "gold")):
    return Job(name, layer, {f"d{i}": n for i, n in enumerate(needs)}, transform, source_layers=layers)


def test_order_follows_the_graph():
    jobs = [_job("d", ["b", "c"]), _job("b", ["a"]), _job("c", ["a"]), _job("a", ["raw"])]
    assert upstream(jobs) == [[1, 2], [3], [3], []]
    assert run_order(jobs) == [3, 1, 2, 0]
    assert run_order(SILVER_JOBS) == [0, 1, 2]          # Bronze is not their own layer
    assert run_order(GOLD_JOBS[::-1])[0] == len(GOLD_JOBS) - 1
    with pytest.raises(ValueError, match="cycle"):
        run_order([_job("x", ["y"]), _job("y", ["x"])])
    with pytest.raises(ValueError, match="cycle"):
        run_order([_job("x", ["X"])])


def test_a_failing_job_skips_exactly_its_descendants(spark, tmp_root):
    audit = AuditStore(spark, tmp_root + "/_audit")
    write_snapshot(spark.range(5), tmp_root, "silver", "raw", "1")
    write_snapshot(spark.range(99), tmp_root, "gold", "mid", "0")       # an older snapshot must not be read instead

    def fails(**frames):
        raise RuntimeError("broken")

    jobs = [_job("leaf", ["below", "side"]), _job("below", ["mid"]), _job("mid", ["top"], fails), _job("side", ["top"]), _job("top", ["raw"]), _job("lost", ["nowhere"]), _job("under_lost", ["lost"])]
    results = {r.job: r for r in run_jobs(spark, jobs, tmp_root, audit)}
    assert [r for r in results] == [j.output_name for j in jobs]
    assert {n: r.status for n, r in results.items()} == {"leaf": "skipped", "below": "skipped", "mid": "failed", "side": "success", "top": "success", "lost": "missing_dependency", "under_lost": "skipped"}
    assert "mid failed" in results["below"].error and "below skipped" in results["leaf"].error
    assert not list_snapshots(spark, tmp_root, "gold", "below") and list_snapshots(spark, tmp_root, "gold", "mid") == ["0"]
    runs = audit.read(RUNS).collect()
    assert {r.script_name.removeprefix("gold_"): r.status for r in runs} == {"leaf": "skipped", "below": "skipped", "mid": "failed", "side": "success", "top": "success", "under_lost": "skipped"}
    assert sorted(r.run_id for r in runs) == list(range(1, 7))


def test_independent_jobs_run_at_once_and_dependent_ones_do_not(spark, tmp_root):
    audit = AuditStore(spark, tmp_root + "/_audit")
    write_snapshot(spark.range(5), tmp_root, "silver", "raw", "1")
    both, seen = threading.Barrier(2, timeout=60), []

    def meet(**frames):
        both.wait()                     # passes only if the other one runs now
        return next(iter(frames.values()))

    def last(**frames):
        seen.append([len(list_snapshots(spark, tmp_root, "gold", n)) for n in ("a", "b")])
        return next(iter(frames.values()))

    results = run_jobs(spark, [_job("z", ["a", "b"], last), _job("a", ["raw"], meet), _job("b", ["raw"], meet)], tmp_root, audit, concurrent=2)
    assert [r.status for r in results] == ["success"] * 3 and seen == [[1, 1]]
    one = run_jobs(spark, [_job("c", ["raw"]), _job("d", ["raw"])], tmp_root, audit, concurrent=1)
    assert [r.status for r in one] == ["success"] * 2


def test_many_signatures_one_bad(spark, tmp_root):
    """Every file its own table; a table that cannot be written fails alone, the others are committed."""
    raw, lake = tmp_root + "/raw", tmp_root + "/lake"
    os.makedirs(raw)
    for k in range(40):
        with open(f"{raw}/t{k:02}.txt", "w") as fh:
            fh.write(f"title {k}\n| a{k} | b |\n" + "".join(f"| {i} | x |\n" for i in range(k + 1)))
    os.makedirs(lake + "/bronze")
    with open(lake + "/bronze/t07", "w") as fh:
        fh.write("a file where the table's folder should be")
    audit = AuditStore(spark, lake + "/_audit")
    began = time.time()
    result = ingest_bronze(spark, raw, lake, audit)
    assert result.status == "partial" and result.files_processed == 39 and time.time() - began < 300
    assert [f["file"] for f in result.files if f["status"] == "error"] == ["t07.txt"]
    assert sorted(r.row_count for r in audit.read(MANIFEST).collect()) == [k + 1 for k in range(40) if k != 7]
    for k in (0, 39):
        df, _ = read_latest(spark, lake, f"t{k:02}", ("bronze",))
        assert df.columns == [f"a{k}", "b"] and df.count() == k + 1


def test_states_merge_to_the_profile_of_all_rows(spark):
    df = spark.createDataFrame([(k, [None, "", "  ", "ab", f"v{k}"][k % 5], float(k % 7)) for k in range(200)], "k int, `s p` string, f double")
    parts = [df.where(F.col("k") % 3 == i) for i in range(3)] + [df.limit(0)]
    states = None
    for i, p in enumerate(parts):
        s = profile_state(p).withColumn("part", F.lit(str(i)))
        states = s if states is None else states.unionByName(s)
    merged = merge_states(states)
    assert sorted(map(tuple, state_rows(merged).collect())) == sorted(map(tuple, blank_profile_rows(df).collect()))
    got = {r.metric: r for r in merged.select("*", F.hll_sketch_estimate("distinct").alias("n")).collect()}
    assert (got["s p"].shortest, got["s p"].longest, got["s p"].n) == (2, 4, 41) and got["k"].n == 200 and got["f"].n == 7
    assert [got[c].position for c in df.columns] == [0, 1, 2]


def test_new_snapshots_only_are_read(spark, tmp_root):
    for k in range(2):
        write_snapshot(spark.createDataFrame([(i, "x" if i % 2 else "") for i in range(10 * (k + 1))], "a int, b string"), tmp_root, "silver", "t", f"{k}")
    assert update_profile(spark, tmp_root, "silver", "t") == ["0", "1"] and update_profile(spark, tmp_root, "silver", "t") == []
    write_snapshot(spark.createDataFrame([(1, "x", None)], "a int, b string, c string"), tmp_root, "silver", "t", "2")
    assert update_profile(spark, tmp_root, "silver", "t") == ["2"]
    got = {r.metric: (r.n_rows, r.blanks) for r in merged_profile(spark, tmp_root, "silver", "t").collect()}
    assert got == {"a": (31, 0), "b": (31, 15), "c": (31, 31)}      # c is missing in 30 rows and NULL in one
    assert merged_profile(spark, tmp_root, "silver", "nothing").collect() == []
