import os
import shutil

from pyspark.sql import functions as F

from tidemark.operators import clean as C
from tidemark.operators.reconcile import area_mismatches, group_mismatches
from tidemark.plans import fixtures as fx
from tidemark.plans.audit import MANIFEST, RUNS, TRANSFORMS, AuditStore, latest
from tidemark.plans.hr_summary import hr_summary
from tidemark.plans.ingest import ingest_bronze
from tidemark.plans.jobs import GOLD_JOBS, SILVER_JOBS, run_jobs
from tidemark.sources.snapshots import export_report, list_snapshots, read_latest

SF = "/root/testdata/sf0.001"

# A template as a user would write it: the dates parsed leniently, blanks and zero dates to NULL.
TEMPLATE = """
WITH typed AS (
  SELECT *, CAST(try_to_timestamp(nullif(replace(trim(`Start Date`), '00.00.0000', ''), ''), 'd.M.y') AS DATE) AS a,
         CAST(try_to_timestamp(nullif(replace(trim(`End Date`), '00.00.0000', ''), ''), 'd.M.y') AS DATE) AS b
  FROM {source_file} {filters})
SELECT a AS valid_from, b AS valid_to, * EXCEPT (`Start Date`, `End Date`, a, b) FROM typed"""


def write_report(path, title, df, per_page=40):
    headers = df.columns
    rows = [["" if v is None else str(v) for v in r] for r in df.collect()]
    out = [title]
    for i, r in enumerate(rows):
        if i % per_page == 0:
            out += [f"Page {i // per_page + 1}", "|" + "-" * 40 + "|",
                    "| " + " | ".join(headers) + " |", "|" + "-" * 40 + "|"]
        out.append("| " + " | ".join(r) + " |")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(out) + "\n")


def test_raw_to_report(spark, tmp_root):
    raw = os.path.join(tmp_root, "raw")
    root = os.path.join(tmp_root, "lake")
    os.makedirs(raw)
    pa1 = fx.pa0001_bronze(spark, SF)
    pa8 = fx.pa0008_bronze(spark, SF)
    zp = fx.zpost_bronze(spark, SF).withColumn("Position Pay Scale Group", F.lit("P"))
    write_report(os.path.join(raw, "pa0001_export.txt"), "Table To Be Searched   PA0001", pa1)
    write_report(os.path.join(raw, "pa0008_export.txt"), "Table To Be Searched   PA0008", pa8)
    write_report(os.path.join(raw, "zpost_2024.txt"), "Table To Be Searched   ZPOST", zp)
    with open(os.path.join(raw, "cover.txt"), "w") as fh:
        fh.write("cover page without a grid\n| only | header |\n")
    audit = AuditStore(spark, os.path.join(root, "_audit"))

    r1 = ingest_bronze(spark, raw, root, audit)
    assert r1.status == "success" and r1.files_processed == 3
    assert {f["file"]: f["status"] for f in r1.files}["cover.txt"] == "skipped_empty"
    assert audit.read(MANIFEST).count() == 3
    b = spark.read.parquet(os.path.join(root, "bronze", "pa0001"))
    assert b.count() == pa1.count()

    # same content under another name, a ragged file, and a re-run: nothing new but the error
    shutil.copy(os.path.join(raw, "pa0008_export.txt"), os.path.join(raw, "pa0008_copy.txt"))
    with open(os.path.join(raw, "broken.txt"), "w") as fh:
        fh.write("t\n| a | b |\n| 1 | 2 | 3 |\n")
    r2 = ingest_bronze(spark, raw, root, audit)
    assert r2.files_processed == 0 and r2.status == "partial"
    assert audit.read(MANIFEST).count() == 3
    runs = audit.read(RUNS).orderBy("run_id").collect()
    assert [r["run_id"] for r in runs] == [1, 2] and runs[1]["status"] == "partial"

    silver = run_jobs(spark, SILVER_JOBS, root, audit)
    assert [s.status for s in silver] == ["success"] * 3
    bal = {r["table_name"]: r for r in audit.read(TRANSFORMS).collect()}
    expected_out = C.clean(pa1, C.PA0001, where=C.org_assignment_filter).count()
    assert bal["pa0001"]["output_row_count"] == expected_out
    assert bal["pa0001"]["input_row_count"] - expected_out == bal["pa0001"]["rows_filtered"]

    gold = run_jobs(spark, GOLD_JOBS, root, audit)
    assert [g.status for g in gold] == ["success"] * 3
    g, _ = read_latest(spark, root, "hr_summary", ("silver", "gold"))
    direct = hr_summary(C.clean(zp, C.ZPOST), C.clean(pa1, C.PA0001, where=C.org_assignment_filter),
                        C.clean(pa8, C.PA0008))
    assert g.count() == direct.count() > 0
    assert g.exceptAll(direct).count() == 0
    # the Gold-on-Gold jobs read the Gold table
    assert list_snapshots(spark, root, "gold", "monthly_cost_summary")
    by_month, _ = read_latest(spark, root, "calendar_cost_summary", ("gold",))
    assert by_month.agg(F.sum("days")).first()[0] == g.agg(F.sum("Days in Segment")).first()[0]

    # reports: zero rows -> no file; otherwise a file with header
    out = export_report(area_mismatches(g), os.path.join(tmp_root, "reports", "pa"))
    none = export_report(group_mismatches(g).where(F.lit(False)), os.path.join(tmp_root, "reports", "none"))
    assert none is None and not os.path.exists(os.path.join(tmp_root, "reports", "none"))
    if out is not None:
        assert spark.read.option("header", True).csv(out).count() == area_mismatches(g).count()

    top = latest(audit.read(RUNS), "run_at", 2, tie_break=["run_id"]).collect()
    assert len(top) == 2 and top[0]["run_at"] == max(r["run_at"] for r in audit.read(RUNS).collect())


def test_missing_dependency_and_failing_job(spark, tmp_root):
    from tidemark.plans.jobs import Job
    audit = AuditStore(spark, os.path.join(tmp_root, "_audit"))
    res = run_jobs(spark, SILVER_JOBS[:1], tmp_root, audit)
    assert res[0].status == "missing_dependency"
    assert audit.read(RUNS).count() == 0               # no log row without dependencies
    # one failing job among others
    b = spark.range(5).selectExpr("CAST(id AS STRING) AS x")
    from tidemark.sources.snapshots import write_snapshot
    write_snapshot(b, tmp_root, "bronze", "t", "20240101_000000_000000")
    jobs = [Job("bad", "silver", {"s": "t"}, lambda s: s.select(F.col("missing"))),
            Job("good", "silver", {"s": "t"}, lambda s: s)]
    res = run_jobs(spark, jobs, tmp_root, audit)
    assert [r.status for r in res] == ["failed", "success"]
    assert sorted(r["status"] for r in audit.read(RUNS).collect()) == ["failed", "success"]


def test_sql_template_job_equals_dataframe_job(spark, tmp_root):
    from tidemark.plans.jobs import Job, run_job
    from tidemark.sources.snapshots import write_snapshot
    audit = AuditStore(spark, os.path.join(tmp_root, "_audit"))
    write_snapshot(fx.pa0008_bronze(spark, SF), tmp_root, "bronze", "pa0008", "20240101_000000_000000")
    a = run_job(spark, Job("sql_pa0008", "silver", {"source_file": "pa0008"}, sql=TEMPLATE), tmp_root, audit)
    b = run_job(spark, SILVER_JOBS[1], tmp_root, audit)
    x, y = spark.read.parquet(a.output), spark.read.parquet(b.output)
    assert x.columns == y.columns and x.count() == y.count() > 0
    assert x.exceptAll(y).count() == 0


def test_latest_snapshot_gold_beats_silver(spark, tmp_root):
    from tidemark.sources.snapshots import latest_snapshot, pick_latest, write_snapshot
    df = spark.range(1)
    write_snapshot(df, tmp_root, "silver", "x", "20250101_000000_000000")
    write_snapshot(df, tmp_root, "gold", "x", "20240101_000000_000000")
    write_snapshot(df, tmp_root, "silver", "y", "20240101_000000_000000")
    write_snapshot(df, tmp_root, "silver", "y", "20240102_000000_000000")
    assert latest_snapshot(spark, tmp_root, "x", ("silver", "gold")).endswith("gold/x/snapshot=20240101_000000_000000")
    assert latest_snapshot(spark, tmp_root, "y", ("silver", "gold")).endswith("silver/y/snapshot=20240102_000000_000000")
    assert latest_snapshot(spark, tmp_root, "z", ("silver", "gold")) is None
    listing = spark.createDataFrame([("x", "silver", "2"), ("x", "gold", "1"), ("y", "silver", "1"), ("y", "silver", "3")],
                                    "d string, l string, s string")
    got = {r["dataset"]: (r["layer"], r["snapshot"]) for r in pick_latest(listing, "d", "l", "s", ["silver", "gold"]).collect()}
    assert got == {"x": ("gold", "1"), "y": ("silver", "3")}


def test_sql_file_template_and_missing_template(spark, tmp_root):
    from tidemark.plans.jobs import Job, run_job
    from tidemark.sources.snapshots import write_snapshot
    audit = AuditStore(spark, os.path.join(tmp_root, "_audit"))
    write_snapshot(fx.pa0008_bronze(spark, SF), tmp_root, "bronze", "pa0008", "20240101_000000_000000")
    path = os.path.join(tmp_root, "pa0008.sql")
    with open(path, "w") as fh:
        fh.write(TEMPLATE + ";\n")
    ok = run_job(spark, Job("from_file", "silver", {"source_file": "pa0008"}, sql_file=path,
                            filters="`PS group` = '1'"), tmp_root, audit)
    assert ok.status == "success" and 0 < ok.output_rows < ok.input_rows
    gone = run_job(spark, Job("nofile", "silver", {"source_file": "pa0008"},
                              sql_file=os.path.join(tmp_root, "missing.sql")), tmp_root, audit)
    assert gone.status == "missing_template"
    assert [r["script_name"] for r in audit.read(RUNS).collect()] == ["silver_from_file"]


def test_unchanged_files_are_not_re_read(spark, tmp_root):
    from tidemark.plans.audit import FILE_INDEX
    from tidemark.plans.ingest import hash_files
    import hashlib
    raw = os.path.join(tmp_root, "raw")
    os.makedirs(raw)
    for name, text in [("a.txt", "t\n| x |\n| 1 |\n"), ("b.txt", "t\n| x |\n| 2 |\n")]:
        with open(os.path.join(raw, name), "w") as fh:
            fh.write(text)
    audit = AuditStore(spark, os.path.join(tmp_root, "_audit"))
    h1 = {os.path.basename(r["file"]): r["file_hash"] for r in hash_files(spark, raw, "*.txt", audit).collect()}
    assert h1["a.txt"] == hashlib.md5(b"t\n| x |\n| 1 |\n").hexdigest()
    assert audit.read(FILE_INDEX).count() == 2
    h2 = {os.path.basename(r["file"]): r["file_hash"] for r in hash_files(spark, raw, "*.txt", audit).collect()}
    assert h2 == h1 and audit.read(FILE_INDEX).count() == 2      # nothing re-hashed
    with open(os.path.join(raw, "b.txt"), "a") as fh:               # changed content -> new hash
        fh.write("| 3 |\n")
    h3 = {os.path.basename(r["file"]): r["file_hash"] for r in hash_files(spark, raw, "*.txt", audit).collect()}
    assert h3["a.txt"] == h1["a.txt"] and h3["b.txt"] != h1["b.txt"] and audit.read(FILE_INDEX).count() == 3


def test_report_step(spark, tmp_root):
    from tidemark.plans.reports import extract_mismatches
    from tidemark.sources.snapshots import write_snapshot
    from tidemark.operators.reconcile import area_mismatches
    out_dir = os.path.join(tmp_root, "reports")
    assert extract_mismatches(spark, tmp_root, out_dir).status == "no_gold"
    g = hr_summary(fx.zpost(spark, SF), fx.pa0001(spark, SF), fx.pa0008(spark, SF), sort=False)
    write_snapshot(g, tmp_root, "gold", "hr_summary", "20240101_000000_000000")
    r = extract_mismatches(spark, tmp_root, out_dir, "pa", fmt="parquet")
    assert r.status == "exported" and r.rows == area_mismatches(g).count() > 0
    write_snapshot(g.where(F.lit(False)), tmp_root, "gold", "hr_summary", "20240102_000000_000000")
    assert extract_mismatches(spark, tmp_root, out_dir, "psg").status == "no_mismatches"


def test_command_line_layers(spark, tmp_root, capsys):
    import json
    from tidemark.__main__ import main
    raw = os.path.join(tmp_root, "raw")
    root = os.path.join(tmp_root, "lake")
    os.makedirs(raw)
    write_report(os.path.join(raw, "pa0001.txt"), "Table To Be Searched   PA0001", fx.pa0001_bronze(spark, SF))
    write_report(os.path.join(raw, "pa0008.txt"), "Table To Be Searched   PA0008", fx.pa0008_bronze(spark, SF))
    write_report(os.path.join(raw, "zpost.txt"), "Table To Be Searched   ZPOST",
                 fx.zpost_bronze(spark, SF).withColumn("Position Pay Scale Group", F.lit("P")))
    assert main(["bronze", raw, root], spark=spark) == 0
    assert json.loads(capsys.readouterr().out)["files_processed"] == 3
    assert main(["silver", root], spark=spark) == 0
    assert main(["gold", root], spark=spark) == 0
    assert [j["status"] for j in json.loads(capsys.readouterr().out.strip().splitlines()[-1])] == ["success"] * 3
    assert main(["report", root, os.path.join(tmp_root, "out"), "--kind", "psg"], spark=spark) == 0
    assert json.loads(capsys.readouterr().out)["status"] in ("exported", "no_mismatches")


def test_ingest_latin1_report(spark, tmp_root):
    raw = os.path.join(tmp_root, "raw")
    root = os.path.join(tmp_root, "lake")
    os.makedirs(raw)
    text = "Table To Be Searched   T001\r\n| Name | City |\r\n|------|\r\n| José | Málaga |\r\n| Zoë | Köln |\r\n"
    with open(os.path.join(raw, "t.txt"), "wb") as fh:
        fh.write(text.encode("latin-1"))
    audit = AuditStore(spark, os.path.join(root, "_audit"))
    res = ingest_bronze(spark, raw, root, audit, encoding="latin-1")
    assert res.status == "success" and res.files_processed == 1 and res.total_rows == 2
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(root, "bronze", "t001")).select("Name", "City").collect())
    assert got == [("José", "Málaga"), ("Zoë", "Köln")]


def test_export_report_single_file(spark, tmp_root):
    from tidemark.sources.snapshots import export_report
    df = spark.range(0, 1000, 1, 8).selectExpr("id", "CAST(id AS STRING) AS s")
    out = export_report(df, os.path.join(tmp_root, "one"), single_file=True)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 1
    assert spark.read.option("header", True).csv(out).count() == 1000


def test_file_names_sizes_and_unreadable_files(spark, tmp_root):
    """Spaces, escapes and glob characters in names; hashing in pieces; a file that cannot be read fails alone."""
    import hashlib
    from tidemark.plans import audit as A
    raw, root = os.path.join(tmp_root, "raw"), os.path.join(tmp_root, "lake")
    os.makedirs(raw)
    names = ["cost report 2024.txt", "50%25 + [a]{b}*.txt", "plain.txt"]
    for k, name in enumerate(names):
        with open(os.path.join(raw, name), "w") as fh:
            fh.write(f"t{k}\n| a | b |\n| {k} | 2 |\n" + "| x | y |\n" * (200_000 if k == 2 else 1))
    assert os.path.getsize(os.path.join(raw, names[2])) > A.PIECE
    hashes = {r["file"].rsplit("/", 1)[1]: r["file_hash"] for r in A.file_hashes(spark, raw).collect()}
    assert hashes == {n: hashlib.md5(open(os.path.join(raw, n), "rb").read()).hexdigest() for n in names}
    audit = AuditStore(spark, os.path.join(root, "_audit"))
    res = ingest_bronze(spark, raw, root, audit)
    assert (res.status, res.files_processed) == ("success", 3)
    assert {f["file"]: f["rows"] for f in res.files} == {names[0]: 2, names[1]: 2, names[2]: 200_001}

    os.symlink(os.path.join(tmp_root, "gone"), os.path.join(raw, "later.txt"))  # listed by some stores, readable by none
    with open(os.path.join(raw, "good.txt"), "w") as fh:
        fh.write("t\n| a |\n| 1 |\n")
    odd = spark.createDataFrame([(os.path.join(raw, "later.txt"), 1)], "file string, size long").withColumn("modified", F.current_timestamp())
    assert [r["file_hash"] for r in odd.mapInPandas(A._hash_pieces, "file string, file_hash string, size long, modified timestamp").collect()] == [None]
    os.unlink(os.path.join(raw, "later.txt"))
    assert ingest_bronze(spark, raw, root, audit).files_processed == 1


def test_counts_beyond_two_billion(spark, tmp_root):
    audit = AuditStore(spark, os.path.join(tmp_root, "_audit"))
    audit.log_run("job", "out", 3_000_000_000, 1, "success")
    audit.log_transform("t", "silver", ["a"], "b", 5_000_000_000, 3_000_000_000)
    assert audit.read(RUNS).first()["total_rows"] == 3_000_000_000
    assert audit.read(TRANSFORMS).first()["rows_filtered"] == 2_000_000_000


def test_a_failed_write_is_never_the_latest(spark, tmp_root):
    """What a failed or running write leaves has no commit marker: the next layer reads the snapshot before it."""
    from tidemark.plans.jobs import Job, run_jobs as run
    from tidemark.sources.snapshots import latest_snapshot, write_snapshot
    audit = AuditStore(spark, os.path.join(tmp_root, "_audit"))
    good = write_snapshot(spark.range(3).selectExpr("cast(id as string) v"), tmp_root, "bronze", "t", "20240101_000000_000000")
    to_int = Job("u", "silver", {"t": "t"}, lambda t: t.selectExpr("cast(v as int) v"))
    assert run(spark, [to_int], tmp_root, audit)[0].status == "success"
    first = latest_snapshot(spark, tmp_root, "u")
    write_snapshot(spark.createDataFrame([("bad",)], "v string"), tmp_root, "bronze", "t", "20240102_000000_000000")
    assert run(spark, [to_int], tmp_root, audit)[0].status == "failed"
    os.makedirs(os.path.join(tmp_root, "silver", "u", "snapshot=99999999_000000_000000"), exist_ok=True)  # a write under way
    assert latest_snapshot(spark, tmp_root, "u") == first
    last = run(spark, [Job("w", "gold", {"u": "u"}, lambda u: u, source_layers=("silver",))], tmp_root, audit)[0]
    assert (last.status, last.output_rows) == ("success", 3)
    assert good.endswith("000000")


def test_position_cost_export_goes_through_silver(spark, tmp_root):
    """The layout that the shipped export has: recognised by its keywords, cleaned by its own template."""
    from tidemark.sources.layouts import POSITION_COST_HEADERS, POSITION_COST_SIGNATURE
    raw, root = os.path.join(tmp_root, "raw"), os.path.join(tmp_root, "lake")
    os.makedirs(raw)
    headers = POSITION_COST_SIGNATURE + [f"h{k}" for k in range(len(POSITION_COST_HEADERS) - len(POSITION_COST_SIGNATURE))]
    values = ["01.02.2024" if "date" in h.lower() else "1,234.50" for h in POSITION_COST_HEADERS]
    with open(os.path.join(raw, "x.txt"), "w") as fh:
        fh.write("report\n| " + " | ".join(headers) + " |\n| " + " | ".join(values) + " |\n")
    audit = AuditStore(spark, os.path.join(root, "_audit"))
    res = ingest_bronze(spark, raw, root, audit)
    assert [f["table"].lower() for f in res.files] == ["zpost"], res.files
    silver = {r.job: r for r in run_jobs(spark, SILVER_JOBS, root, audit)}["zpost"]
    assert (silver.status, silver.output_rows) == ("success", 1), silver.error
    row = spark.read.parquet(silver.output).first()
    assert str(row["valid_from"]) == "2024-02-01" and str(row["Total"]) == "1234.50"


def test_files_are_listed_once_and_marked_by_tasks(spark, tmp_root, monkeypatch):
    """one listing for an ingest's hashes, and many commit markers written by tasks, none by the driver."""
    from tidemark.plans import ingest as I
    from tidemark.plans.audit import AuditStore
    from tidemark.sources import snapshots as S
    raw = os.path.join(tmp_root, "raw")
    os.makedirs(raw)
    for n in range(3):
        with open(os.path.join(raw, f"{n}.txt"), "w") as out:
            out.write(f"file {n}\n")
    listed, listing = [], I.list_files
    monkeypatch.setattr(I, "list_files", lambda *a: listed.append(1) or listing(*a))
    assert I.hash_files(spark, raw, "*.txt", AuditStore(spark, f"{tmp_root}/audit")).count() == 3
    assert listed == [1]

    outputs = [(S.dataset_path(tmp_root, "bronze", "t") + f"/{S.SNAPSHOT}=s{n:03d}", n) for n in range(I.DRIVER_MARKS + 1)]
    for path, _ in outputs:
        os.makedirs(path)
    by_driver = []
    monkeypatch.setattr(I, "commit_snapshot", lambda spark, path, rows: by_driver.append(path))
    I.commit_snapshots(spark, outputs)
    assert by_driver == []
    assert S.list_snapshots(spark, tmp_root, "bronze", "t") == [f"s{n:03d}" for n, _ in enumerate(outputs)]
    assert [S.snapshot_rows(spark, path) for path, _ in outputs] == [rows for _, rows in outputs]
    I.commit_snapshots(spark, [("nowhere://host/t/snapshot=x", 1)] + outputs)       # one that Arrow cannot reach
    assert by_driver == ["nowhere://host/t/snapshot=x"]
