"""Command line: run one layer of the pipeline.

    python -m tidemark bronze RAW_DIR ROOT [--encoding latin-1]
    python -m tidemark silver ROOT
    python -m tidemark gold ROOT
    python -m tidemark report ROOT OUT_DIR [--kind pa|psg] [--format csv|parquet]

``ROOT`` holds ``bronze/ silver/ gold/`` snapshots and the ``_audit`` tables.  The Spark master
comes from the launcher (``spark-submit``) or ``--master``.
"""

from __future__ import annotations

import argparse
import json
import sys

from tidemark.session import get_spark


def main(argv: list[str] | None = None, spark=None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="layer", required=True)
    b = sub.add_parser("bronze")
    b.add_argument("raw_dir")
    b.add_argument("root")
    b.add_argument("--encoding", default="utf-8")
    b.add_argument("--glob", default="*.txt")
    for name in ("silver", "gold"):
        sub.add_parser(name).add_argument("root")
    r = sub.add_parser("report")
    r.add_argument("root")
    r.add_argument("out_dir")
    r.add_argument("--kind", default="pa", choices=["pa", "psg"])
    r.add_argument("--format", default="csv", choices=["csv", "parquet"])
    a = ap.parse_args(argv)

    spark = spark or get_spark(a.master)
    from tidemark.plans.audit import AuditStore
    audit = AuditStore(spark, a.root.rstrip("/") + "/_audit")
    if a.layer == "bronze":
        from tidemark.plans.ingest import ingest_bronze
        res = ingest_bronze(spark, a.raw_dir, a.root, audit, glob=a.glob, encoding=a.encoding)
        out = dict(status=res.status, files_processed=res.files_processed, total_rows=res.total_rows,
                   files=res.files)
        ok = res.status != "failed"
    elif a.layer in ("silver", "gold"):
        from tidemark.plans.jobs import GOLD_JOBS, SILVER_JOBS, run_jobs
        results = run_jobs(spark, SILVER_JOBS if a.layer == "silver" else GOLD_JOBS, a.root, audit)
        out = [dict(job=x.job, status=x.status, input_rows=x.input_rows, output_rows=x.output_rows,
                    output=x.output, error=x.error) for x in results]
        ok = all(x.status != "failed" for x in results)
    else:
        from tidemark.plans.reports import extract_mismatches
        res = extract_mismatches(spark, a.root, a.out_dir, a.kind, fmt=a.format)
        out = dict(report=res.report, status=res.status, rows=res.rows, output=res.output)
        ok = True
    print(json.dumps(out, default=str))
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
