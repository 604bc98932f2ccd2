"""Report step (lifecycle C): latest Gold -> mismatch report -> export (SRC8, FLT5, FLT6, SNK4)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tidemark.operators.reconcile import area_mismatches, group_mismatches
from tidemark.sources.snapshots import export_report, latest_snapshot

# The two reports, the Gold dataset they read, and their file-name prefixes.
REPORTS = {
    "pa": (area_mismatches, "PA_Mismatches"),
    "psg": (group_mismatches, "PSG_Mismatches"),
}
GOLD_DATASET = "hr_summary"


@dataclass
class ReportResult:
    report: str
    status: str            # exported / no_mismatches / no_gold
    rows: int = 0
    output: str | None = None


def extract_mismatches(spark: SparkSession, root: str, out_dir: str, report: str = "pa",
                       fmt: str = "csv", single_file: bool = False,
                       run_ts: _dt.datetime | None = None) -> ReportResult:
    """Read the latest Gold snapshot, build the report, write it unless it is empty."""
    build, prefix = REPORTS[report]
    gold = latest_snapshot(spark, root, GOLD_DATASET, ("gold",))
    if gold is None:
        return ReportResult(report, "no_gold")
    df = build(spark.read.parquet(gold))
    path = f"{out_dir.rstrip('/')}/{prefix}_{(run_ts or _dt.datetime.now()):%Y%m%d_%H%M%S}"
    out = export_report(df, path, fmt=fmt, single_file=single_file)
    if out is None:
        return ReportResult(report, "no_mismatches")
    return ReportResult(report, "exported", spark.read.parquet(out).count() if fmt == "parquet" else
                        spark.read.option("header", True).csv(out).count(), out)
