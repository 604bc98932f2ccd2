"""tidemark: temporal ETL and reconciliation on Spark DataFrames.

Layers (all DataFrame -> DataFrame, Catalyst-planned, no row-at-a-time Python):

* ``tidemark.functions``  scalar Column builders (dirty dates / amounts, blanks, day counts)
* ``tidemark.sources``    report-text extraction, layout registry, snapshots, sinks
* ``tidemark.operators``  cleaning, overlap (interval) joins and proration, reconciliation, profiling
* ``tidemark.plans``      job configuration and runners, audit tables, the built-in job templates
"""

from tidemark.session import get_spark, checkpoint_dir
from tidemark.operators.clean import CleanSpec, clean
from tidemark.operators.profile import blank_profile, blank_profile_rows
from tidemark.operators.reconcile import mismatches
from tidemark.operators.temporal import DimSpec, clip_and_weigh, overlap_left_join
from tidemark.sources.reports import extract_grid, read_report_lines

__all__ = [
    "get_spark", "checkpoint_dir", "CleanSpec", "clean", "blank_profile", "blank_profile_rows",
    "mismatches", "DimSpec", "clip_and_weigh", "overlap_left_join", "extract_grid", "read_report_lines",
]
__version__ = "0.1.0"
