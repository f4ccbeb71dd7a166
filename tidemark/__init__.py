"""Keep tables in step with change feeds, on Spark."""

from tidemark.plans.backfill import build_versions, run_backfill
from tidemark.plans.build import build_snapshot, latest_in_window
from tidemark.plans.log import read_log, run_logged
from tidemark.plans.run import RunReport, run_snapshot
from tidemark.spec import FLAT, PARTITIONED, FeedSpec, RunOptions, Target

__all__ = [
    "FLAT",
    "PARTITIONED",
    "FeedSpec",
    "RunOptions",
    "RunReport",
    "Target",
    "build_snapshot",
    "build_versions",
    "latest_in_window",
    "read_log",
    "run_backfill",
    "run_logged",
    "run_snapshot",
]
