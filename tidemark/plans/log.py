"""A log of runs: a row for each run that was published, refused or failed, with its counts.

The log is a folder of Parquet files to which every run appends one row, whatever becomes of it, so it can be
kept beside the tables, for many of them, and read like any frame."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace
from datetime import UTC, date, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.plans.run import COUNTS, EFFECTS, RunReport, run_snapshot
from tidemark.sources.snapshots import load_or_empty
from tidemark.spec import FLAT, FeedSpec, RunOptions, Target

PUBLISHED, REFUSED, FAILED = "published", "refused", "failed"

LOG = (
    T.StructType()
    .add("table", "string")
    .add("mode", "string")
    .add("as_of", "string")
    .add("status", "string")
    .add("reason", "string")
    .add("last_date", "date")
    .add("with_load", "boolean")
    .add("resumed", "date")
    .add("started", "timestamp")
    .add("seconds", "double")
)
for _name in (*COUNTS, *EFFECTS):
    LOG = LOG.add(_name, "long")

#: Of an error's message this much is kept.
REASON = 1000


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a log; none where nothing was logged yet."""
    return load_or_empty(spark, path, LOG)


def append(spark: SparkSession, path: str, entry: dict[str, Any]) -> None:
    row = tuple(entry.get(name) for name in LOG.fieldNames())
    spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").parquet(path)


@contextmanager
def logged(
    spark: SparkSession, path: str, table: str, mode: str, as_of: date | str
) -> Iterator[dict[str, Any]]:
    """Appends a row when the block ends: refused for a `ValueError`, which comes before any work, failed for
    any other error, which goes on to the caller, else published, with what the block enters."""
    entry: dict[str, Any] = {"table": table, "mode": mode, "as_of": str(as_of)}
    entry["started"] = datetime.now(UTC)
    begin = time.monotonic()
    try:
        yield entry
        entry["status"] = PUBLISHED
    except Exception as error:
        entry["status"] = REFUSED if isinstance(error, ValueError) else FAILED
        entry["reason"] = str(error)[:REASON]
        raise
    finally:
        entry["seconds"] = time.monotonic() - begin
        append(spark, path, entry)


def run_logged(
    spark: SparkSession,
    spec: FeedSpec,
    as_of: date | str,
    target: Target,
    mode: str = FLAT,
    options: RunOptions = RunOptions(),
    *,
    log: str,
) -> RunReport:
    """`run_snapshot` with counts, and a row in the log at `log`."""
    with logged(spark, log, target.table, mode, as_of) as entry:
        report = run_snapshot(spark, spec, as_of, target, mode, replace(options, count_rows=True))
        entry.update(
            last_date=report.last_date,
            with_load=report.with_load,
            resumed=report.resumed,
            **report.rows,
            **report.effects,
        )
    return report
