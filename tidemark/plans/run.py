"""Running one table: snapshot of a date, then publication."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import change_day
from tidemark.functions.names import cols
from tidemark.operators.merge import merge_snapshot, merge_stored, sort_merge, store_measured
from tidemark.plans.build import RunWindow, latest_in_window, previous_snapshot, run_window
from tidemark.scratch import owned_scratch, store
from tidemark.sinks.publish import publish, resume
from tidemark.sinks.tables import in_buckets, store_in_buckets
from tidemark.sources.catalog import describe
from tidemark.sources.feed import check_file_names, scan_feed, select_files
from tidemark.sources.footers import check_footers
from tidemark.sources.ledger import enter, plan_reading, read_only
from tidemark.spec import (
    DELETE,
    FLAT,
    IS_CHANGE,
    OP,
    PARTITION,
    PARTITIONED,
    STAMP,
    FeedSpec,
    RunOptions,
    Target,
)


@dataclass(frozen=True)
class RunReport:
    """What a run did. `rows` and `effects` are filled when `RunOptions.count_rows` is set: what it
    read, and how many keys it changed, how many of these it deleted, and the rows it published."""

    table: str
    as_of: date
    mode: str
    last_date: date | None
    with_load: bool
    resumed: date | None = None
    rows: dict[str, int] = field(default_factory=dict)
    effects: dict[str, int] = field(default_factory=dict)


EFFECTS = ("changed", "deleted", "published")
COUNTS = ("read", "undated", "too_early", "too_late")


def keeps_buckets(spark: SparkSession, target: Target) -> bool:
    """Whether the snapshot that a run starts from is in the target's buckets already."""
    entry = describe(spark, target.table) or {}
    return (
        entry.get("num_buckets") == target.buckets
        and tuple(entry.get("bucket_columns") or ()) == target.bucket_keys
    )


def _counted(feed: DataFrame, window: RunWindow, seen: Observation) -> DataFrame:
    """Count, while the feed streams by, the change rows the date window leaves out."""
    picked = select_files(feed, window.first, window.as_of, window.with_load)
    day = change_day(F.col(STAMP), "drop")
    change = F.col(IS_CHANGE) == 1
    return picked.observe(
        seen,
        F.count(F.lit(1)).alias("read"),
        F.count_if(change & day.isNull()).alias("undated"),
        F.count_if(change & (day < F.lit(window.first))).alias("too_early"),
        F.count_if(change & (day > F.lit(window.as_of))).alias("too_late"),
    )


def _merged_run(
    old: DataFrame,
    delta: DataFrame,
    spec: FeedSpec,
    target: Target,
    options: RunOptions,
    columns: list[str],
    counted: bool,
) -> tuple[DataFrame, DataFrame]:
    """Merge a run's changes, stored first where that pays: later readings of them do not scan the feed
    again. Returns the changes too.

    A bucketed snapshot does not move in a sort-merge join, nor do changes stored in its buckets, and
    the join leaves the rows there, which a broadcast would scatter over many files."""
    keys, policy = spec.primary_keys, options.null_policy
    if target.buckets:
        stored = store_in_buckets(delta, target, "delta")
        return sort_merge(old, stored, keys, columns, policy), stored
    if options.merge == "broadcast_delta":
        stored, _, size = store_measured(delta, "delta")
        return merge_stored(old, stored, keys, columns, policy, size=size), stored
    if counted or options.merge == "split":
        delta, _ = store(delta, "delta")
    return merge_snapshot(old, delta, keys, columns, policy, options.merge), delta


def _effects(spark: SparkSession, delta: DataFrame, target: Target, day: date, mode: str) -> dict[str, int]:
    """Counts over a run's stored changes and over what it published; the latter reads no column."""
    deleted = F.count_if(F.col(OP) == DELETE)
    changed = delta.agg(F.count(F.lit(1)).alias("changed"), deleted.alias("deleted")).first()
    shown = spark.table(target.table)
    if mode == PARTITIONED:
        shown = shown.where(F.col(PARTITION) == F.lit(day))
    return {**changed.asDict(), "published": shown.count()}


def run_snapshot(
    spark: SparkSession,
    spec: FeedSpec,
    as_of: date | str,
    target: Target,
    mode: str = FLAT,
    options: RunOptions = RunOptions(),
) -> RunReport:
    """Bring a table to the state of a date and publish it; repeating a run is safe."""
    run_window(spark, spec, as_of, target, mode)  # refuses bad arguments before any work
    target = target.bucketed_by(spec.primary_keys)
    with owned_scratch():
        resumed = resume(spark, target, mode)
        window = run_window(spark, spec, as_of, target, mode)
        feed = scan_feed(spark, spec)
        if options.check_names:
            check_file_names(feed, spec.path)
        if options.check_columns:
            check_footers(spark, spec, window.first, window.as_of, window.with_load)
        reading = None
        if options.ledger and mode == FLAT:
            span = window.first, window.as_of, window.with_load, window.last_date
            reading = plan_reading(spark, spec, feed, target, *span)
            feed = read_only(feed, reading)
        # A folder that is not there plans to nothing, which would carry no counts.
        seen = Observation("feed") if options.count_rows and feed.inputFiles() else None
        rows = dict.fromkeys(COUNTS, 0) if options.count_rows else {}
        if seen is not None:
            feed = _counted(feed, window, seen)
        columns = spec.snapshot_schema(mode).fieldNames()
        delta = latest_in_window(feed, spec, window, mode, options).select(OP, *cols(columns))
        old = previous_snapshot(spark, spec, window, target, mode)
        merged, delta = _merged_run(old, delta, spec, target, options, columns, options.count_rows)
        if seen is not None:
            rows = seen.get
        if target.buckets and not keeps_buckets(spark, target):
            merged = in_buckets(merged, target)
        publish(merged, target, window.as_of, mode)
        if reading is not None:
            enter(target, reading, window.last_date)
        effects = _effects(spark, delta, target, window.as_of, mode) if options.count_rows else {}
    return RunReport(
        table=target.table,
        as_of=window.as_of,
        mode=mode,
        last_date=window.last_date,
        with_load=window.with_load,
        resumed=resumed,
        rows=rows,
        effects=effects,
    )
