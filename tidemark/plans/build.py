"""The snapshot of a date as one lazy plan over feed files and the previous snapshot."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import as_date
from tidemark.functions.frames import empty_frame
from tidemark.functions.names import cols
from tidemark.operators.changes import change_order, latest_change, within_dates
from tidemark.operators.merge import merge_snapshot, partition_rows
from tidemark.sources.catalog import describe, last_published, table_exists
from tidemark.sources.feed import check_file_names, rebase_load, scan_feed, select_files
from tidemark.sources.snapshots import load_or_empty
from tidemark.spec import (
    FLAT,
    PARTITION,
    PARTITIONED,
    FeedSpec,
    RunOptions,
    Target,
    check_dates,
    check_mode,
)


@dataclass(frozen=True)
class RunWindow:
    """What a run covers, decided from the catalog before any job starts."""

    as_of: date
    last_date: date | None
    first: date
    with_load: bool


def run_window(
    spark: SparkSession, spec: FeedSpec, as_of: date | str, target: Target, mode: str
) -> RunWindow:
    """Dates and files of a run, after checking its arguments.

    A run starts at the last published day, not after it, so that changes exported
    late are picked up. The load takes part on the start date and while there is no
    table."""
    check_mode(spec, mode, target)
    as_of = as_date(as_of)
    check_dates(spec, as_of, None)
    exists = table_exists(spark, target.table)
    last_date = last_published(spark, target.table, mode) if exists else None
    check_dates(spec, as_of, last_date)
    with_load = as_of == spec.cdc_start_date or not exists
    return RunWindow(as_of, last_date, last_date or spec.cdc_start_date, with_load)


def latest_in_window(
    feed: DataFrame,
    spec: FeedSpec,
    window: RunWindow,
    mode: str = FLAT,
    options: RunOptions = RunOptions(),
) -> DataFrame:
    """Latest change per key among the rows of a feed that a run covers."""
    picked = select_files(feed, window.first, window.as_of, window.with_load)
    load_day = spec.cdc_start_date if options.load_rank == "first" else window.as_of
    changes = within_dates(
        rebase_load(picked, load_day), window.first, window.as_of, options.bad_timestamp
    )
    latest = latest_change(changes, spec.primary_keys, change_order(options.load_rank))
    if mode == PARTITIONED:
        latest = partition_rows(latest, spec.partition_date, window.as_of, options.bad_timestamp)
    return latest


def _fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A table's rows under another schema: new columns are null, others keep their
    name; read through the catalog, which knows the buckets."""
    known = set(df.columns)
    return df.select(
        *[
            (column if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
            for f, column in zip(schema.fields, cols(schema.fieldNames()))
        ]
    )


def previous_snapshot(
    spark: SparkSession, spec: FeedSpec, window: RunWindow, target: Target, mode: str
) -> DataFrame:
    """The rows a run starts from: the current version, the date's partition, or none."""
    schema = spec.snapshot_schema(mode)
    if not table_exists(spark, target.table):
        return empty_frame(spark, schema)
    if mode == FLAT:
        entry = describe(spark, target.table)
        if entry.get("num_buckets"):
            return _fitted(spark.table(target.table), schema)
        return load_or_empty(spark, entry["location"], schema, target.fmt)
    return spark.table(target.table).where(F.col(PARTITION) == F.lit(window.as_of))


def build_snapshot(
    spark: SparkSession,
    spec: FeedSpec,
    as_of: date | str,
    target: Target,
    mode: str = FLAT,
    options: RunOptions = RunOptions(merge="sort_merge"),
) -> DataFrame:
    """The snapshot of a date, without publishing it.

    Lazy and free of side effects apart from looking up names in the catalog and the
    file index (and, with `merge="broadcast_delta"`, storing the changes)."""
    window = run_window(spark, spec, as_of, target, mode)
    feed = scan_feed(spark, spec)
    if options.check_names:
        check_file_names(feed, spec.path)
    delta = latest_in_window(feed, spec, window, mode, options)
    old = previous_snapshot(spark, spec, window, target, mode)
    columns = spec.snapshot_schema(mode).fieldNames()
    return merge_snapshot(
        old, delta, spec.primary_keys, columns, options.null_policy, options.merge
    )
