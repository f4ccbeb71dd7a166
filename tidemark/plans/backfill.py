"""Several versions of a flat table in one pass over its feed.

A backfill by single runs scans the feed and moves the snapshot once a version. Here every change is dealt to
the versions whose run would have read it, the latest one per key and version is kept, and a key's
changes, put in a row behind its old row, say for how long each of them is shown: from its version until
the next one's. Only then rows are repeated, once a version that shows them.

The result is that of single runs on the same days, one after another, in either null policy."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date, change_day, file_day
from tidemark.functions.names import cols
from tidemark.operators.changes import change_order, latest_change, within_dates
from tidemark.plans.build import RunWindow, previous_snapshot, run_window
from tidemark.plans.run import run_snapshot
from tidemark.scratch import owned_scratch
from tidemark.sinks.publish import publish_versions, resume
from tidemark.sources.feed import check_file_names, rebase_load, scan_feed, select_files
from tidemark.spec import (
    DELETE,
    FILE_NAME,
    FLAT,
    IS_CHANGE,
    OP,
    STAMP,
    VERSION,
    FeedSpec,
    RunOptions,
    Target,
)

_AT, _UNTIL, _LIFE = "_cdc_at", "_cdc_until", "_cdc_life"

#: Where old rows stand, before every version.
_OLD = -1


def as_days(days: Sequence[date | str]) -> list[date]:
    """The days of a backfill: at least one, ascending."""
    made = [as_date(day) for day in days]
    if not made or any(a >= b for a, b in zip(made, made[1:])):
        raise ValueError("the days of a backfill must ascend, and there must be one")
    return made


def _dates(days: Sequence[date]) -> Column:
    return F.array(*[F.lit(day) for day in days])


def dealt_to_versions(
    changes: DataFrame, first: date, days: Sequence[date], bad_timestamp: str = "fail"
) -> DataFrame:
    """Repeat every change for each version whose run reads it, as `_cdc_at`.

    The run of a day reads rows and files dated from the run before it to that day, both ends
    included, so a change is read by one run, by two if row and file are of a run's day, or by none. Load rows
    take part in the first."""
    span = (days[-1] - first).days + 1
    every = [first + timedelta(days=n) for n in range(span)]
    numbers = iter(range(len(days)))
    at, closing = [], next(numbers)
    for day in every:
        while day > days[closing]:
            closing = next(numbers)
        at.append(closing)
    day = change_day(F.col(STAMP), bad_timestamp)
    named = F.when(F.col(IS_CHANGE) == 0, day).otherwise(file_day(F.col(FILE_NAME)))
    early, late = F.least(day, named), F.greatest(day, named)
    run = F.get(F.array(*[F.lit(n) for n in at]), F.datediff(late, F.lit(first)))
    starts, ends = _dates([first, *days[:-1]]), _dates(days)
    in_run = (early >= F.get(starts, run)) & ((F.col(IS_CHANGE) == 1) | (run == 0))
    in_next = (early >= F.get(ends, run)) & (run < len(days) - 1) & (F.col(IS_CHANGE) == 1)
    read_by = F.array(F.when(in_run, run), F.when(in_next, run + 1))
    return changes.withColumn(_AT, F.explode(F.array_compact(read_by)))


def _shown(rows: DataFrame, days: Sequence[date], columns: Sequence[str]) -> DataFrame:
    """A row for every version from the row's own until the next one of its key."""
    begin = F.greatest(_AT, F.lit(0))
    alive = rows.where(F.col(OP).isNull() | (F.col(OP) != DELETE)).where(F.col(_UNTIL) > begin)
    at = F.explode(F.sequence(begin, F.col(_UNTIL) - 1))
    repeated = alive.select(*cols(columns), at.alias(_AT))
    return repeated.select(*cols(columns), F.get(_dates(days), F.col(_AT)).alias(VERSION))


def _carried(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Nulls of a row take the last value that its key has had since it was last deleted."""
    before = Window.partitionBy(*cols(keys)).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    deletes = F.coalesce(F.count_if(F.col(OP) == DELETE).over(before), F.lit(0))
    life = Window.partitionBy(*cols(keys), _LIFE).orderBy(_AT)
    so_far = life.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = [
        F.col(c) if c in set(keys) else F.last(column, ignorenulls=True).over(so_far).alias(c)
        for c, column in zip(columns, cols(columns))
    ]
    return rows.withColumn(_LIFE, deletes).select(*values, OP, _AT, _UNTIL)


def fill_versions(
    old: DataFrame,
    latest: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    days: Sequence[date],
    null_policy: str = "keep_old",
) -> DataFrame:
    """All versions, from the old rows and the latest change per key and version (`_cdc_at`).

    `old` holds a key once, as every published snapshot does; one that repeats a key is refused
    while it is read. Rows with a null in the key match nothing: a change adds a row to its version
    and all later ones."""
    null_key = reduce(or_, [c.isNull() for c in cols(keys)])
    place = F.lit(_OLD).alias(_AT)
    old = old.select(*cols(columns), F.lit(None).cast("string").alias(OP), place)
    rows = old.unionByName(latest.select(*cols(columns), OP, F.col(_AT).cast("int").alias(_AT)))
    unkeyed = rows.where(null_key).withColumn(_UNTIL, F.lit(len(days)))

    of_key = Window.partitionBy(*cols(keys))
    later = of_key.orderBy(_AT).rangeBetween(1, Window.unboundedFollowing)
    repeated = F.count_if(F.col(_AT) == _OLD).over(of_key) > 1
    refused = F.raise_error(F.lit("the snapshot repeats a key: bring it up to date by single runs")).cast("int")
    keyed = rows.where(~null_key).withColumn(
        _UNTIL, F.when(repeated, refused).otherwise(F.coalesce(F.min(_AT).over(later), F.lit(len(days))))
    )
    if null_policy == "keep_old":
        keyed = _carried(keyed, keys, columns)
    return _shown(keyed.unionByName(unkeyed), days, columns)


def latest_by_version(
    feed: DataFrame, spec: FeedSpec, window: RunWindow, days: Sequence[date], options: RunOptions
) -> DataFrame:
    """Latest change per key and version among the rows that the runs of these days read."""
    picked = select_files(feed, window.first, days[-1], window.with_load)
    load_day = spec.cdc_start_date if options.load_rank == "first" else window.as_of
    changes = within_dates(
        rebase_load(picked, load_day), window.first, days[-1], options.bad_timestamp
    )
    dealt = dealt_to_versions(changes, window.first, days, options.bad_timestamp)
    return latest_change(dealt, [*spec.primary_keys, _AT], change_order(options.load_rank))


def build_versions(
    spark: SparkSession,
    spec: FeedSpec,
    days: Sequence[date | str],
    target: Target,
    options: RunOptions = RunOptions(),
) -> DataFrame:
    """The snapshots of several days as one frame, their day in the column `version`.

    Starts from the table's current version, or from the load. Nothing is published."""
    days = as_days(days)
    window = run_window(spark, spec, days[0], target, FLAT)
    feed = scan_feed(spark, spec)
    if options.check_names:
        check_file_names(feed, spec.path)
    latest = latest_by_version(feed, spec, window, days, options)
    old = previous_snapshot(spark, spec, window, target, FLAT)
    return fill_versions(old, latest, spec.primary_keys, spec.columns, days, options.null_policy)


def run_backfill(
    spark: SparkSession,
    spec: FeedSpec,
    days: Sequence[date | str],
    target: Target,
    options: RunOptions = RunOptions(),
) -> list[date]:
    """Publish the versions of several days and make the table show the last one.

    A first day that is published already is run again on its own, since it starts from what it
    replaces. Returns the days; repeating a backfill that was cut off is safe."""
    days = as_days(days)
    run_window(spark, spec, days[0], target, FLAT)  # refuses bad arguments before any work
    target = target.bucketed_by(spec.primary_keys)
    with owned_scratch():
        resume(spark, target, FLAT)
        rest = days
        if run_window(spark, spec, days[0], target, FLAT).last_date == days[0]:
            run_snapshot(spark, spec, days[0], target, FLAT, options)
            rest = days[1:]
        if rest:
            publish_versions(build_versions(spark, spec, rest, target, options), target, rest)
    return days
