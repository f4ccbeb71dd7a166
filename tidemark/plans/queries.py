"""The registered queries: every operator of the engine over whole tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import suppress
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import job
from tidemark.functions.files import write_text
from tidemark.functions.frames import empty_frame
from tidemark.functions.names import cols
from tidemark.operators.changes import (
    change_sequence,
    deleted_keys,
    latest_change_agg,
    within_dates,
)
from tidemark.operators.merge import merge_snapshot, partition_rows
from tidemark.plans.backfill import run_backfill
from tidemark.plans.build import RunWindow, build_snapshot, latest_in_window
from tidemark.plans.feeds import (
    A_END,
    A_MID,
    A_START,
    B_END,
    B_MID,
    B_START,
    SPEC_A,
    SPEC_A2,
    SPEC_B,
    export_files,
    feed_a,
    feed_b,
    fresh_table,
    load_a,
    previous_a,
    previous_b,
    skewed_b,
)
from tidemark.plans.log import logged, read_log, run_logged
from tidemark.plans.run import COUNTS, EFFECTS, run_snapshot
from tidemark.scratch import scratch_path, store
from tidemark.sinks.publish import publish_partition, publish_version, resume
from tidemark.sinks.record import WRITTEN, note, publication
from tidemark.sinks.tables import (
    WHOLE,
    begin,
    overwrite_partitions,
    overwrite_table,
    write_files,
    write_table,
)
from tidemark.sources.catalog import current_version, last_partition, partitions, table_exists
from tidemark.sources.feed import (
    file_day,
    file_kind,
    is_load,
    list_feed,
    rebase_load,
    scan_feed,
    select_files,
    select_load_files,
)
from tidemark.sources.footers import compare_footers
from tidemark.sources.ledger import read_ledger
from tidemark.sources.snapshots import all_versions, load_or_empty, version_as_of
from tidemark.spec import (
    FILE_NAME,
    FLAT,
    IS_CHANGE,
    OP,
    PARTITION,
    PARTITIONED,
    ROW_INDEX,
    STAMP,
    VERSION,
    FeedSpec,
    RunOptions,
    Target,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        return run

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates as text, so that results compare without regard to date types."""
    return df.select(
        *[
            column.cast("string").alias(field.name)
            if isinstance(field.dataType, T.DateType)
            else column
            for field, column in zip(df.schema.fields, cols(df.columns))
        ]
    )


def _latest(
    feed: DataFrame, spec: FeedSpec, first: date, last: date, with_load: bool = False
) -> DataFrame:
    return latest_in_window(feed, spec, RunWindow(last, None, first, with_load))


def _latest_a(spark: SparkSession, folder: str) -> DataFrame:
    return _latest(feed_a(spark, folder), SPEC_A, A_START, A_END)


def _target(spark: SparkSession, label: str) -> Target:
    return Target(fresh_table(label), scratch_path(spark, label))


# Scans and file selection


@query("feed_scan")
def feed_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Load and change files of feed A in one scan, told apart by the names of their files."""
    rows = scan_feed(spark, _exported(spark, folder))
    return plain(rows.select(OP, STAMP, *SPEC_A.columns, F.col(IS_CHANGE).alias("is_change")))


@query("feed_scan_files")
def feed_scan_files(spark: SparkSession, folder: str) -> DataFrame:
    """Feed A exported to dated files and read back in one scan under the fixed schema."""
    path = export_files(feed_a(spark, folder), SPEC_A)
    rows = scan_feed(spark, replace(SPEC_A, path=path))
    return plain(rows.select(OP, STAMP, *SPEC_A.columns))


@query("feed_scan_selected_files")
def feed_scan_selected_files(spark: SparkSession, folder: str) -> DataFrame:
    """Only the exported files named after a day in a range; the load is left out."""
    rows = scan_feed(spark, _exported(spark, folder))
    picked = select_files(rows, date(2024, 1, 5), A_MID, with_load=False)
    return plain(picked.select(OP, STAMP, *SPEC_A.columns))


@query("feed_files")
def feed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per change file of feed B named after a day of the first half."""
    picked = select_files(feed_b(spark, folder), B_START, B_MID, with_load=False)
    counted = picked.groupBy(F.col(FILE_NAME).alias("file_name")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    name = F.col("file_name")
    return plain(
        counted.select(
            name, file_kind(name).alias("kind"), file_day(name).alias("file_date"), "n_rows"
        )
    )


@query("feed_files_listed")
def feed_files_listed(spark: SparkSession, folder: str) -> DataFrame:
    """Days that the exported files of feed A and its load are named after."""
    both = feed_a(spark, folder).unionByName(load_a(spark, folder))
    listed = list_feed(spark, export_files(both, SPEC_A))
    return plain(listed.select("kind", "file_date").distinct())


@query("feed_footers")
def feed_footers(spark: SparkSession, folder: str) -> DataFrame:
    """Columns in the footers of five exports of feed A: as it is, with a narrower integer, without a column,
    with one more, and with a number written as text."""
    feed, fields = feed_a(spark, folder), SPEC_A.schema.fields
    retyped = lambda name, kind: T.StructType([T.StructField(f.name, kind if f.name == name else f.dataType) for f in fields])
    exports = {
        "plain": (feed, SPEC_A.schema),
        "narrow": (feed.withColumn("user_id", F.col("user_id").cast("int")), retyped("user_id", T.IntegerType())),
        "missing": (feed, T.StructType([f for f in fields if f.name != "event_type"])),
        "extra": (feed.withColumn("more", F.lit(1.5)), T.StructType([*fields, T.StructField("more", T.DoubleType())])),
        "misfit": (feed.withColumn("value", F.col("value").cast("string")), retyped("value", T.StringType())),
    }
    compared = None
    for label, (rows, schema) in exports.items():
        path = export_files(rows, replace(SPEC_A, schema=schema, partition_date=None))
        found = compare_footers(SPEC_A, list_feed(spark, path)).drop("path").distinct()
        found = found.select(F.lit(label).alias("export"), "*")
        compared = found if compared is None else compared.unionByName(found)
    return compared


@query("full_load_rows")
def full_load_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The load files of an exported feed, which hold no envelope columns."""
    path = export_files(load_a(spark, folder), SPEC_A, with_stamp=False)
    load = select_load_files(scan_feed(spark, replace(SPEC_A, path=path)))
    return plain(load.select(OP, STAMP, *SPEC_A.columns))


@query("full_load_rebase")
def full_load_rebase(spark: SparkSession, folder: str) -> DataFrame:
    both = load_a(spark, folder).unionByName(feed_a(spark, folder))
    rebased = rebase_load(both, A_START)
    return plain(
        rebased.select(is_load(F.col(FILE_NAME)).cast("int").alias("is_load"), STAMP, "user_id")
    )


# Order and latest change


@query("change_window")
def change_window(spark: SparkSession, folder: str) -> DataFrame:
    rows = within_dates(feed_a(spark, folder), date(2024, 1, 5), A_MID)
    return plain(rows.select(OP, STAMP, *SPEC_A.columns))


def _sequence(spark: SparkSession, folder: str, **how: int) -> DataFrame:
    numbered = change_sequence(feed_a(spark, folder), SPEC_A.primary_keys, **how)
    return numbered.select("user_id", F.col(ROW_INDEX).alias("event_id"), "change_seq")


@query("change_sequence")
def change_sequence_window(spark: SparkSession, folder: str) -> DataFrame:
    return _sequence(spark, folder)


@query("change_sequence_slices")
def change_sequence_slices(spark: SparkSession, folder: str) -> DataFrame:
    """The same numbers, with every key of more than fifty changes treated as hot."""
    return _sequence(spark, folder, hot_rows=50)


@query("change_sequence_files")
def change_sequence_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same numbers from exported files, ordered by file metadata only."""
    rows = scan_feed(spark, replace(SPEC_A, path=export_files(feed_a(spark, folder), SPEC_A)))
    numbered = change_sequence(rows, SPEC_A.primary_keys)
    return plain(numbered.select("user_id", STAMP, "event_type", "value", "change_seq"))


@query("latest_change")
def latest_change_window(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_latest_a(spark, folder).select(OP, STAMP, *SPEC_A.columns))


@query("latest_change_composite")
def latest_change_composite(spark: SparkSession, folder: str) -> DataFrame:
    latest = _latest(feed_a(spark, folder), SPEC_A2, A_START, A_END)
    return plain(latest.select(OP, STAMP, *SPEC_A.columns))


@query("latest_change_agg")
def latest_change_max_by(spark: SparkSession, folder: str) -> DataFrame:
    changes = within_dates(feed_a(spark, folder), A_START, A_END)
    latest = latest_change_agg(changes, SPEC_A.primary_keys)
    return plain(latest.select(OP, STAMP, *SPEC_A.columns))


@query("deleted_keys")
def deleted_users(spark: SparkSession, folder: str) -> DataFrame:
    return deleted_keys(_latest_a(spark, folder), SPEC_A.primary_keys)


# Merge


def _merge_a(spark: SparkSession, folder: str, **how: str) -> DataFrame:
    return merge_snapshot(
        previous_a(spark, folder),
        _latest_a(spark, folder),
        SPEC_A.primary_keys,
        SPEC_A.columns,
        **how,
    )


@query("snapshot_merge")
def snapshot_merge(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_merge_a(spark, folder))


@query("snapshot_merge_overwrite")
def snapshot_merge_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_merge_a(spark, folder, null_policy="overwrite"))


@query("snapshot_merge_broadcast")
def snapshot_merge_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_merge_a(spark, folder, strategy="broadcast_delta"))


@query("snapshot_merge_broadcast_overwrite")
def snapshot_merge_broadcast_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_merge_a(spark, folder, strategy="broadcast_delta", null_policy="overwrite"))


@query("snapshot_merge_skewed")
def snapshot_merge_skewed(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as an old snapshot in which a third of the rows hold one key, merged with two joins."""
    latest = _latest(feed_b(spark, folder), SPEC_B, B_START, B_END)
    merged = merge_snapshot(
        skewed_b(spark, folder), latest, SPEC_B.primary_keys, SPEC_B.columns, strategy="split"
    )
    return plain(merged)


@query("snapshot_merge_composite")
def snapshot_merge_composite(spark: SparkSession, folder: str) -> DataFrame:
    """The state of mid-month, brought to the end of the month."""
    feed = feed_a(spark, folder)
    keys, columns = SPEC_A2.primary_keys, SPEC_A2.columns
    none = empty_frame(spark, SPEC_A2.schema)
    first = _latest(feed, SPEC_A2, A_START, A_MID)
    mid, _ = store(merge_snapshot(none, first, keys, columns), "mid")
    return plain(merge_snapshot(mid, _latest(feed, SPEC_A2, A_MID, A_END), keys, columns))


@query("snapshot_chain")
def snapshot_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs on feed B, the second starting from the day the first ended on."""
    feed = feed_b(spark, folder)
    keys, columns = SPEC_B.primary_keys, SPEC_B.columns
    first = _latest(feed, SPEC_B, B_START, B_MID)
    mid, _ = store(merge_snapshot(previous_b(spark, folder), first, keys, columns), "mid")
    return plain(merge_snapshot(mid, _latest(feed, SPEC_B, B_MID, B_END), keys, columns))


@query("snapshot_late_bootstrap")
def snapshot_late_bootstrap(spark: SparkSession, folder: str) -> DataFrame:
    """No table yet and a date past the start: load rows come before every change."""
    feed = load_a(spark, folder).unionByName(feed_a(spark, folder))
    latest = _latest(feed, SPEC_A, A_START, A_END, with_load=True)
    none = empty_frame(spark, SPEC_A.schema)
    return plain(merge_snapshot(none, latest, SPEC_A.primary_keys, SPEC_A.columns))


@query("snapshot_late_bootstrap_restamped")
def snapshot_late_bootstrap_restamped(spark: SparkSession, folder: str) -> DataFrame:
    """The same with load rows stamped by the run date, which beat older changes."""
    feed = load_a(spark, folder).unionByName(feed_a(spark, folder))
    window = RunWindow(A_END, None, A_START, True)
    options = RunOptions(load_rank="processing_date")
    latest = latest_in_window(feed, SPEC_A, window, options=options)
    none = empty_frame(spark, SPEC_A.schema)
    return plain(merge_snapshot(none, latest, SPEC_A.primary_keys, SPEC_A.columns))


@query("load_or_empty")
def load_or_empty_merge(spark: SparkSession, folder: str) -> DataFrame:
    """A merge onto a previous snapshot whose path does not exist."""
    old = load_or_empty(spark, scratch_path(spark, "missing"), SPEC_A.schema)
    latest = _latest_a(spark, folder)
    return plain(merge_snapshot(old, latest, SPEC_A.primary_keys, SPEC_A.columns))


# Date partitions


def _partition_a(spark: SparkSession, folder: str, day: date) -> DataFrame:
    return partition_rows(
        _latest(feed_a(spark, folder), SPEC_A, A_START, day), SPEC_A.partition_date, day
    )


def _partition_after(spark: SparkSession, folder: str, day: date) -> DataFrame:
    """A day's partition, merged from customers already in it and the day's changes."""
    old = previous_a(spark, folder, day).withColumn(PARTITION, F.lit(day))
    columns = SPEC_A.snapshot_schema(PARTITIONED).fieldNames()
    return merge_snapshot(old, _partition_a(spark, folder, day), SPEC_A.primary_keys, columns)


@query("partition_snapshot")
def partition_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_partition_a(spark, folder, A_END).select(OP, *SPEC_A.columns, PARTITION))


@query("partition_merge")
def partition_merge(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_partition_after(spark, folder, A_END))


def _two_days(spark: SparkSession, folder: str, label: str) -> Target:
    """A table holding customers in both of two days."""
    target = _target(spark, label)
    days = F.explode(F.array(F.lit(A_MID), F.lit(A_END)))
    old = previous_a(spark, folder).withColumn(PARTITION, days)
    write_table(old, target, partition_keys=[PARTITION])
    return target


@query("partition_overwrite")
def partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Two days published; the second merged with its changes and published again."""
    target = _two_days(spark, folder, "partition_overwrite")
    old = spark.table(target.table).where(F.col(PARTITION) == F.lit(A_END))
    columns = SPEC_A.snapshot_schema(PARTITIONED).fieldNames()
    delta = _partition_a(spark, folder, A_END)
    merged = merge_snapshot(old, delta, SPEC_A.primary_keys, columns)
    publish_partition(merged, target, A_END)
    return plain(spark.table(target.table))


@query("partition_overwrite_dynamic")
def partition_overwrite_dynamic(spark: SparkSession, folder: str) -> DataFrame:
    """Only the partitions that occur in the written frame are replaced."""
    target = _two_days(spark, folder, "partition_dynamic")
    rows = _partition_a(spark, folder, A_MID).select(*SPEC_A.columns, PARTITION)
    overwrite_partitions(rows, target)
    return plain(spark.table(target.table))


@query("schema_overwrite_dynamic")
def schema_overwrite_dynamic(spark: SparkSession, folder: str) -> DataFrame:
    """Two days, then one day whole under other columns, in a session whose overwrites are dynamic."""
    target = _two_days(spark, folder, "schema_dynamic")
    session = spark.newSession()
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    more = previous_a(session, folder).select("*", F.lit(1).alias("more"), F.lit(A_END).alias(PARTITION))
    write_table(more, target, WHOLE, partition_keys=[PARTITION])
    spark.catalog.refreshTable(target.table)
    return plain(spark.table(target.table))


@query("partition_files")
def partition_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a small day after each of three publications."""
    target = _two_days(spark, folder, "partition_files")
    counts = None
    for n in (1, 2, 3):
        publish_partition(_partition_after(spark, folder, A_END), target, A_END)
        day = spark.table(target.table).where(F.col(PARTITION) == F.lit(A_END))
        files = day.select(F.col("_metadata.file_path").alias("file")).distinct()
        # counted and stored now, since the next publication replaces the files
        row, _ = store(files.agg(F.lit(n).alias("publication"), F.count(F.lit(1)).alias("files")), "files")
        counts = row if counts is None else counts.unionByName(row)
    return counts


@query("max_records")
def max_records(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the largest file and of all files, of a whole write and of a day published again, when a
    file may hold a hundredth of all rows."""
    rows = feed_a(spark, folder).select(*SPEC_A.columns, F.col("event_date").alias(PARTITION))
    most = max(1, rows.count() // 100)
    flat = replace(_target(spark, "records_flat"), max_records_per_file=most)
    overwrite_table(rows.drop(PARTITION), flat)
    daily = replace(_target(spark, "records_daily"), max_records_per_file=most)
    write_table(rows, daily, partition_keys=[PARTITION])
    publish_partition(rows.where(F.col(PARTITION) == F.lit(A_END)), daily, A_END)
    sizes = [
        spark.table(target.table)
        .groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.lit(kind).alias("kind"), F.max("n").alias("largest"), F.sum("n").alias("n_rows"))
        for kind, target in (("whole", flat), ("daily", daily))
    ]
    return sizes[0].unionByName(sizes[1])


# Publication and whole runs


def _publish_twice(spark: SparkSession, folder: str, label: str) -> Target:
    target = _target(spark, label)
    publish_version(previous_a(spark, folder), target, A_START)
    old = version_as_of(spark, target, A_START, SPEC_A.schema)
    latest = _latest_a(spark, folder)
    publish_version(
        merge_snapshot(old, latest, SPEC_A.primary_keys, SPEC_A.columns), target, A_END
    )
    return target


@query("versioned_publish")
def versioned_publish(spark: SparkSession, folder: str) -> DataFrame:
    return plain(spark.table(_publish_twice(spark, folder, "versioned").table))


def _cut_off(df: DataFrame, target: Target, day: date, mode: str) -> None:
    """What a driver leaves that dies when its files are complete, before the catalog shows them."""
    spark = df.sparkSession
    keys = [PARTITION] if mode == PARTITIONED else None
    path = target.root if keys else target.version_path(day)
    begin(spark, target, df.schema, path, keys)
    write_files(df, path, target, keys)
    note(spark, target, WRITTEN, publication(target, df.schema, path, keys, None))


@query("publish_after_crash")
def publish_after_crash(spark: SparkSession, folder: str) -> DataFrame:
    """First publications of both kinds that were cut off, each finished by the run after it: the rows that
    the finished table showed, and those after the run."""
    spec = _exported(spark, folder)
    first = {FLAT: previous_a(spark, folder)}
    first[PARTITIONED] = first[FLAT].withColumn(PARTITION, F.lit(A_MID))
    counts = None
    for mode, rows in first.items():
        target = _target(spark, f"cut_off_{mode}")
        _cut_off(rows, target, A_MID, mode)
        resumed = resume(spark, target, mode)
        shown, _ = store(spark.table(target.table).select(*SPEC_A.columns), "shown")
        run_snapshot(spark, spec, A_END, target, mode)
        for step, found in (("finished", shown), ("run", spark.table(target.table).select(*SPEC_A.columns))):
            row = found.select(F.lit(mode).alias("mode"), F.lit(step).alias("step"), F.lit(str(resumed)).alias("resumed"), "*")
            counts = row if counts is None else counts.unionByName(row)
    return plain(counts)


@query("version_as_of")
def version_as_of_first(spark: SparkSession, folder: str) -> DataFrame:
    target = _publish_twice(spark, folder, "versioned")
    return plain(version_as_of(spark, target, A_START, SPEC_A.schema))


@query("versions_side_by_side")
def versions_side_by_side(spark: SparkSession, folder: str) -> DataFrame:
    target = _publish_twice(spark, folder, "versioned")
    rows = all_versions(spark, target, SPEC_A.schema)
    return plain(rows.groupBy("version").agg(F.count(F.lit(1)).alias("n_rows")))


def _exported(spark: SparkSession, folder: str) -> FeedSpec:
    both = feed_a(spark, folder).unionByName(load_a(spark, folder))
    return replace(SPEC_A, path=export_files(both, SPEC_A))


@query("run_flat")
def run_flat(spark: SparkSession, folder: str) -> DataFrame:
    """Load and changes from files, published on the first, a middle and the last day,
    the last one twice."""
    spec, target = _exported(spark, folder), _target(spark, "run_flat")
    for day in (A_START, A_MID, A_END, A_END):
        run_snapshot(spark, spec, day, target)
    return plain(spark.table(target.table))


def _run_ledger(spark: SparkSession, folder: str) -> Target:
    """The same runs with a ledger, the last day twice more."""
    spec, target = _exported(spark, folder), _target(spark, "run_ledger")
    for day in (A_START, A_MID, A_END, A_END, A_END):
        run_snapshot(spark, spec, day, target, options=RunOptions(ledger=True))
    return target


@query("run_flat_ledger")
def run_flat_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return plain(spark.table(_run_ledger(spark, folder).table))


@query("feed_ledger")
def feed_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The days whose files each run took in: none twice, and none by the repeated runs."""
    entries = read_ledger(spark, _run_ledger(spark, folder))
    return plain(entries.select("as_of", "file_date", "first_day", "last_day").distinct())


@query("run_flat_bucketed")
def run_flat_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a table bucketed by its key and merges that keep the buckets."""
    return plain(spark.table(_run_bucketed(spark, folder).table))


def _run_bucketed(spark: SparkSession, folder: str) -> Target:
    spec = _exported(spark, folder)
    target = replace(_target(spark, "run_bucketed"), buckets=8)
    for day in (A_START, A_MID, A_END, A_END):
        run_snapshot(spark, spec, day, target)
    return target


@query("bucket_files")
def bucket_files(spark: SparkSession, folder: str) -> DataFrame:
    """Buckets of the last version and the most files that one of them has."""
    name = F.col("_metadata.file_name")
    bucket = F.regexp_extract(name, r"_(\d{5})\.c", 1).alias("bucket")
    files = spark.table(_run_bucketed(spark, folder).table).select(bucket, name.alias("file")).distinct()
    counted = files.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.count(F.lit(1)).alias("buckets"), F.max("n").alias("most_files"))


@query("run_partitioned")
def run_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """The partitions of a middle and the last day, the last one published twice."""
    spec, target = _exported(spark, folder), _target(spark, "run_partitioned")
    for day in (A_MID, A_END, A_END):
        run_snapshot(spark, spec, day, target, PARTITIONED)
    return plain(spark.table(target.table))


@query("job_run")
def job_run(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs by the command line's arguments and a file of feed settings."""
    spec, target = _exported(spark, folder), _target(spark, "job")
    settings = {
        "path": spec.path,
        "primary_keys": list(spec.primary_keys),
        "cdc_start_date": str(spec.cdc_start_date),
        "schema": spec.schema.simpleString().removeprefix("struct<").removesuffix(">"),
    }
    feeds = scratch_path(spark, "feeds")
    write_text(spark, f"{feeds}/feeds.json", json.dumps({"users": settings}))
    common = ["--feeds", f"{feeds}/feeds.json", "--input-table", "users", "--null-policy", "overwrite"]
    common += ["--output-table", target.table, "--output-root", target.root]
    for day in (A_MID, A_END):
        job.main([*common, "--processing-date", str(day)], spark)
    return plain(spark.table(target.table))


@query("run_report")
def run_report(spark: SparkSession, folder: str) -> DataFrame:
    """The log of four flat and two partitioned runs over exported files."""
    spec, log = _exported(spark, folder), scratch_path(spark, "log")
    runs = {FLAT: (A_START, A_MID, A_END, A_END), PARTITIONED: (A_MID, A_END)}
    for mode, days in runs.items():
        target = _target(spark, f"logged_{mode}")
        for day in days:
            run_logged(spark, spec, day, target, mode, log=log)
    wanted = ["mode", "as_of", "status", "last_date", "with_load", *COUNTS, *EFFECTS]
    return plain(read_log(spark, log).select(*wanted).withColumn("with_load", F.col("with_load").cast("int")))


@query("refused_runs")
def refused_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The log of runs and writes that are refused before any work, and the rows of the table after them."""
    spec, log = _exported(spark, folder), scratch_path(spark, "log")
    target = _target(spark, "refusing")
    run_snapshot(spark, spec, A_MID, target)
    attempts = [
        (spec, "2023-12-31", FLAT),
        (spec, str(A_START), FLAT),
        (spec, "15.01.2024", FLAT),
        (spec, str(A_END), PARTITIONED),
        (replace(spec, partition_date=None), str(A_END), PARTITIONED),
        (spec, str(A_END), "hourly"),
    ]
    for of, day, mode in attempts:
        with suppress(ValueError):
            run_logged(spark, of, day, target, mode, log=log)
    with suppress(ValueError), logged(spark, log, target.table, "write", A_END):
        write_table(spark.table(target.table), target, version=str(A_END), partition_keys=["event_date"])
    n_rows = F.lit(spark.table(target.table).count()).alias("n_rows")
    refused = read_log(spark, log).select("mode", "as_of", "status", "reason")
    # the table's name and folder differ from run to run
    named = F.replace(F.col("reason"), F.lit(target.table), F.lit("table"))
    return refused.withColumn("reason", named).select("*", n_rows)


BACKFILL = [A_START, date(2024, 1, 8), A_MID, date(2024, 1, 22), A_END]


def _backfill(spark: SparkSession, folder: str, **how: str) -> DataFrame:
    spec, target = _exported(spark, folder), _target(spark, "backfill")
    run_backfill(spark, spec, BACKFILL, target, RunOptions(**how))
    return plain(all_versions(spark, target, spec.schema))


@query("backfill")
def backfill(spark: SparkSession, folder: str) -> DataFrame:
    """Five versions of feed A in one pass over its files, as single runs would publish them."""
    return _backfill(spark, folder)


@query("backfill_overwrite")
def backfill_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    return _backfill(spark, folder, null_policy="overwrite")


@query("build_without_publishing")
def build_without_publishing(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot of the last day from files, as a frame."""
    return plain(
        build_snapshot(spark, _exported(spark, folder), A_END, _target(spark, "unpublished"))
    )


# Catalog state


@query("table_state")
def table_state(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a table exists before and after its publication, and its rows."""
    target = _target(spark, "state")
    before = table_exists(spark, target.table)
    publish_version(_merge_a(spark, folder), target, A_END)
    after = table_exists(spark, target.table)
    return spark.table(target.table).agg(
        F.lit(int(before)).alias("existed_before"),
        F.lit(int(after)).alias("exists_after"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def _daily(spark: SparkSession, folder: str, label: str) -> Target:
    """All events of feed A, one partition per day."""
    target = _target(spark, label)
    rows = feed_a(spark, folder).select(*SPEC_A.columns, F.col("event_date").alias(PARTITION))
    write_table(rows, target, partition_keys=[PARTITION])
    return target


@query("partition_list")
def partition_list(spark: SparkSession, folder: str) -> DataFrame:
    return partitions(spark, _daily(spark, folder, "daily").table)


@query("last_partition")
def last_partition_date(spark: SparkSession, folder: str) -> DataFrame:
    target = _daily(spark, folder, "daily")
    day = str(last_partition(spark, target.table))
    return spark.table(target.table).agg(
        F.lit(day).alias("last_partition"), F.count(F.lit(1)).alias("n_rows")
    )


@query("current_version")
def current_version_date(spark: SparkSession, folder: str) -> DataFrame:
    target = _publish_twice(spark, folder, "versioned")
    day = str(current_version(spark, target.table))
    return spark.table(target.table).agg(
        F.lit(day).alias("current_version"), F.count(F.lit(1)).alias("n_rows")
    )
