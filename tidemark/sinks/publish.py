"""Publishing a snapshot so that no failure leaves a table without its data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.files import matching, remove
from tidemark.sinks.record import STAGING, WRITTEN, clear, pending, record_folder, staging_root
from tidemark.sinks.tables import (
    begin,
    move_back,
    overwrite_table,
    point_table,
    release_days,
    rewrite_table,
    same_folder,
    show,
    show_day,
    write_day,
    write_versions,
)
from tidemark.sources.catalog import current_version, describe, last_partition, table_exists
from tidemark.spec import FLAT, PARTITION, VERSION, Target


def publish_version(df: DataFrame, target: Target, version: date) -> None:
    """Publish a flat snapshot as `version=D` and point the table at it.

    A new version is written in one go, into a folder that nothing refers to yet.
    Repeating the current version replaces the very files that are being read, so it
    goes through a staged copy."""
    finish_publication(df.sparkSession, target)
    refuse_unknown_files(df.sparkSession, target, "version=*")
    again = current_version(df.sparkSession, target.table) == version
    (rewrite_table if again else overwrite_table)(df, target, str(version))


def publish_versions(df: DataFrame, target: Target, versions: Sequence[date]) -> None:
    """Publish several snapshots, told apart by the column `version`, and point the table at the last one.

    All of them are later than the current one, so they go into folders that nothing refers to yet. Until the
    table moves, a publication that stops is cleared as a whole."""
    spark = df.sparkSession
    finish_publication(spark, target)
    refuse_unknown_files(spark, target, "version=*")
    current = current_version(spark, target.table)
    if current is not None and versions[0] <= current:
        raise ValueError(f"version {versions[0]} is not later than the current one, {current}")
    schema = df.drop(VERSION).schema
    *others, last = [target.version_path(version) for version in versions]
    begin(spark, target, schema, last, also=others)
    write_versions(df, target, [str(version) for version in versions])
    show(spark, target, schema, last)


def refuse_unknown_files(spark: SparkSession, target: Target, pattern: str) -> None:
    """Refuse to replace data below the root while the catalog has no such table: it may
    belong to another catalog, as after a session whose catalog was kept in memory only."""
    if table_exists(spark, target.table):
        return
    found = matching(spark, f"{target.root}/{pattern}")
    if found:
        raise ValueError(
            f"{target.table} is not in the catalog, yet {target.root} holds {found[0].rsplit('/', 1)[1]}; "
            "register that data or choose another root"
        )


def finish_publication(spark: SparkSession, target: Target) -> str | None:
    """Finish what the record announces: show a folder that is complete, remove one that is not.

    Returns the folder that the table now shows, if there was one to finish. A record
    made before the table was made anew by other means is dropped, not replayed."""
    found = pending(spark, target)
    if found is None:
        return None
    state, made = found
    entry = describe(spark, target.table)
    location = (entry or {}).get("location")
    ours = entry is None or entry["created_time"] == made.before or same_folder(location, made.path)
    shown = None
    if state == WRITTEN and ours:
        point_table(spark, made.of(target), made.columns, made.path, made.partition_keys or None)
        shown = made.path
    elif state != WRITTEN:
        for folder in (made.path, *made.also):
            if not _inside(location, folder):
                remove(spark, folder)
    clear(spark, target)
    _release_copies(spark, target)
    return shown


def _inside(location: str | None, folder: str) -> bool:
    """Whether what the table shows lies in the folder, at any depth."""
    while location:
        if same_folder(location, folder):
            return True
        location = location.rstrip("/").rpartition("/")[0]
    return False


def _release_copies(spark: SparkSession, target: Target) -> None:
    """Remove staged copies that no entry shows."""
    location = (describe(spark, target.table) or {}).get("location")
    for copy in matching(spark, f"{staging_root(target)}/*"):
        if not same_folder(copy, record_folder(target)) and not _inside(location, copy):
            remove(spark, copy)


def resume_rewrite(spark: SparkSession, target: Target) -> str | None:
    """Finish a rewrite that was cut off while the table showed its staged copy, so that its
    own folder is whole for time travel too. Returns that folder."""
    entry = describe(spark, target.table)
    location = (entry or {}).get("location") or ""
    if f"/{STAGING}/" not in location:
        return None
    keys = entry.get("partition_columns")
    name = location.rstrip("/").rpartition("/")[2]
    path = f"{target.root}/{name}" if name.startswith("version=") else target.root
    rows = spark.read.load(location, format=target.fmt, schema=spark.table(target.table).schema)
    move_back(rows, target, location, path, keys)
    return path


def resume_version(spark: SparkSession, target: Target) -> date | None:
    """Finish a cut-off publication of a flat table; its version, if there was one."""
    shown = finish_publication(spark, target)
    if not table_exists(spark, target.table):
        return None
    version = current_version(spark, target.table)  # refuses tables of the other kind
    return version if resume_rewrite(spark, target) or shown else None


def publish_partition(df: DataFrame, target: Target, day: date) -> None:
    """Publish one date partition; other partitions are left alone.

    The day is written once, into a folder of its own, which the partition then shows in one
    step of the catalog. So `df` may read the day it replaces, a day without rows reads
    empty, and until that step, or if it never comes, the old rows are shown."""
    spark = df.sparkSession
    finish_publication(spark, target)
    if not table_exists(spark, target.table):
        refuse_unknown_files(spark, target, f"{PARTITION}=*")
        overwrite_table(df, target, partition_keys=[PARTITION])
        return
    last_partition(spark, target.table)  # refuses tables of the other kind
    path = write_day(df, target, PARTITION, str(day))
    show_day(spark, target, PARTITION, str(day), path)
    release_days(spark, target, PARTITION, str(day), keep=path)


def resume_partitions(spark: SparkSession, target: Target) -> date | None:
    """Finish a cut-off publication of a partitioned table as a whole; its last day, if there was
    one. A day's own publication needs no finishing."""
    shown = finish_publication(spark, target)
    if not table_exists(spark, target.table):
        return None
    last = last_partition(spark, target.table)  # refuses tables of the other kind
    return last if resume_rewrite(spark, target) or shown else None


def resume(spark: SparkSession, target: Target, mode: str) -> date | None:
    """Finish what an earlier run left half done; the date concerned, if any."""
    return (resume_version if mode == FLAT else resume_partitions)(spark, target)


def publish(df: DataFrame, target: Target, day: date, mode: str) -> None:
    (publish_version if mode == FLAT else publish_partition)(df, target, day)
