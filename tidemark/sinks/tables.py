"""Writing external catalog tables: whole, by version, or some of their partitions."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.files import matching, remove
from tidemark.functions.frames import empty_frame
from tidemark.functions.names import cols, quoted
from tidemark.scratch import on_release, release, scratch_path, store
from tidemark.sinks.record import (
    STAGING,
    WRITING,
    WRITTEN,
    clear,
    note,
    publication,
    staging_root,
)
from tidemark.sources.catalog import describe, table_exists
from tidemark.spec import VERSION, Target

# Below a table's root: a folder for each publication of a partition. Readers of the root by path
# see none of them, the catalog says which one counts.
DAYS = "_days"

# What a write replaces in a table that exists.
PARTITIONS, WHOLE = "partitions", "whole"


def new_staging_path(target: Target) -> str:
    return f"{staging_root(target)}/{uuid4().hex}"


def sized_by_partition(df: DataFrame, partition_keys: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together before writing: one file for a small one.

    A rebalance, unlike a repartition, lets adaptive execution split a large partition
    over many tasks; without adaptive execution the rows stay where they are."""
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return df
    return df.hint("rebalance", *cols(partition_keys))


def in_buckets(df: DataFrame, target: Target) -> DataFrame:
    """Bring the rows of a bucket together before writing: one file a bucket and version."""
    return df.repartition(target.buckets, *cols(target.bucket_keys))


def write_files(
    df: DataFrame, path: str, target: Target, partition_keys: Sequence[str] | None = None
) -> None:
    """Replace the contents of a folder."""
    if partition_keys:
        df = sized_by_partition(df, partition_keys)
    # Static whatever the session says: partitions that are not written must go.
    writer = df.write.format(target.fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if target.max_records_per_file:
        writer = writer.option("maxRecordsPerFile", target.max_records_per_file)
    if partition_keys:
        writer = writer.partitionBy(*partition_keys)
    if not target.buckets:
        writer.save(path)
        return
    # Only table writes can bucket; dropping the helper table leaves the files. It lives in
    # the target's database, where the caller may create tables anyway.
    database, _, _ = target.table.rpartition(".")
    helper = f"{database}.tidemark_{uuid4().hex}".lstrip(".")
    writer = writer.bucketBy(target.buckets, *target.bucket_keys).option("path", path)
    try:
        writer.saveAsTable(helper)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {helper}")


def store_in_buckets(df: DataFrame, target: Target, label: str) -> DataFrame:
    """Store an intermediate table in the buckets of the target, so that a join of the two moves neither.

    Only the catalog knows buckets, so it gets a helper table, which goes with the scratch that owns it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    database, _, _ = target.table.rpartition(".")
    helper = f"{database}.tidemark_{uuid4().hex}".lstrip(".")
    on_release(lambda: spark.sql(f"DROP TABLE IF EXISTS {helper}"))
    writer = in_buckets(df, target).write.format("parquet").option("path", path)
    writer.bucketBy(target.buckets, *target.bucket_keys).saveAsTable(helper)
    return spark.table(helper)


def stage(
    df: DataFrame, target: Target, path: str, partition_keys: Sequence[str] | None = None
) -> DataFrame:
    """Materialise a result that depends on what is about to be replaced."""
    write_files(df, path, target, partition_keys)
    return df.sparkSession.read.load(path, format=target.fmt, schema=df.schema)


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def point_table(
    spark: SparkSession,
    target: Target,
    schema: T.StructType,
    path: str,
    partition_keys: Sequence[str] | None = None,
) -> None:
    """Make the table show the files below `path`.

    With the same columns only the location moves. A new schema replaces the entry of
    an external table, whose files stay; managed tables, which would lose them, are
    refused."""
    entry = describe(spark, target.table)
    if entry is not None:
        if entry.get("type") != "EXTERNAL":
            raise ValueError(f"{target.table} is not an external table")
        same = (
            not partition_keys
            and not entry.get("partition_columns")
            and entry.get("provider") == target.fmt
            and entry.get("num_buckets") == target.buckets
            and tuple(entry.get("bucket_columns") or ()) == target.bucket_keys
            and _shape(spark.table(target.table).schema) == _shape(schema)
        )
        if same:
            spark.sql(f"ALTER TABLE {target.table} SET LOCATION {_text(path)}")
            spark.catalog.refreshTable(target.table)
            return
        spark.sql(f"DROP TABLE {target.table}")
    create_entry(spark, target, schema, path, partition_keys)


def create_entry(
    spark: SparkSession,
    target: Target,
    schema: T.StructType,
    path: str,
    partition_keys: Sequence[str] | None = None,
) -> None:
    """Make a catalog entry for the files below `path`, with the partitions found there."""
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    by = f"PARTITIONED BY ({', '.join(map(quoted, partition_keys))})" if partition_keys else ""
    if target.buckets:
        names = ", ".join(map(quoted, target.bucket_keys))
        by += f" CLUSTERED BY ({names}) INTO {target.buckets} BUCKETS"
    spark.sql(
        f"CREATE TABLE {target.table} ({nullable.toDDL()}) USING {target.fmt} {by} "
        f"LOCATION {_text(path)}"
    )
    if partition_keys:
        spark.sql(f"ALTER TABLE {target.table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(target.table)


def write_versions(df: DataFrame, target: Target, versions: Sequence[str]) -> None:
    """Write the rows of several versions, told apart by their column, each into its folder.

    Other versions below the root stay. One without rows gets a folder without rows."""
    spark = df.sparkSession
    payload = df.drop(VERSION)
    if target.buckets:  # only a write of its own can put a version into buckets
        stored, _ = store(df, "versions")
        for version in versions:
            rows = stored.where(F.col(VERSION) == F.lit(version).cast("date")).drop(VERSION)
            write_files(in_buckets(rows, target), target.version_path(version), target)
        return
    writer = sized_by_partition(df, [VERSION]).write.format(target.fmt).mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(VERSION)
    if target.max_records_per_file:
        writer = writer.option("maxRecordsPerFile", target.max_records_per_file)
    writer.save(target.root)
    for version in versions:
        if not matching(spark, target.version_path(version)):
            write_files(empty_frame(spark, payload.schema), target.version_path(version), target)


def begin(
    spark: SparkSession,
    target: Target,
    schema: T.StructType,
    path: str,
    partition_keys: Sequence[str] | None = None,
    also: Sequence[str] = (),
) -> None:
    """Announce that the folder, and others with it, is about to be written."""
    before = (describe(spark, target.table) or {}).get("created_time")
    note(spark, target, WRITING, publication(target, schema, path, partition_keys, before, also))


def show(
    spark: SparkSession,
    target: Target,
    schema: T.StructType,
    path: str,
    partition_keys: Sequence[str] | None = None,
) -> None:
    """Make the table show a complete folder, so that a run that dies on the way can be finished."""
    before = (describe(spark, target.table) or {}).get("created_time")
    note(spark, target, WRITTEN, publication(target, schema, path, partition_keys, before))
    point_table(spark, target, schema, path, partition_keys)
    clear(spark, target)


def _keys_last(df: DataFrame, partition_keys: Sequence[str] | None) -> DataFrame:
    payload = [name for name in df.columns if name not in set(partition_keys or ())]
    return df.select(*cols(payload), *cols(partition_keys or ()))


def overwrite_table(
    df: DataFrame,
    target: Target,
    version: str | None = None,
    partition_keys: Sequence[str] | None = None,
) -> None:
    """Write a frame whole and make the table show it, schema included.

    The files are complete before the catalog changes, so a failed write leaves the table
    as it was; a folder that the table already shows is rewritten through a staged copy.
    `df` must not read the folder that is written."""
    path = target.version_path(version) if version else target.root
    entry = describe(df.sparkSession, target.table)
    if entry is not None and same_folder(entry.get("location"), path):
        rewrite_table(df, target, version, partition_keys)
        return
    df = _keys_last(df, partition_keys)
    begin(df.sparkSession, target, df.schema, path, partition_keys)
    write_files(df, path, target, partition_keys)
    show(df.sparkSession, target, df.schema, path, partition_keys)


def same_folder(location: str | None, path: str) -> bool:
    """Whether a catalog location is the folder: schemes may be spelled file:/ or left out."""
    plain = lambda p: p.removeprefix("file:").replace("///", "/").rstrip("/")
    return location is not None and plain(location) == plain(path)


def rewrite_table(
    df: DataFrame,
    target: Target,
    version: str | None = None,
    partition_keys: Sequence[str] | None = None,
) -> None:
    """The same for a folder that the table already shows and that `df` may read.

    The rows are staged, and the table shows the staged copy until its own folder is
    complete again: whenever this stops, the table is whole and it can be repeated."""
    spark = df.sparkSession
    path = target.version_path(version) if version else target.root
    df = _keys_last(df, partition_keys)
    copy = f"{new_staging_path(target)}/{path.rsplit('/', 1)[1]}"
    begin(spark, target, df.schema, copy, partition_keys)
    rows = stage(df, target, copy, partition_keys)
    show(spark, target, df.schema, copy, partition_keys)
    move_back(rows, target, copy, path, partition_keys)


def move_back(
    rows: DataFrame,
    target: Target,
    copy: str,
    path: str,
    partition_keys: Sequence[str] | None = None,
) -> None:
    """Rewrite a table's own folder from the staged copy it shows, then show the folder."""
    if target.buckets:
        rows = in_buckets(rows, target)  # read as plain files, which know no buckets
    write_files(rows, path, target, partition_keys)
    show(rows.sparkSession, target, rows.schema, path, partition_keys)
    release(rows.sparkSession, copy.rsplit("/", 1)[0])


def in_table_order(df: DataFrame, spark: SparkSession, table: str) -> DataFrame:
    """Columns by name in the table's order, since inserts go by position."""
    wanted = spark.table(table).columns
    extra = {c.lower() for c in df.columns} - {c.lower() for c in wanted}
    if extra:
        raise ValueError(f"{table} has no column {', '.join(sorted(extra))}")
    return df.select(*cols(wanted))


def _inserting_session(spark: SparkSession, target: Target, **settings: str) -> SparkSession:
    """A sibling session for one insert, with the caller's runtime settings and catalog.
    Inserts take the overwrite mode and the file size limit from the session only; the
    caller's own settings are left as they are."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and session.conf.isModifiable(name):
            session.conf.set(name, value)
    session.catalog.setCurrentCatalog(spark.catalog.currentCatalog())
    session.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    if target.max_records_per_file:
        session.conf.set("spark.sql.files.maxRecordsPerFile", target.max_records_per_file)
    for name, value in settings.items():
        session.conf.set(f"spark.sql.sources.{name}", value)
    return session


def write_day(df: DataFrame, target: Target, key: str, value: str) -> str:
    """Write the rows of one partition into a folder of its own, which nothing refers to yet."""
    rows = sized_by_partition(in_table_order(df, df.sparkSession, target.table).drop(key), ())
    path = f"{target.root}/{DAYS}/{key}={value}-{uuid4().hex}"
    write_files(rows, path, target)
    return path


def show_day(spark: SparkSession, target: Target, key: str, value: str, path: str) -> None:
    """Make a partition show a folder, in one step of the catalog; a new partition is added with it."""
    part = f"PARTITION ({quoted(key)} = {_text(value)})"
    spark.sql(f"ALTER TABLE {target.table} ADD IF NOT EXISTS {part} LOCATION {_text(path)}")
    spark.sql(f"ALTER TABLE {target.table} {part} SET LOCATION {_text(path)}")
    spark.catalog.refreshTable(target.table)


def release_days(spark: SparkSession, target: Target, key: str, value: str, keep: str) -> None:
    """Remove the folders that a partition showed before, and those that a crash left behind."""
    for old in matching(spark, f"{target.root}/{DAYS}/{key}={value}-*"):
        if not same_folder(old, keep):
            remove(spark, old)
    remove(spark, f"{target.root}/{key}={value}")


def overwrite_partitions(df: DataFrame, target: Target) -> None:
    """Replace exactly the partitions that occur in `df`, keep all others.

    Always staged: `df` may read the partitions it replaces."""
    spark = df.sparkSession
    path = new_staging_path(target)
    ordered = in_table_order(df, spark, target.table)
    stage(ordered, target, path)
    session = _inserting_session(spark, target, partitionOverwriteMode="dynamic")
    rows = session.read.load(path, format=target.fmt, schema=ordered.schema)
    keys = describe(session, target.table)["partition_columns"]
    sized_by_partition(rows, keys).write.insertInto(target.table, overwrite=True)
    spark.catalog.refreshTable(target.table)
    release(spark, path)


def write_table(
    df: DataFrame,
    target: Target,
    mode: str = PARTITIONS,
    version: str | None = None,
    partition_keys: Sequence[str] | None = None,
) -> None:
    """Write a frame into a table that may not exist yet.

    mode  partitions: replace the partitions that occur in the frame, keep the others;
          whole: replace everything, columns included

    Either way the frame may read what it replaces. A table that is not there is created."""
    if mode not in (PARTITIONS, WHOLE):
        raise ValueError(f"mode must be {PARTITIONS!r} or {WHOLE!r}, not {mode!r}")
    if version and partition_keys and mode == PARTITIONS:
        raise ValueError("versions of a partitioned table can only be written whole")
    exists = table_exists(df.sparkSession, target.table)
    if exists and mode == PARTITIONS:
        overwrite_partitions(df, target)
    elif exists:
        rewrite_table(df, target, version, partition_keys)
    else:
        overwrite_table(df, target, version, partition_keys)
