"""Publication: what readers see after each step, and after a failure at any of them."""

from __future__ import annotations

import os
import time
from dataclasses import replace
from datetime import date
from pathlib import Path
from uuid import uuid4

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.sinks import publish as publishing
from tidemark.sinks import tables
from tidemark.sinks.publish import (
    finish_publication,
    publish_partition,
    publish_version,
    resume,
    resume_version,
)
from tidemark.sinks.record import pending, record_folder, staging_root
from tidemark.sinks.tables import (
    DAYS,
    WHOLE,
    overwrite_partitions,
    overwrite_table,
    write_table,
)
from tidemark.sources.catalog import (
    current_version,
    describe,
    last_partition,
    partitions,
    table_exists,
)
from tidemark.sources.snapshots import all_versions, load_or_empty, version_as_of
from tidemark.spec import Target

D = [date(2021, 3, 5), date(2021, 3, 6), date(2021, 3, 7)]
SCHEMA = T.StructType().add("id", "long").add("name", "string")
DAILY = T.StructType([*SCHEMA.fields, T.StructField("dt", T.DateType())])


def flat(spark, *made):
    return spark.createDataFrame(list(made), SCHEMA)


def daily(spark, *made):
    return spark.createDataFrame(list(made), DAILY)


def shown(spark, target):
    return rows(spark.table(target.table))


def files(path):
    return sorted(Path(path).rglob("part-*"))


class Crash(Exception):
    pass


def crash_at(monkeypatch, module, name, call=1):
    """Make the n-th call of a step fail."""
    step, count = getattr(module, name), [0]

    def failing(*args, **kwargs):
        count[0] += 1
        if count[0] == call:
            raise Crash(name)
        return step(*args, **kwargs)

    monkeypatch.setattr(module, name, failing)


def test_versions_and_time_travel(spark, target):
    publish_version(flat(spark, (1, "a")), target, D[0])
    assert current_version(spark, target.table) == D[0]
    held = version_as_of(spark, target, D[0], SCHEMA)
    publish_version(held.withColumn("name", F.lit("b")), target, D[1])
    assert current_version(spark, target.table) == D[1]
    assert shown(spark, target) == [(1, "b")]
    assert rows(version_as_of(spark, target, "2021-03-05", SCHEMA)) == [(1, "a")]
    assert rows(version_as_of(spark, target, D[2], SCHEMA)) == []
    assert rows(all_versions(spark, target, SCHEMA)) == [(1, "a", D[0]), (1, "b", D[1])]
    assert all_versions(spark, target, SCHEMA).schema["version"].dataType == T.DateType()


def test_same_version_again_from_its_own_rows(spark, target):
    publish_version(flat(spark, (1, "a")), target, D[0])
    for expected in ("aa", "aaaa"):
        own = spark.read.schema(SCHEMA).parquet(target.version_path(D[0]))
        publish_version(own.withColumn("name", F.concat("name", "name")), target, D[0])
        assert shown(spark, target) == [(1, expected)]
        assert rows(version_as_of(spark, target, D[0], SCHEMA)) == [(1, expected)]


@pytest.mark.parametrize(
    "step, call",
    [
        ("begin", 1),
        ("stage", 1),
        ("show", 1),
        ("point_table", 1),
        ("clear", 1),
        ("write_files", 2),
        ("show", 2),
        ("point_table", 2),
        ("clear", 2),
        ("release", 1),
    ],
)
def test_crash_while_repeating_a_version(spark, target, monkeypatch, step, call):
    """Old or new rows are shown after every crash, never none, and a repeat heals."""
    publish_version(flat(spark, (1, "a")), target, D[0])
    new = flat(spark, (1, "b"), (2, "b"))
    with monkeypatch.context() as patch:
        crash_at(patch, tables, step, call)
        with pytest.raises(Crash):
            publish_version(new, target, D[0])
    assert shown(spark, target) in ([(1, "a")], [(1, "b"), (2, "b")])
    assert current_version(spark, target.table) == D[0]
    publish_version(new, target, D[0])
    assert shown(spark, target) == [(1, "b"), (2, "b")]
    assert rows(version_as_of(spark, target, D[0], SCHEMA)) == [(1, "b"), (2, "b")]


def test_rewrite_interrupted_half_way(spark, target, monkeypatch):
    """The version's folder is already gone when the rewrite stops."""
    publish_version(flat(spark, (1, "a")), target, D[0])

    write = tables.write_files

    def torn(df, path, target, partition_keys=None):
        if path != target.version_path(D[0]):
            return write(df, path, target, partition_keys)
        df.where(F.lit(False)).write.mode("overwrite").parquet(path)
        raise Crash("write_files")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_files", torn)
        with pytest.raises(Crash):
            publish_version(flat(spark, (1, "b")), target, D[0])
    assert shown(spark, target) == [(1, "b")]
    assert rows(version_as_of(spark, target, D[0], SCHEMA)) == []
    assert resume_version(spark, target) == D[0]
    assert shown(spark, target) == rows(version_as_of(spark, target, D[0], SCHEMA)) == [(1, "b")]
    assert resume_version(spark, target) is None


@pytest.mark.parametrize("step", ["write_files", "point_table"])
def test_crash_of_a_new_version_leaves_the_old_one(spark, target, monkeypatch, step):
    publish_version(flat(spark, (1, "a")), target, D[0])
    with monkeypatch.context() as patch:
        crash_at(patch, tables, step)
        with pytest.raises(Crash):
            publish_version(flat(spark, (1, "b")), target, D[1])
    assert shown(spark, target) == [(1, "a")]
    assert current_version(spark, target.table) == D[0]
    publish_version(flat(spark, (1, "b")), target, D[1])
    assert shown(spark, target) == [(1, "b")]


def test_failing_rows_leave_the_old_version(spark, target):
    publish_version(flat(spark, (1, "a")), target, D[0])
    broken = flat(spark, (1, "b")).withColumn("name", F.raise_error(F.lit("boom")).cast("string"))
    for version in (D[0], D[1]):
        with pytest.raises(Exception, match="boom"):
            publish_version(broken, target, version)
        assert shown(spark, target) == [(1, "a")]


def test_schema_change_keeps_old_versions(spark, target):
    publish_version(flat(spark, (1, "a")), target, D[0])
    wider = flat(spark, (1, "b")).withColumn("more", F.lit(1.5))
    publish_version(wider, target, D[1])
    assert shown(spark, target) == [(1, "b", 1.5)]
    assert rows(version_as_of(spark, target, D[0], SCHEMA)) == [(1, "a")]
    publish_version(wider.withColumn("more", F.lit("text")), target, D[1])
    assert shown(spark, target) == [(1, "b", "text")]


def test_managed_tables_are_refused(spark, target):
    spark.sql(f"CREATE TABLE {target.table} (id long) USING parquet")
    with pytest.raises(ValueError, match="external"):
        overwrite_table(flat(spark, (1, "a")), target)
    assert table_exists(spark, target.table)


def test_staging_space_is_released(spark, target):
    for _ in range(2):
        publish_version(flat(spark, *[(i, "x" * 100) for i in range(1000)]), target, D[0])
    left = files(tables.staging_root(target))
    assert not left


def two_days(spark, target):
    publish_partition(daily(spark, (1, "a", D[0]), (2, "a", D[0])), target, D[0])
    publish_partition(daily(spark, (3, "a", D[1])), target, D[1])


def test_partition_overwrite_keeps_the_others(spark, target):
    two_days(spark, target)
    publish_partition(daily(spark, (4, "b", D[1]), (5, "b", D[1])), target, D[1])
    assert shown(spark, target) == [
        (1, "a", D[0]),
        (2, "a", D[0]),
        (4, "b", D[1]),
        (5, "b", D[1]),
    ]
    assert last_partition(spark, target.table) == D[1]


def test_partition_from_its_own_rows(spark, target):
    two_days(spark, target)
    own = spark.table(target.table).where(F.col("dt") == F.lit(D[0]))
    publish_partition(own.withColumn("name", F.lit("own")).where("id = 2"), target, D[0])
    assert shown(spark, target) == [(2, "own", D[0]), (3, "a", D[1])]


def test_empty_partition(spark, target):
    two_days(spark, target)
    publish_partition(daily(spark), target, D[0])
    assert shown(spark, target) == [(3, "a", D[1])]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_session_mode_does_not_matter(spark, target, mode):
    setting = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(setting, mode)
    try:
        two_days(spark, target)
        publish_partition(daily(spark), target, D[0])
        overwrite_partitions(daily(spark, (9, "c", D[2])), target)
        assert spark.conf.get(setting).lower() == mode
    finally:
        spark.conf.unset(setting)
    assert shown(spark, target) == [(3, "a", D[1]), (9, "c", D[2])]


def test_columns_land_by_name(spark, target):
    two_days(spark, target)
    turned = daily(spark, (7, "turned", D[1])).select("dt", "name", "id")
    publish_partition(turned, target, D[1])
    assert shown(spark, target)[-1] == (7, "turned", D[1])
    overwrite_partitions(turned, target)
    assert shown(spark, target)[-1] == (7, "turned", D[1])
    with pytest.raises(ValueError, match="more"):
        publish_partition(turned.withColumn("more", F.lit(1)), target, D[1])


FIRST_STEPS = ["begin", "write_files", "show", "point_table", "create_entry", "clear"]


@pytest.mark.parametrize("step", FIRST_STEPS)
@pytest.mark.parametrize("resuming", [True, False])
def test_crash_of_the_first_version(spark, target, monkeypatch, step, resuming):
    """A run finishes what is complete; a publication may also just be repeated."""
    with monkeypatch.context() as patch:
        crash_at(patch, tables, step)
        with pytest.raises(Crash):
            publish_version(flat(spark, (1, "a")), target, D[0])
    complete = step in ("point_table", "create_entry", "clear")
    if resuming:
        assert resume(spark, target, "flat") == (D[0] if complete else None)
        assert table_exists(spark, target.table) == complete
        assert resume(spark, target, "flat") is None and pending(spark, target) is None
    publish_version(flat(spark, (1, "b"), (2, "b")), target, D[1])
    assert shown(spark, target) == [(1, "b"), (2, "b")]
    first = rows(version_as_of(spark, target, D[0], SCHEMA))
    assert first == ([(1, "a")] if complete else [])
    assert os.listdir(record_folder(target)) == []


@pytest.mark.parametrize("step", FIRST_STEPS)
@pytest.mark.parametrize("resuming", [True, False])
def test_crash_of_the_first_partitions(spark, target, monkeypatch, step, resuming):
    with monkeypatch.context() as patch:
        crash_at(patch, tables, step)
        with pytest.raises(Crash):
            publish_partition(daily(spark, (1, "a", D[0])), target, D[0])
    complete = step in ("point_table", "create_entry", "clear")
    if resuming:
        assert resume(spark, target, "partitioned") == (D[0] if complete else None)
        assert table_exists(spark, target.table) == complete
        assert resume(spark, target, "partitioned") is None
    publish_partition(daily(spark, (2, "b", D[1])), target, D[1])
    assert shown(spark, target) == [(1, "a", D[0])] * complete + [(2, "b", D[1])]


@pytest.mark.parametrize("mode", ["flat", "partitioned"])
def test_first_files_torn_half_way(spark, target, monkeypatch, mode):
    """Incomplete files are cleared; they are never shown and never taken for someone else's."""
    write = tables.write_files

    def torn(df, path, target, partition_keys=None):
        write(df.where("id = 1"), path, target, partition_keys)
        raise Crash("write_files")

    made = daily(spark, (1, "a", D[0]), (2, "a", D[0]))
    made = made.drop("dt") if mode == "flat" else made
    publish = publish_version if mode == "flat" else publish_partition
    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_files", torn)
        with pytest.raises(Crash):
            publish(made, target, D[0])
    assert files(target.root) and not table_exists(spark, target.table)
    assert resume(spark, target, mode) is None and not files(target.root)
    publish(made, target, D[0])
    assert len(shown(spark, target)) == 2


@pytest.mark.parametrize("buckets", [None, 2])
def test_schema_change_cut_between_drop_and_create(spark, target, monkeypatch, buckets):
    target = replace(target, buckets=buckets, bucket_keys=("id",) if buckets else ())
    publish_version(flat(spark, (1, "a")), target, D[0])
    wider = flat(spark, (1, "b")).withColumn("more", F.lit(1.5))
    with monkeypatch.context() as patch:
        crash_at(patch, tables, "create_entry")
        with pytest.raises(Crash):
            publish_version(wider, target, D[1])
    assert not table_exists(spark, target.table)
    assert resume(spark, target, "flat") == D[1]
    assert shown(spark, target) == [(1, "b", 1.5)]
    assert rows(version_as_of(spark, target, D[0], SCHEMA)) == [(1, "a")]
    assert describe(spark, target.table).get("num_buckets") == buckets


@pytest.mark.parametrize("call", [1, 2])
def test_schema_change_of_the_same_version_cut_between_drop_and_create(spark, target, monkeypatch, call):
    publish_version(flat(spark, (1, "a")), target, D[0])
    wider = flat(spark, (1, "b")).withColumn("more", F.lit(1.5))
    create, seen = tables.create_entry, []

    def cut(*args, **kwargs):
        seen.append(args)
        if len(seen) == call:
            raise Crash("create_entry")
        create(*args, **kwargs)

    # the second time only the location moves, unless the entry changes in between
    with monkeypatch.context() as patch:
        patch.setattr(tables, "create_entry", cut)
        if call == 2:
            patch.setattr(tables, "_shape", lambda schema: object())
        with pytest.raises(Crash):
            publish_version(wider, target, D[0])
    assert not table_exists(spark, target.table)
    assert resume(spark, target, "flat") == D[0]
    assert shown(spark, target) == [(1, "b", 1.5)]
    assert current_version(spark, target.table) == D[0]
    whole = T.StructType([*SCHEMA.fields, T.StructField("more", T.DoubleType())])
    assert rows(version_as_of(spark, target, D[0], whole)) == [(1, "b", 1.5)]
    assert not files(staging_root(target))


@pytest.mark.parametrize("call", [1, 2])
def test_schema_change_of_partitions_cut_between_drop_and_create(spark, target, monkeypatch, call):
    two_days(spark, target)
    publish_partition(daily(spark, (4, "b", D[1])), target, D[1])
    wider = spark.table(target.table).withColumn("more", F.lit(1))
    with monkeypatch.context() as patch:
        crash_at(patch, tables, "create_entry", call)
        with pytest.raises(Crash):
            write_table(wider, target, WHOLE, partition_keys=["dt"])
    assert not table_exists(spark, target.table)
    assert resume(spark, target, "partitioned") == D[1]
    assert shown(spark, target) == [(1, "a", 1, D[0]), (2, "a", 1, D[0]), (4, "b", 1, D[1])]
    assert describe(spark, target.table)["location"].endswith(target.root)
    assert not files(staging_root(target)) and resume(spark, target, "partitioned") is None


def test_record_of_another_table_makes_no_files_ours(spark, target, monkeypatch):
    with monkeypatch.context() as patch:
        crash_at(patch, tables, "point_table")
        with pytest.raises(Crash):
            publish_version(flat(spark, (1, "a")), target, D[0])
    other = Target(f"{target.table}_other", target.root)
    with pytest.raises(ValueError, match="not in the catalog"):
        publish_version(flat(spark, (1, "b")), other, D[0])
    assert resume(spark, target, "flat") == D[0] and shown(spark, target) == [(1, "a")]


def test_record_belongs_to_one_catalog_entry(spark, target, monkeypatch):
    """The table is made anew by other means before the publication is finished."""
    publish_version(flat(spark, (1, "a")), target, D[0])
    with monkeypatch.context() as patch:
        crash_at(patch, tables, "point_table")
        with pytest.raises(Crash):
            publish_version(flat(spark, (1, "stale")), target, D[1])
    spark.sql(f"DROP TABLE {target.table}")
    time.sleep(1.1)  # creation times are kept in seconds
    flat(spark, (5, "fresh")).write.parquet(target.version_path(D[2]))
    spark.sql(f"CREATE TABLE {target.table} (id long, name string) USING parquet LOCATION '{target.version_path(D[2])}'")
    assert finish_publication(spark, target) is None
    assert shown(spark, target) == [(5, "fresh")] and pending(spark, target) is None


def test_a_record_does_not_clear_a_folder_that_the_table_shows(spark, target, monkeypatch):
    """The whole write to the root dies before its first file; a version below the root is still shown."""
    publish_version(flat(spark, (1, "a")), target, D[0])
    with monkeypatch.context() as patch:
        crash_at(patch, tables, "write_files")
        with pytest.raises(Crash):
            overwrite_table(flat(spark, (2, "b")), target)
    assert finish_publication(spark, target) is None
    assert shown(spark, target) == [(1, "a")]


@pytest.mark.parametrize("step", ["write_day", "show_day", "release_days"])
def test_crash_of_a_day(spark, target, monkeypatch, step):
    """Old or new rows are shown, nothing has to be finished, and a repeat leaves no folder behind."""
    two_days(spark, target)
    for n in (1, 2):
        with monkeypatch.context() as patch:
            crash_at(patch, publishing, step)
            with pytest.raises(Crash):
                publish_partition(daily(spark, (4, f"b{n}", D[1])), target, D[1])
        want = (4, f"b{n}", D[1]) if step == "release_days" else (3, "a", D[1])
        assert shown(spark, target) == [(1, "a", D[0]), (2, "a", D[0]), want]
        assert resume(spark, target, "partitioned") is None
    publish_partition(daily(spark, (4, "c", D[1])), target, D[1])
    assert shown(spark, target)[-1] == (4, "c", D[1])
    assert len(os.listdir(f"{target.root}/{DAYS}")) == 1 and not os.path.exists(f"{target.root}/dt={D[1]}")


def test_failing_rows_leave_the_old_day(spark, target):
    two_days(spark, target)
    broken = daily(spark, (4, "b", D[1])).withColumn("name", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        publish_partition(broken, target, D[1])
    assert shown(spark, target)[-1] == (3, "a", D[1])


def test_a_day_is_written_once(spark, target, monkeypatch):
    two_days(spark, target)
    write, paths = tables.write_files, []
    monkeypatch.setattr(tables, "write_files", lambda df, path, *rest: (paths.append(path), write(df, path, *rest)))
    own = spark.table(target.table).where(F.col("dt") == F.lit(D[1]))
    publish_partition(own.withColumn("name", F.lit("own")), target, D[1])
    assert len(paths) == 1 and shown(spark, target)[-1] == (3, "own", D[1])


def test_a_day_that_moved_is_pruned_and_replaced_by_either_way(spark, target):
    two_days(spark, target)
    publish_partition(daily(spark, (4, "b", D[1]), (5, "b", D[1])), target, D[1])
    day = spark.table(target.table).where(F.col("dt") == F.lit(D[1]))
    assert rows(day) == [(4, "b", D[1]), (5, "b", D[1])]
    assert len({r.f for r in day.select(F.col("_metadata.file_path").alias("f")).collect()}) == 1
    overwrite_partitions(day.where("id = 4").withColumn("name", F.lit("dynamic")), target)
    assert shown(spark, target) == [(1, "a", D[0]), (2, "a", D[0]), (4, "dynamic", D[1])]
    publish_partition(daily(spark), target, D[1])
    assert shown(spark, target) == [(1, "a", D[0]), (2, "a", D[0])]
    publish_partition(daily(spark, (6, "new", D[2])), target, D[2])
    assert [r.partition for r in partitions(spark, target.table).collect()] == [f"dt={d}" for d in D]
    write_table(spark.table(target.table), target, WHOLE, partition_keys=["dt"])
    assert shown(spark, target) == [(1, "a", D[0]), (2, "a", D[0]), (6, "new", D[2])]
    assert not os.path.exists(f"{target.root}/{DAYS}")


def test_small_partitions_get_one_file_each(spark, target):
    made = daily(spark, *[(i, "x", D[i % 3]) for i in range(90)]).repartition(8)
    overwrite_table(made, target, partition_keys=["dt"])
    assert [len(files(f"{target.root}/dt={day}")) for day in D] == [1, 1, 1]
    overwrite_partitions(made, target)
    assert [len(files(f"{target.root}/dt={day}")) for day in D] == [1, 1, 1]


def test_large_partition_is_split_over_tasks(spark, target):
    """One date holds all rows; adaptive execution cuts it into several files."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        made = spark.range(0, 60_000, 1, 8).select(
            "id", F.sha2(F.col("id").cast("string"), 256).alias("name"), F.lit(D[0]).alias("dt")
        )
        overwrite_table(made, target, partition_keys=["dt"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(f"{target.root}/dt={D[0]}")) > 2
    assert spark.table(target.table).distinct().count() == 60_000


def test_last_partition(spark, target):
    assert last_partition(spark, target.table) is None
    overwrite_table(daily(spark), target, partition_keys=["dt"])
    assert last_partition(spark, target.table) is None
    overwrite_partitions(daily(spark, (1, "a", D[0]), (2, "b", D[1]), (3, "c", None)), target)
    assert last_partition(spark, target.table) == D[1]
    names = [row.partition for row in partitions(spark, target.table).collect()]
    assert "dt=__HIVE_DEFAULT_PARTITION__" in names


def test_max_records(spark, tmp_path):
    for partition_keys in (None, ["dt"]):
        name = f"t_{uuid4().hex[:8]}"
        target = Target(name, str(tmp_path / name), max_records_per_file=3)
        made = daily(spark, *[(i, "x", D[0]) for i in range(10)]).coalesce(1)
        overwrite_table(made, target, partition_keys=partition_keys)
        assert len(files(target.root)) == 4
        if partition_keys:
            publish_partition(made, target, D[0])
            assert len(files(f"{target.root}/{DAYS}")) == 4
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("fmt", ["orc", "json", "csv"])
def test_other_formats(spark, tmp_path, fmt):
    name = f"t_{uuid4().hex[:8]}"
    target = Target(name, str(tmp_path / name), fmt=fmt)
    publish_version(flat(spark, (1, "a")), target, D[0])
    publish_version(flat(spark, (1, "b"), (2, "b")), target, D[0])
    assert shown(spark, target) == [(1, "b"), (2, "b")]
    assert rows(version_as_of(spark, target, D[0], SCHEMA)) == [(1, "b"), (2, "b")]
    spark.sql(f"DROP TABLE {name}")
    target = Target(name, f"{target.root}_daily", fmt=fmt)
    two_days(spark, target)
    publish_partition(daily(spark, (4, "b", D[1])), target, D[1])
    assert shown(spark, target) == [(1, "a", D[0]), (2, "a", D[0]), (4, "b", D[1])]
    spark.sql(f"DROP TABLE {name}")


def test_write_table(spark, target):
    write_table(daily(spark, (1, "a", D[0]), (2, "a", D[1])), target, partition_keys=["dt"])
    write_table(daily(spark, (3, "b", D[1])), target, partition_keys=["dt"])
    assert shown(spark, target) == [(1, "a", D[0]), (3, "b", D[1])]
    own = spark.table(target.table).withColumn("more", F.lit(1))
    write_table(own, target, WHOLE, partition_keys=["dt"])
    assert shown(spark, target) == [(1, "a", 1, D[0]), (3, "b", 1, D[1])]
    assert spark.table(target.table).columns == ["id", "name", "more", "dt"]
    write_table(flat(spark, (9, "v")), target, WHOLE, version=str(D[2]))
    assert shown(spark, target) == [(9, "v")]
    assert current_version(spark, target.table) == D[2]
    write_table(daily(spark, (8, "v", D[0])), target, WHOLE, "2021-03-08", ["dt"])
    assert shown(spark, target) == [(8, "v", D[0])]
    with pytest.raises(ValueError, match="mode"):
        write_table(flat(spark), target, "other")


def test_whole_write_under_dynamic_mode_leaves_no_stale_partition(spark, target):
    two_days(spark, target)
    session = spark.newSession()
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    one = daily(session, (7, "new", D[1])).withColumn("more", F.lit(1))
    write_table(one, target, WHOLE, partition_keys=["dt"])
    spark.catalog.refreshTable(target.table)
    assert shown(spark, target) == [(7, "new", 1, D[1])]


def test_inserts_keep_the_callers_settings(spark, target):
    spark.conf.set("spark.sql.parquet.compression.codec", "gzip")
    try:
        two_days(spark, target)
        publish_partition(daily(spark, (4, "b", D[1])), target, D[1])
        overwrite_partitions(daily(spark, (5, "b", D[0])), target)
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")
    names = files(target.root)
    assert len(names) == 2
    assert names and all(".gz." in str(name) for name in names)


def test_data_that_the_catalog_does_not_know_is_never_replaced(spark, target):
    """As when an earlier session kept its catalog in memory."""
    two_days(spark, target)
    spark.sql(f"DROP TABLE {target.table}")
    with pytest.raises(ValueError, match="not in the catalog"):
        publish_partition(daily(spark, (4, "b", D[1])), target, D[1])
    flat_target = Target(target.table, f"{target.root}_flat")
    publish_version(flat(spark, (1, "a")), flat_target, D[0])
    spark.sql(f"DROP TABLE {target.table}")
    with pytest.raises(ValueError, match="not in the catalog"):
        publish_version(flat(spark, (1, "a")), flat_target, D[1])


def test_repeated_publications_leave_one_file_a_day_and_no_staging(spark, target):
    two_days(spark, target)
    for n in range(4):
        made = daily(spark, *[(i, f"v{n}", D[1]) for i in range(9)]).repartition(3)
        publish_partition(made, target, D[1])
        assert len(files(f"{target.root}/{DAYS}")) == 1
    staging = staging_root(target)
    assert sorted(os.listdir(staging)) == ["publication"] and not os.listdir(record_folder(target))


def test_other_current_database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE side LOCATION '{tmp_path}/side'")
    try:
        spark.catalog.setCurrentDatabase("side")
        target = Target("here", str(tmp_path / "here"))
        two_days(spark, target)
        overwrite_partitions(daily(spark, (7, "b", D[1])), target)
        spark.catalog.setCurrentDatabase("default")
        assert table_exists(spark, "side.here") and not table_exists(spark, "here")
        named = Target("side.here", target.root)
        assert shown(spark, named)[-1] == (7, "b", D[1])
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE side CASCADE")
    assert not table_exists(spark, "side.here")
    assert current_version(spark, "no_such_database.t") is None


def test_mixed_case_table_names(spark, tmp_path):
    target = Target(f"Mixed_{uuid4().hex[:6]}", str(tmp_path / "mixed"))
    publish_version(flat(spark, (1, "a")), target, D[0])
    assert table_exists(spark, target.table.lower()) and table_exists(spark, target.table)
    assert current_version(spark, target.table.upper()) == D[0]
    spark.sql(f"DROP TABLE {target.table}")


def test_load_or_empty(spark, tmp_path):
    none = load_or_empty(spark, str(tmp_path / "nothing"), SCHEMA)
    assert rows(none) == [] and none.schema.fieldNames() == ["id", "name"]
    flat(spark, (1, "a")).write.parquet(str(tmp_path / "some"))
    assert rows(load_or_empty(spark, str(tmp_path / "some"), SCHEMA)) == [(1, "a")]
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        load_or_empty(spark, str(tmp_path / "some"), SCHEMA, "no_such_format")
