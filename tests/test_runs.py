"""Whole runs over feed files: one test per rule about dates, order, keys and modes."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import types as T

from tests import model
from tests.conftest import SCHEMA, START, change, rows
from tidemark import FLAT, PARTITIONED, RunOptions, build_snapshot, run_snapshot
from tidemark.sinks import tables
from tidemark.sources.catalog import describe
from tidemark.sources.snapshots import version_as_of

D = [START + timedelta(days=i) for i in range(6)]
SCHEMA_WITHOUT_CITY = T.StructType([f for f in SCHEMA.fields if f.name != "city"])
FIRST = RunOptions()
OVERWRITE = RunOptions(null_policy="overwrite")


def published(spark, target, *columns):
    return rows(spark.table(target.table), *columns)


def at(day: date, time: str = "08:00:00") -> str:
    return f"{day} {time}"


def file(day: date, number: int = 1) -> str:
    return f"{day:%Y%m%d}-{number:09d}.parquet"


def person(id, name, day=START, city=None):
    return {"id": id, "name": name, "city": city, "day": day}


def test_first_run_takes_load_and_changes(spark, feed, target):
    feed.load("LOAD1.parquet", person(1, "a"), person(2, "b"), person(3, "c"))
    feed.write(file(D[0]), change("U", at(D[0]), 1, "a2"), change("D", at(D[0]), 2))
    feed.write(file(D[1]), change("U", at(D[1]), 3, "later"))
    report = run_snapshot(spark, feed.spec(), D[0], target)
    assert published(spark, target, "id", "name") == [(1, "a2"), (3, "c")]
    assert (report.last_date, report.with_load) == (None, True)


def test_change_older_than_its_load_row(spark, feed, target):
    """The load exported the key at nine, yet its update says eight."""
    feed.write("LOAD1.parquet", change(None, at(D[0], "09:00:00"), 1, "loaded"))
    feed.write(file(D[0]), change("U", at(D[0], "08:00:00"), 1, "updated"))
    run_snapshot(spark, feed.spec(), D[0], target)
    assert published(spark, target, "name") == [("updated",)]


def test_load_row_and_change_at_midnight(spark, feed, target):
    feed.load("zLOAD/LOAD1.parquet", person(1, "loaded"))
    feed.write(file(D[0]), change("U", at(D[0], "00:00:00"), 1, "updated"))
    for options in (FIRST, RunOptions(load_rank="processing_date")):
        snapshot = build_snapshot(spark, feed.spec(), D[0], target, options=options)
        assert rows(snapshot, "name") == [("updated",)]


def test_late_bootstrap(spark, feed, target):
    """First run a day after the changes: they must not be undone by the load."""
    feed.load("LOAD1.parquet", person(1, "a"), person(2, "b"))
    feed.write(file(D[1]), change("U", at(D[1]), 1, "a2"), change("D", at(D[1]), 2))
    snapshot = build_snapshot(spark, feed.spec(), D[2], target)
    assert rows(snapshot, "id", "name") == [(1, "a2")]
    restamped = RunOptions(load_rank="processing_date")
    snapshot = build_snapshot(spark, feed.spec(), D[2], target, options=restamped)
    assert rows(snapshot, "id", "name") == [(1, "a"), (2, "b")]


def test_delete_and_reinsert(spark, feed, target):
    feed.write(
        file(D[0]),
        change("I", at(D[0], "01:00:00"), 1, "first"),
        change("D", at(D[0], "02:00:00"), 1),
        change("I", at(D[0], "03:00:00"), 1, "second"),
        change("D", at(D[0], "03:00:00"), 2, "never there"),
    )
    run_snapshot(spark, feed.spec(), D[0], target)
    assert published(spark, target, "id", "name") == [(1, "second")]


def test_load_is_read_again_on_the_start_date_only(spark, feed, target):
    feed.load("LOAD1.parquet", person(1, "a"))
    assert run_snapshot(spark, feed.spec(), D[0], target).with_load
    assert run_snapshot(spark, feed.spec(), D[0], target).with_load
    feed.load("LOAD2.parquet", person(2, "b"))
    assert not run_snapshot(spark, feed.spec(), D[1], target).with_load
    assert published(spark, target, "name") == [("a",)]


def test_update_to_null(spark, feed, target):
    feed.load("LOAD1.parquet", person(1, "x", city="here"))
    run_snapshot(spark, feed.spec(), D[0], target)
    feed.write(file(D[1]), change("U", at(D[1]), 1, "y", None, D[0]))
    keep = build_snapshot(spark, feed.spec(), D[1], target)
    assert rows(keep, "name", "city") == [("y", "here")]
    over = build_snapshot(spark, feed.spec(), D[1], target, options=OVERWRITE)
    assert rows(over, "name", "city") == [("y", None)]


def test_null_key(spark, feed, target):
    feed.load("LOAD1.parquet", person(None, "loaded"))
    run_snapshot(spark, feed.spec(), D[0], target)
    feed.write(
        file(D[1]), change("U", at(D[1]), None, "one"), change("U", at(D[1]), None, "two")
    )
    run_snapshot(spark, feed.spec(), D[1], target)
    assert published(spark, target, "id", "name") == [(None, "loaded"), (None, "two")]


def test_rows_before_the_lower_bound_are_ignored(spark, feed, target):
    feed.load("LOAD1.parquet", person(1, "a"))
    run_snapshot(spark, feed.spec(), D[0], target)
    run_snapshot(spark, feed.spec(), D[2], target)
    feed.write(file(D[2]), change("U", at(D[1]), 1, "too late"), change("U", None, 1, "undated"))
    feed.write(file(D[3]), change("U", at(D[4]), 1, "too soon"))
    options = RunOptions(count_rows=True)
    report = run_snapshot(spark, feed.spec(), D[3], target, options=options)
    assert published(spark, target, "name") == [("a",)]
    assert report.rows == {"read": 3, "undated": 1, "too_early": 1, "too_late": 1}


def test_file_after_midnight_is_picked_up_by_the_next_run(spark, feed, target):
    feed.load("LOAD1.parquet", person(1, "a"))
    feed.write(file(D[1]), change("U", at(D[0], "23:59:59"), 1, "b"))
    run_snapshot(spark, feed.spec(), D[0], target)
    assert published(spark, target, "name") == [("a",)]
    run_snapshot(spark, feed.spec(), D[1], target)
    assert published(spark, target, "name") == [("b",)]


def test_last_published_day_is_applied_again(spark, feed, target):
    feed.load("LOAD1.parquet", person(1, "a"), person(2, "a"))
    feed.write(file(D[1]), change("U", at(D[1]), 1, "b"))
    run_snapshot(spark, feed.spec(), D[1], target)
    feed.write(file(D[1], 2), change("U", at(D[1], "23:00:00"), 2, "late"))
    feed.write(file(D[2]), change("U", at(D[2]), 1, "c"))
    run_snapshot(spark, feed.spec(), D[2], target)
    assert published(spark, target, "id", "name") == [(1, "c"), (2, "late")]


def test_chain_and_single_run(spark, feed, target):
    """Day by day equals all at once under overwrite; keep_old remembers old values."""
    feed.load("LOAD1.parquet", person(1, "a", city="here"))
    feed.write(file(D[1]), change("U", at(D[1]), 1, "b", "there"))
    feed.write(file(D[2]), change("U", at(D[2]), 1, "c", None))
    single = {}
    for options in (FIRST, OVERWRITE):
        single[options] = rows(
            build_snapshot(spark, feed.spec(), D[2], target, options=options), "name", "city"
        )
    assert single[FIRST] == single[OVERWRITE] == [("c", None)]
    run_snapshot(spark, feed.spec(), D[1], target)
    over = build_snapshot(spark, feed.spec(), D[2], target, options=OVERWRITE)
    assert rows(over, "name", "city") == [("c", None)]
    keep = build_snapshot(spark, feed.spec(), D[2], target)
    assert rows(keep, "name", "city") == [("c", "there")]


def test_bad_timestamps(spark, feed, target):
    feed.write(file(D[0]), change("U", "soon", 1, "bad"), change("U", at(D[0]), 2, "good"))
    with pytest.raises(Exception, match="malformed change time: soon"):
        run_snapshot(spark, feed.spec(), D[0], target)
    options = RunOptions(bad_timestamp="drop", count_rows=True)
    report = run_snapshot(spark, feed.spec(), D[0], target, options=options)
    assert published(spark, target, "name") == [("good",)]
    assert report.rows["undated"] == 1


def test_bad_file_name_stops_the_run(spark, feed, target):
    feed.write("20201301-x.parquet", change("U", at(D[0]), 1, "a"))
    with pytest.raises(ValueError, match="20201301-x"):
        run_snapshot(spark, feed.spec(), D[0], target)
    assert not spark.catalog.tableExists(target.table)


def test_no_files_at_all(spark, feed, target):
    run_snapshot(spark, feed.spec(path=str(feed.folder / "missing")), D[0], target)
    assert published(spark, target) == []
    feed.write(file(D[1]), change("I", at(D[1]), 1, "a"))
    run_snapshot(spark, feed.spec(), D[1], target)
    run_snapshot(spark, feed.spec(), D[3], target)
    assert published(spark, target, "name") == [("a",)]


def test_new_column_appears_in_the_next_version(spark, feed, target):
    feed.load("LOAD1.parquet", person(1, "a", city="here"))
    narrow = T.StructType().add("id", "integer").add("name", "string")
    run_snapshot(spark, feed.spec(schema=narrow, partition_date=None), D[0], target)
    assert spark.table(target.table).columns == ["id", "name"]
    feed.write(file(D[1]), change("U", at(D[1]), 2, "b", "there"))
    run_snapshot(spark, feed.spec(), D[1], target)
    assert published(spark, target, "id", "city") == [(1, None), (2, "there")]


def test_bucketed_table_takes_and_loses_its_buckets(spark, feed, target):
    feed.load("LOAD1.parquet", *[person(i, f"n{i}") for i in range(50)])
    feed.write(file(D[1]), change("D", at(D[1]), 7), change("I", at(D[1]), 70, "new", "x"))
    narrow = feed.spec(schema=SCHEMA_WITHOUT_CITY, partition_date=None)
    bucketed = replace(target, buckets=4)
    run_snapshot(spark, narrow, D[0], target)
    run_snapshot(spark, narrow, D[0], bucketed)
    run_snapshot(spark, narrow, D[1], bucketed)
    assert describe(spark, target.table)["num_buckets"] == 4
    assert len(published(spark, target)) == 50
    run_snapshot(spark, feed.spec(), D[1], bucketed)
    assert published(spark, target, "id", "city")[-1] == (9, None)
    assert (70, "x") in published(spark, target, "id", "city")
    run_snapshot(spark, feed.spec(), D[1], target)
    assert "num_buckets" not in describe(spark, target.table)
    assert len(published(spark, target)) == 50
    with pytest.raises(ValueError, match="bucketed"):
        run_snapshot(spark, feed.spec(), D[1], bucketed, PARTITIONED)


def random_files(feed, seed, days):
    """Feed files with ties, deletes and nulls; returns all rows in feed order."""
    chance = random.Random(seed)
    made = []
    load = [person(k, f"load{k}", city="here") for k in range(6)]
    feed.load("LOAD1.parquet", *load)
    for day in days:
        for number in (1, 2):
            rows_ = []
            for _ in range(chance.randint(1, 6)):
                stamp = at(day, f"0{chance.randint(0, 2)}:00:00.000000")
                name = chance.choice([None, "a", "b", "c"])
                city = chance.choice([None, "x", "y"])
                rows_.append(
                    change(chance.choice("IUD"), stamp, chance.randint(0, 9), name, city, day)
                )
            feed.write(file(day, number), *rows_)
            made += [(r["cdc_timestamp"], file(day, number), i, r) for i, r in enumerate(rows_)]
    return load, made


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("merge", ["sort_merge", "broadcast_delta"])
@pytest.mark.parametrize("buckets", [None, 3])
def test_chains_against_brute_force(spark, feed, target, seed, merge, buckets):
    target = replace(target, buckets=buckets)
    load, made = random_files(feed, seed, D[:4])
    columns = ["id", "name", "city", "day"]
    overwrite = seed == 1
    options = RunOptions(null_policy="overwrite" if overwrite else "keep_old", merge=merge)

    def step(state, first, last, with_load):
        inside = [m for m in made if str(first) <= m[0][:10] <= str(last)]
        newest = {}
        if with_load:
            newest = {(r["id"],): {**r, "Op": None} for r in load}
        newest.update(model.latest(inside, lambda m: (m[3]["id"],), lambda m: m[:3]))
        newest = {k: v[3] if isinstance(v, tuple) else v for k, v in newest.items()}
        return model.merge(state, newest, columns, ["id"], overwrite)

    state, last = [], None
    for day in (D[0], D[2], D[2], D[3]):
        run_snapshot(spark, feed.spec(), day, target, options=options)
        state = step(state, last or START, day, last is None or day == START)
        last = day
        want = sorted(str(tuple(row[c] for c in columns)) for row in state)
        assert sorted(str(tuple(r)) for r in spark.table(target.table).collect()) == want


# Partitioned runs


def test_partitioned_run_publishes_one_day(spark, feed, target):
    feed.load("LOAD1.parquet", person(1, "old day", day=date(2019, 5, 5)), person(2, "b", day=D[0]))
    report = run_snapshot(spark, feed.spec(), D[0], target, PARTITIONED)
    assert report.with_load
    assert published(spark, target, "id", "name", "dt") == [(2, "b", D[0])]
    assert spark.table(target.table).columns == ["id", "name", "city", "day", "dt"]


def test_partitioned_run_does_not_backfill_skipped_days(spark, feed, target):
    feed.write(file(D[0]), change("I", at(D[0]), 1, "a", day=D[0]))
    feed.write(file(D[1]), change("I", at(D[1]), 2, "b", day=D[1]))
    feed.write(file(D[2]), change("I", at(D[2]), 3, "c", day=D[2]))
    run_snapshot(spark, feed.spec(), D[0], target, PARTITIONED)
    run_snapshot(spark, feed.spec(), D[2], target, PARTITIONED)
    assert published(spark, target, "id", "dt") == [(1, D[0]), (3, D[2])]


def test_moved_key_leaves_its_old_copy(spark, feed, target):
    feed.write(file(D[0]), change("I", at(D[0]), 1, "a", day=D[0]))
    run_snapshot(spark, feed.spec(), D[0], target, PARTITIONED)
    feed.write(file(D[1]), change("U", at(D[1]), 1, "b", day=D[1]))
    run_snapshot(spark, feed.spec(), D[1], target, PARTITIONED)
    assert published(spark, target, "name", "dt") == [("a", D[0]), ("b", D[1])]


def test_partitioned_run_ignores_other_days_and_bare_deletes(spark, feed, target):
    feed.write(
        file(D[0]),
        change("I", at(D[0]), 1, "a", day=D[0]),
        change("I", at(D[0]), 2, "b", day=D[0]),
    )
    run_snapshot(spark, feed.spec(), D[0], target, PARTITIONED)
    feed.write(
        file(D[1]),
        change("U", at(D[1]), 1, "changed", day=D[0]),
        change("D", at(D[1]), 2),
        change("I", at(D[1]), 3, "c", day=D[1]),
    )
    run_snapshot(spark, feed.spec(), D[1], target, PARTITIONED)
    assert published(spark, target, "name", "dt") == [("a", D[0]), ("b", D[0]), ("c", D[1])]


def test_rank_comes_before_the_partition_filter(spark, feed, target):
    """The newest row of the key is of another day, so the day gets no row."""
    feed.write(
        file(D[1]),
        change("U", at(D[1], "01:00:00"), 1, "of today", day=D[1]),
        change("U", at(D[1], "02:00:00"), 1, "of before", day=D[0]),
    )
    assert rows(build_snapshot(spark, feed.spec(), D[1], target, PARTITIONED)) == []


def test_emptied_day(spark, feed, target):
    feed.write(file(D[0]), change("I", at(D[0]), 1, "a", day=D[0]))
    feed.write(file(D[1]), change("I", at(D[1]), 2, "b", day=D[1]))
    run_snapshot(spark, feed.spec(), D[0], target, PARTITIONED)
    run_snapshot(spark, feed.spec(), D[1], target, PARTITIONED)
    feed.write(file(D[1], 2), change("D", at(D[1], "20:00:00"), 2, "b", day=D[1]))
    run_snapshot(spark, feed.spec(), D[1], target, PARTITIONED)
    assert published(spark, target, "name", "dt") == [("a", D[0])]


@pytest.mark.parametrize("mode", [FLAT, PARTITIONED])
def test_repeating_a_run_changes_nothing(spark, feed, target, mode):
    random_files(feed, 3, D[:3])
    run_snapshot(spark, feed.spec(), D[1], target, mode)
    run_snapshot(spark, feed.spec(), D[2], target, mode)
    before = published(spark, target)
    assert before
    for _ in range(2):
        run_snapshot(spark, feed.spec(), D[2], target, mode)
        assert published(spark, target) == before


def test_run_finishes_what_a_crash_left(spark, feed, target, monkeypatch):
    """The repeat of a day dies during its rewrite; the next day's run mends it first."""
    feed.load("LOAD1.parquet", person(1, "a"))
    run_snapshot(spark, feed.spec(), D[0], target)
    write = tables.write_files

    def torn(df, path, *rest):
        if path == target.version_path(D[0]):
            raise RuntimeError("lost")
        return write(df, path, *rest)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_files", torn)
        with pytest.raises(RuntimeError, match="lost"):
            run_snapshot(spark, feed.spec(), D[0], target)
    feed.write(file(D[1]), change("U", at(D[1]), 1, "b"))
    report = run_snapshot(spark, feed.spec(), D[1], target)
    assert report.resumed == D[0]
    assert published(spark, target, "name") == [("b",)]
    assert rows(version_as_of(spark, target, D[0], SCHEMA), "name") == [("a",)]


def test_modes_do_not_mix(spark, feed, target):
    feed.load("LOAD1.parquet", person(1, "a"))
    run_snapshot(spark, feed.spec(), D[0], target)
    with pytest.raises(ValueError, match="flat run"):
        run_snapshot(spark, feed.spec(), D[1], target, PARTITIONED)
    spark.sql(f"DROP TABLE {target.table}")
    run_snapshot(spark, feed.spec(), D[0], target, PARTITIONED)
    with pytest.raises(ValueError, match="partitioned run"):
        run_snapshot(spark, feed.spec(), D[1], target)


def test_composite_key(spark, feed, target):
    spec = feed.spec(primary_keys=("id", "city"))
    feed.load("LOAD1.parquet", person(1, "a", city="x"), person(1, "b", city="y"))
    feed.write(file(D[0]), change("D", at(D[0]), 1, None, "x"), change("U", at(D[0]), 1, "c", "z"))
    run_snapshot(spark, spec, D[0], target)
    assert published(spark, target, "city", "name") == [("y", "b"), ("z", "c")]


def test_snapshot_frame_has_no_side_effects(spark, feed, target):
    feed.load("LOAD1.parquet", person(1, "a"))
    first = build_snapshot(spark, feed.spec(), D[0], target)
    feed.write(file(D[1]), change("U", at(D[1]), 1, "b"))
    second = build_snapshot(spark, feed.spec(), D[1], target)
    assert rows(first, "name") == [("a",)]
    assert rows(second, "name") == [("b",)]
    assert not spark.catalog.tableExists(target.table)


@pytest.mark.parametrize("mode", [FLAT, PARTITIONED])
def test_result_does_not_depend_on_how_the_work_is_split(spark, feed, target, mode):
    random_files(feed, 5, D[:3])
    found = []
    for split, shuffle, adaptive in (("128m", "1", "true"), ("1k", "7", "true"), ("1k", "3", "false")):
        session = spark.newSession()
        session.conf.set("spark.sql.files.maxPartitionBytes", split)
        session.conf.set("spark.sql.shuffle.partitions", shuffle)
        session.conf.set("spark.sql.adaptive.enabled", adaptive)
        for merge in ("sort_merge", "broadcast_delta"):
            options = RunOptions(merge=merge)
            snapshot = build_snapshot(session, feed.spec(), D[2], target, mode, options)
            found.append(rows(snapshot))
            keys = [row[0] for row in found[-1]]
            assert len(keys) == len(set(keys))
    assert found[0] and all(other == found[0] for other in found)


def test_read_options_reach_the_scan(spark, feed, target):
    feed.write(file(D[0]), change("I", at(D[0]), 1, "kept"))
    (feed.folder / file(D[0], 2)).write_bytes(b"garbage")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        rows(build_snapshot(spark, feed.spec(), D[0], target))
    spec = feed.spec(read_options={"ignoreCorruptFiles": "true"})
    assert rows(build_snapshot(spark, spec, D[0], target), "name") == [("kept",)]


def test_malformed_time_fails_without_ansi_too(spark, feed, target):
    feed.write(file(D[0]), change("U", "soon", 1, "bad"), change("U", at(D[0]), 2, "good"))
    session = spark.newSession()
    session.conf.set("spark.sql.ansi.enabled", "false")
    with pytest.raises(Exception, match="malformed change time: soon"):
        rows(build_snapshot(session, feed.spec(), D[0], target))
    options = RunOptions(bad_timestamp="drop")
    assert rows(build_snapshot(session, feed.spec(), D[0], target, options=options), "id") == [(2,)]


def test_counts_of_missing_empty_and_out_of_window_feeds(spark, feed, target):
    options = RunOptions(count_rows=True)
    nothing = {"read": 0, "undated": 0, "too_early": 0, "too_late": 0}
    missing = feed.spec(path=str(feed.folder / "missing"))
    assert run_snapshot(spark, missing, D[0], target, options=options).rows == nothing
    assert run_snapshot(spark, feed.spec(), D[1], target, options=options).rows == nothing
    feed.write(file(D[5]), change("U", at(D[5]), 1, "later"))
    assert run_snapshot(spark, feed.spec(), D[2], target, options=options).rows == nothing
    assert published(spark, target) == []


@pytest.mark.parametrize("merge", ["broadcast_delta", "sort_merge"])
def test_counts_are_the_same_for_every_merge(spark, feed, target, merge):
    feed.write(file(D[0]), change("U", at(D[0]), 1, "a"), change("U", at(D[1]), 2, "too late"))
    report = run_snapshot(spark, feed.spec(), D[0], target, options=RunOptions(count_rows=True, merge=merge))
    assert report.rows == {"read": 2, "undated": 0, "too_early": 0, "too_late": 1}


def test_dates_are_checked_before_any_work(spark, feed, target, monkeypatch):
    feed.load("LOAD1.parquet", person(1, "a"))
    run_snapshot(spark, feed.spec(), D[2], target)

    def resume(*_):
        raise AssertionError("work before the checks")

    monkeypatch.setattr("tidemark.plans.run.resume", resume)
    for day, message in ((D[1], "last published"), (D[0] - timedelta(days=1), "cdc_start_date"), ("today", "today")):
        with pytest.raises(ValueError, match=message):
            run_snapshot(spark, feed.spec(), day, target)


@pytest.mark.parametrize("merge", ["broadcast_delta", "sort_merge"])
def test_bucketed_versions_keep_one_file_a_bucket(spark, feed, target, merge):
    feed.load("LOAD1.parquet", *[person(i, "a") for i in range(200)])
    for day in D[1:4]:
        feed.write(file(day), *[change("U", at(day), i, str(day)) for i in range(150, 260)])
    target = replace(target, buckets=4)
    for day in (D[0], D[1], D[2], D[3], D[3]):
        run_snapshot(spark, feed.spec(), day, target, options=RunOptions(merge=merge))
        names = [r.name for r in spark.table(target.table).selectExpr("_metadata.file_name AS name").distinct().collect()]
        assert len(names) == 4
    assert spark.table(target.table).count() == 260


def test_malformed_partition_dates_follow_the_policy(spark, feed, target):
    schema = "id int, name string, city string"
    spec = replace(feed.spec(), schema=T.StructType.fromDDL(schema), partition_date="city")
    feed.write(
        file(D[0]), change("U", at(D[0]), 1, "a", city=str(D[0])), change("U", at(D[0]), 2, "b", city="soon"),
        columns=["Op", "cdc_timestamp", "id", "name", "city"],
    )
    run_snapshot(spark, spec, D[0], target, PARTITIONED, RunOptions(bad_timestamp="drop"))
    assert published(spark, target, "id") == [(1,)]
    with pytest.raises(Exception, match="soon"):
        run_snapshot(spark, spec, D[0], target, PARTITIONED)


def test_a_run_leaves_no_scratch(spark, feed, target, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemark.scratch.scratch_root", lambda _: str(tmp_path))
    feed.load("LOAD1.parquet", person(1, "a"))
    for _ in range(2):
        run_snapshot(spark, feed.spec(), D[0], target, options=RunOptions(count_rows=True))
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr("tidemark.plans.run.publish", lambda *_: (_ for _ in ()).throw(RuntimeError()))
        run_snapshot(spark, feed.spec(), D[0], target)
    assert not list((tmp_path / "tidemark").glob("*/*"))
