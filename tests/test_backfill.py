"""Several dates in one pass: the same versions as single runs give, and how they are published."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import START, change, rows
from tests.test_publish import Crash, crash_at
from tidemark import RunOptions, build_versions, run_backfill, run_snapshot
from tidemark.plans.backfill import as_days, dealt_to_versions
from tidemark.scratch import store
from tidemark.sinks import publish as publishing
from tidemark.sinks import tables
from tidemark.sinks.publish import publish_version, resume
from tidemark.sources.catalog import current_version, describe, table_exists
from tidemark.sources.snapshots import all_versions
from tidemark.spec import Target

D = [START + timedelta(days=i) for i in range(9)]


def at(day, hour=8):
    return f"{day} {hour:02d}:00:00"


def name(day, number=1):
    return f"{day:%Y%m%d}-{number:09d}.parquet"


def random_feed(feed, seed, load=True):
    """Files with nulls, deletes, null keys, ties, and rows dated before or after the day of their file."""
    made = random.Random(seed)
    if load:
        feed.load("LOAD1.parquet", *({"id": i, "name": f"load{i}", "city": made.choice([None, "c"]), "day": START} for i in [None, *range(6)]))
    for day in D:
        for number in range(made.randint(0, 2)):
            some = []
            for _ in range(made.randint(1, 12)):
                dated = day + timedelta(days=made.choice([0, 0, 0, 0, -1, -2, 1]))
                stamp = made.choice([at(dated, made.randint(0, 5))] * 9 + [None])
                value = lambda s: made.choice([None, f"{s}{made.randint(0, 99)}"])
                some.append(change(made.choice("IUUUD"), stamp, made.choice([None, *range(10)]), value("n"), value("c"), day))
            feed.write(name(day, number + 1), *some)


def by_single_runs(spark, spec, target, days, options):
    for day in days:
        run_snapshot(spark, spec, day, target, options=options)
    return rows(all_versions(spark, target, spec.schema))


@pytest.mark.parametrize("policy", ["keep_old", "overwrite"])
@pytest.mark.parametrize("rank", ["first", "processing_date"])
@pytest.mark.parametrize("days", [D[:1], D[:4], [D[0], D[3], D[4], D[8]], [D[2], D[6]]])
def test_versions_equal_those_of_single_runs(spark, feed, target, policy, rank, days):
    options = RunOptions(null_policy=policy, load_rank=rank)
    random_feed(feed, f"{policy}{rank}{days}")
    spec = feed.spec()
    other = Target(f"{target.table}_single", f"{target.root}_single")
    try:
        want = by_single_runs(spark, spec, other, days, options)
        assert rows(build_versions(spark, spec, days, target, options)) == want
        assert run_backfill(spark, spec, days, target, options) == list(days)
        assert rows(all_versions(spark, target, spec.schema)) == want
        assert rows(spark.table(target.table)) == rows(spark.table(other.table))
        assert current_version(spark, target.table) == days[-1]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {other.table}")


@pytest.mark.parametrize("policy", ["keep_old", "overwrite"])
@pytest.mark.parametrize("buckets", [None, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_going_on_from_a_published_version(spark, feed, target, policy, buckets, seed):
    """The first day of the backfill is the current version; a day without rows gets its folder too."""
    options = RunOptions(null_policy=policy)
    random_feed(feed, seed)
    spec, target = feed.spec(), replace(target, buckets=buckets)
    other = Target(f"{target.table}_single", f"{target.root}_single")
    try:
        for each in (target, other):
            run_snapshot(spark, spec, D[2], each, options=options)
        run_backfill(spark, spec, [D[2], D[3], D[5], D[7]], target, options)
        want = by_single_runs(spark, spec, other, [D[2], D[3], D[5], D[7]], options)
        assert rows(all_versions(spark, target, spec.schema)) == want
        assert describe(spark, target.table).get("num_buckets") == buckets
        with pytest.raises(ValueError, match="before the last published"):
            run_backfill(spark, spec, [D[6], D[8]], target, options)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {other.table}")


def test_versions_without_rows(spark, feed, target):
    feed.write(name(D[0]), change("I", at(D[0]), 1, "a"))
    feed.write(name(D[2]), change("D", at(D[2]), 1))
    feed.write(name(D[4]), change("I", at(D[4]), 2, "b"))
    run_backfill(spark, feed.spec(), D[:5], target)
    found = rows(all_versions(spark, target, feed.spec().schema), "id", "version")
    assert found == [(1, D[0]), (1, D[1]), (2, D[4])]
    for day in D[:5]:
        assert spark.read.parquet(target.version_path(day)).columns == ["id", "name", "city", "day"]


def test_the_feed_is_scanned_once_and_nothing_is_joined(spark, feed, target):
    random_feed(feed, 5)
    run_snapshot(spark, feed.spec(), D[0], target)
    text = build_versions(spark, feed.spec(), D[1:], target)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text
    assert text.count("cdc_timestamp:string") <= 2  # once for keyed changes, once for those without a key
    assert "WindowGroupLimit" in text


def test_each_change_goes_to_the_runs_that_read_it(spark):
    days = [D[0], D[3], D[4]]
    read = [(0, 0, [0, 1]), (1, 1, [1]), (1, 3, [1]), (3, 3, [1, 2]), (3, 4, [2]), (1, 4, []), (4, 1, []), (4, 4, [2]), (0, 3, [1])]
    for n, (row, file, want) in enumerate(read):
        one = spark.createDataFrame([(at(D[row]), name(D[file]), 1)], "cdc_timestamp string, _cdc_file_name string, _cdc_is_change int")
        found = [r._cdc_at for r in dealt_to_versions(one, D[0], days).collect()]
        assert found == want, (n, row, file)


def test_days_must_ascend(spark, feed, target):
    for days in ([], [D[1], D[0]], [D[1], D[1]]):
        with pytest.raises(ValueError, match="ascend"):
            as_days(days)
    with pytest.raises(ValueError, match="cdc_start_date"):
        run_backfill(spark, feed.spec(), [START - timedelta(days=1), START], target)
    assert not table_exists(spark, target.table)


def test_a_snapshot_that_repeats_a_key_is_refused(spark, feed, target):
    feed.write(name(D[1]), change("U", at(D[1]), 1, "b"))
    twice = spark.createDataFrame([(1, "a", None, START), (1, "a", None, START), (None, "n", None, START), (None, "n", None, START)], feed.spec().schema)
    publish_version(twice, target, D[0])
    with pytest.raises(Exception, match="repeats a key"):
        run_backfill(spark, feed.spec(), D[1:3], target)
    assert rows(spark.table(target.table), "name") == [("a",), ("a",), ("n",), ("n",)]
    assert resume(spark, target, "flat") is None
    assert {r.version for r in all_versions(spark, target, feed.spec().schema).select("version").collect()} == {D[0]}


@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("step", ["begin", "write_versions", "show"])
def test_crash_of_a_backfill(spark, feed, target, monkeypatch, step, first):
    """Before the table moves, versions that were written are cleared; a repeat gives them all."""
    random_feed(feed, 11)
    spec = feed.spec()
    if not first:
        run_snapshot(spark, spec, D[0], target)
    days = D[1:4]
    before = rows(all_versions(spark, target, spec.schema))
    with monkeypatch.context() as patch:
        crash_at(patch, publishing, step)
        with pytest.raises(Crash):
            run_backfill(spark, spec, days, target)
    assert resume(spark, target, "flat") is None
    assert rows(all_versions(spark, target, spec.schema)) == before
    run_backfill(spark, spec, days, target)
    assert current_version(spark, target.table) == D[3]


@pytest.mark.parametrize("step", ["point_table", "create_entry", "clear"])
def test_crash_when_all_versions_are_written(spark, feed, target, monkeypatch, step):
    random_feed(feed, 12)
    spec = feed.spec()
    with monkeypatch.context() as patch:
        crash_at(patch, tables, step)
        with pytest.raises(Crash):
            run_backfill(spark, spec, D[:4], target)
    assert resume(spark, target, "flat") == D[3]
    want, _ = store(build_versions(spark, spec, D[:4], Target("nothing_there", f"{target.root}_x")), "want")
    assert rows(all_versions(spark, target, spec.schema)) == rows(want)
    assert rows(spark.table(target.table)) == rows(want.where(F.col("version") == F.lit(D[3])).drop("version"))


def test_max_records_of_a_backfill(spark, feed, target):
    feed.write(name(D[0]), *(change("I", at(D[0]), i, "a") for i in range(10)))
    target = replace(target, max_records_per_file=4)
    run_backfill(spark, feed.spec(), D[:2], target)
    sizes = all_versions(spark, target, feed.spec().schema).groupBy(F.input_file_name()).count()
    assert sizes.agg(F.max("count")).first()[0] <= 4
