"""The physical plans that matter at scale."""

from __future__ import annotations

import os
import re
import subprocess
import sys
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import START, change
from tidemark import RunOptions, build_snapshot, run_snapshot
from tidemark.operators.changes import latest_change
from tidemark.operators.merge import merge_snapshot
from tidemark.plans import run as running
from tidemark.scratch import application_folder, owned_scratch, scratch_root, store
from tidemark.sinks.tables import store_in_buckets
from tidemark.sources.feed import list_feed, scan_feed


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def filled(feed):
    feed.load("LOAD1.parquet", {"id": 1, "name": "a", "day": START})
    feed.write("20210305-1.parquet", change("U", "2021-03-05 08:00:00", 1, "b", day=START))
    feed.write("20210306-1.parquet", change("U", "2021-03-06 08:00:00", 1, "c", day=START))
    return feed


def test_latest_change_is_cut_before_the_shuffle(spark, filled):
    text = plan(latest_change(scan_feed(spark, filled.spec()), ["id"]))
    assert text.count("Exchange hashpartitioning(id") == 1
    before_shuffle = text[text.index("Exchange") :]
    assert re.search(r"WindowGroupLimit.*Partial", before_shuffle)


def test_first_snapshot_needs_no_join(spark, filled, target):
    text = plan(build_snapshot(spark, filled.spec(), START, target))
    assert "Join" not in text and text.count("Exchange") == 1


def test_sort_merge_reuses_the_shuffle_of_the_ranking(spark, filled, target):
    run_snapshot(spark, filled.spec(), START, target)
    text = plan(build_snapshot(spark, filled.spec(), "2021-03-06", target))
    assert "SortMergeJoin" in text and "FullOuter" in text
    assert text.count("Exchange hashpartitioning") == 2


def test_sort_merge_with_a_bucketed_snapshot_shuffles_the_changes_only(spark, filled, target):
    target = replace(target, buckets=4)
    run_snapshot(spark, filled.spec(), START, target)
    merged = build_snapshot(spark, filled.spec(), "2021-03-06", target)
    text = plan(merged)
    assert "FullOuter" in text and "Bucketed: true" in text
    old = text[text.index("SortMergeJoin") : text.index("Bucketed: true")]
    assert "Exchange" not in old
    assert [row.name for row in merged.collect()] == ["c"]


def test_changes_stored_in_the_buckets_of_the_table_do_not_move(spark, filled, target):
    """No Exchange on either side of the join, however many changes there are."""
    target = replace(target, buckets=4).bucketed_by(("id",))
    run_snapshot(spark, filled.spec(), START, target)
    old = spark.table(target.table)
    rows = spark.range(5000).select(F.lit("U").alias("Op"), F.col("id").cast("int"), F.lit("n").alias("name"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with owned_scratch():
            delta = store_in_buckets(rows, target, "delta")
            merged = merge_snapshot(old, delta, ["id"], ["id", "name"])
            text = plan(merged)
            assert "FullOuter" in text and text.count("Bucketed: true") == 2
            assert "Exchange" not in text
            assert merged.count() == 5000
            helpers = [t.name for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]
            assert len(helpers) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def test_a_bucketed_run_moves_its_changes_once(spark, filled, target, monkeypatch):
    """The plan that a run publishes shuffles nothing: its changes lie in the table's buckets."""
    target = replace(target, buckets=4)
    run_snapshot(spark, filled.spec(), START, target)
    plans = []
    publish = running.publish
    monkeypatch.setattr(running, "publish", lambda df, *rest: (plans.append(plan(df)), publish(df, *rest)))
    run_snapshot(spark, filled.spec(), "2021-03-06", target)
    assert "FullOuter" in plans[0] and "Exchange" not in plans[0]
    assert [r.name for r in spark.table(target.table).collect()] == ["c"]


def scratch_left(spark):
    return sorted(os.listdir(application_folder(spark).removeprefix("file:")))


def test_owned_scratch_goes_with_its_block(spark, filled, target):
    before = scratch_left(spark)
    with owned_scratch():
        kept, path = store(spark.range(3), "kept")
        with owned_scratch():
            store(spark.range(3), "inner")
        assert kept.count() == 3 and len(scratch_left(spark)) == len(before) + 1
    assert scratch_left(spark) == before
    run_snapshot(spark, filled.spec(), START, target)
    assert scratch_left(spark) == before


def test_a_failed_run_leaves_no_scratch(spark, filled, target):
    before = scratch_left(spark)
    filled.write("20210307-1.parquet", change("U", "no time at all, but long", 1, "b", day=START))
    for buckets in (None, 2):
        with pytest.raises(Exception, match="malformed"):
            run_snapshot(spark, filled.spec(), "2021-03-07", replace(target, buckets=buckets))
        assert scratch_left(spark) == before
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def test_scratch_goes_with_the_application(tmp_path):
    code = """
import sys
from pyspark.sql import SparkSession
from tidemark.scratch import store
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
import os
path = store(spark.range(3), "left")[1]
assert os.path.isdir(path), path
"""
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run(
        [sys.executable, "-c", code, str(tmp_path / "shared")],
        capture_output=True, text=True, timeout=200, env={**os.environ, "PYTHONPATH": root}, cwd=tmp_path,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert os.listdir(tmp_path / "shared" / "tidemark") == []


def test_broadcast_merge_never_shuffles_the_old_rows(spark, filled, target):
    run_snapshot(spark, filled.spec(), START, target)
    options = RunOptions(merge="broadcast_delta")
    text = plan(build_snapshot(spark, filled.spec(), "2021-03-06", target, options=options))
    assert "SortMergeJoin" not in text
    # The one shuffle left makes the keys found in both sides distinct.
    (shuffle,) = re.findall(r"Exchange hashpartitioning\((.*?)\)", text)
    assert re.fullmatch(r"id#\d+, \d+", shuffle)


def test_old_partition_is_pruned(spark, filled, target):
    run_snapshot(spark, filled.spec(), START, target, "partitioned")
    text = plan(build_snapshot(spark, filled.spec(), "2021-03-06", target, "partitioned"))
    assert re.search(r"PartitionFilters: \[.*dt#\d+ = 2021-03-06", text)


def test_scan_reads_only_what_is_needed(spark, filled):
    narrow = latest_change(scan_feed(spark, filled.spec()), ["id"]).select("id", "Op")
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan(narrow))
    assert schemas and all("city" not in s and "name" not in s for s in schemas)


def test_name_check_leaves_nothing_to_read(spark, filled):
    odd = list_feed(spark, str(filled.folder)).where(F.col("kind") == "other")
    assert odd.rdd.getNumPartitions() == 0


def test_merge_of_a_stored_frame_reads_null_keys_by_pushdown(spark, filled):
    old, _ = store(spark.createDataFrame([(1, "a")], "id int, name string"), "old")
    delta = spark.createDataFrame([("U", 1, "b")], "Op string, id int, name string")
    text = plan(merge_snapshot(old, delta, ["id"], ["id", "name"]))
    assert "PushedFilters: [IsNull(id)]" in text and "PushedFilters: [IsNotNull(id)]" in text


def test_scratch_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch_root(spark) == named.rstrip("/")
    else:
        assert scratch_root(spark) and scratch_root(spark) == scratch_root(spark)


def test_scratch_of_a_cluster_must_be_named():
    class Conf:
        def get(self, name, default):
            return default

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Cluster())
