"""The log of runs."""

from __future__ import annotations

from datetime import date

import pytest

from tests.conftest import START, change
from tidemark import RunOptions, job, read_log, run_logged, run_snapshot
from tidemark.plans import run as running
from tidemark.plans.log import logged
from tidemark.sources.catalog import table_exists


@pytest.fixture
def log(tmp_path):
    return str(tmp_path / "log")


@pytest.fixture
def filled(feed):
    feed.load("LOAD1.parquet", {"id": 1, "name": "a", "day": START}, {"id": 2, "name": "b", "day": START})
    feed.write("20210305-1.parquet", change("D", "2021-03-05 08:00:00", 1), change("I", "2021-03-05 09:00:00", 3, "c", day=START))
    feed.write("20210306-1.parquet", change("U", "2021-03-06 08:00:00", 2, "c"), change("U", None, 2, "lost"))
    return feed


def entries(spark, log):
    return read_log(spark, log).orderBy("started").collect()


def test_published_runs(spark, filled, target, log):
    assert entries(spark, log) == []
    run_logged(spark, filled.spec(), START, target, log=log)
    run_logged(spark, filled.spec(), "2021-03-06", target, options=RunOptions(merge="sort_merge"), log=log)
    first, second = entries(spark, log)
    assert (first.table, first.mode, first.as_of, first.status, first.reason) == (target.table, "flat", "2021-03-05", "published", None)
    assert (first.last_date, first.with_load, first.resumed) == (None, True, None) and first.seconds > 0
    assert (first.read, first.undated, first.too_early, first.too_late) == (4, 0, 0, 0)
    assert (first.changed, first.deleted, first.published) == (3, 1, 2)
    assert (second.last_date, second.with_load, second.as_of) == (date(2021, 3, 5), False, "2021-03-06")
    assert (second.read, second.undated, second.changed, second.deleted, second.published) == (4, 1, 3, 1, 2)


def test_partitioned_runs_count_their_day(spark, filled, target, log):
    run_logged(spark, filled.spec(), START, target, "partitioned", log=log)
    run_logged(spark, filled.spec(), "2021-03-06", target, "partitioned", log=log)
    assert [(e.changed, e.deleted, e.published) for e in entries(spark, log)] == [(2, 0, 2), (0, 0, 0)]


def test_refused_runs(spark, filled, target, log):
    with pytest.raises(ValueError, match="cdc_start_date"):
        run_logged(spark, filled.spec(), "2021-03-04", target, log=log)
    with pytest.raises(ValueError, match="YYYY-MM-DD"):
        run_logged(spark, filled.spec(), "5 March", target, log=log)
    refused = entries(spark, log)
    assert [(e.as_of, e.status) for e in refused] == [("2021-03-04", "refused"), ("5 March", "refused")]
    assert "cdc_start_date" in refused[0].reason and refused[0].read is None
    assert not table_exists(spark, target.table)


def test_failed_runs(spark, filled, target, log, monkeypatch):
    with monkeypatch.context() as patch:
        patch.setattr(running, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_logged(spark, filled.spec(), START, target, log=log)
    filled.write("20210305-2.parquet", change("U", "no time, but long enough to be one", 1, "b"))
    with pytest.raises(Exception, match="malformed"):
        run_logged(spark, filled.spec(), START, target, log=log)
    failed = entries(spark, log)
    assert [e.status for e in failed] == ["failed", "failed"]
    assert "division" in failed[0].reason and "malformed" in failed[1].reason and len(failed[1].reason) <= 1000


def test_a_log_serves_many_tables_and_other_work(spark, filled, target, log):
    run_logged(spark, filled.spec(), START, target, log=log)
    with logged(spark, log, "other", "write", START) as entry:
        entry["published"] = 7
    assert [(e.table, e.mode, e.published) for e in entries(spark, log)] == [(target.table, "flat", 2), ("other", "write", 7)]


def test_counts_without_a_log(spark, filled, target):
    assert run_snapshot(spark, filled.spec(), START, target).effects == {}
    report = run_snapshot(spark, filled.spec(), START, target, options=RunOptions(count_rows=True))
    assert report.effects == {"changed": 3, "deleted": 1, "published": 2}


def test_job_writes_the_log(spark, filled, target, log, tmp_path):
    feeds = '{"people": {"path": "%s", "primary_keys": ["id"], "cdc_start_date": "2021-03-05", "schema": "id int, name string"}}'
    (tmp_path / "feeds.json").write_text(feeds % filled.folder)
    args = ["--feeds", str(tmp_path / "feeds.json"), "--input-table", "people", "--output-table", target.table]
    args += ["--output-root", target.root, "--run-log", log]
    report = job.main([*args, "--processing-date", "2021-03-05"], spark)
    assert report.effects["published"] == 2
    with pytest.raises(ValueError, match="before"):
        job.main([*args, "--processing-date", "2021-03-04"], spark)
    assert [e.status for e in entries(spark, log)] == ["published", "refused"]
