from __future__ import annotations

from datetime import date

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import START, change, rows
from tidemark.operators.changes import change_sequence, latest_change, within_dates
from tidemark.sources.feed import (
    check_file_names,
    list_feed,
    rebase_load,
    scan_feed,
    select_files,
    select_load_files,
)
from tidemark.spec import FILE_NAME, FILE_PATH, IS_CHANGE, ROW_INDEX

T0 = "2021-03-05 08:00:00"


def test_listing_tells_files_apart(spark, feed):
    feed.load("LOAD00000001.parquet", {"id": 1})
    feed.write("20210305-1.parquet", change("U", T0, 1))
    feed.write("deep/er/20210306-1.parquet", change("U", T0, 1))
    (feed.folder / "notes.txt").write_text("hello")
    (feed.folder / "_SUCCESS").write_text("")
    listed = list_feed(spark, str(feed.folder))
    assert rows(listed, "file_name", "kind", "file_date") == [
        ("20210305-1.parquet", "change", date(2021, 3, 5)),
        ("20210306-1.parquet", "change", date(2021, 3, 6)),
        ("LOAD00000001.parquet", "load", None),
        ("notes.txt", "other", None),
    ]
    assert rows(list_feed(spark, str(feed.folder / "missing"))) == []


@pytest.mark.parametrize(
    "name", ["20201301-x.parquet", "notes.parquet", "2020111.parquet", "xLOAD.parquet", "a.txt"]
)
def test_bad_names_are_named(spark, feed, name):
    feed.write("20210305-1.parquet", change("U", T0, 1))
    check_file_names(scan_feed(spark, feed.spec()), str(feed.folder))
    (feed.folder / name).write_bytes(b"not parquet")
    with pytest.raises(ValueError, match=name):
        check_file_names(scan_feed(spark, feed.spec()), str(feed.folder))


def test_files_outside_the_dates_are_not_opened(spark, feed):
    """Unwanted files hold garbage, which any attempt to open them would show."""
    feed.load("LOAD1.parquet", {"id": 1})
    for day in ("20210305", "20210306", "20210307", "20210308"):
        feed.write(f"{day}-1.parquet", change("U", T0, 1, day))
    for name in ("20210305-1", "20210308-1"):
        (feed.folder / f"{name}.parquet").write_bytes(b"garbage")
    first, last = date(2021, 3, 6), date(2021, 3, 7)
    scanned = scan_feed(spark, feed.spec())
    inside = select_files(scanned, first, last, with_load=False)
    assert rows(inside, "name") == [("20210306",), ("20210307",)]
    both = select_files(scanned, first, last, with_load=True)
    assert rows(both, "name", IS_CHANGE) == [("20210306", 1), ("20210307", 1), (None, 0)]
    assert rows(select_load_files(scanned), FILE_NAME) == [("LOAD1.parquet",)]
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        scanned.collect()


def test_load_without_envelope_is_stamped(spark, feed):
    feed.load("LOAD1.parquet", {"id": 1, "name": "a"})
    feed.write("20210305-1.parquet", change("U", T0, 1, "b"))
    stamped = rebase_load(scan_feed(spark, feed.spec()), START)
    assert rows(stamped, "name", "Op", "cdc_timestamp") == [
        ("a", None, "2021-03-05 00:00:00.000000"),
        ("b", "U", f"{T0}.000000"),
    ]


def test_any_load_stamp_is_replaced_before_it_is_read(spark, feed):
    feed.write("LOAD1.parquet", change("I", "whenever", 1, "a"))
    stamped = rebase_load(scan_feed(spark, feed.spec()), START)
    assert rows(within_dates(stamped, START, START), "name") == [("a",)]


def test_equal_times_within_one_file(spark, feed):
    feed.write("20210305-1.parquet", change("U", T0, 1, "b"), change("U", T0, 1, "c"))
    assert rows(latest_change(scan_feed(spark, feed.spec()), ["id"]), "name") == [("c",)]


def test_equal_times_across_files_written_in_any_order(spark, feed):
    feed.write("20210305-2.parquet", change("U", T0, 1, "c"))
    feed.write("20210305-1.parquet", *[change("U", T0, 1, "b")] * 500)
    assert rows(latest_change(scan_feed(spark, feed.spec()), ["id"]), "name") == [("c",)]


def test_file_order_is_by_path_even_with_characters_that_uris_escape(spark, feed):
    names = ["20210305 a", "20210305!a", "20210305%a", "20210305+a", "20210305-a", "20210305é"]
    for name in sorted(names, reverse=True):
        feed.write(f"{name}.parquet", change("U", T0, 1, name))
    scanned = scan_feed(spark, feed.spec())
    assert rows(scanned.select(F.substring_index(FILE_PATH, "/", -1))) == [
        (f"{name}.parquet",) for name in sorted(names)
    ]
    numbered = change_sequence(scanned, ["id"]).orderBy("change_seq")
    assert [row.name for row in numbered.collect()] == sorted(names)


def test_order_survives_splitting_a_file(spark, feed):
    """One file read by many tasks keeps the positions of its rows."""
    count = 20_000
    feed.write(
        "20210305-1.parquet",
        *[change("U", T0, 1, str(i)) for i in range(count)],
        row_group=500,
    )
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    scanned = scan_feed(session, feed.spec())
    assert scanned.rdd.getNumPartitions() > 4
    assert scanned.where(F.col("name") != F.col(ROW_INDEX).cast("string")).count() == 0
    assert rows(latest_change(scanned, ["id"]), "name") == [(str(count - 1),)]


def test_strict_schema(spark, feed):
    table = pa.table(
        {
            "Op": ["U"],
            "cdc_timestamp": [T0],
            "id": pa.array([1], pa.int32()),
            "name": ["a"],
            "extra": ["ignored"],
        }
    )
    pq.write_table(table, feed.folder / "20210305-1.parquet")
    scanned = scan_feed(spark, feed.spec())
    assert rows(scanned, "id", "name", "city", "day") == [(1, "a", None, None)]
    assert "extra" not in scanned.columns
    wide = T.StructType().add("id", "long").add("name", "string")
    spec = feed.spec(schema=wide, partition_date=None)
    assert rows(scan_feed(spark, spec), "id") == [(1,)]
    text = T.StructType().add("id", "integer").add("name", "timestamp")
    with pytest.raises(Exception, match="PARQUET_COLUMN_DATA_TYPE_MISMATCH"):
        scan_feed(spark, feed.spec(schema=text, partition_date=None)).collect()


def test_folder_names_do_not_matter(spark, feed):
    feed.write("LOADED/day=1/20210305-1.parquet", change("U", T0, 1, "a"))
    scanned = scan_feed(spark, feed.spec())
    assert rows(scanned, "name", IS_CHANGE) == [("a", 1)]
    assert len(scanned.columns) == 10


def test_missing_folder_is_a_feed_without_files(spark, feed):
    scanned = scan_feed(spark, feed.spec(path=str(feed.folder / "missing")))
    check_file_names(scanned, str(feed.folder / "missing"))
    assert rows(latest_change(scanned, ["id"])) == []
