from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidemark.operators.changes import (
    STAMP_ORDER,
    change_sequence,
    deleted_keys,
    latest_change,
    latest_change_agg,
    within_dates,
)
from tidemark.spec import FILE_PATH, IS_CHANGE, OP, ROW_INDEX, STAMP

FEED = (
    T.StructType()
    .add("k1", "integer")
    .add("k2", "string")
    .add("v", "string")
    .add(OP, "string")
    .add(STAMP, "string")
    .add(IS_CHANGE, "integer")
    .add(FILE_PATH, "string")
    .add(ROW_INDEX, "long")
)
NAMES = FEED.fieldNames()


def random_feed(seed: int, n: int, hot: float = 0.0):
    """Rows with many ties in time and file; a hot and a null key take a share."""
    chance = random.Random(seed)
    made = []
    for i in range(n):
        k1 = 1 if chance.random() < hot else chance.choice([None, 2, 3, 4, 5, 6])
        k2 = chance.choice([None, "a", "b"]) if k1 != 1 else "a"
        stamp = f"2024-01-0{chance.randint(1, 4)} 0{chance.randint(0, 2)}:00:00.000000"
        load = chance.random() < 0.1
        made.append(
            (
                k1,
                k2,
                str(i),
                None if load else chance.choice("IUD"),
                stamp,
                0 if load else 1,
                f"file{chance.randint(0, 3)}",
                i,
            )
        )
    chance.shuffle(made)
    return made


def by_order(*names):
    places = [NAMES.index(n) for n in names]
    return lambda row: tuple(row[i] for i in places)


def expected_latest(made, keys, order):
    key, place = by_order(*keys), by_order(*order)
    newest = {}
    for row in sorted(made, key=place):
        newest[key(row)] = row
    return newest


ORDER = (IS_CHANGE, STAMP, FILE_PATH, ROW_INDEX)


@pytest.mark.parametrize("keys", [["k1"], ["k1", "k2"]])
@pytest.mark.parametrize("order", [ORDER, STAMP_ORDER])
def test_latest_change_against_brute_force(spark, keys, order):
    made = random_feed(1, 600, hot=0.4)
    frame = spark.createDataFrame(made, FEED).repartition(5)
    want = sorted(map(str, expected_latest(made, keys, order).values()))
    for find in (latest_change, latest_change_agg):
        found = find(frame, keys, order).select(*NAMES)
        assert sorted(str(tuple(row)) for row in found.collect()) == want


def expected_sequence(made, keys, order):
    key, place = by_order(*keys), by_order(*order)
    seen, numbers = {}, {}
    for row in sorted(made, key=place):
        seen[key(row)] = seen.get(key(row), 0) + 1
        numbers[row[-1]] = seen[key(row)]
    return numbers


@pytest.mark.parametrize("keys", [["k1"], ["k1", "k2"]])
@pytest.mark.parametrize("hot_rows", [5_000_000, 150, 0])
def test_change_sequence_against_brute_force(spark, keys, hot_rows):
    """Above 150 rows lie the hot key and, for the short key, perhaps others; above 0
    lie all keys, null ones included."""
    made = random_feed(2, 900, hot=0.4)
    frame = spark.createDataFrame(made, FEED).repartition(6)
    numbered = change_sequence(frame, keys, hot_rows=hot_rows)
    assert numbered.columns == [*NAMES, "change_seq"]
    found = {row[ROW_INDEX]: row.change_seq for row in numbered.collect()}
    assert found == expected_sequence(made, keys, ORDER)


def test_change_sequence_of_one_key_and_one_time(spark):
    """All rows tie in key and time, so only file and position cut the slices."""
    made = [(1, "a", "v", "U", "2024-01-01", 1, f"f{i % 3}", i) for i in range(1000)]
    frame = spark.createDataFrame(made, FEED).repartition(7)
    numbered = change_sequence(frame, ["k1"], hot_rows=10)
    found = {row[ROW_INDEX]: row.change_seq for row in numbered.collect()}
    assert found == expected_sequence(made, ["k1"], ORDER)


def test_sequence_needs_no_slices_for_an_empty_feed(spark):
    assert change_sequence(spark.createDataFrame([], FEED), ["k1"]).count() == 0


def stamped(spark, *stamps):
    made = [(i, None, s, "U", s, 1, "f", i) for i, s in enumerate(stamps)]
    return spark.createDataFrame(made, FEED)


def test_dates_are_inclusive_and_undated_rows_drop_out(spark):
    frame = stamped(
        spark,
        "2024-01-01 23:59:59.999999",
        "2024-01-02 00:00:00.000000",
        "2024-01-03 23:59:59.999999",
        "2024-01-04 00:00:00.000000",
        None,
    )
    kept = within_dates(frame, date(2024, 1, 2), date(2024, 1, 3))
    assert rows(kept, "k1") == [(1,), (2,)]


def test_malformed_time_fails_or_drops(spark):
    frame = stamped(spark, "2024-01-02 00:00:00.000000", "soon")
    day = date(2024, 1, 2)
    with pytest.raises(Exception, match="malformed change time: soon"):
        within_dates(frame, day, day).collect()
    assert rows(within_dates(frame, day, day, "drop"), "k1") == [(0,)]


def test_filter_comes_before_rank(spark):
    """Changes before, in and after the range: the last one inside counts."""
    made = [
        (1, None, day, "U", f"2024-01-0{day} 00:00:00", 1, "f", int(day)) for day in "12345"
    ]
    kept = within_dates(spark.createDataFrame(made, FEED), date(2024, 1, 2), date(2024, 1, 4))
    assert rows(latest_change(kept, ["k1"]), "v") == [("4",)]


def test_deleted_keys(spark):
    made = [
        (1, None, "x", "I", "1", 1, "f", 0),
        (1, None, "x", "D", "2", 1, "f", 1),
        (2, None, "x", "D", "1", 1, "f", 2),
        (2, None, "x", "I", "2", 1, "f", 3),
        (3, None, "x", None, "1", 0, "f", 4),
    ]
    latest = latest_change(spark.createDataFrame(made, FEED), ["k1"])
    assert rows(deleted_keys(latest, ["k1"])) == [(1,)]


def test_column_names_need_no_care(spark):
    frame = spark.createDataFrame(
        [(1, "x", "U", "1", 1, "f", 0)],
        T.StructType()
        .add("a.b `c`", "integer")
        .add("select", "string")
        .add(OP, "string")
        .add(STAMP, "string")
        .add(IS_CHANGE, "integer")
        .add(FILE_PATH, "string")
        .add(ROW_INDEX, "long"),
    )
    for find in (latest_change, latest_change_agg):
        assert find(frame, ["a.b `c`"]).count() == 1
    for hot_rows in (0, 10):
        numbered = change_sequence(frame, ["a.b `c`"], hot_rows=hot_rows)
        assert numbered.select(F.col("change_seq")).first().change_seq == 1
