from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import model
from tests.conftest import rows
from tidemark.operators import merge as merging
from tidemark.operators.merge import fits_broadcast, merge_snapshot, partition_rows
from tidemark.scratch import store

SNAPSHOT = T.StructType().add("k1", "integer").add("k2", "string").add("v", "string").add("w", "long")
DELTA = T.StructType([T.StructField("Op", T.StringType()), *SNAPSHOT.fields])
COLUMNS = SNAPSHOT.fieldNames()
KEYS = ["k1", "k2"]

STRATEGIES = ["sort_merge", "split", "broadcast_delta"]


def frames(spark, old, delta):
    return spark.createDataFrame(old, SNAPSHOT), spark.createDataFrame(delta, DELTA)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_update_insert_delete(spark, strategy):
    old, delta = frames(
        spark,
        [(1, "a", "x", 1), (2, "a", "x", 2), (3, "a", "x", 3), (4, "a", "x", 4)],
        [
            ("U", 1, "a", "new", None),
            ("D", 2, "a", "x", 2),
            (None, 3, "a", "load", 30),
            ("D", 9, "a", None, None),
            ("U", 8, "a", None, 8),
        ],
    )
    kept = [(3, "a", "load", 30), (4, "a", "x", 4), (8, "a", None, 8)]
    merged = merge_snapshot(old, delta, KEYS, COLUMNS, strategy=strategy)
    assert merged.columns == COLUMNS
    assert rows(merged) == sorted([(1, "a", "new", 1), *kept], key=str)
    merged = merge_snapshot(old, delta, KEYS, COLUMNS, "overwrite", strategy)
    assert rows(merged) == sorted([(1, "a", "new", None), *kept], key=str)


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("policy", ["keep_old", "overwrite"])
def test_null_keys_match_nothing(spark, strategy, policy):
    old, delta = frames(
        spark,
        [(None, "a", "old", 1), (1, None, "old", 2), (None, "a", "old", 3)],
        [("U", None, "a", "new", 4), ("D", 1, None, "new", 5), ("D", None, None, "new", 6)],
    )
    merged = merge_snapshot(old, delta, KEYS, COLUMNS, policy, strategy)
    assert rows(merged, "v", "w") == [("new", 4), ("old", 1), ("old", 2), ("old", 3)]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_repeated_old_rows_are_all_updated(spark, strategy):
    old, delta = frames(
        spark,
        [(1, "a", "x", 1), (1, "a", "x", 2), (2, "a", "x", 3), (2, "a", "x", 4)],
        [("U", 1, "a", "y", None), ("D", 2, "a", None, None)],
    )
    merged = merge_snapshot(old, delta, KEYS, COLUMNS, strategy=strategy)
    assert rows(merged) == [(1, "a", "y", 1), (1, "a", "y", 2)]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_empty_sides(spark, strategy):
    old, delta = frames(spark, [(1, "a", "x", 1)], [("U", 2, "a", "y", 2)])
    none, nothing = frames(spark, [], [])
    merge = lambda o, d: rows(merge_snapshot(o, d, KEYS, COLUMNS, strategy=strategy))
    assert merge(old, nothing) == [(1, "a", "x", 1)]
    assert merge(none, delta) == [(2, "a", "y", 2)]
    assert merge(none, nothing) == []


def test_limits_decide_on_broadcast(spark, monkeypatch):
    old, delta = frames(spark, [(1, "a", "x", 1)], [("U", k, "a", "y" * 50, k) for k in range(20)])
    stored, _ = store(delta, "test")
    assert fits_broadcast(stored)
    assert not fits_broadcast(stored, max_rows=19)
    assert not fits_broadcast(stored, max_bytes=1000)
    assert fits_broadcast(stored.limit(0), max_rows=0, max_bytes=0)

    def joins(df):
        return df._jdf.queryExecution().executedPlan().toString()

    small = merge_snapshot(old, delta, KEYS, COLUMNS, strategy="broadcast_delta")
    assert "BroadcastHashJoin" in joins(small)
    for limit in ({"max_rows": 19}, {"max_bytes": 1000}):
        large = merging.merge_stored(old, stored, KEYS, COLUMNS, **limit)
        assert "LeftOuter" in joins(large) and "LeftAnti" in joins(large) and "FullOuter" not in joins(large)
        assert rows(large) == rows(small)
    with pytest.raises(ValueError):
        merge_snapshot(old, delta, KEYS, COLUMNS, strategy="cross")


SKEWED = {
    "spark.sql.files.maxPartitionBytes": "200k",
    "spark.sql.files.openCostInBytes": "1k",
    "spark.sql.shuffle.partitions": "12",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skewed(spark):
    before = {name: spark.conf.get(name, None) for name in SKEWED}
    for name, value in SKEWED.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("policy", ["keep_old", "overwrite"])
def test_a_hot_key_of_the_old_snapshot_is_split_over_tasks(spark, skewed, policy):
    """A third of the old rows hold one key, which also changes."""
    n = 60_000
    old, _ = store(
        spark.range(0, n, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("int").alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
            F.col("id").alias("w"),
        ),
        "hot",
    )
    made = [("U", 7, "hot", None), ("D", 10, None, None), ("I", n + 5, "new", 1), ("U", 11, None, 3), ("D", n + 6, "x", 1)]
    delta, _ = store(spark.createDataFrame(made, "Op string, k int, v string, w long"), "delta")
    largest, found = {}, {}
    for strategy in ("split", "sort_merge"):
        merged = merge_snapshot(old, delta, ["k"], ["k", "v", "w"], policy, strategy)
        done, _ = store(merged.withColumn("task", F.spark_partition_id()), "merged")
        largest[strategy] = done.groupBy("task").count().agg(F.max("count")).first()[0]
        found[strategy] = done.drop("task")
    assert largest["sort_merge"] > n / 3 and largest["split"] < n / 10
    assert found["split"].exceptAll(found["sort_merge"]).isEmpty()
    assert found["sort_merge"].exceptAll(found["split"]).isEmpty()
    assert found["split"].where("k = 7 AND v = 'hot'").count() == n / 3 + 1


key = st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "a", "b"]))
value = st.tuples(st.sampled_from([None, "x", "y"]), st.sampled_from([None, 1, 2]))


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    old=st.dictionaries(key, value, max_size=9),
    delta=st.dictionaries(key, st.tuples(st.sampled_from([None, "I", "U", "D"]), value), max_size=9),
    overwrite=st.booleans(),
)
def test_strategies_agree_with_brute_force(spark, old, delta, overwrite):
    old_rows = [(*k, *v) for k, v in old.items()]
    delta_rows = [(op, *k, *v) for k, (op, v) in delta.items()]
    newest = {row[1:3]: dict(zip(DELTA.fieldNames(), row)) for row in delta_rows}
    old_dicts = [dict(zip(COLUMNS, row)) for row in old_rows]
    want = model.merge(old_dicts, newest, COLUMNS, KEYS, overwrite)
    want = sorted(str(tuple(row[c] for c in COLUMNS)) for row in want)
    policy = "overwrite" if overwrite else "keep_old"
    for strategy in STRATEGIES:
        merged = merge_snapshot(*frames(spark, old_rows, delta_rows), KEYS, COLUMNS, policy, strategy)
        assert sorted(str(tuple(row)) for row in merged.collect()) == want


def test_partition_rows(spark):
    made = [(1, "2024-01-02 10:00:00"), (2, "2024-01-03"), (3, None)]
    frame = spark.createDataFrame(made, "k int, t string")
    kept = partition_rows(frame, "t", date(2024, 1, 2))
    assert rows(kept, "k", "dt") == [(1, date(2024, 1, 2))]
    stamps = frame.withColumn("t", F.to_timestamp("t"))
    assert rows(partition_rows(stamps, "t", date(2024, 1, 3)), "k") == [(2,)]


def test_complex_payload_passes_through(spark):
    schema = (
        T.StructType()
        .add("k", "integer")
        .add("m", T.MapType(T.StringType(), T.IntegerType()))
        .add("a", T.ArrayType(T.StringType()))
        .add("s", T.StructType().add("x", "decimal(10,2)").add("t", "timestamp"))
    )
    old = spark.createDataFrame([(1, {"a": 1}, ["x"], None)], schema)
    delta = spark.createDataFrame(
        [("U", 1, {"b": 2}, None, None), ("I", 2, None, ["y"], None)],
        T.StructType([T.StructField("Op", T.StringType()), *schema.fields]),
    )
    for strategy in STRATEGIES:
        merged = merge_snapshot(old, delta, ["k"], schema.fieldNames(), strategy=strategy)
        assert sorted((r.k, r.m, r.a) for r in merged.collect()) == [
            (1, {"b": 2}, ["x"]),
            (2, None, ["y"]),
        ]
