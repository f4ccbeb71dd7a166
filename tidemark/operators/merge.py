"""Bringing the latest changes and the previous snapshot together."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import cols
from tidemark.scratch import store
from tidemark.spec import DELETE, OP, PARTITION

# Limits below which a set of changes is sent to every executor.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

_HIT = "_cdc_hit"


def partition_rows(
    latest: DataFrame, partition_date: str, day: date, bad_date: str = "fail"
) -> DataFrame:
    """Latest changes that belong to one date partition, with the date as `dt`.

    Applied after ranking: a key whose newest row is of another day has no row here.
    `bad_date` says whether a malformed text date stops the run or leaves its row out."""
    (column,) = cols([partition_date])
    if bad_date == "drop" and isinstance(latest.schema[partition_date].dataType, T.StringType):
        column = F.try_to_timestamp(column)
    return latest.withColumn(PARTITION, F.to_date(column)).where(F.col(PARTITION) == F.lit(day))


def upserts() -> Column:
    """Rows that stay after a merge: everything but deletes."""
    return F.col(f"new.{OP}").isNull() | (F.col(f"new.{OP}") != DELETE)


def _changes_only(delta: DataFrame, columns: Sequence[str]) -> DataFrame:
    return delta.select(OP, *cols(columns), F.lit(True).alias(_HIT))


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(and_, [o == n for o, n in zip(cols(keys, "old"), cols(keys, "new"))])


def _merged(columns: Sequence[str], null_policy: str) -> list[Column]:
    """New over old, column by column (keep_old) or row by row (overwrite)."""
    pairs = zip(columns, cols(columns, "old"), cols(columns, "new"))
    if null_policy == "keep_old":
        return [F.coalesce(new, old).alias(name) for name, old, new in pairs]
    hit = F.col(f"new.{_HIT}")
    return [F.when(hit, new).otherwise(old).alias(name) for name, old, new in pairs]


def sort_merge(
    old: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    null_policy: str = "keep_old",
) -> DataFrame:
    """Full outer join on the key; one row per key in `delta` and normally in `old`.

    The shuffle by key that ranked the changes also serves the join. Old rows with a
    null in the key match nothing; they bypass the join, because Spark cannot split
    them when they pile up in one task of a full outer join. `old` is read twice, the
    second time with the null test pushed down, so pass a stored frame."""
    key_is_null = reduce(or_, [c.isNull() for c in cols(keys)])
    keyed = old.where(~key_is_null).select(*cols(columns)).alias("old")
    unkeyed = old.where(key_is_null).select(*cols(columns))
    new = _changes_only(delta, columns).alias("new")
    joined = keyed.join(new, _same_key(keys), "full_outer").where(upserts())
    return joined.select(*_merged(columns, null_policy)).unionByName(unkeyed)


def split_merge(
    old: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    null_policy: str = "keep_old",
) -> DataFrame:
    """The same rows as two joins that adaptive execution can split where a key is hot.

    A full outer join must see all rows of a key in one task, since only there it is known which side found
    nothing. Here old rows take their change in a left outer join, whose left side may be cut anywhere, and
    changes without an old row are those that an anti join with the old keys leaves; these are made
    distinct before they move, so a hot key costs one row a task. For that the key columns of `old` are read a
    second time. For any stored or lazy `delta` with one row per key."""
    kept = (
        old.select(*cols(columns)).alias("old")
        .join(_changes_only(delta, columns).alias("new"), _same_key(keys), "left_outer")
        .where(upserts())
        .select(*_merged(columns, null_policy))
    )
    known = old.select(*cols(keys)).distinct().alias("old")
    live = _changes_only(delta, columns).alias("new").where(upserts())
    added = live.join(known, _same_key(keys), "left_anti").select(*cols(columns, "new"))
    return kept.unionByName(added)


def broadcast_merge(
    old: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    null_policy: str = "keep_old",
) -> DataFrame:
    """The same rows without moving `old`: it streams past the broadcast changes.

    Only for a stored `delta` that passed `fits_broadcast`. Changes that found no old
    row are the ones whose key a second, key-only reading of `old` does not show."""
    new = F.broadcast(_changes_only(delta, columns)).alias("new")
    kept = (
        old.select(*cols(columns)).alias("old")
        .join(new, _same_key(keys), "left_outer")
        .where(upserts())
        .select(*_merged(columns, null_policy))
    )
    live = _changes_only(delta, columns).alias("new").where(upserts())
    known = (
        old.select(*cols(keys)).alias("old")
        .join(F.broadcast(live.select(*cols(keys, "new"))).alias("new"), _same_key(keys), "left_semi")
        .distinct()
        .alias("old")
    )
    added = live.join(known, _same_key(keys), "left_anti").select(*cols(columns, "new"))
    return kept.unionByName(added)


def fits_broadcast(
    delta: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a stored set of changes is small enough to copy to every executor.

    Rows are counted first; the bytes of their text form only if the count passes."""
    if delta.count() > max_rows:
        return False
    size = F.sum(F.octet_length(F.to_json(F.struct(*cols(delta.columns)))))
    return (delta.agg(size.alias("size")).first().size or 0) <= max_bytes


def store_measured(delta: DataFrame, label: str) -> tuple[DataFrame, str, tuple[int, int]]:
    """Store a frame and count its rows, and the bytes of their text form, on the way."""
    seen = Observation(f"{label}-size")
    text = F.octet_length(F.to_json(F.struct(*cols(delta.columns)))).cast("long")
    stored, path = store(delta.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(text).alias("size")), label)
    return stored, path, (seen.get["n"], seen.get["size"] or 0)


def merge_stored(
    old: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    null_policy: str = "keep_old",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    size: tuple[int, int] | None = None,
) -> DataFrame:
    """Merge a stored set of changes the cheap way if its size allows; `size` is its rows and
    bytes where `store_measured` has counted them."""
    slim = delta.select(OP, *cols(columns))
    if size is None:
        small = fits_broadcast(slim, max_rows, max_bytes)
    else:
        small = size[0] <= max_rows and size[1] <= max_bytes
    return (broadcast_merge if small else split_merge)(old, slim, keys, columns, null_policy)


def merge_snapshot(
    old: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    null_policy: str = "keep_old",
    strategy: str = "sort_merge",
) -> DataFrame:
    """Previous snapshot plus latest changes: deletes gone, new keys added.

    `sort_merge` and `split` are lazy; the first moves every row once, the second also bears
    an old snapshot with many rows for one key. `broadcast_delta` writes the changes to the
    scratch folder to learn their size, and falls back to `split` above the limits."""
    lazy = {"sort_merge": sort_merge, "split": split_merge}
    if strategy in lazy:
        return lazy[strategy](old, delta, keys, columns, null_policy)
    if strategy != "broadcast_delta":
        raise ValueError(f"unknown merge strategy {strategy!r}")
    stored, _ = store(delta.select(OP, *cols(columns)), "delta")
    return merge_stored(old, stored, keys, columns, null_policy)
