"""The order of changes and the latest one per key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import change_day
from tidemark.functions.names import cols, quoted
from tidemark.scratch import store
from tidemark.spec import DELETE, FILE_PATH, IS_CHANGE, OP, ROW_INDEX, STAMP

# Load rows first, then by change time; ties by file, then by place in the file.
CHANGE_ORDER = (IS_CHANGE, STAMP, FILE_PATH, ROW_INDEX)
# Load rows take part at the time they are stamped with.
STAMP_ORDER = (STAMP, IS_CHANGE, FILE_PATH, ROW_INDEX)

# A key with more rows than this is numbered by several tasks, of about as many rows.
ROWS_PER_SLICE = 5_000_000
# Upper bound of the offsets that numbering in slices broadcasts, one row per slice.
MAX_SLICES = 20_000


def change_order(load_rank: str) -> tuple[str, ...]:
    return CHANGE_ORDER if load_rank == "first" else STAMP_ORDER


def within_dates(
    changes: DataFrame, first: date, last: date, bad_timestamp: str = "fail"
) -> DataFrame:
    """Changes whose day lies in [first, last]; rows without a change time drop out.

    Belongs below the ranking: order within a subset is the order within the whole,
    and every row removed here is a row not sorted or shuffled."""
    day = change_day(F.col(STAMP), bad_timestamp)
    return changes.where(day.between(F.lit(first), F.lit(last)))


def latest_change(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str] = CHANGE_ORDER
) -> DataFrame:
    """The last change of every key, all null keys counting as one.

    Ranking descending and keeping rank 1 lets Spark cut each input partition to one
    row per key before the shuffle, so a hot key costs one row per map task."""
    newest_first = Window.partitionBy(*cols(keys)).orderBy(*[c.desc() for c in cols(order)])
    ranked = changes.withColumn("_cdc_rank", F.row_number().over(newest_first))
    return ranked.where(F.col("_cdc_rank") == 1).drop("_cdc_rank")


def latest_change_agg(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str] = CHANGE_ORDER
) -> DataFrame:
    """The same rows as `latest_change`, as one aggregate with partial combining."""
    rest = [name for name in changes.columns if name not in set(keys)]
    newest = F.max_by(F.struct(*cols(rest)), F.struct(*cols(order)))
    return (
        changes.groupBy(*cols(keys))
        .agg(newest.alias("_cdc_newest"))
        .select(*cols(keys), *[F.col(f"_cdc_newest.{quoted(name)}") for name in rest])
    )


def deleted_keys(latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose last change removes them."""
    return latest.where(F.col(OP) == DELETE).select(*cols(keys))


def _same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for l, r in zip(cols(keys, left), cols(keys, right)):
        condition = condition & l.eqNullSafe(r)
    return condition


def change_sequence(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = CHANGE_ORDER,
    hot_rows: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Number the changes of every key from 1 on, in order, as `change_seq`.

    Unlike the latest change, a full numbering keeps every row, so one window would
    hand a hot key whole to one task. Keys are therefore counted first (key columns
    only, combined before the shuffle), and keys with more than `hot_rows` changes are
    numbered slice by slice. Counting starts a Spark job; the result itself is lazy.
    """
    in_order = Window.partitionBy(*cols(keys)).orderBy(*cols(order))
    number = F.row_number().over(in_order).cast("long")

    sizes = changes.groupBy(*cols(keys)).agg(F.count(F.lit(1)).alias("_cdc_rows"))
    hot, _ = store(sizes.where(F.col("_cdc_rows") > hot_rows), "hot-keys")
    in_hot_keys = hot.agg(F.sum("_cdc_rows").alias("n")).first().n
    if not in_hot_keys:
        return changes.withColumn("change_seq", number)

    def on_hot(how: str) -> DataFrame:
        hot_keys = hot.select(*cols(keys)).alias("hot")
        return changes.alias("all").join(hot_keys, _same_key("all", "hot", keys), how)

    cold = on_hot("left_anti").withColumn("change_seq", number)
    cores = changes.sparkSession.sparkContext.defaultParallelism
    slices = min(max(cores, ceil(in_hot_keys / ROWS_PER_SLICE)), MAX_SLICES)
    return cold.unionByName(_sequence_in_slices(on_hot("left_semi"), keys, order, slices))


def _sequence_in_slices(
    changes: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int
) -> DataFrame:
    """Number keys that span tasks: cut the rows into ranges of (key, order), number
    within each range, and add the rows of the same key in earlier ranges.

    The ranges are written once, so both readings below see the same cut even when
    an executor is lost in between."""
    ranged = changes.repartitionByRange(slices, *cols(keys), *cols(order))
    cut, _ = store(ranged.withColumn("_cdc_slice", F.spark_partition_id()), "slices")

    earlier = (
        Window.partitionBy(*cols(keys))
        .orderBy("_cdc_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # A key has rows before a slice only if it is the first key of that slice, so
    # at most one row per slice is left to broadcast.
    before = (
        cut.groupBy("_cdc_slice", *cols(keys))
        .agg(F.count(F.lit(1)).alias("_cdc_rows"))
        .withColumn("_cdc_before", F.sum("_cdc_rows").over(earlier))
        .where(F.col("_cdc_before") > 0)
        .drop("_cdc_rows")
    )
    in_slice = Window.partitionBy("_cdc_slice", *cols(keys)).orderBy(*cols(order))
    numbered = cut.withColumn("_cdc_nr", F.row_number().over(in_slice).cast("long"))
    same_slice = F.col("rows._cdc_slice") == F.col("before._cdc_slice")
    joined = numbered.alias("rows").join(
        F.broadcast(before).alias("before"),
        same_slice & _same_key("rows", "before", keys),
        "left_outer",
    )
    seq = F.col("rows._cdc_nr") + F.coalesce(F.col("before._cdc_before"), F.lit(0))
    return joined.select(*cols(changes.columns, "rows"), seq.alias("change_seq"))
