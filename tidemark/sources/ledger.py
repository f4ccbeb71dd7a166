"""Which feed files a table has taken in, so that a run reads new ones and those it must read again.

A run covers the last published day once more, since files of that day may arrive after its run. Mostly none do,
and then all that day's rows are in the snapshot already. The ledger, beside the table's folder, has a
row per file that a published run read: its length and time of change, by which a file that was written
again is a new one, and the days of its rows. With it a run skips the files of the last published day, unless

* a new file holds rows of that day or an earlier one, which have to be ranked among the old ones,
* one of the files holds rows of a later day, which no run has taken in yet, or rows with a null in the key, which
  every run adds that reads them, or
* the load takes part, which must not come without the changes after it.

Then all of them are read, since their rows have to be ranked among each other.

So the result is that of reading all files, as long as the null policy stays the same from run to run. Flat runs
only: a partitioned run takes other rows from the same file on another day."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import change_day
from tidemark.functions.names import cols
from tidemark.scratch import store
from tidemark.sources.feed import list_feed, list_selected
from tidemark.sources.snapshots import load_or_empty
from tidemark.spec import FILE_NAME, FILE_PATH, STAMP, FeedSpec, Target

LEDGER = (
    T.StructType()
    .add("file_path", "string")
    .add("file_name", "string")
    .add("length", "long")
    .add("modified", "timestamp")
    .add("file_date", "date")
    .add("first_day", "date")
    .add("last_day", "date")
    .add("null_keys", "boolean")
    .add("as_of", "date")
)
FILE = ("file_path", "length", "modified")


def ledger_path(target: Target) -> str:
    parent, name = target.root.rsplit("/", 1)
    return f"{parent}/_ledger/{name}"


def read_ledger(spark: SparkSession, target: Target) -> DataFrame:
    return load_or_empty(spark, ledger_path(target), LEDGER)


@dataclass(frozen=True)
class Reading:
    """What a run reads: names of files, and ledger rows of those that are new."""

    names: list[str]
    skipped: list[str] = field(default_factory=list)
    new: DataFrame | None = None


def _known(spark: SparkSession, target: Target, last_date: date | None) -> DataFrame:
    """One row per file that the table's current version has taken in. Rows of later versions, to
    which the table was rolled back, or of a table that is gone, do not count."""
    current = F.col("as_of") <= F.lit(last_date) if last_date is not None else F.lit(False)
    newest = Window.partitionBy(*FILE).orderBy(F.col("as_of").desc())
    valid = read_ledger(spark, target).where(current).withColumn("rank", F.row_number().over(newest))
    return valid.where("rank = 1").select(*FILE, "last_day", "null_keys", F.lit(True).alias("known"))


def _days_of(feed: DataFrame, spec: FeedSpec, names: list[str]) -> DataFrame:
    """First and last day of the rows of each file, and whether a key has a null; reads these columns only."""
    day = change_day(F.col(STAMP), "drop")
    null_key = reduce(or_, [c.isNull() for c in cols(spec.primary_keys)])
    return (
        feed.where(F.col(FILE_NAME).isin(names))
        .groupBy(F.col(FILE_PATH).alias("file_path"))
        .agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.max(null_key).alias("null_keys"))
    )


def plan_reading(
    spark: SparkSession,
    spec: FeedSpec,
    feed: DataFrame,
    target: Target,
    first: date,
    as_of: date,
    with_load: bool,
    last_date: date | None,
) -> Reading:
    """Choose the files of a run from the listing and the ledger.

    What comes to the driver is a row per file of the run's days, as the file index holds them anyway."""
    listed = list_selected(list_feed(spark, spec.path), first, as_of, with_load)
    known = _known(spark, target, last_date)
    files, _ = store(listed.join(known, list(FILE), "left"), "files")
    rows = files.select("file_name", "kind", "known", "last_day", "null_keys").collect()
    unread = [r.file_name for r in rows if not r.known or r.kind == "load"]
    changes = [r.file_name for r in rows if not r.known and r.kind == "change"]
    taken = [r for r in rows if r.known and r.kind == "change"]
    new = None
    reopened = with_load  # load rows must not come alone: they would undo the changes of their day
    if changes:
        fresh = files.where("known IS NULL AND kind = 'change'").drop("last_day", "null_keys")
        days = _days_of(feed, spec, changes)
        entry = fresh.join(days, "file_path", "left").withColumn("as_of", F.lit(as_of))
        new, _ = store(entry.select(LEDGER.fieldNames()), "ledger")
        earliest = new.agg(F.min("first_day").alias("day")).first().day
        reopened = reopened or last_date is not None and earliest is not None and earliest <= last_date
    reopened = reopened or any(r.null_keys or r.last_day and r.last_day > last_date for r in taken)
    again = [r.file_name for r in taken] if reopened else []
    skipped = sorted({r.file_name for r in taken} - set(again) - set(unread))
    return Reading(sorted({*unread, *again}), skipped, new)


def read_only(feed: DataFrame, reading: Reading) -> DataFrame:
    """The rows of the chosen files; others are pruned in the file index."""
    return feed.where(F.col(FILE_NAME).isin(reading.names))


def enter(target: Target, reading: Reading, last_date: date | None) -> None:
    """Add the new files, once what they hold is published. A table made anew starts a new ledger."""
    if reading.new is not None:
        mode = "append" if last_date is not None else "overwrite"
        reading.new.coalesce(1).write.mode(mode).parquet(ledger_path(target))
