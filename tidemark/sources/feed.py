"""Reading a feed: one scan over all its files, ordered by file metadata.

The predicates on file names are pushed into the file index, so files outside the
run's dates are never opened and no job per file is needed.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import compact, file_day, midnight
from tidemark.functions.frames import empty_frame
from tidemark.spec import FILE_NAME, FILE_PATH, IS_CHANGE, ROW_INDEX, STAMP, FeedSpec

LOAD_PREFIX = "LOAD"

_LISTING = (
    T.StructType()
    .add("path", "string")
    .add("file_path", "string")
    .add("file_name", "string")
    .add("length", "long")
    .add("modified", "timestamp")
    .add("kind", "string")
    .add("file_date", "date")
)
_POSITION = (
    T.StructType()
    .add(FILE_NAME, "string")
    .add(IS_CHANGE, "integer")
    .add(FILE_PATH, "string")
    .add(ROW_INDEX, "long")
)


def is_load(file_name: Column) -> Column:
    return file_name.startswith(LOAD_PREFIX)


def file_kind(file_name: Column) -> Column:
    return (
        F.when(is_load(file_name), "load")
        .when(file_day(file_name).isNotNull(), "change")
        .otherwise("other")
    )


def _plain_path(path: Column) -> Column:
    """Undo the URI escapes of metadata paths, which would change the sort order."""
    escaped_plus = F.replace(path, F.lit("+"), F.lit("%2B"))
    return F.when(path.contains("%"), F.url_decode(escaped_plus)).otherwise(path)


def list_feed(spark: SparkSession, path: str) -> DataFrame:
    """The files below a folder, as rows; contents are not read."""
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, _LISTING)
    name = F.col("_metadata.file_name")
    return files.select(
        "path",
        _plain_path(F.col("_metadata.file_path")).alias("file_path"),
        name.alias("file_name"),
        "length",
        F.col("modificationTime").alias("modified"),
        file_kind(name).alias("kind"),
        file_day(name).alias("file_date"),
    )


def list_selected(listed: DataFrame, first: date, last: date, with_load: bool) -> DataFrame:
    """The listed files that a run over these days reads."""
    day = F.substring("file_name", 1, 8).between(compact(first), compact(last))
    change = (F.col("kind") == "change") & day
    return listed.where(change | (F.col("kind") == "load") if with_load else change)


def scan_feed(spark: SparkSession, spec: FeedSpec) -> DataFrame:
    """All rows below the feed path under the fixed schema, with their position.

    A missing folder is a feed without files, as for any object store prefix."""
    reader = spark.read.options(**spec.read_options).option("recursiveFileLookup", True)
    try:
        rows = reader.schema(spec.envelope).parquet(spec.path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, T.StructType(spec.envelope.fields + _POSITION.fields))
    name = F.col("_metadata.file_name")
    return rows.select(
        "*",
        name.alias(FILE_NAME),
        F.when(is_load(name), 0).otherwise(1).alias(IS_CHANGE),
        _plain_path(F.col("_metadata.file_path")).alias(FILE_PATH),
        F.col("_metadata.row_index").alias(ROW_INDEX),
    )


def check_file_names(feed: DataFrame, path: str) -> None:
    """Refuse a scanned feed holding files that are neither load nor dated change files.

    The name test runs inside the file index that the scan has already listed, so a
    clean feed leaves no partition to read and starts no job."""
    odd = feed.where(file_kind(F.col(FILE_NAME)) == "other")
    if odd.rdd.getNumPartitions() == 0:
        return
    listed = list_feed(feed.sparkSession, path).where(F.col("kind") == "other")
    names = ", ".join(row.path for row in listed.select("path").take(3))
    raise ValueError(f"feed file names must start with {LOAD_PREFIX} or YYYYMMDD: {names}")


def select_files(feed: DataFrame, first: date, last: date, with_load: bool) -> DataFrame:
    """Rows of change files named after a day in [first, last], plus load files if asked."""
    name = F.col(FILE_NAME)
    wanted = ~is_load(name) & F.substring(name, 1, 8).between(compact(first), compact(last))
    return feed.where(is_load(name) | wanted if with_load else wanted)


def select_load_files(feed: DataFrame) -> DataFrame:
    return feed.where(is_load(F.col(FILE_NAME)))


def rebase_load(feed: DataFrame, day: date) -> DataFrame:
    """Stamp load rows with the first moment of a day; changes keep their time."""
    stamp = F.when(F.col(IS_CHANGE) == 0, F.lit(midnight(day))).otherwise(F.col(STAMP))
    return feed.withColumn(STAMP, stamp)
