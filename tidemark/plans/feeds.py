"""Change feeds derived from the benchmark tables, and their export as feed files.

Two feeds: A from `events`, keyed by user, with change times cut to the hour so that
many changes of a user tie; B from `orders`, keyed by customer, with change times by
the day and a hundred files a day.
"""

from __future__ import annotations

from datetime import date
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.names import cols
from tidemark.scratch import scratch_path
from tidemark.spec import FILE_NAME, FILE_PATH, IS_CHANGE, OP, ROW_INDEX, STAMP, FeedSpec

A_START, A_MID, A_END = date(2024, 1, 1), date(2024, 1, 15), date(2024, 1, 30)
B_START, B_MID, B_END = date(1995, 1, 1), date(1998, 6, 30), date(2001, 8, 1)

SPEC_A = FeedSpec(
    path="derived from events",
    primary_keys=("user_id",),
    schema=T.StructType()
    .add("user_id", "long")
    .add("event_type", "string")
    .add("value", "double")
    .add("event_date", "date"),
    cdc_start_date=A_START,
    partition_date="event_date",
)
SPEC_A2 = FeedSpec(
    path="derived from events",
    primary_keys=("user_id", "event_type"),
    schema=SPEC_A.schema,
    cdc_start_date=A_START,
)
SPEC_B = FeedSpec(
    path="derived from orders",
    primary_keys=("c_custkey",),
    schema=T.StructType()
    .add("c_custkey", "long")
    .add("amount", "double")
    .add("priority", "string")
    .add("order_date", "date"),
    cdc_start_date=B_START,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _stamp(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def feed_a(spark: SparkSession, folder: str) -> DataFrame:
    """`error` events delete a user, `signup` inserts; views carry no value."""
    kind, ts = F.col("event_type"), F.col("ts")
    name = F.concat(F.date_format(ts, "yyyyMMdd"), F.lit("-000000000.parquet"))
    return table(spark, folder, "events").select(
        F.when(kind == "error", "D").when(kind == "signup", "I").otherwise("U").alias(OP),
        _stamp(F.date_trunc("hour", ts)).alias(STAMP),
        "user_id",
        "event_type",
        F.when(kind != "view", F.col("value")).alias("value"),
        F.to_date(ts).alias("event_date"),
        name.alias(FILE_NAME),
        F.lit(1).alias(IS_CHANGE),
        name.alias(FILE_PATH),
        F.col("event_id").alias(ROW_INDEX),
    )


def feed_b(spark: SparkSession, folder: str) -> DataFrame:
    """Finished orders delete a customer, open ones insert; some orders have no amount."""
    status, day = F.col("o_orderstatus"), F.col("o_orderdate")
    number = F.lpad((F.col("o_orderkey") % 100).cast("string"), 9, "0")
    name = F.concat(F.date_format(day, "yyyyMMdd"), F.lit("-"), number, F.lit(".parquet"))
    unspecified = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    return table(spark, folder, "orders").select(
        F.when(status == "F", "D").when(status == "O", "I").otherwise("U").alias(OP),
        _stamp(day).alias(STAMP),
        F.col("o_custkey").alias("c_custkey"),
        F.when(~unspecified, F.col("o_totalprice")).alias("amount"),
        F.col("o_orderpriority").alias("priority"),
        F.to_date(day).alias("order_date"),
        name.alias(FILE_NAME),
        F.lit(1).alias(IS_CHANGE),
        name.alias(FILE_PATH),
        F.col("o_orderkey").alias(ROW_INDEX),
    )


def load_a(spark: SparkSession, folder: str) -> DataFrame:
    """All customers as load rows of feed A; load rows have no code and no time."""
    name = F.lit("LOAD00000001.parquet")
    return table(spark, folder, "customer").select(
        F.lit(None).cast("string").alias(OP),
        F.lit(None).cast("string").alias(STAMP),
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("event_type"),
        F.col("c_acctbal").alias("value"),
        F.lit(date(2023, 12, 31)).alias("event_date"),
        name.alias(FILE_NAME),
        F.lit(0).alias(IS_CHANGE),
        name.alias(FILE_PATH),
        F.col("c_custkey").alias(ROW_INDEX),
    )


def previous_a(spark: SparkSession, folder: str, day: date = date(2023, 12, 31)) -> DataFrame:
    """All suppliers as the previous snapshot of feed A; more users than these have events."""
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("user_id"),
        F.col("s_name").alias("event_type"),
        F.col("s_acctbal").alias("value"),
        F.lit(day).alias("event_date"),
    )


def previous_b(spark: SparkSession, folder: str) -> DataFrame:
    """All suppliers as the previous snapshot of feed B, whose keys are customers."""
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"),
        F.col("s_acctbal").alias("amount"),
        F.col("s_name").alias("priority"),
        F.lit(date(1994, 12, 31)).alias("order_date"),
    )


def skewed_b(spark: SparkSession, folder: str) -> DataFrame:
    """All orders as a previous snapshot of feed B; a third of them hold the key of one customer."""
    third = F.col("o_orderkey") % 3 == 0
    return table(spark, folder, "orders").select(
        F.when(third, 1).otherwise(F.col("o_custkey")).cast("long").alias("c_custkey"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("priority"),
        F.to_date("o_orderdate").alias("order_date"),
    )


def export_files(feed: DataFrame, spec: FeedSpec, with_stamp: bool = True) -> str:
    """Write a derived feed the way an exporter would: dated change files and LOAD files
    in one folder, rows in feed order. Returns the folder.

    Large days become several files: rows are cut into ranges of (day, position), and
    the range number, which grows with the position, names the file within its day."""
    spark = feed.sparkSession
    folder, work = scratch_path(spark, "feed"), scratch_path(spark, "export")
    head = [OP, STAMP] if with_stamp else []
    label = F.when(F.col(IS_CHANGE) == 0, "LOAD").otherwise(F.substring(FILE_NAME, 1, 8))
    (
        feed.withColumn("_cdc_label", label)
        .repartitionByRange("_cdc_label", ROW_INDEX)
        .sortWithinPartitions("_cdc_label", ROW_INDEX)
        .select(*cols(head + spec.columns), "_cdc_label")
        .write.partitionBy("_cdc_label")
        .parquet(work)
    )
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(work).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop.Path(folder))
    for found in files.globStatus(hadoop.Path(f"{work}/_cdc_label=*/part-*")):
        label = found.getPath().getParent().getName().split("=")[1]
        number = found.getPath().getName().split("-")[1]
        files.rename(found.getPath(), hadoop.Path(f"{folder}/{label}-{number}.parquet"))
    return folder


def fresh_table(label: str) -> str:
    return f"{label}_{uuid4().hex[:12]}"
