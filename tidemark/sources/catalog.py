"""What the catalog knows about a published table."""

from __future__ import annotations

import json
import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import as_date
from tidemark.spec import FLAT, PARTITION

_VERSION = re.compile(r"/version=(\d{4}-\d{2}-\d{2})/?$")


def table_exists(spark: SparkSession, table: str) -> bool:
    """True for `table` or `database.table`; a missing database is simply False."""
    return spark.catalog.tableExists(table)


def describe(spark: SparkSession, table: str) -> dict | None:
    """Catalog entry of a table, or None when there is none."""
    if not table_exists(spark, table):
        return None
    row = spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()
    return json.loads(row.json_metadata)


def partitions(spark: SparkSession, table: str) -> DataFrame:
    """One row per partition, in the catalog's `key=value` form."""
    return spark.sql(f"SHOW PARTITIONS {table}")


def last_partition(spark: SparkSession, table: str) -> date | None:
    """Newest date partition, ignoring the null one; None when there is none."""
    entry = describe(spark, table)
    if entry is None:
        return None
    if entry.get("partition_columns") != [PARTITION]:
        raise ValueError(f"{table} is not partitioned by {PARTITION}: use a flat run for it")
    day = F.try_to_date(F.substring_index("partition", "=", -1))
    return partitions(spark, table).agg(F.max(day).alias("day")).first().day


def current_version(spark: SparkSession, table: str) -> date | None:
    """Version in the table's location; None when the table does not exist."""
    entry = describe(spark, table)
    if entry is None:
        return None
    found = _VERSION.search(entry.get("location") or "")
    if not found:
        raise ValueError(f"{table} has no version folder: use a partitioned run for it")
    return as_date(found.group(1))


def last_published(spark: SparkSession, table: str, mode: str) -> date | None:
    return current_version(spark, table) if mode == FLAT else last_partition(spark, table)
