"""What the operators of this package share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Stands for a null id where ids are ordered: no id is smaller.
NULL_ID = -(2**63)


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did; a cluster whose executors do
    not share that folder gets the package with `--py-files`."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(name: str) -> Column:
    """The text, a null one as the empty one."""
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; `lower` does that where all characters are ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of the frame has it (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows per Arrow batch for the jobs started within: long texts make large batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
