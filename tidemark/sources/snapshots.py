"""Reading snapshots by path: the current one, an older version, or none yet."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import as_date
from tidemark.functions.frames import empty_frame
from tidemark.spec import Target


def load_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """A stored frame under a fixed schema; an empty one when the path does not exist."""
    try:
        return spark.read.load(path, format=fmt, schema=schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, schema)


def version_as_of(
    spark: SparkSession, target: Target, version: date | str, schema: T.StructType
) -> DataFrame:
    """One published version, still readable after newer ones; lists only its own files."""
    return load_or_empty(spark, target.version_path(as_date(version)), schema, target.fmt)


def all_versions(spark: SparkSession, target: Target, schema: T.StructType) -> DataFrame:
    """Every version side by side, with its date in the partition column `version`."""
    with_version = T.StructType(schema.fields + [T.StructField("version", T.DateType())])
    frame = load_or_empty(spark, target.root, with_version, target.fmt)
    return frame.where(F.col("version").isNotNull())
