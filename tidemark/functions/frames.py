"""Frames without rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows under a schema, in a form that Catalyst folds out of joins and unions."""
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*nothing).where(F.lit(False))
