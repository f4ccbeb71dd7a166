"""Feed files whose columns do not fit the fixed schema, found from their footers.

Spark meets such a file when it reads its rows, as an error of some task late in a run, or not at all: a date
under an integer is read as a number of days. The footers of all files that a run selects are a few kilobytes each; tasks read
them, and what they say is compared with the schema before any row is read."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.feed import list_feed, list_selected
from tidemark.spec import FeedSpec

FITS, MISSING, EXTRA, MISFIT = "fits", "missing", "extra", "misfit"

COLUMNS = "path string, name string, kind string"

#: Footers that one task reads, about.
FILES_A_TASK = 64

#: Kinds of column that the Parquet reader takes for a kind that the schema asks for, besides the
#: kind itself.
TAKEN = {
    "int64": ["int32"],
    "double": ["float", "int32"],
    "string": ["binary"],
    "binary": ["string"],
    "timestamp": ["timestamp_ntz"],
    "timestamp_ntz": ["timestamp", "date"],
}


def footer_kind(found: pa.DataType) -> str:
    """What the reader makes of a column: names of Spark's types, all narrow integers as one."""
    types = pa.types
    narrow = types.is_int8(found) or types.is_int16(found) or types.is_int32(found) or types.is_uint8(found)
    tests = (
        (narrow or types.is_uint16(found), "int32"),
        (types.is_int64(found) or types.is_uint32(found), "int64"),
        (types.is_float32(found), "float"),
        (types.is_float64(found), "double"),
        (types.is_decimal(found), "decimal"),
        (types.is_boolean(found), "boolean"),
        (types.is_date(found), "date"),
        (types.is_timestamp(found), "timestamp" if getattr(found, "tz", None) else "timestamp_ntz"),
        (types.is_string(found) or types.is_large_string(found), "string"),
        (types.is_binary(found) or types.is_large_binary(found), "binary"),
        (types.is_struct(found), "struct"),
        (types.is_map(found), "map"),
        (types.is_list(found) or types.is_large_list(found), "array"),
    )
    return next((kind for holds, kind in tests if holds), str(found))


def wanted_kind(wanted: T.DataType) -> str:
    """The same names for a type of the schema."""
    if isinstance(wanted, (T.ByteType, T.ShortType, T.IntegerType)):
        return "int32"
    if isinstance(wanted, T.LongType):
        return "int64"
    if isinstance(wanted, (T.CharType, T.VarcharType)):
        return "string"
    return wanted.typeName()


def open_file(path: str) -> pa.NativeFile:
    scheme = urlsplit(path).scheme
    if not scheme:
        return pa.fs.LocalFileSystem().open_input_file(path)
    system, inner = pa.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return system.open_input_file(inner)


def read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple[str, str, str]] = []
        for path in batch.column(0).to_pylist():
            with open_file(path) as file:
                rows += [(path, field.name, footer_kind(field.type)) for field in pq.read_schema(file)]
        columns = zip(*rows, strict=True) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["path", "name", "kind"])


def footer_columns(files: DataFrame) -> DataFrame:
    """path, name and kind of every column in the footers of some files (column `path`), read in tasks."""
    tasks = max(1, -(-files.count() // FILES_A_TASK))
    return files.select("path").repartition(tasks).mapInArrow(read_footers, COLUMNS)


def _wanted(spec: FeedSpec) -> list[tuple[str, str, list[str]]]:
    kinds = [(f.name, wanted_kind(f.dataType)) for f in spec.envelope.fields]
    return [(name, kind, [kind, *TAKEN.get(kind, ())]) for name, kind in kinds]


def compare_footers(spec: FeedSpec, files: DataFrame) -> DataFrame:
    """One row per file and column: path, name, found, wanted, verdict.

    A column is extra (it is ignored), missing (it reads as null), or there; then it fits or is a misfit:
    the reader fails with it, or takes it for a bare number, as it does with dates under an integer. Names are compared as the session compares them, without regard to case."""
    found = footer_columns(files).select("path", F.col("name").alias("found_name"), F.col("kind").alias("found"))
    fields = [
        F.struct(F.lit(n).alias("wanted_name"), F.lit(k).alias("wanted"), F.array(*map(F.lit, a)).alias("accepted"))
        for n, k, a in _wanted(spec)
    ]
    wanted = F.explode(F.array(*fields))
    here = files.select("path", wanted.alias("of")).select("path", "of.*").withColumn("key", F.lower("wanted_name"))
    there = found.withColumn("key", F.lower("found_name"))
    both = here.join(there, ["path", "key"], "full_outer")
    return both.select(
        "path",
        F.coalesce("wanted_name", "found_name").alias("name"),
        "found",
        "wanted",
        _verdict().alias("verdict"),
    )


def _verdict() -> Column:
    return (
        F.when(F.col("wanted").isNull(), EXTRA)
        .when(F.col("found").isNull(), MISSING)
        .when(F.array_contains("accepted", F.col("found")), FITS)
        .otherwise(MISFIT)
    )


def check_footers(spark: SparkSession, spec: FeedSpec, first: date, last: date, with_load: bool) -> None:
    """Refuse a run whose files hold columns that cannot be read under the schema, naming some of them."""
    files = list_selected(list_feed(spark, spec.path), first, last, with_load)
    compared = compare_footers(spec, files)
    bad = compared.where(F.col("verdict") == MISFIT).orderBy("path", "name").take(3)
    if bad:
        named = "; ".join(f"{r.path.rsplit('/', 1)[1]}: {r.name} is {r.found}, not {r.wanted}" for r in bad)
        raise ValueError(f"feed files do not fit the schema: {named}")
