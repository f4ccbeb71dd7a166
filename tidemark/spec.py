"""What a feed looks like, where its snapshots go, and how a run may be tuned."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import types as T

from tidemark.functions.dates import as_date

# The envelope columns the exporter puts in front of every row,
# the only operation code with a meaning of its own, the partition column, and what
# the folder of a version is named after.
OP = "Op"
STAMP = "cdc_timestamp"
DELETE = "D"
PARTITION = "dt"
VERSION = "version"

# Columns added while a feed is processed; a payload may not use this prefix.
RESERVED = "_cdc_"
IS_CHANGE = "_cdc_is_change"
FILE_NAME = "_cdc_file_name"
FILE_PATH = "_cdc_file_path"
ROW_INDEX = "_cdc_row_index"

FLAT, PARTITIONED = "flat", "partitioned"

# Ways to bring changes and the previous snapshot together.
MERGES = ("broadcast_delta", "split", "sort_merge")


# Scheme and bucket or host of a path.
_AUTHORITY = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/]*)?")


def _one_of(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, not {value!r}")


@dataclass(frozen=True)
class FeedSpec:
    """One source table: where its files are, its key and its fixed schema."""

    path: str
    primary_keys: tuple[str, ...]
    schema: T.StructType
    cdc_start_date: date
    partition_date: str | None = None
    read_options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        keys = self.primary_keys
        object.__setattr__(self, "primary_keys", (keys,) if isinstance(keys, str) else tuple(keys))
        object.__setattr__(self, "cdc_start_date", as_date(self.cdc_start_date))
        object.__setattr__(self, "partition_date", self.partition_date or None)
        if not self.primary_keys:
            raise ValueError("a feed needs at least one primary key column")
        types = {f.name: f.dataType for f in self.schema.fields}
        if len({name.lower() for name in types}) != len(self.schema.fields):
            raise ValueError("payload column names must differ, ignoring case")
        for name in types:
            if name.lower() in (OP.lower(), STAMP) or name.lower().startswith(RESERVED):
                raise ValueError(f"payload column {name!r} clashes with the change envelope")
        for name in self.primary_keys:
            if name not in types:
                raise ValueError(f"primary key {name!r} is not in the schema")
            if isinstance(types[name], T.MapType):
                raise ValueError(f"primary key {name!r} is a map, which cannot be compared")
        if self.partition_date is not None:
            if self.partition_date not in types:
                raise ValueError(f"partition_date column {self.partition_date!r} is not in the schema")
            if PARTITION in (name.lower() for name in types):
                raise ValueError(f"payload column {PARTITION!r} clashes with the partition column")

    @classmethod
    def from_dict(cls, settings: Mapping) -> FeedSpec:
        """Build a spec from plain settings; `schema` may be a StructType or DDL text."""
        schema = settings["schema"]
        return cls(
            path=settings["path"],
            primary_keys=settings["primary_keys"],
            schema=schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema),
            cdc_start_date=settings["cdc_start_date"],
            partition_date=settings.get("partition_date"),
            read_options=settings.get("read_options") or {},
        )

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def envelope(self) -> T.StructType:
        """Schema of a change file: envelope columns first, then the payload."""
        head = [T.StructField(OP, T.StringType()), T.StructField(STAMP, T.StringType())]
        return T.StructType(head + self.schema.fields)

    def snapshot_schema(self, mode: str = FLAT) -> T.StructType:
        tail = [T.StructField(PARTITION, T.DateType())] if mode == PARTITIONED else []
        return T.StructType(self.schema.fields + tail)


@dataclass(frozen=True)
class Target:
    """A catalog table and the folder that holds its data.

    With `buckets`, versions of a flat table are bucketed by its key, so that a merge
    with many changes shuffles the changes only, not the snapshot. Choose a number that
    keeps one bucket within the memory of a task."""

    table: str
    root: str
    fmt: str = "parquet"
    max_records_per_file: int | None = None
    buckets: int | None = None
    bucket_keys: tuple[str, ...] = ()

    def __post_init__(self):
        object.__setattr__(self, "root", self.root.rstrip("/"))
        # The staging area lies beside the table's folder, so there must be a parent.
        if "/" not in _AUTHORITY.sub("", self.root, count=1):
            raise ValueError(f"table data needs a folder of its own, not {self.root!r}")

    def bucketed_by(self, keys: tuple[str, ...]) -> Target:
        return replace(self, bucket_keys=keys) if self.buckets else self

    def version_path(self, version: date | str) -> str:
        return f"{self.root}/{VERSION}={version}"


@dataclass(frozen=True)
class RunOptions:
    """Choices that change results (first three) or only the plan (the rest).

    null_policy   keep_old: a null in a change keeps the old value; overwrite: the
                  change replaces the whole row
    load_rank     first: load rows come before every change; processing_date: load
                  rows are stamped with the run date and may win over older changes
    bad_timestamp fail: malformed change times stop the run; drop: they are left out
    merge         broadcast_delta: join without moving the old snapshot as long as the
                  changes pass a size check; split: shuffle both sides, a hot old key may
                  span tasks; sort_merge: shuffle both sides once
    check_names   refuse feed folders holding files that are neither load nor change
    check_columns refuse feed files whose footers show columns that do not fit the schema
    ledger        keep a list of the files read, and read files of the last published day
                  again only where that can change a row; flat runs
    count_rows    report how many rows the date window left out, and what the run changed
    """

    null_policy: str = "keep_old"
    load_rank: str = "first"
    bad_timestamp: str = "fail"
    merge: str = "broadcast_delta"
    check_names: bool = True
    check_columns: bool = False
    ledger: bool = False
    count_rows: bool = False

    def __post_init__(self):
        _one_of("null_policy", self.null_policy, ("keep_old", "overwrite"))
        _one_of("load_rank", self.load_rank, ("first", "processing_date"))
        _one_of("bad_timestamp", self.bad_timestamp, ("fail", "drop"))
        _one_of("merge", self.merge, MERGES)


def check_mode(spec: FeedSpec, mode: str, target: Target) -> None:
    _one_of("mode", mode, (FLAT, PARTITIONED))
    if mode == PARTITIONED and target.buckets:
        raise ValueError("only flat tables can be bucketed")
    if mode == PARTITIONED and spec.partition_date is None:
        raise ValueError("a partitioned run needs partition_date in the feed spec")


def check_dates(spec: FeedSpec, as_of: date, last_date: date | None) -> None:
    """A run may repeat the last published date but never go behind it."""
    if as_of < spec.cdc_start_date:
        raise ValueError(f"run date {as_of} lies before cdc_start_date {spec.cdc_start_date}")
    if last_date is not None and as_of < last_date:
        raise ValueError(f"run date {as_of} lies before the last published date {last_date}")
