"""The record, beside a table's folder, of what a publication is about to make appear.

Files come first and the catalog entry after them, and replacing an entry under other columns is a drop and a
create; a driver can die between any two of these. So the record says, before the first file, which
folder is being written ("writing"), and once the files are complete, which entry is to show them
("written"). The next run finishes what is written, clears what is not, and can tell both from data that
belongs to someone else: files below a root that neither the catalog nor the record knows are foreign.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.functions.files import read_text, remove, write_text
from tidemark.spec import Target

# Spark hides folders with a leading underscore from readers of the parent folder.
STAGING = "_staging"

WRITING, WRITTEN = "writing", "written"


def staging_root(target: Target) -> str:
    """Beside the table's folder: as durable as the table, and outside what is replaced."""
    parent, name = target.root.rsplit("/", 1)
    return f"{parent}/{STAGING}/{name}"


def record_folder(target: Target) -> str:
    return f"{staging_root(target)}/publication"


@dataclass(frozen=True)
class Publication:
    """Files of one folder and the catalog entry that shows them.

    `before` is the creation time of the entry that the publication replaces, None when there
    was none: an entry made since by other means is not touched. `also` are folders of
    earlier versions that are written along."""

    table: str
    path: str
    schema: str
    partition_keys: tuple[str, ...]
    fmt: str
    buckets: int | None
    bucket_keys: tuple[str, ...]
    before: str | None
    also: tuple[str, ...] = ()

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))

    def of(self, target: Target) -> Target:
        """The target as it was when the files were written."""
        return replace(target, fmt=self.fmt, buckets=self.buckets, bucket_keys=self.bucket_keys)


def _last_name(table: str) -> str:
    return table.rpartition(".")[2].lower()


def publication(
    target: Target,
    schema: T.StructType,
    path: str,
    partition_keys: Sequence[str] | None,
    before: str | None,
    also: Sequence[str] = (),
) -> Publication:
    return Publication(
        table=target.table,
        path=path,
        schema=schema.json(),
        partition_keys=tuple(partition_keys or ()),
        fmt=target.fmt,
        buckets=target.buckets,
        bucket_keys=target.bucket_keys,
        before=before,
        also=tuple(also),
    )


def note(spark: SparkSession, target: Target, state: str, made: Publication) -> None:
    """Enter a publication; a state replaces the one before it."""
    folder = record_folder(target)
    write_text(spark, f"{folder}/{state}.json", json.dumps(asdict(made)))
    remove(spark, f"{folder}/{WRITING if state == WRITTEN else WRITTEN}.json")


def clear(spark: SparkSession, target: Target) -> None:
    """The catalog shows what the record announced. "Written" goes last: found alone, it is
    only repeated."""
    for state in (WRITING, WRITTEN):
        remove(spark, f"{record_folder(target)}/{state}.json")


def pending(spark: SparkSession, target: Target) -> tuple[str, Publication] | None:
    """What a publication that was cut off had announced, and how far it had come."""
    for state in (WRITTEN, WRITING):
        text = read_text(spark, f"{record_folder(target)}/{state}.json")
        if text is not None:
            found = json.loads(text)
            for name in ("partition_keys", "bucket_keys", "also"):
                found[name] = tuple(found[name])
            made = Publication(**found)
            if _last_name(made.table) == _last_name(target.table):
                return state, made
    return None
