"""Intermediate tables in the folder that every executor can reach, and who removes them.

All lie in one folder an application, which goes when the application ends. Within `owned_scratch` they
go when the block ends, whether it ends well or not."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.files import file_system, remove

SETTING = "spark.checkpoint.dir"

_owner: ContextVar[list[Callable[[], None]] | None] = ContextVar("owner", default=None)
_marked: set[str] = set()


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only for local masters."""
    named = spark.conf.get(SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


def application_folder(spark: SparkSession) -> str:
    """The folder of this application, which its file system removes when the driver ends."""
    folder = f"{scratch_root(spark)}/tidemark/{spark.sparkContext.applicationId}"
    if folder not in _marked:
        files, where = file_system(spark, folder)
        files.mkdirs(where)
        files.deleteOnExit(where)
        _marked.add(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{application_folder(spark)}/{label}-{uuid4().hex}"
    on_release(lambda: remove(spark, path))
    return path


def on_release(undo: Callable[[], None]) -> None:
    """Have something undone when the enclosing `owned_scratch` ends, if there is one."""
    owned = _owner.get()
    if owned is not None:
        owned.append(undo)


@contextmanager
def owned_scratch() -> Iterator[None]:
    """Removes what is stored within when the block ends; frames that read it are of no use after that."""
    owned: list[Callable[[], None]] = []
    token = _owner.set(owned)
    try:
        yield
    finally:
        _owner.reset(token)
        for undo in reversed(owned):
            undo()


def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write a frame once and read it back: cuts lineage, gives Catalyst its size,
    and lets each later use read only the columns it needs."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table; a path already gone is no error."""
    remove(spark, path)
