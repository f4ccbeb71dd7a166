"""Small files and folders, through the file system their path belongs to."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system of a path and the path as it takes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern with wildcards matches; none where the folder is missing."""
    files, where = file_system(spark, pattern)
    return [found.getPath().toString() for found in files.globStatus(where) or []]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder; one already gone is no error."""
    files, where = file_system(spark, path)
    files.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a small file appear whole: written under another name, then renamed."""
    files, where = file_system(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = files.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    files.delete(where, False)
    if not files.rename(part, where):
        raise OSError(f"cannot rename {path}.part")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None when there is no such file."""
    files, where = file_system(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
