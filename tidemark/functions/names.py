"""Column names with arbitrary characters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cols(names: Iterable[str], side: str | None = None) -> list[Column]:
    """Columns by exact name, optionally of one aliased side of a join."""
    prefix = f"{side}." if side else ""
    return [F.col(prefix + quoted(name)) for name in names]
