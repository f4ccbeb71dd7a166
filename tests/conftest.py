from __future__ import annotations

import sys
from datetime import date
from pathlib import Path
from uuid import uuid4

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.spec import FeedSpec, Target  # noqa: E402

START = date(2021, 3, 5)

SCHEMA = (
    T.StructType()
    .add("id", "integer")
    .add("name", "string")
    .add("city", "string")
    .add("day", "date")
)

ARROW = {
    "Op": pa.string(),
    "cdc_timestamp": pa.string(),
    "id": pa.int32(),
    "name": pa.string(),
    "city": pa.string(),
    "day": pa.date32(),
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[2]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


class Feed:
    """A feed folder with hand-written files."""

    def __init__(self, folder: Path):
        self.folder = folder
        folder.mkdir(parents=True)

    def write(self, name: str, *rows: dict, columns=None, row_group: int | None = None) -> None:
        names = columns or list(ARROW)
        table = pa.table(
            {n: pa.array([row.get(n) for row in rows], ARROW[n]) for n in names}
        )
        path = self.folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        pq.write_table(table, path, row_group_size=row_group)

    def load(self, name: str, *rows: dict) -> None:
        self.write(name, *rows, columns=["id", "name", "city", "day"])

    def spec(self, **changes) -> FeedSpec:
        settings = dict(
            path=str(self.folder),
            primary_keys=("id",),
            schema=SCHEMA,
            cdc_start_date=START,
            partition_date="day",
        )
        return FeedSpec(**{**settings, **changes})


def change(op, stamp, id, name=None, city=None, day=None) -> dict:
    if stamp is not None and len(stamp) == 19:
        stamp += ".000000"
    return {"Op": op, "cdc_timestamp": stamp, "id": id, "name": name, "city": city, "day": day}


@pytest.fixture
def feed(tmp_path):
    return Feed(tmp_path / "feed")


@pytest.fixture
def target(spark, tmp_path):
    name = f"t_{uuid4().hex[:10]}"
    yield Target(name, str(tmp_path / name))
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows(df, *columns):
    """Rows as a sorted list of tuples, nulls last."""
    picked = df.select(*columns) if columns else df
    return sorted(map(tuple, picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
