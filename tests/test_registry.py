"""Every registered query against its SQL, as the driver compares them."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as registry
import check
from tidemark.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")


@pytest.fixture(scope="module")
def connection():
    return check.database(FOLDER)


@pytest.fixture(scope="module", autouse=True)
def compiled(spark):
    """Other tests interpret plans to save time; these run the code that users run."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query(spark, connection, name):
    assert check.difference(spark, connection, name, FOLDER) is None
