from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

#: Extra columns have names that the operators use themselves.
SCHEMA = (
    T.StructType()
    .add("doc_id", "long").add("text", "string").add("lang", "string").add("source", "string").add("n_chars", "long")
    .add("id", "string").add("score", "string").add("text_sha256", "long").add("component", "string").add("tokens", "string")
)


def words(seed: int, n: int) -> str:
    made = random.Random(seed)
    return " ".join("".join(made.choice("abcdefghij") for _ in range(made.randint(2, 7))) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties, repeated rows and copies."""
    base = words(1, 80)
    texts = [
        (1, base), (2, base.upper()), (3, base), (4, base + " Tail"), (5, None), (6, ""), (7, " \n\t "),
        (8, words(2, 30)), (8, words(2, 30)), (9, words(3, 6000)), (10, "one two three"), (11, "One two\nthree"),
        (12, "été Île ÉTÉ"), (13, words(4, 25) + " " + base), (14, "x" * 500), (15, "ab" * 300), (16, "日本語 テキスト"),
        (None, words(5, 40)), (None, None), (None, words(5, 40) + " more"), (17, words(6, 50)), (17, words(7, 50)),
    ]
    return [
        (i, t, None if n % 5 == 0 else "en", None if n % 7 == 0 else f"src{n % 3}", None, "id", "s", 1, None, "t")
        for n, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, text string")
