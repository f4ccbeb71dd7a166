"""Fill-in-middle against a plain version, and the skip list against sums."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import odd_rows, table
from tidemark.llm.fill_in_middle import FAN, SkipList, fill_in_middle, restored, unit_widths

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_version(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def cut_rows(docs):
    out = fill_in_middle(docs)
    back = restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", back.alias("back")).collect()


@given(st.lists(st.integers(0, 50), max_size=5 * FAN * FAN))
@settings(max_examples=50, deadline=None)
def test_every_rank_is_reached(widths):
    units = SkipList(np.array(widths, np.int64))
    assert [units.seek(r) for r in range(len(widths) + 1)] == np.cumsum([0, *widths]).tolist()


def test_ranks_outside():
    units = SkipList(np.array([3, 4]))
    for rank in (-1, 3):
        with pytest.raises(IndexError):
            units.seek(rank)


@given(st.text(alphabet=" \t\n\x0b\x0c\r\x1c\xa0aé日𝒳<P>", max_size=60))
def test_units(text):
    data = np.frombuffer(text.encode(), np.uint8)
    assert unit_widths(data).tolist() == [len(u) for u in UNIT.findall(text)]


def test_odd_rows(odd, nothing):
    docs = odd.select("doc_id", "text")
    rows = cut_rows(docs)
    assert Counter(r[:6] for r in map(tuple, rows)) == Counter(plain_version(i, t) for i, t, *_ in odd_rows())
    assert Counter((r.doc_id, r.back) for r in rows) == Counter((i, t or "") for i, t, *_ in odd_rows())
    assert cut_rows(nothing) == []


def test_marks_in_parts(spark):
    texts = ["a < P> b <", "<P", "x <S <M y <P", "<<P> z", "a <M> b", "<S>", "é <P 日本 <S\n<M 𝒳 " * 50, " \n ", "word " * 40]
    made = [(i, texts[i % len(texts)]) for i in range(300)]
    rows = cut_rows(table(spark, *made))
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert Counter(tuple(r)[:6] for r in rows) == Counter(plain_version(i, t) for i, t in made)
    assert all(r.back == texts[r.doc_id % len(texts)] for r in rows)


def test_long_text(spark):
    text = " ".join(f"wörd{i}" for i in range(300_000))
    assert {tuple(r)[:6] for r in cut_rows(table(spark, *((i, text) for i in range(4))))} == {
        plain_version(i, text) for i in range(4)
    }


def test_other_columns_stay_and_no_shuffle(spark, odd):
    docs = odd.withColumn("output", F.lit(1)).withColumn("N", F.lit(2)).withColumn("cuts", F.lit(3))
    out = fill_in_middle(docs)
    assert out.columns == [*docs.columns, "n_", "form", "prefix_chars", "middle_chars", "output_"]
    assert Counter(map(str, out.select(docs.columns).collect())) == Counter(map(str, docs.collect()))
    plan = fill_in_middle(spark.range(3).selectExpr("id AS doc_id", "'a b' AS text"))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
