"""The stages one after another, each against a plain version on the stage's own input."""

from __future__ import annotations

import os
from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.test_exact_dups import LOWER
from tests.llm.test_near_dups import brute_force
from tidemark.llm.queries import MAX_REPEATS, QUERIES
from tidemark.llm.toxicity import Restorer, train

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Name, input rows and output rows of every stage."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, FOLDER)
        made.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


@pytest.fixture(scope="module")
def odd_stages(spark, odd, tmp_path_factory):
    """The same from odd rows: nulls, empty and long texts, ties, repeated rows and ids, clashing columns."""
    folder = tmp_path_factory.mktemp("odd")
    docs, out = odd, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_odd_rows_toxicity(spark, odd_stages):
    before, after = odd_stages["toxicity"]
    assert Counter(after.collect()) == Counter(before.collect())


def test_odd_rows_exact_dedup(odd_stages):
    before, after = odd_stages["exact dedup"]
    last = {}
    for r in before.collect():
        key = (r.text or "").translate(LOWER)
        last.setdefault(key, []).append(r)
    rank = lambda i: (i is not None, i or 0)
    kept = after.collect()
    assert Counter((r.text or "").translate(LOWER) for r in kept) == Counter(last.keys())
    for r in kept:
        group = last[(r.text or "").translate(LOWER)]
        assert r in group and rank(r.doc_id) == max(rank(g.doc_id) for g in group)


def test_odd_rows_near_dedup(odd_stages):
    before, after = odd_stages["MinHash near dedup"]
    found = brute_force([(r.doc_id, r.text) for r in before.collect()], 80)
    kept = Counter({i: n for (i, _, c), n in found.items() if i == c})
    want = Counter()
    for (i, _, c), n in found.items():
        want[i] += n * (i == c)
    assert Counter(r.doc_id for r in after.collect()) == +want and kept


def test_odd_rows_mixing(odd_stages):
    before, after = odd_stages["mix sources"]
    assert set(after.collect()) == set(before.collect())


def test_odd_rows_packing(odd_stages):
    before, after = odd_stages["pack"]
    pieces = after.collect()
    assert Counter(r.doc_id for r in pieces if r.start == 0) == Counter(r.doc_id for r in before.collect())
    assert min(r.doc_tokens for r in pieces) == 1  # an empty text is its end alone
    used = Counter()
    for r in pieces:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 4096


def test_stages_of_an_empty_table(spark, nothing):
    docs = nothing
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0
        if name != "pack":
            assert out.columns == nothing.columns


def test_order_and_columns(stages):
    assert list(stages) == ["toxicity", "exact dedup", "MinHash near dedup", "mix sources", "pack"]
    for name, (before, after) in stages.items():
        if name != "pack":
            assert after.columns == before.columns


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    model = train(before, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = before.collect()
    scores = model.scores([r.text for r in rows], Restorer(model.chars))
    assert Counter(after.collect()) == Counter(r for r, s in zip(rows, scores, strict=True) if s < 0.5)


def test_exact_dedup(stages):
    before, after = stages["exact dedup"]
    last = {}
    for r in before.collect():
        key = (r.text or "").translate(LOWER)
        last[key] = max(last.get(key, r), r, key=lambda x: x.doc_id)
    assert Counter(after.collect()) == Counter(last.values())


def test_near_dedup(stages):
    before, after = stages["MinHash near dedup"]
    kept = Counter(i for i, _, c in brute_force([(r.doc_id, r.text) for r in before.collect()], 80) if i == c)
    assert Counter(r.doc_id for r in after.collect()) == kept


def test_mixing(stages):
    before, after = stages["mix sources"]
    assert set(after.collect()) == set(before.collect())
    assert max(Counter(after.collect()).values()) <= MAX_REPEATS + 1


def test_packing(stages):
    before, after = stages["pack"]
    pieces = after.collect()
    whole = Counter((r.doc_id, r.doc_tokens) for r in pieces if r.start == 0)
    assert Counter(i for i, _ in whole.elements()) == Counter(r.doc_id for r in before.collect())
    assert sum(r.length for r in pieces) == sum(t * n for (_, t), n in whole.items())
    used = Counter()
    for r in pieces:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 4096 and sum(4096 - n for n in used.values()) < 4096 * after.rdd.getNumPartitions()


def test_run(spark, stages):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_every_operator_is_registered(spark):
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))


def test_whole_tables_are_read(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for name in ("op2_token_counts", "op9_surrogates"):
        assert QUERIES[name](spark, FOLDER).count() == documents
