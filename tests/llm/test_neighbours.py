from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import neighbours
from tidemark.llm.neighbours import balanced_parts, learn_router, nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, part int, score string"
def every_tenth():
    return F.col("vec_id") % 10 == 0



def vectors(n=1500, d=12, seed=0):
    made = np.random.default_rng(seed)
    return (made.standard_normal((25, d))[made.integers(0, 25, n)] + 0.4 * made.standard_normal((n, d))).astype(np.float32)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "s") for i, v in rows], SCHEMA)


def brute_force(rows, k=10):
    good = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    lengths = [len(v) for _, v in good]
    size = max(sorted(set(lengths)), key=lengths.count) if good else 0
    good = [(i, v) for i, v in good if len(v) == size]
    out = {}
    for q, x in good:
        if q % 10 == 0:
            near = sorted((float(np.sqrt(((v - x) ** 2).sum())), i) for i, v in good if i != q)
            out[q] = near[:k]
    return out


def found(df, k=10):
    out = {}
    for r in sorted(nearest_neighbours(df, every_tenth(), k).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART_ROWS", 150)
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    monkeypatch.setattr(neighbours, "SAMPLE", 800)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors())]
    got, true = found(frame(spark, rows)), brute_force(rows)
    assert got.keys() == true.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in true[q]}) for q in true)
    assert hits >= 0.9 * sum(map(len, true.values()))
    for q, near in got.items():  # exact scores, nearest first, ties to the smaller id
        assert near == sorted(near)
        exact = dict((i, s) for s, i in brute_force([r for r in rows if r[0] == q or r[0] in {i for _, i in near}])[q])
        assert all(s == pytest.approx(exact[i], abs=1e-12) for s, i in near)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [1.0, 0.5]), (8, [2.0, 2.0, 2.0]), (None, [1.0, 0.0]), (10, [1.0, 0.5]), (11, []), (20, None)]
    got, true = found(frame(spark, rows)), brute_force(rows)
    assert got == true == {0: [(0.5, 1), (0.5, 7), (0.5, 10)], 10: [(0.0, 1), (0.0, 7), (0.5, 0)]}
    assert found(frame(spark, rows), k=1) == {0: [(0.5, 1)], 10: [(0.0, 1)]}
    assert found(frame(spark, [])) == found(frame(spark, [(10, [1.0, 2.0])])) == {}


def test_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(600)] + [(1000 + i, v.tolist()) for i, v in enumerate(vectors(300, 3))]
    got = found(frame(spark, rows))
    for q in range(0, 600, 10):
        assert got[q] == [(0.0, i) for i in range(11) if i != q][:10]


def test_small_parts_are_topped_up(spark, monkeypatch):
    """Every query goes to its own part only, and one part holds fewer rows than a query needs."""
    def lopsided(x, parts):
        second = np.zeros((neighbours.HIDDEN + 3, 3))
        second[neighbours.HIDDEN] = [50.0, 0.0, -50.0]  # the first part holds x > 0, the last x < 0, the other none
        router = neighbours.Router(np.zeros(2), np.ones(2), np.zeros((3, neighbours.HIDDEN)), second)
        router.enough = 0.0
        return router

    monkeypatch.setattr(neighbours, "learn_router", lopsided)
    monkeypatch.setattr(neighbours, "PART_ROWS", 30)
    rows = [(i, [1.0, i / 100]) for i in range(1, 95)] + [(100, [-1.0, 0.0]), (100, [-1.0, 0.5]), (101, [-1.0, 1.0])]
    got = found(frame(spark, rows))
    assert got.keys() == {*range(10, 100, 10), 100} and all(len(near) == 10 for near in got.values())
    assert 101 in {i for _, i in got[100]}


def test_parts_are_balanced_and_learned():
    x = vectors(900).astype(np.float64)
    part = balanced_parts(x, 8)
    sizes = np.bincount(part, minlength=8)
    assert sizes.min() >= 0.8 * 900 / 8 and sizes.max() <= 1.2 * 900 / 8
    router = learn_router(x, 8)
    p = router.probabilities(x)
    assert p.sum(axis=1) == pytest.approx(np.ones(900)) and 0 < router.enough <= 1.0 + 1e-9
    order, before = router.ranked(x)
    assert (np.diff(before, axis=1) >= -1e-12).all() and (before[:, 0] == 0).all() and (order[:, 0] == p.argmax(axis=1)).all()


def test_other_element_types(spark):
    schema = T.StructType().add("vec_id", "long").add("embedding", T.ArrayType(T.DoubleType()))
    rows = [(i, [float(i), 1.0]) for i in range(1, 25)]
    out = nearest_neighbours(spark.createDataFrame(rows, schema), every_tenth(), 2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in out] == [(10, 9, 1.0), (10, 11, 1.0), (20, 19, 1.0), (20, 21, 1.0)]
